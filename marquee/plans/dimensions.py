"""Code dimensions that belong to the catalogue. Standard name lists come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of historic or non-standard codes that a standard list may lack.
MANUAL_COUNTRIES = {
    "SU": "Soviet Union",
    "XC": "Czechoslovakia",
    "XG": "East Germany",
    "YU": "Yugoslavia",
    "AN": "Netherlands Antilles",
    "CS": "Serbia and Montenegro",
    "XK": "Kosovo",
}
MANUAL_LANGUAGES = {
    "cn": "Cantonese",
    "xx": "No Language",
}

# Country codes of each sales region and subregion.
REGIONS = {
    ("NA", "United States"): ("US",),
    ("NA", "Canada"): ("CA", "BM"),
    ("LATAM", "Brazil"): ("BR",),
    ("LATAM", "Hispanic LATAM"): (
        "AR", "BO", "CL", "CO", "CR", "CU", "DO", "EC", "GT", "HN", "JM", "MX", "NI", "PA", "PE", "PR", "PY", "SV",
        "TT", "UY", "VE", "AN", "AW", "BB", "GD", "KY", "MQ", "BS", "HT",
    ),
    ("EMEA", "Western Europe"): ("GB", "FR", "IE", "PT", "IT", "ES", "GI", "MT", "BE", "NL", "MC"),
    ("EMEA", "DACH"): ("DE", "AT", "CH", "LI", "LU", "XG"),
    ("EMEA", "Nordics"): ("SE", "NO", "DK", "FI", "IS", "FO", "GL"),
    ("EMEA", "CEE"): (
        "PL", "CZ", "SK", "HU", "RO", "BG", "HR", "SI", "RS", "ME", "MK", "MD", "AL", "BA", "BY", "UA", "GE", "TR",
        "CY", "GR", "RU", "XK", "EE", "LT", "LV", "SU", "XC", "YU", "CS",
    ),
    ("EMEA", "MENA"): (
        "EG", "SA", "AE", "IQ", "JO", "KW", "LB", "QA", "PS", "DZ", "TN", "MA", "LY", "MR", "YE", "OM", "BH", "IL",
        "TF", "SY", "IR",
    ),
    ("EMEA", "Sub-Saharan Africa"): (
        "ZA", "NG", "KE", "ET", "GH", "TZ", "UG", "RW", "CM", "CI", "SN", "AO", "MG", "MZ", "BW", "ZW", "CD", "ML",
        "BF", "GN", "LR", "CF", "SO", "ZM", "MW", "TD", "IO", "NA", "CG", "AQ",
    ),
    ("APAC", "South Asia"): ("IN", "PK", "BD", "LK", "NP", "BT", "AF"),
    ("APAC", "North Asia"): ("JP", "KR", "TW", "HK", "MO", "MN", "KP"),
    ("APAC", "SEA"): ("ID", "TH", "PH", "MY", "SG", "VN", "KH", "LA", "MM", "BN", "TL"),
    ("APAC", "ANZ"): ("AU", "NZ", "PG"),
    ("APAC", "Central Asia"): ("KZ", "UZ", "TJ", "KG", "AZ", "AM", "TM"),
    ("APAC", "Other APAC"): ("CN", "GU", "PF", "UM", "WS"),
}
REGION_NAMES = ("NA", "LATAM", "EMEA", "APAC")

# Countries in which the service is not offered.
RESTRICTED_COUNTRIES = ("CN", "RU", "BY", "KP", "IR", "SY", "CU", "AQ")

# Minority spelling of a company and the spelling to keep.
COMPANY_SPELLINGS = {"Columbia Pictures": "Columbia Pictures Corporation"}

# Fixed value: a token that list splitting leaves behind and that is no company.
COMPANY_STOP_WORD = "the"


def region_rows() -> list[tuple[str, str, str]]:
    """(code, region, subregion) for every listed country."""
    return [(code, region, subregion) for (region, subregion), codes in REGIONS.items() for code in codes]


def region_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        region_rows(), "iso_country_code string, country_region string, country_subregion string"
    )


def manual_countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(MANUAL_COUNTRIES.items()), "iso_country_code string, country_name string"
    )


def manual_languages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(MANUAL_LANGUAGES.items()), "iso_language_code string, language_name string"
    )
