"""Clean tables: typed, deduplicated, filled from the enrichment, one row per attribute."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from marquee.contracts import SOURCE_ORDER
from marquee.functions.collections import coded_pairs, literal_broken, literal_codes, literal_fault, prefer_list
from marquee.functions.dates import parse_date
from marquee.functions.numbers import is_fractional, to_key, to_money
from marquee.functions.text import first_filled, same_word, trim_unicode
from marquee.operators.dedup import keep_first
from marquee.operators.joins import fill_amounts
from marquee.operators.lookup import flag_members, lookup_columns, lookup_name
from marquee.plans.dimensions import COMPANY_SPELLINGS, COMPANY_STOP_WORD, RESTRICTED_COUNTRIES


def keyed(raw: DataFrame) -> DataFrame:
    """Raw rows with a numeric key; rows without one are dropped."""
    return raw.withColumn("movie_id", to_key(F.col("id"))).where(F.col("movie_id").isNotNull())


def unique_enriched(enriched: DataFrame) -> DataFrame:
    """One enrichment row per movie. The table has no order of its own, so ties between
    repeated lookups are settled by content, which does not depend on partitioning."""
    order = ["budget", "revenue", "genres", "production_countries", "spoken_languages"]
    return keep_first(enriched, ["movie_id"], [F.desc_nulls_last(c) for c in order])


def movies(main: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row per movie: the first raw row, unknown amounts filled from `enriched` (unique)."""
    first = keep_first(keyed(main), ["movie_id"], SOURCE_ORDER)
    typed = first.select(
        "movie_id",
        trim_unicode(F.col("title")).alias("movie_title"),
        parse_date(F.col("release_date")).alias("release_date"),
        to_money(F.col("budget")).alias("budget"),
        to_money(F.col("revenue")).alias("revenue"),
    )
    return fill_amounts(typed, enriched, "movie_id", ["budget", "revenue"])


def attach_enrichment(extended: DataFrame, enriched: DataFrame) -> DataFrame:
    """Extended rows with the enrichment texts beside them: one join for all three fills.

    `enriched` is unique by movie. Repeated raw rows stay, so a hot key stays on the left.
    """
    found = enriched.select(
        "movie_id",
        F.col("genres").alias("genres_found"),
        F.col("production_countries").alias("countries_found"),
        F.col("spoken_languages").alias("languages_found"),
    )
    columns = ["movie_id", "genres", "production_companies", "production_countries", "spoken_languages"]
    return keyed(extended).select(*columns).join(found, "movie_id", "left")


def _tokens(df: DataFrame, text: Column, name: str) -> DataFrame:
    """One row per token of `split_tokens`; here the parts are trimmed as rows, which is compiled, not as array
    entries, which is interpreted."""
    parts = df.select("movie_id", F.explode(F.split(text, ",")).alias(name))
    return parts.select("movie_id", trim_unicode(F.col(name)).alias(name)).where(F.col(name) != "")


def movie_genres(attached: DataFrame) -> DataFrame:
    """One row per listed genre, duplicates kept; a blank list is replaced by the enrichment."""
    return _tokens(attached, first_filled(F.col("genres"), F.col("genres_found")), "genre")


def production_companies(
    attached: DataFrame,
    stop_word: str = COMPANY_STOP_WORD,
    spellings: Mapping[str, str] = COMPANY_SPELLINGS,
) -> DataFrame:
    """One row per listed company, duplicates kept, stray articles dropped, spellings unified."""
    listed = _tokens(attached, F.col("production_companies"), "company_name")
    kept = listed.where(~same_word(F.col("company_name"), stop_word))
    return kept.replace(dict(spellings), subset=["company_name"])


def _codes(attached: DataFrame, raw: str, found: str, key: str, name: str) -> DataFrame:
    """One row per code. The raw list wins when it parses to anything, even to blank codes."""
    # Parsed in a step of its own: the choice looks at the list twice and would parse it twice.
    parsed = attached.select("movie_id", literal_codes(F.col(raw), key).alias("_listed"), found)
    chosen = prefer_list(F.col("_listed"), coded_pairs(F.col(found)))
    codes = parsed.select("movie_id", F.explode(chosen).alias("_code"))
    return codes.select("movie_id", trim_unicode(F.col("_code")).alias(name)).where(F.col(name) != "")


def producing_countries(
    attached: DataFrame,
    names: DataFrame,
    regions: DataFrame,
    restricted: tuple[str, ...] = RESTRICTED_COUNTRIES,
) -> DataFrame:
    """One row per listed country, duplicates kept, with name, region and restriction flag."""
    codes = _codes(attached, "production_countries", "countries_found", "iso_3166_1", "iso_country_code")
    named = lookup_name(codes, names, "iso_country_code", "country_name")
    placed = lookup_columns(named, regions, "iso_country_code")
    flagged = flag_members(placed, "iso_country_code", restricted, "is_service_restricted")
    return flagged.where(F.col("country_name") != "").select(
        "movie_id", "iso_country_code", "country_name", "country_region", "country_subregion",
        "is_service_restricted",
    )


def spoken_languages(attached: DataFrame, names: DataFrame) -> DataFrame:
    """One row per listed language, duplicates kept, with its name."""
    codes = _codes(attached, "spoken_languages", "languages_found", "iso_639_1", "iso_language_code")
    named = lookup_name(codes, names, "iso_language_code", "language_name")
    return named.where(F.col("language_name") != "").select("movie_id", "iso_language_code", "language_name")


def raw_faults() -> dict[str, dict[str, Column]]:
    """Raw values the cleaner has no answer for, as violation counts per raw table."""
    fractional = F.count_if(is_fractional(F.col("id")))
    return {
        "movies_main": {"fractional_id": fractional},
        "movie_extended": {
            "fractional_id": fractional,
            "odd_country_list": F.count_if(literal_fault(F.col("production_countries"), "iso_3166_1")),
            "odd_language_list": F.count_if(literal_fault(F.col("spoken_languages"), "iso_639_1")),
        },
    }


def raw_warnings() -> dict[str, dict[str, Column]]:
    """Raw values that the cleaner reads as empty though they look like more."""
    return {
        "movies_main": {},
        "movie_extended": {
            "broken_country_list": F.count_if(literal_broken(F.col("production_countries"), "iso_3166_1")),
            "broken_language_list": F.count_if(literal_broken(F.col("spoken_languages"), "iso_639_1")),
        },
    }
