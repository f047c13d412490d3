"""The checks of each layer. Each function returns a report for `gate`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.contracts import CLEAN, RAW
from marquee.functions.dates import scope_years
from marquee.functions.numbers import TIER_LABELS
from marquee.operators import checks as c
from marquee.operators.joins import missing_numbers, orphans
from marquee.plans.dimensions import REGION_NAMES
from marquee.plans.silver import raw_faults, raw_warnings

BRIDGES = ("bridge_movie_genres", "bridge_movie_languages", "bridge_movie_countries", "bridge_movie_companies")


def bronze_checks(
    spark: SparkSession, stored: Mapping[str, DataFrame], sources: Mapping[str, DataFrame]
) -> DataFrame:
    """Columns, rows against a fresh read of the source, keys, blank rows, odd values."""
    parts = []
    for name, table in RAW.items():
        df = stored[name]
        parts += [
            c.contract(spark, f"{name}.columns", df.schema, table),
            c.same_rows(name, sources[name], df, table.names),
            # Errors and warnings ask the same lists, so one pass reads each list once for both.
            c.graded_checks(df, {
                c.ERROR: {
                    f"{name}.not_empty": c.not_empty(),
                    f"{name}.id_not_null": c.not_null("id"),
                    **{f"{name}.{fault}": count for fault, count in raw_faults()[name].items()},
                },
                c.WARN: {
                    f"{name}.no_empty_rows": c.no_empty_rows(table.names),
                    **{f"{name}.{found}": count for found, count in raw_warnings()[name].items()},
                },
            }),
        ]
    return c.report(parts)


def value_ranges() -> dict[str, dict[str, Column]]:
    return {
        "movies": {
            "budget_not_negative": c.not_negative("budget"),
            "revenue_not_negative": c.not_negative("revenue"),
        },
        "movie_genres": {"genre_not_blank": c.not_blank("genre")},
        "production_companies": {"company_not_blank": c.not_blank("company_name")},
        "producing_countries": {"country_not_blank": c.not_blank("iso_country_code", "country_name")},
        "spoken_languages": {"language_not_blank": c.not_blank("iso_language_code", "language_name")},
    }


def silver_checks(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Types, non-empty, required columns, unique movies, value ranges."""
    parts = []
    for name, table in CLEAN.items():
        df = tables[name]
        parts += [
            c.contract(spark, f"{name}.types", df.schema, table),
            c.table_checks(df, {
                f"{name}.not_empty": c.not_empty(),
                **{f"{name}.{column}_not_null": c.not_null(column) for column in table.required},
                **{f"{name}.{check}": count for check, count in value_ranges().get(name, {}).items()},
            }),
        ]
    parts.append(c.unique("movies.movie_id_unique", tables["movies"], ["movie_id"]))
    return c.report(parts)


# Columns that must hold a value, and keys that must be unique, per table or view.
REQUIRED = {
    "stg_movies": ("movie_id", "movie_title", "release_date", "release_year"),
    "stg_movie_genres": ("movie_id", "genre"),
    "stg_movie_companies": ("movie_id", "company_name"),
    "stg_movie_countries": ("movie_id", "iso_country_code", "country_name", "is_service_restricted"),
    "stg_movie_languages": ("movie_id", "iso_language_code", "language_name"),
    "int_yearly_movie_trends": ("release_year", "movie_count"),
    "int_movie_financials": ("movie_id",),
    "fact_movies": (
        "movie_id", "movie_title", "release_year", "genre_count", "company_count", "country_count", "language_count",
    ),
    "mart_genre_share": ("genre", "movie_count", "pct_of_movies"),
    "mart_language_share": ("iso_language_code", "language_name", "pct_of_movies"),
    "mart_country_summary": ("iso_country_code", "country_name", "is_service_restricted", "movie_count"),
    "mart_yearly_trends": ("release_year", "movie_count"),
    "bridge_movie_genres": ("movie_id", "genre"),
    "bridge_movie_languages": ("movie_id", "iso_language_code"),
    "bridge_movie_countries": ("movie_id", "iso_country_code", "is_service_restricted"),
    "bridge_movie_companies": ("movie_id", "company_name"),
}
UNIQUE = {
    "stg_movies": "movie_id",
    "int_yearly_movie_trends": "release_year",
    "int_movie_financials": "movie_id",
    "fact_movies": "movie_id",
    "mart_genre_share": "genre",
    "mart_language_share": "iso_language_code",
    "mart_country_summary": "iso_country_code",
    "mart_yearly_trends": "release_year",
}
ACCEPTED = {
    "stg_movie_countries": ("country_region", REGION_NAMES),
    "int_movie_financials": ("budget_tier", TIER_LABELS),
    "mart_country_summary": ("country_region", REGION_NAMES),
}


def column_checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The declared column tests of every given table, one pass per table plus one per key."""
    parts = []
    for name, df in tables.items():
        tests = {f"{name}.{column}_not_null": c.not_null(column) for column in REQUIRED.get(name, ())}
        if name in ACCEPTED:
            column, values = ACCEPTED[name]
            tests[f"{name}.{column}_accepted"] = c.accepted(column, values)
        if tests:
            parts.append(c.table_checks(df, tests))
        if name in UNIQUE:
            parts.append(c.unique(f"{name}.{UNIQUE[name]}_unique", df, [UNIQUE[name]]))
    return parts


def untiered(financials: DataFrame) -> DataFrame:
    return financials.where(F.col("budget_tier").isNull())


def negative_counts(fact: DataFrame) -> DataFrame:
    return fact.where("genre_count < 0 OR company_count < 0 OR country_count < 0 OR language_count < 0")


def orphan_rows(bridges: Mapping[str, DataFrame], fact: DataFrame) -> DataFrame:
    return orphans(bridges, fact, "movie_id", "bridge_table")


def low_share_sum(genre_share: DataFrame) -> DataFrame:
    """A row if the shares of a multi-label attribute do not sum to more than 100."""
    return genre_share.agg(F.sum("pct_of_movies").alias("total_pct")).where("total_pct <= 100")


def duplicate_genres(bridge_genres: DataFrame) -> DataFrame:
    return c.repeated(bridge_genres, ["movie_id", "genre"])


def years_outside(scope: DataFrame, years: range = scope_years()) -> DataFrame:
    return scope.where((F.col("release_year") < years[0]) | (F.col("release_year") > years[-1]))


def restricted_without_region(country_summary: DataFrame) -> DataFrame:
    return country_summary.where(
        "is_service_restricted AND (country_region IS NULL OR country_subregion IS NULL)"
    )


def missing_years(spark: SparkSession, trends: DataFrame, years: range = scope_years()) -> DataFrame:
    return missing_numbers(spark, years, trends, "release_year")


def wrong_deltas(trends: DataFrame) -> DataFrame:
    return trends.where("yoy_movie_count_delta != movie_count - prev_year_movie_count")


def gold_checks(spark: SparkSession, tables: Mapping[str, DataFrame], years: range = scope_years()) -> DataFrame:
    """Column tests and invariants of the star schema."""
    bridges = {name: tables[name] for name in BRIDGES}
    return c.report([
        *column_checks(tables),
        c.expect_none("budget_tier_coverage", untiered(tables["int_movie_financials"])),
        c.expect_none("fact_counts_not_negative", negative_counts(tables["fact_movies"])),
        c.expect_none("no_orphan_bridge_rows", orphan_rows(bridges, tables["fact_movies"])),
        c.expect_none("genre_shares_over_100", low_share_sum(tables["mart_genre_share"])),
        c.expect_none("no_duplicate_genres", duplicate_genres(tables["bridge_movie_genres"])),
        c.expect_none("scope_years", years_outside(tables["stg_movies"], years)),
        c.expect_none("restricted_have_region", restricted_without_region(tables["mart_country_summary"])),
        c.expect_none("no_missing_years", missing_years(spark, tables["mart_yearly_trends"], years)),
        c.expect_none("yearly_delta", wrong_deltas(tables["mart_yearly_trends"])),
    ])
