"""Star schema: scoped staging frames, fact, bridges and summary tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.dates import SCOPE_FROM, SCOPE_TO, in_scope
from marquee.functions.numbers import classify, mean_of, pct_of_total
from marquee.operators.dedup import distinct_rows
from marquee.operators.joins import within_scope
from marquee.operators.ordering import Ranking, exact_percentiles, rank_descending
from marquee.operators.shares import distinct_per, share_of_having

COUNTRY = ["iso_country_code", "country_name", "country_region", "country_subregion", "is_service_restricted"]
LANGUAGE = ["iso_language_code", "language_name"]


# Staging: the scope every later table inherits.

def stg_movies(movies: DataFrame, start: dt.date = SCOPE_FROM, end: dt.date = SCOPE_TO) -> DataFrame:
    return movies.where(in_scope(F.col("release_date"), start, end)).select(
        "movie_id", "movie_title", "release_date", F.year("release_date").alias("release_year"), "budget", "revenue"
    )


def distinct_in_scope(pairs: DataFrame, scope: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct pairs in scope. Duplicates go before the join, while map tasks can drop them, so
    a movie with very many rows reaches the join with few."""
    return within_scope(distinct_rows(pairs, ["movie_id", *columns]), scope, "movie_id")


def stg_movie_genres(genres: DataFrame, scope: DataFrame) -> DataFrame:
    return distinct_in_scope(genres, scope, ["genre"])


def stg_movie_companies(companies: DataFrame, scope: DataFrame) -> DataFrame:
    return within_scope(companies.select("movie_id", "company_name"), scope, "movie_id")


def stg_movie_countries(countries: DataFrame, scope: DataFrame) -> DataFrame:
    return within_scope(countries.select("movie_id", *COUNTRY), scope, "movie_id")


def stg_movie_languages(languages: DataFrame, scope: DataFrame) -> DataFrame:
    return within_scope(languages.select("movie_id", *LANGUAGE), scope, "movie_id")


# Intermediate.

def movie_financials(scope: DataFrame) -> DataFrame:
    """Ranks within the year, neighbouring budgets and money tiers."""
    columns = scope.select("movie_id", "movie_title", "release_year", "budget", "revenue")
    ranked = rank_descending(columns, ["release_year"], "movie_id", [
        Ranking("revenue", "revenue_rank_in_year"),
        Ranking("budget", "budget_rank_in_year", "higher_budget", "lower_budget"),
    ])
    return ranked.select(
        "*",
        classify(F.col("budget")).alias("budget_tier"),
        classify(F.col("revenue")).alias("revenue_tier"),
    )


def yearly_aggregates(scope: DataFrame, unique_ids: bool = True) -> DataFrame:
    """Movies, known amounts, means and medians per year.

    With `unique_ids`, which the clean layer's gate guarantees, rows are movies and nothing
    needs to be made distinct; without it movies are counted by distinct id.
    """
    movies = F.count("movie_id") if unique_ids else F.countDistinct("movie_id")

    def known(column: str):
        flagged = F.when(F.col(column).isNotNull(), F.col("movie_id"))
        return F.count(flagged) if unique_ids else F.countDistinct(flagged)

    totals = scope.groupBy("release_year").agg(
        movies.alias("movie_count"),
        known("budget").alias("movies_with_budget"),
        known("revenue").alias("movies_with_revenue"),
        mean_of(F.col("budget"), 0).alias("avg_budget"),
        mean_of(F.col("revenue"), 0).alias("avg_revenue"),
    )
    amounts = scope.select("release_year", F.inline(F.array(*[
        F.struct(F.lit(c).alias("amount"), F.col(c).cast("double").alias("value")) for c in ("budget", "revenue")
    ])))
    medians = exact_percentiles(
        amounts, ["release_year", "amount"], "value", {"median": 0.5}
    ).groupBy("release_year").agg(*[
        F.max(F.when(F.col("amount") == c, F.col("median"))).alias(f"median_{c}") for c in ("budget", "revenue")
    ])
    return totals.join(medians, "release_year", "left")


def yearly_trends_from(yearly: DataFrame) -> DataFrame:
    """Neighbouring years, change and rolling mean. The one window without a partition here
    orders one row per year."""
    series = Window.orderBy("release_year")
    before = F.lag("movie_count").over(series)
    delta = F.col("movie_count") - before
    return yearly.select(
        "release_year", "movie_count", "movies_with_budget", "movies_with_revenue",
        "avg_budget", "avg_revenue", "median_budget", "median_revenue",
        before.alias("prev_year_movie_count"),
        F.lag("avg_budget").over(series).alias("prev_year_avg_budget"),
        F.lag("avg_revenue").over(series).alias("prev_year_avg_revenue"),
        F.lead("movie_count").over(series).alias("next_year_movie_count"),
        delta.alias("yoy_movie_count_delta"),
        pct_of_total(delta, before).alias("yoy_movie_count_pct"),
        F.round(
            F.avg(F.col("movie_count").cast("decimal(20,0)")).over(series.rowsBetween(-2, Window.currentRow)), 1
        ).alias("rolling_3yr_avg_movies"),
    )


def yearly_movie_trends(scope: DataFrame, unique_ids: bool = True) -> DataFrame:
    return yearly_trends_from(yearly_aggregates(scope, unique_ids))


# Marts.

def fact_movies(
    scope: DataFrame, genres: DataFrame, companies: DataFrame, countries: DataFrame, languages: DataFrame
) -> DataFrame:
    """One row per movie with its attribute counts; distinct for genres and countries only.

    The attribute frames need no scoping: each is reduced to one row per movie before it meets
    the scoped movies.
    """
    counts = (
        distinct_per(genres, ["movie_id"], "genre", "genre_count"),
        companies.groupBy("movie_id").agg(F.count(F.lit(1)).alias("company_count")),
        distinct_per(countries, ["movie_id"], "iso_country_code", "country_count"),
        languages.groupBy("movie_id").agg(F.count(F.lit(1)).alias("language_count")),
    )
    fact = scope.select("movie_id", "movie_title", "release_date", "release_year", "budget", "revenue")
    for per_movie in counts:
        fact = fact.join(per_movie, "movie_id", "left")
    return fact.na.fill(0, ["genre_count", "company_count", "country_count", "language_count"])


# The marts count distinct movies, so they take staging frames, stored bridges and the output of
# distinct_in_scope alike.

def mart_genre_share(stg_genres: DataFrame) -> DataFrame:
    return share_of_having(stg_genres, ["genre"], "movie_id", "movie_count", "total_movies", "pct_of_movies")


def mart_language_share(stg_languages: DataFrame) -> DataFrame:
    return share_of_having(stg_languages, LANGUAGE, "movie_id", "movie_count", "total_movies", "pct_of_movies")


def mart_country_summary(stg_countries: DataFrame, unique_pairs: bool = False) -> DataFrame:
    """With `unique_pairs`, which `distinct_in_scope` guarantees, a pair is a movie of its country, and tasks
    keep a count per country instead of every pair once more."""
    if unique_pairs:
        return stg_countries.groupBy(*COUNTRY).agg(F.count("movie_id").alias("movie_count"))
    return distinct_per(stg_countries, COUNTRY, "movie_id", "movie_count")


def mart_yearly_trends(trends: DataFrame) -> DataFrame:
    return trends.drop("prev_year_avg_budget", "prev_year_avg_revenue")


def bridge(staged: DataFrame) -> DataFrame:
    """A stored projection of a staging frame."""
    return staged.select(*staged.columns)


def for_display(mart: DataFrame, by: str, *tie: str, descending: bool = True) -> DataFrame:
    """Reading order of a mart, ties settled by the given columns."""
    return mart.orderBy(F.desc(by) if descending else F.asc(by), *tie)
