"""Dashboard figures over the star schema, under the page filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.numbers import pct_of_total
from marquee.operators.joins import within_scope
from marquee.operators.profile import top_n
from marquee.operators.shares import share_of_having
from marquee.plans.gold import distinct_in_scope
from marquee.session import checkpointed


@dataclass(frozen=True)
class Filters:
    """A filter that is None does not narrow anything. Dates are inclusive on both ends."""

    released_from: dt.date | None = None
    released_to: dt.date | None = None
    countries: tuple[str, ...] | None = None
    regions: tuple[str, ...] | None = None
    subregions: tuple[str, ...] | None = None
    restricted: bool | None = None
    languages: tuple[str, ...] | None = None
    genres: tuple[str, ...] | None = None


def _all(conditions: list[Column]) -> Column | None:
    out = None
    for condition in conditions:
        out = condition if out is None else out & condition
    return out


def filtered_movies(star: Mapping[str, DataFrame], filters: Filters) -> DataFrame:
    """Fact rows that pass every filter. Attribute filters on one bridge must hold in one row."""
    dates = [F.col("release_date") >= filters.released_from] if filters.released_from else []
    dates += [F.col("release_date") <= filters.released_to] if filters.released_to else []
    country = [
        F.col(column).isin(*values)
        for column, values in (
            ("iso_country_code", filters.countries),
            ("country_region", filters.regions),
            ("country_subregion", filters.subregions),
        )
        if values is not None
    ]
    if filters.restricted is not None:
        country.append(F.col("is_service_restricted") == filters.restricted)
    language = [F.col("iso_language_code").isin(*filters.languages)] if filters.languages is not None else []
    genre = [F.col("genre").isin(*filters.genres)] if filters.genres is not None else []

    movies = star["fact_movies"]
    if dates:
        movies = movies.where(_all(dates))
    for name, conditions in (
        ("bridge_movie_countries", country),
        ("bridge_movie_languages", language),
        ("bridge_movie_genres", genre),
    ):
        if conditions:
            # Distinct before the join: a movie with very many bridge rows becomes one row.
            matching = star[name].where(_all(conditions)).select("movie_id").distinct()
            movies = within_scope(movies, matching, "movie_id")
    return movies


def kpis(star: Mapping[str, DataFrame], filters: Filters = Filters(), language: str = "en") -> DataFrame:
    """One row: films, percent with the given language, and the leading genre with its percent.

    Percentages refer to the filtered films that have any language, or any genre, at all.
    """
    movies = filtered_movies(star, filters)
    if filters != Filters():
        # Stored once: three figures need the films, and would repeat the joins of the filters.
        movies = checkpointed(movies.select("movie_id"))
    genres = distinct_in_scope(star["bridge_movie_genres"], movies, ["genre"])

    # One row per movie before the join, which also makes this a count without a distinct.
    spoken = star["bridge_movie_languages"].groupBy("movie_id").agg(
        F.max(F.col("iso_language_code") == language).alias("speaks")
    )
    language_pct = within_scope(spoken, movies, "movie_id").agg(
        pct_of_total(F.count_if("speaks"), F.count(F.lit(1))).alias("pct")
    ).scalar()
    leading = top_n(
        share_of_having(genres, ["genre"], "movie_id", "movie_count", "total", "pct"), 1, "movie_count", "genre"
    ).select(F.struct("genre", "pct").alias("leading")).scalar()

    counted = movies.agg(F.count(F.lit(1)).alias("films"))
    return counted.select(
        "films", language_pct.alias("language_pct"), leading.alias("_leading")
    ).select(
        "films",
        "language_pct",
        F.col("_leading.genre").alias("top_genre"),
        F.col("_leading.pct").alias("top_genre_pct"),
    )
