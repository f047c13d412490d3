"""Declared tables of each layer: columns, types, nullability, text lengths, descriptions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Text that the raw reader treats as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

MONEY = T.DecimalType(15, 2)

# Where a raw row stood in its source; carried so that "first row wins" has a meaning.
SOURCE_ORDER = ("_src_file", "_src_block", "_src_row")


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    comment: str = ""
    default: object = None
    formerly: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: str | None = None
    technical: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, c.type, not c.required, {"comment": c.comment} if c.comment else None)
            for c in self.columns
        ])


def _text(name: str, length: int | None = None, required: bool = False, comment: str = "", **more) -> Column:
    return Column(name, T.StringType(), required, length, comment, **more)


def _movie_id(comment: str = "Movie key") -> Column:
    return Column("movie_id", T.LongType(), True, comment=comment)


RAW = {
    "movies_main": Table("movies_main", (
        _text("id", comment="Movie key as found"),
        _text("title", comment="Title as found"),
        _text("release_date", comment="Release date, mixed formats"),
        _text("budget", comment="Budget as found"),
        _text("revenue", comment="Revenue as found"),
    ), key="id", technical=SOURCE_ORDER),
    "movie_extended": Table("movie_extended", (
        _text("id", comment="Movie key as found"),
        _text("genres", comment="Comma separated genres"),
        _text("production_companies", comment="Comma separated companies"),
        _text("production_countries", comment="List of mappings with a country code"),
        _text("spoken_languages", comment="List of mappings with a language code"),
    ), key="id", technical=SOURCE_ORDER),
}

CLEAN = {
    "movies": Table("movies", (
        _movie_id("Movie key, unique"),
        _text("movie_title", 500, comment="Trimmed title", formerly="title"),
        Column("release_date", T.DateType(), comment="Parsed release date"),
        Column("budget", MONEY, comment="Budget; unknown is NULL"),
        Column("revenue", MONEY, comment="Revenue; unknown is NULL"),
    ), key="movie_id"),
    "movie_genres": Table("movie_genres", (
        _movie_id(),
        _text("genre", 100, True, "One genre of the movie"),
    )),
    "production_companies": Table("production_companies", (
        _movie_id(),
        _text("company_name", 255, True, "One company of the movie"),
    )),
    "movies_enriched": Table("movies_enriched", (
        _movie_id("Movie key that was looked up"),
        Column("budget", MONEY, comment="Budget from the metadata source"),
        Column("revenue", MONEY, comment="Revenue from the metadata source"),
        _text("genres", comment="Genres joined by a comma"),
        _text("production_countries", comment="code:name pairs joined by a pipe"),
        _text("spoken_languages", comment="code:name pairs joined by a pipe"),
    )),
    "producing_countries": Table("producing_countries", (
        _movie_id(),
        _text("iso_country_code", 10, True, "Country code"),
        _text("country_name", 255, True, "English country name"),
        _text("country_region", 50, comment="Sales region"),
        _text("country_subregion", 50, comment="Sales subregion"),
        Column("is_service_restricted", T.BooleanType(), True, comment="Service not offered there", default=False),
    )),
    "spoken_languages": Table("spoken_languages", (
        _movie_id(),
        _text("iso_language_code", 10, True, "Language code"),
        _text("language_name", 255, True, "English language name"),
    )),
}

# The nine tables a dashboard imports, in publishing order.
STAR_TABLES = (
    "fact_movies",
    "bridge_movie_companies",
    "bridge_movie_countries",
    "bridge_movie_genres",
    "bridge_movie_languages",
    "mart_country_summary",
    "mart_genre_share",
    "mart_language_share",
    "mart_yearly_trends",
)
