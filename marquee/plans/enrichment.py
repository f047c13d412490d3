"""Which movies to look up, and what the answers become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.collections import join_texts
from marquee.functions.text import is_blank, is_empty_list, is_missing_amount
from marquee.operators.joins import union_distinct

_ANSWER = (
    "budget decimal(38,2), revenue decimal(38,2), genres array<map<string,string>>, "
    "production_countries array<map<string,string>>, spoken_languages array<map<string,string>>, _broken string"
)


def candidates(movies_main: DataFrame, movie_extended: DataFrame) -> DataFrame:
    """Raw ids with a missing amount, genre, country or language, each once.

    The ids are texts: two spellings of one number are two candidates.
    """
    amounts = is_missing_amount(F.col("budget")) | is_missing_amount(F.col("revenue"))
    lists = (
        is_blank(F.col("genres"))
        | is_empty_list(F.col("production_countries"))
        | is_empty_list(F.col("spoken_languages"))
    )
    return union_distinct([
        movies_main.where(amounts).select("id"),
        movie_extended.where(lists).select("id"),
    ])


def _amount(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(38,2)"))


def _names(entries: Column) -> Column:
    named = F.filter(entries, lambda e: F.map_contains_key(e, "name"))
    return F.coalesce(join_texts(F.transform(named, lambda e: e["name"]), ", "), F.lit(""))


def _code_names(entries: Column, code: str) -> Column:
    coded = F.filter(entries, lambda e: F.coalesce(e[code] != "", F.lit(False)))
    # A name that is absent prints as nothing, a null name as None.
    pairs = F.transform(coded, lambda e: F.concat(
        e[code], F.lit(":"),
        F.when(F.map_contains_key(e, "name"), F.coalesce(e["name"], F.lit("None"))).otherwise(F.lit("")),
    ))
    return F.coalesce(join_texts(pairs, "|"), F.lit(""))


def flatten_answers(payloads: DataFrame) -> DataFrame:
    """(id, payload) with a JSON answer each, to one flat row per usable answer.

    Unparsable answers, ids that are no integers and genre lists with a null name are dropped.
    """
    answer = F.from_json("payload", _ANSWER, {"columnNameOfCorruptRecord": "_broken"})
    # One row each comes out of a generator: later steps cannot be folded into the parse, which would
    # repeat it for every filter and column.
    parsed = payloads.where(
        F.col("payload").rlike(r"^\s*\{") & F.col("id").rlike(r"^\s*[+-]?[0-9]+\s*$")
    ).select("id", F.inline(F.array(F.struct(answer.alias("a"))))).where("a._broken IS NULL")
    nameless = F.exists("a.genres", lambda e: e.isNull() | (F.map_contains_key(e, "name") & e["name"].isNull()))
    return parsed.where(~F.coalesce(nameless, F.lit(False))).select(
        F.trim("id", F.lit(" \t\n\r")).cast("bigint").alias("movie_id"),
        _amount(F.col("a.budget")).alias("budget"),
        _amount(F.col("a.revenue")).alias("revenue"),
        _names(F.col("a.genres")).alias("genres"),
        _code_names(F.col("a.production_countries"), "iso_3166_1").alias("production_countries"),
        _code_names(F.col("a.spoken_languages"), "iso_639_1").alias("spoken_languages"),
    )


def is_useful() -> Column:
    texts = (F.col(c) != "" for c in ("genres", "production_countries", "spoken_languages"))
    useful = (F.col("budget") > 0) | (F.col("revenue") > 0)
    for filled in texts:
        useful = useful | filled
    return useful


def movies_enriched(payloads: DataFrame, asked: DataFrame) -> DataFrame:
    """Flat, useful rows of the answers to the asked candidates."""
    answered = payloads.join(asked.select("id"), "id", "left_semi")
    return flatten_answers(answered).where(is_useful())


def enrichment_summary(asked: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: candidates, kept rows and skipped candidates."""
    kept = enriched.agg(F.count(F.lit(1)).alias("n")).scalar()
    return asked.agg(F.count(F.lit(1)).alias("candidates")).select(
        "candidates", kept.alias("kept"), (F.col("candidates") - kept).alias("skipped")
    )
