from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a lookup table if it has at most `max_rows` rows, else leave it to a shuffle join.

    The count stops one row past the limit, so checking a huge table costs no full pass.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def merge_names(standard: DataFrame, manual: DataFrame, code: str, name: str) -> DataFrame:
    """One name per code: the standard list first, the manual list for codes it lacks."""
    extra = manual.select(code, name).join(standard.select(code), code, "left_anti")
    return standard.select(code, name).unionByName(extra).groupBy(code).agg(F.min(name).alias(name))


def lookup_name(df: DataFrame, names: DataFrame, code: str, name: str) -> DataFrame:
    """Add the name of a code; an unknown code is its own name."""
    known = small_side(names.select(code, F.col(name).alias("_name")))
    return df.join(known, code, "left").withColumn(name, F.coalesce("_name", code)).drop("_name")


def lookup_columns(df: DataFrame, dimension: DataFrame, code: str) -> DataFrame:
    """Add every other column of the dimension by code, NULL for an unknown code."""
    return df.join(small_side(dimension), code, "left")


def flag_members(df: DataFrame, code: str, members: Iterable[str], flag: str) -> DataFrame:
    """Add a flag that is TRUE for listed codes and FALSE for all others, NULL included."""
    return df.withColumn(flag, F.coalesce(F.col(code).isin(*members), F.lit(False)))
