from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.numbers import pct_of_total


def distinct_total(df: DataFrame, column: str) -> Column:
    """Number of distinct values of a whole frame, as a scalar for use next to other columns."""
    return df.agg(F.countDistinct(column).alias("total")).scalar()


def row_total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("total")).scalar()


def distinct_per(df: DataFrame, keys: Sequence[str], column: str, count: str) -> DataFrame:
    """Distinct values of `column` per key; NULL keys form a group."""
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(count))


def share_of_having(
    pairs: DataFrame, keys: Sequence[str], entity: str, count: str, total: str, pct: str, decimals: int = 2
) -> DataFrame:
    """Entities per key over the entities that have any key at all, with the total beside it."""
    return (
        distinct_per(pairs, keys, entity, count)
        .withColumn(total, distinct_total(pairs, entity))
        .withColumn(pct, pct_of_total(F.col(count), F.col(total), decimals))
    )


def shares(
    pairs: DataFrame,
    keys: Sequence[str],
    entity: str,
    denominator: str,
    scope: DataFrame | None = None,
    decimals: int = 1,
) -> DataFrame:
    """Frequency and share per key under one of the three denominators in use.

    scope:  entities per key over all entities in scope
    having: entities per key over the entities that have any key
    rows:   pair rows per key over all pair rows
    """
    if denominator == "rows":
        counted, total = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency")), row_total(pairs)
    elif denominator == "having":
        counted, total = distinct_per(pairs, keys, entity, "frequency"), distinct_total(pairs, entity)
    elif denominator == "scope":
        if scope is None:
            raise ValueError("the scope denominator needs the scope frame")
        counted, total = distinct_per(pairs, keys, entity, "frequency"), distinct_total(scope, entity)
    else:
        raise ValueError(f"unknown denominator {denominator!r}")
    return counted.withColumn("total", total).withColumn(
        "share_pct", pct_of_total(F.col("frequency"), F.col("total"), decimals)
    )


def share_gap(
    catalogue: DataFrame, weights: DataFrame, key: str, pct: str, weight: str
) -> DataFrame:
    """Target share minus catalogue share per key; positive means under-represented.

    A key that only one side knows counts as zero on the other.
    """
    joined = catalogue.select(key, pct).join(weights.select(key, weight), key, "full")
    known = [F.coalesce(F.col(c).cast("decimal(15,2)"), F.lit(0).cast("decimal(15,2)")) for c in (weight, pct)]
    return joined.select(
        key,
        known[1].alias("catalogue_pct"),
        known[0].alias("target_pct"),
        (known[0] - known[1]).alias("gap_pct"),
    )
