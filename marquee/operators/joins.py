from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.numbers import zero_to_null
from marquee.functions.text import first_filled


def fill_amounts(df: DataFrame, source: DataFrame, key: str, amounts: Sequence[str]) -> DataFrame:
    """Fill NULL amounts from `source`, which has one row per key; a zero found there stays unknown."""
    right = source.select(key, *[F.col(a).alias(f"_{a}_found") for a in amounts])
    joined = df.join(right, key, "left")
    return joined.select(*[
        zero_to_null(F.coalesce(F.col(c), F.col(f"_{c}_found"))).alias(c) if c in amounts else F.col(c)
        for c in df.columns
    ])


def fill_texts(df: DataFrame, source: DataFrame, key: str, texts: Mapping[str, str]) -> DataFrame:
    """Replace blank texts by the named text of `source`, which has one row per key."""
    right = source.select(key, *[F.col(s).alias(f"_{t}_found") for t, s in texts.items()])
    joined = df.join(right, key, "left")
    return joined.select(*[
        first_filled(F.col(c), F.col(f"_{c}_found")).alias(c) if c in texts else F.col(c)
        for c in df.columns
    ])


def within_scope(df: DataFrame, scope: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in scope. A semi-join cannot multiply rows, and a hot key stays on
    the left, the side that adaptive execution can split. Tasks keep their part of the scope's keys, each
    once, and let the rows pass unsorted."""
    return df.join(scope.select(key).hint("shuffle_hash"), key, "left_semi")


def orphans(children: Mapping[str, DataFrame], parent: DataFrame, key: str, label: str) -> DataFrame:
    """Child rows without a parent, labelled by child table. NULL parent keys hide nothing.

    The parent has one row per key; hot keys are on the left, the side that can be split. Tasks keep
    their part of the parent's keys and let the children, many times as many, pass unsorted.
    """
    tagged = [df.select(F.lit(name).alias(label), key) for name, df in children.items()]
    everything = reduce(DataFrame.unionByName, tagged)
    return everything.join(parent.select(key).hint("shuffle_hash"), key, "left_anti").select(label, key)


def missing_numbers(spark: SparkSession, expected: range, df: DataFrame, column: str) -> DataFrame:
    """Numbers of the expected series that do not occur in `column`."""
    series = spark.range(expected.start, expected.stop, expected.step, numPartitions=1)
    # Distinct first: the right side of an anti-join cannot be split when one value is hot.
    found = df.select(F.col(column).cast("bigint").alias(column)).distinct()
    return series.select(F.col("id").alias(column)).join(found, column, "left_anti")


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    """Distinct rows of several frames with the same columns."""
    return reduce(DataFrame.unionByName, frames).distinct()
