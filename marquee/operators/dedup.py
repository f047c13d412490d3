from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first by `order`.

    Asking for row number 1 lets Spark keep one row per key in every map task before the
    shuffle, so a key that holds most of the rows sends only one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def removed_by_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after and rows removed by a keep-first on `keys`."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of occurrences."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
