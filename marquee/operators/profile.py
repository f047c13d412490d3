"""Data profiling: coverage, distribution, outliers, shares and enrichment gain."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.numbers import pct_of_total, ratio
from marquee.operators.ordering import bucket_bounds, bucket_of, exact_percentiles
from marquee.session import checkpointed

# Percentiles of a numeric summary, by column name.
SUMMARY_FRACTIONS = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def coverage(df: DataFrame, columns: Sequence[str], decimals: int = 1) -> DataFrame:
    """Filled and NULL rows per column, in one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_{c}") for c in columns]
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("filled")) for c in columns
    ])
    return counts.select("_rows", F.inline(entries)).select(
        "column_name",
        "filled",
        (F.col("_rows") - F.col("filled")).alias("nulls"),
        pct_of_total(F.col("filled"), F.col("_rows"), decimals).alias("fill_pct"),
    )


def _long_form(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    return df.select(*keys, F.inline(entries))


def numeric_summary(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Min, percentiles, mean, max, sample deviation and mean/median ratio, per column (and key)."""
    by = [*keys, "column_name"]
    values = _long_form(df, keys, columns).where(F.col("value").isNotNull())
    moments = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("value").alias("min"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
        F.stddev_samp("value").alias("stddev"),
    )
    percentiles = exact_percentiles(values, by, "value", SUMMARY_FRACTIONS)
    # A key may be NULL, so the keys are compared as one struct.
    packed = percentiles.select(F.struct(*by).alias("_key"), *SUMMARY_FRACTIONS)
    return (
        moments.withColumn("_key", F.struct(*by)).join(packed, "_key")
        .withColumn("mean_median_ratio", ratio(F.col("mean"), F.col("p50")))
        .select(*by, "n", "min", *SUMMARY_FRACTIONS, "mean", "max", "stddev", "mean_median_ratio")
    )


def _mean_median(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean over median per column (and key), without the rest of the summary."""
    by = [*keys, "column_name"]
    values = _long_form(df, keys, columns).where(F.col("value").isNotNull())
    means = values.groupBy(*by).agg(F.avg("value").alias("mean")).withColumn("_key", F.struct(*by))
    middle = exact_percentiles(values, by, "value", {"p50": 0.5}).select(F.struct(*by).alias("_key"), "p50")
    return means.join(middle, "_key").select(*by, ratio(F.col("mean"), F.col("p50")).alias("mean_median_ratio"))


def skew(df: DataFrame, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    """Mean over median per column."""
    return _mean_median(df, columns).select("column_name", F.round("mean_median_ratio", decimals).alias("skew"))


def spread(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, sample deviation and the threshold of three deviations above the mean."""
    value = F.col(column).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"))
    return stats.withColumn("threshold", F.col("mean") + 3 * F.col("stddev"))


def outliers(df: DataFrame, column: str, decimals: int = 1) -> DataFrame:
    """Rows beyond three deviations above the mean, with their z-score."""
    stats = spread(df, column).select(F.struct("mean", "stddev", "threshold").alias("s")).scalar()
    value = F.col(column).cast("double")
    return (
        df.withColumn("_s", stats)
        .where(value > F.col("_s.threshold"))
        .withColumn("z_score", F.round((value - F.col("_s.mean")) / F.col("_s.stddev"), decimals))
        .drop("_s")
    )


def top_n(df: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    """The n highest rows; every task keeps n rows at most, no full sort is run."""
    return df.orderBy(F.desc_nulls_last(by), tie).limit(n)


def in_windows(
    df: DataFrame, date: str, windows: Mapping[str, tuple[dt.date, dt.date]], label: str = "window"
) -> DataFrame:
    """Each row once per window that contains its date. Windows may overlap; none needs a join."""
    listed = F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        for name, (lo, hi) in windows.items()
    ])
    hits = F.filter(listed, lambda w: (F.col(date) >= w["lo"]) & (F.col(date) < w["hi"]))
    return df.withColumn(label, F.explode(F.transform(hits, lambda w: w["name"])))


def window_comparison(
    df: DataFrame,
    date: str,
    columns: Sequence[str],
    windows: Mapping[str, tuple[dt.date, dt.date]],
    decimals: int = 2,
) -> DataFrame:
    """Rows and mean/median skew of each column, per candidate date window. Windows without rows are left out.

    The bounds of all windows cut time into elementary intervals, and every row lies in one of them. Rows are
    counted and summed once per interval and bucket of values, and a window is a stretch of these intervals,
    so the work on rows does not depend on how many windows there are or how far they overlap. Buckets only
    tell where the median's positions lie; the rows of those buckets are put in order, so medians are exact.
    """
    cuts = sorted({d for window in windows.values() for d in window})
    stretches = df.sparkSession.createDataFrame(
        [(name, i) for name, (lo, hi) in windows.items() for i in range(cuts.index(lo), cuts.index(hi))], "window string, interval int")
    interval = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(date))) - 1
    rows = df.select(date, *columns).where((F.col(date) >= cuts[0]) & (F.col(date) < cuts[-1])).withColumn("interval", interval)
    per_interval = rows.groupBy("interval").agg(F.count(F.lit(1)).alias("n"))
    counted = per_interval.join(F.broadcast(stretches), "interval").groupBy("window").agg(F.sum("n").alias("rows_in_window"))

    values = _long_form(rows, ["interval"], columns).where(F.col("value").isNotNull())
    bounds = bucket_bounds(values, ["column_name"], "value")
    values = values.join(bounds, "column_name").select("interval", "column_name", "value", bucket_of("value").alias("bucket"))
    # At most intervals x columns x buckets rows from here on; they are used twice.
    held = checkpointed(values.groupBy("interval", "column_name", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
    merged = held.join(F.broadcast(stretches), "interval").groupBy("window", "column_name", "bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    group = Window.partitionBy("window", "column_name")
    placed = merged.select(
        "window", "column_name", "bucket", "n", (F.sum("n").over(group.orderBy("bucket")) - F.col("n")).alias("before"),
        F.sum("n").over(group).alias("all"), (F.sum("total").over(group) / F.sum("n").over(group)).alias("mean"))
    low, high = (F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2))
    wanted = placed.where((F.col("before") <= high) & (F.col("before") + F.col("n") > low)).withColumns({"low": low, "high": high})
    wanted = checkpointed(wanted.drop("n", "all"))
    # Of all rows only those in a bucket that holds a median of some window.
    near = values.join(F.broadcast(wanted.select("column_name", "bucket").distinct()), ["column_name", "bucket"], "left_semi")
    near = near.groupBy("interval", "column_name", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))
    near = near.join(F.broadcast(stretches), "interval").groupBy("window", "column_name", "bucket", "value").agg(F.sum("n").alias("n"))
    until = F.sum("n").over(Window.partitionBy("window", "column_name", "bucket").orderBy("value")) + F.col("before")
    ladder = near.join(F.broadcast(wanted), ["window", "column_name", "bucket"]).withColumn("until", until).withColumn(
        "from", F.col("until") - F.col("n"))

    def at(position: str) -> Column:
        return F.max(F.when((F.col("from") <= F.col(position)) & (F.col(position) < F.col("until")), F.col("value")))
    skews = ladder.groupBy("window", "column_name").agg(F.first("mean").alias("mean"), ((at("low") + at("high")) / 2).alias("median"))
    wide = skews.groupBy("window").agg(*[
        F.round(F.max(F.when(F.col("column_name") == c, ratio(F.col("mean"), F.col("median")))), decimals).alias(f"{c}_skew") for c in columns])
    return counted.join(wide, "window", "left")


def count_summary(per: DataFrame, column: str) -> DataFrame:
    """Summary of a whole-number column with few distinct values, such as rows per entity.

    The input is reduced to one row per distinct value first, and that small table is stored,
    so the joins and aggregations behind `per` run once.
    """
    histogram = checkpointed(
        per.groupBy(F.col(column).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("w")).where("v IS NOT NULL")
    )
    v, w = (F.col(c).cast("decimal(19,0)") for c in ("v", "w"))
    sums = histogram.agg(
        F.sum("w").alias("n"),
        F.min("v").cast("double").alias("min"),
        F.max("v").cast("double").alias("max"),
        F.sum(v * w).cast("double").alias("total"),
        F.sum((v * v).cast("decimal(38,0)") * w).cast("double").alias("squares"),
    )
    # Exact, over few distinct values with their frequencies.
    percentiles = histogram.agg(*[
        F.percentile(F.col("v").cast("double"), F.lit(f), F.col("w")).alias(name) for name, f in SUMMARY_FRACTIONS.items()])
    row = percentiles.select(F.struct(*SUMMARY_FRACTIONS).alias("p")).scalar()
    mean = F.col("total") / F.col("n")
    deviation = F.sqrt((F.col("squares") - F.col("total") * mean) / F.nullif(F.col("n") - 1, F.lit(0)))
    return sums.withColumn("p", row).select(
        F.lit(column).alias("column_name"), "n", "min", "p.*", mean.alias("mean"), "max",
        deviation.alias("stddev"), ratio(mean, F.col("p.p50")).alias("mean_median_ratio"),
    )


def values_per_entity(pairs: DataFrame, entity: str) -> DataFrame:
    """Distribution of the number of rows per entity."""
    return count_summary(pairs.groupBy(entity).agg(F.count(F.lit(1)).alias("values_per_entity")), "values_per_entity")


def duplicate_inflation(pairs: DataFrame, entity: str, value: str) -> DataFrame:
    """Entities with more rows than distinct values."""
    return (
        pairs.groupBy(entity)
        .agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct(value).alias("distinct_count"))
        .where("row_count > distinct_count")
    )


def cap_at_percentile(
    df: DataFrame, column: str, fraction: float, capped: str, derived: bool = False
) -> DataFrame:
    """Add the column limited to its own percentile; NULL stays NULL."""
    limit = exact_percentiles(df, [], column, {"limit": fraction}, derived=derived).scalar()
    value = F.col(column).cast("double")
    return df.withColumn(capped, F.when(value.isNotNull(), F.least(value, limit)))


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column. Columns are stacked first, so one shuffle counts them all."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(F.inline(entries))
        .groupBy("column_name")
        .agg(F.countDistinct("value").alias("distinct_values"))
    )


def period_counts(df: DataFrame, period: str) -> DataFrame:
    """Min, max, mean and median of the rows per period."""
    per = df.groupBy(period).agg(F.count(F.lit(1)).alias("rows_per_period"))
    return count_summary(per, "rows_per_period").select(
        F.col("n").alias("periods"), "min", "max", "mean", F.col("p50").alias("median"), "mean_median_ratio"
    )


def fill_gain(before: DataFrame, after: DataFrame, columns: Sequence[str], decimals: int = 1) -> DataFrame:
    """Known values before and after filling, and the coverage of all rows, per column."""
    def known(df: DataFrame, name: str) -> DataFrame:
        return coverage(df, columns).select("column_name", F.col("filled").alias(name), (F.col("filled") + F.col("nulls")).alias(f"{name}_rows"))

    both = known(before, "before").join(known(after, "after"), "column_name")
    return both.select(
        "column_name",
        "before",
        (F.col("after") - F.col("before")).alias("added"),
        "after",
        pct_of_total(F.col("before"), F.col("before_rows"), decimals).alias("before_pct"),
        pct_of_total(F.col("after"), F.col("after_rows"), decimals).alias("after_pct"),
    )


def known_cohort(df: DataFrame, columns: Sequence[str], decimals: int = 1) -> DataFrame:
    """Rows in which every named column is known, and their share of all rows."""
    known = reduce(lambda left, right: left & right, (F.col(c).isNotNull() for c in columns))
    return df.agg(
        F.count_if(known).alias("cohort"), F.count(F.lit(1)).alias("total_rows")
    ).withColumn("share_pct", pct_of_total(F.col("cohort"), F.col("total_rows"), decimals))


def scope_summary(df: DataFrame, year: str, focus: int) -> DataFrame:
    """Rows, rows of one year, first and last year, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(year) == focus).alias("rows_in_focus_year"),
        F.min(year).alias("min_year"),
        F.max(year).alias("max_year"),
    )
