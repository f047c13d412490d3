"""The history of checks: an append-only table of every gate of every run, which outlives the runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.sources.versions import hadoop

SCHEMA = "run string, layer string, check string, severity string, violations bigint, stopped boolean, checked_at timestamp"


def record(spark: SparkSession, root: str, run: str, layer: str, rows: Sequence[tuple[str, str, int]], stopped: bool) -> None:
    """Append the report of one gate; `stopped` says that it let nothing through. One small file a gate."""
    report = spark.createDataFrame(list(rows), "check string, severity string, violations bigint")
    report.select(
        F.lit(run).alias("run"), F.lit(layer).alias("layer"), "check", "severity", "violations",
        F.lit(stopped).alias("stopped"), F.current_timestamp().alias("checked_at"),
    ).coalesce(1).write.mode("append").parquet(f"{root}/_audit")


def history(spark: SparkSession, root: str) -> DataFrame:
    """Every recorded check; no rows before the first run."""
    where, files = hadoop(spark, f"{root}/_audit")
    return spark.read.schema(SCHEMA).parquet(f"{root}/_audit") if files.exists(where) else spark.createDataFrame([], SCHEMA)


def stops(spark: SparkSession, root: str) -> DataFrame:
    """run, layer, check, violations of every check of error severity that stopped a run."""
    return history(spark, root).where("stopped AND severity = 'error' AND violations > 0").select("run", "layer", "check", "violations")


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    """run, attempts, passed gates, and the layer of the last stop of every run, if any."""
    gates = history(spark, root).groupBy("run", "layer", "stopped", "checked_at").agg(F.count(F.lit(1)).alias("checks"))
    return gates.groupBy("run").agg(
        F.count_if(~F.col("stopped")).alias("gates_passed"), F.count_if("stopped").alias("times_stopped"),
        F.max_by(F.when(F.col("stopped"), F.col("layer")), "checked_at").alias("stopped_at"),
        F.sum("checks").alias("checks"),
    )
