"""Data checks. A report has one row per check: check, severity, violations; zero is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marquee.contracts import Table
from marquee.functions.text import all_blank, is_blank
from marquee.operators.dedup import repeated
from marquee.operators.fingerprint import hash_sums

ERROR, WARN = "error", "warn"
_REPORT = "check string, severity string, violations bigint"


class GateFailure(RuntimeError):
    """At least one check of severity error found violations."""

    def __init__(self, layer: str, failed: Sequence[tuple[str, int]], rows: Sequence[tuple[str, str, int]] = ()):
        self.layer, self.failed, self.rows = layer, list(failed), list(rows)
        super().__init__(f"{layer}: " + ", ".join(f"{name} ({count})" for name, count in self.failed))


def not_null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def not_blank(*columns: str) -> Column:
    """Texts that are there but blank."""
    blank = [F.col(c).isNotNull() & is_blank(F.col(c)) for c in columns]
    return F.count_if(reduce(lambda left, right: left | right, blank))


def not_negative(*columns: str) -> Column:
    below = [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns]
    return F.count_if(reduce(lambda left, right: left | right, below))


def accepted(column: str, values: Iterable[object], where: Column | None = None) -> Column:
    """Values outside the list; NULL passes."""
    outside = ~F.col(column).isin(*values)
    return F.count_if(outside if where is None else where & outside)


def not_empty() -> Column:
    return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


def no_empty_rows(columns: Sequence[str]) -> Column:
    return F.count_if(all_blank(columns))


def table_checks(df: DataFrame, checks: Mapping[str, Column], severity: str = ERROR) -> DataFrame:
    """Run any number of aggregate checks over a table in one pass."""
    return graded_checks(df, {severity: checks})


def graded_checks(df: DataFrame, checks: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Checks of several severities, still in one pass."""
    each = [(name, severity, violations) for severity, some in checks.items() for name, violations in some.items()]
    counted = df.agg(*[violations.cast("bigint").alias(f"_{i}") for i, (_, _, violations) in enumerate(each)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.col(f"_{i}").alias("violations"))
        for i, (name, severity, _) in enumerate(each)
    ])
    return counted.select(F.inline(rows))


def expect_none(name: str, violating: DataFrame, severity: str = ERROR) -> DataFrame:
    """A check whose violations are the rows of a frame."""
    return violating.agg(
        F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.count(F.lit(1)).alias("violations")
    )


def unique(name: str, df: DataFrame, keys: Sequence[str], severity: str = ERROR) -> DataFrame:
    return expect_none(name, repeated(df, keys), severity)


def same_count(name: str, source: DataFrame, stored: DataFrame, severity: str = ERROR) -> DataFrame:
    """The violation count is the difference in rows."""
    expected = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stored.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.abs(F.col("n") - expected).alias("violations")
    )


def same_rows(name: str, source: DataFrame, stored: DataFrame, columns: Sequence[str], severity: str = ERROR) -> DataFrame:
    """Two checks from one pass over each side: `row_count` has the difference in rows as its violations,
    `row_fingerprint` has 1 if the sides do not hold the same rows in any order."""
    sums = hash_sums(columns)
    expected = source.agg(F.struct(*sums).alias("s")).scalar()
    found = stored.agg(F.struct(*sums).alias("found")).withColumn("expected", expected)
    rows = F.array(*[F.struct(F.lit(f"{name}.{check}").alias("check"), F.lit(severity).alias("severity"), violations.cast("bigint").alias("violations"))
                     for check, violations in (("row_count", F.abs(F.col("found.rows") - F.col("expected.rows"))),
                                               ("row_fingerprint", (F.col("found") != F.col("expected")).cast("int")))])
    return found.select(F.inline(rows))


def contract(spark: SparkSession, name: str, schema: T.StructType, table: Table) -> DataFrame:
    """Column set and types against the declaration. Needs no scan."""
    found = {f.name: f.dataType for f in schema.fields if f.name not in table.technical}
    declared = {c.name: c.type for c in table.columns}
    faults = len(found.keys() ^ declared.keys()) + sum(
        found[c] != declared[c] for c in found.keys() & declared.keys()
    )
    return spark.createDataFrame([(name, ERROR, faults)], _REPORT)


def report(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(layer: str, checks: DataFrame) -> list[tuple[str, str, int]]:
    """Run all checks, then stop if any error was found. Returns the report rows."""
    rows = [(r["check"], r["severity"], r["violations"]) for r in checks.collect()]
    failed = [(name, count) for name, severity, count in rows if severity == ERROR and count]
    if failed:
        raise GateFailure(layer, failed, rows)
    return rows
