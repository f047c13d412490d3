"""Are two tables the same rows, in any order? And if not, which rows differ?

A fingerprint is the count and the sums of two independent hashes of all rows, one pass and no shuffle of rows.
To find differences, both sides are fingerprinted by bucket of the key; only rows of buckets that differ are
compared, by key and row hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of a side are dealt to so many buckets, so a few damaged rows lead to a few parts in BUCKETS of all rows.
BUCKETS = 4096
_PIECE = (1 << 21) - 1
LOST, DOUBLED, EXTRA, CHANGED = "lost", "doubled", "extra", "changed"


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """A hash of the values; a NULL counts by its place, and a value also by its type (1 as int is not 1 as long)."""
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts)


def _exact_sum(value: Column) -> Column:
    """The sum of longs as a decimal, 0 without rows. Three pieces of each value are summed as longs, which is
    much faster than decimals and has room for 2^41 rows."""
    pieces = (F.shiftright(value, 42), F.shiftright(value, 21).bitwiseAND(_PIECE), value.bitwiseAND(_PIECE))
    high, middle, low = (F.coalesce(F.sum(p), F.lit(0)).cast("decimal(19,0)") for p in pieces)
    return (high * F.lit(1 << 42).cast("decimal(14,0)") + middle * F.lit(1 << 21).cast("decimal(14,0)") + low).cast("decimal(38,0)")


def hash_sums(columns: Sequence[str]) -> list[Column]:
    """Aggregates: rows, and the sums of two hashes."""
    return [F.count(F.lit(1)).alias("rows"), *[_exact_sum(row_hash(columns, seed)).alias(f"sum{seed}") for seed in (0, 1)]]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, str]:
    """Row count and a text that is equal for equal rows in any order."""
    found = df.agg(*hash_sums(columns or df.columns)).first()
    return found["rows"], f"{found['sum0']}:{found['sum1']}"


def row_differences(source: DataFrame, stored: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """key, fault, lost_rows, extra_rows of every key whose rows differ. lost: rows of the source are missing;
    doubled: rows of the source are there more often; extra: rows that the source lacks; changed: both. A NULL
    key is a key. Hot keys are counted by row before they are shuffled."""
    columns = list(columns or source.columns)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).alias("_bucket")

    def by_bucket(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(bucket).agg(*hash_sums(columns)).select("_bucket", F.struct("rows", "sum0", "sum1").alias(name))
    differing = by_bucket(source, "a").join(by_bucket(stored, "b"), "_bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("_bucket")

    def rows(side: DataFrame, is_source: bool) -> DataFrame:
        # At most BUCKETS rows on the right.
        return side.select(F.col(key).alias("_key"), row_hash(columns).alias("_row"), bucket, F.lit(is_source).alias("_source")).join(
            F.broadcast(differing), "_bucket", "left_semi").select("_key", "_row", "_source")
    # Both sides are counted by one aggregate, so a task holds its rows once; rows as often on either side say
    # nothing and go before the keys are put together.
    both = rows(source, True).union(rows(stored, False)).groupBy("_key", "_row").agg(
        F.count_if("_source").alias("n"), F.count_if(~F.col("_source")).alias("m")).where("n <> m")
    per = both.groupBy("_key").agg(
        F.sum(F.greatest(F.col("n") - F.col("m"), F.lit(0))).alias("lost_rows"),
        F.sum(F.greatest(F.col("m") - F.col("n"), F.lit(0))).alias("extra_rows"),
        F.count_if((F.col("m") > F.col("n")) & (F.col("n") == 0)).alias("foreign"))
    fault = (F.when(F.col("extra_rows") == 0, LOST).when(F.col("lost_rows") > 0, CHANGED)
             .when(F.col("foreign") > 0, EXTRA).otherwise(DOUBLED))
    return per.where("lost_rows + extra_rows > 0").select(F.col("_key").alias(key), fault.alias("fault"), "lost_rows", "extra_rows")
