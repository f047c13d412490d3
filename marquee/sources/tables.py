from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marquee.contracts import Table
from marquee.operators.fingerprint import fingerprint
from marquee.sources.versions import current, hadoop, read_parts, write_version


class EmptyResult(ValueError):
    """A table that must hold rows came out empty."""


class CountMismatch(ValueError):
    """The stored rows are not the rows that were written."""


class RowMismatch(ValueError):
    """As many rows are stored as were written, but not the same."""


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Bring a frame of an older layout to the declared one: renames, added columns, order."""
    for column in table.columns:
        if column.formerly and column.formerly in df.columns and column.name not in df.columns:
            df = df.withColumnRenamed(column.formerly, column.name)
        if column.name not in df.columns:
            df = df.withColumn(column.name, F.lit(column.default).cast(column.type))
    return df.select(*table.names, *[c for c in table.technical if c in df.columns])


def storage_cast(df: DataFrame, table: Table) -> DataFrame:
    """Cast to the declared types. A value that does not fit, is too long or is missing where
    one is required fails the job, whether or not the session runs in ANSI mode."""
    def stored(name: str, column_type: T.DataType, required: bool, length: int | None) -> Column:
        raw = F.col(name)
        value = raw.try_cast(column_type)
        fault = value.isNull() & raw.isNotNull()
        if required:
            fault = fault | raw.isNull()
        if length:
            fault = fault | (F.length(value) > length)
        problem = F.raise_error(F.concat(
            F.lit(f"{table.name}.{name} cannot store: "), F.coalesce(raw.cast("string"), F.lit("NULL"))
        ))
        return F.when(fault, problem).otherwise(value).cast(column_type).alias(name)

    return df.select(
        *[stored(c.name, c.type, c.required, c.max_length) for c in table.columns],
        *[c for c in table.technical if c in df.columns],
    )


def write_table(df: DataFrame, path: str, table: Table | None = None, allow_empty: bool = False) -> int:
    """Replace the table at `path` by a new version and return its row count, read back from what was stored.

    An empty result, or a job that fails at any step, leaves the old version as it is. Rewriting gives
    the same table, so a failed run is simply run again.
    """
    ready = storage_cast(conform(df, table), table) if table else df
    version = write_version(ready, path, least_rows=0 if allow_empty else 1)
    if version is None:
        raise EmptyResult(f"no rows for {path}")
    return version.rows


def append_table(df: DataFrame, path: str) -> int:
    """Add rows, in whatever layout they have, and return the row count of the new version."""
    return write_version(df, path, append=True).rows


def read_table(spark: SparkSession, path: str, table: Table | None = None) -> DataFrame:
    """The current version of a table, or a plain Parquet folder. Parts in older layouts are brought to the
    declared one, if it is given, else to one that has the columns of all."""
    version = current(spark, path)
    if version is None:
        return spark.read.parquet(path)
    frames = read_parts(spark, path, version)
    if table:
        return reduce(DataFrame.unionByName, [storage_cast(conform(f, table), table) for f in frames])
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_mixed(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """A folder of Parquet files, some of them in older layouts, as one frame of the declared layout.

    Files are taken in the order of their age. Those whose types agree are read by one scan; where types
    changed in between, a stretch of files is halved until the types of each half agree, so there are about
    as many scans as there were changes.
    """
    where, files = hadoop(spark, path)
    found = sorted((f.getModificationTime(), f.getPath().toString()) for f in files.listStatus(where)
                   if f.isFile() and not f.getPath().getName().startswith(("_", ".")))

    def frames(part: list[str]) -> list[DataFrame]:
        try:
            return [_one_scan(spark, part, table)]
        except (PySparkException, Py4JJavaError) as error:
            # PySpark hands the failed merge of schemas on as it came from Java.
            if len(part) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
        half = len(part) // 2
        return frames(part[:half]) + frames(part[half:])
    stretches = frames([name for _, name in found])
    return reduce(DataFrame.unionByName, [storage_cast(conform(f, table), table) for f in stretches])


def _one_scan(spark: SparkSession, files: list[str], table: Table) -> DataFrame:
    """Files whose layouts differ in names only: a file has a renamed column under one of its two names."""
    df = spark.read.option("mergeSchema", True).parquet(*files)
    for column in table.columns:
        if column.formerly in df.columns and column.name in df.columns:
            new, old = F.col(column.name), F.col(column.formerly)
            twice = F.raise_error(F.lit(f"{table.name}: a row has both {column.name} and {column.formerly}"))
            value = F.when(new.isNotNull() & old.isNotNull(), twice).otherwise(F.coalesce(new, old))
            df = df.withColumn(column.name, value).drop(column.formerly)
    return df


def first_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """Some n rows, in no order, for a look at the data. Checks read all rows."""
    return df.limit(n)


def sample_rows(df: DataFrame, key: str, n: int = 1000, salt: str = "") -> DataFrame:
    """n rows that depend on their keys alone, not on files, partitions or runs: those of the least digests of
    key and salt. Each task keeps its n least; rows of one key are taken in the order of their values."""
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return df.orderBy(digest, *df.columns).limit(n)


def table_columns(spark: SparkSession, path: str) -> list[str]:
    """Ordered column names of a stored table."""
    columns = read_table(spark, path).columns
    if not columns:
        raise KeyError(f"no columns found at {path}")
    return columns


def verify_count(source: DataFrame, stored: DataFrame) -> int:
    """Row count of both frames, which must agree."""
    expected, found = source.count(), stored.count()
    if expected != found:
        raise CountMismatch(f"{found} rows stored, {expected} in the source")
    return found


def verify_rows(source: DataFrame, stored: DataFrame) -> int:
    """Row count of both frames, which must hold the same rows in any order; one pass each."""
    columns = source.columns
    expected, found = fingerprint(source, columns), fingerprint(stored, columns)
    if expected[0] != found[0]:
        raise CountMismatch(f"{found[0]} rows stored, {expected[0]} in the source")
    if expected != found:
        raise RowMismatch(f"the {found[0]} rows stored are not those of the source")
    return found[0]


def declare_table(spark: SparkSession, database: str, table: Table, recreate: bool = False) -> None:
    """Create a catalogue table with column descriptions if it is absent, or anew on request."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table.name}`"
    if recreate:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_declared(spark, name, table)


def create_declared(spark: SparkSession, name: str, table: Table, location: str | None = None) -> None:
    def one(c) -> str:
        comment = c.comment.replace("\\", "\\\\").replace("'", "\\'")
        return f"`{c.name}` {c.type.simpleString()}" + (" NOT NULL" if c.required else "") + (f" COMMENT '{comment}'" if comment else "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(one, table.columns))}) USING parquet"
              + (f" LOCATION '{location}'" if location else ""))


def publications(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and path of every complete publication, oldest first. A pointer whose write broke off
    has no success mark and counts for nothing."""
    where, files = hadoop(spark, f"{root}/_published")
    if not files.exists(where):
        return []
    found = [s.getPath() for s in files.listStatus(where)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted((int(p.getName()), p.toString()) for p in done)


def publish(spark: SparkSession, root: str, run: str) -> None:
    """Make a finished run the one that readers see. Every publication is a new numbered pointer, so
    there is no moment without one."""
    number = max([n for n, _ in publications(spark, root)], default=0) + 1
    pointer = spark.createDataFrame([(run,)], "run string").coalesce(1)
    pointer.write.mode("overwrite").parquet(f"{root}/_published/{number:08d}")


def published(spark: SparkSession, root: str) -> str:
    """The run of the latest complete publication."""
    found = publications(spark, root)
    if not found:
        raise LookupError(f"nothing is published in {root}")
    return spark.read.parquet(found[-1][1]).first()["run"]


def published_runs(spark: SparkSession, root: str) -> set[str]:
    """Every run that readers see or saw."""
    found = publications(spark, root)
    return {r["run"] for r in spark.read.parquet(*[p for _, p in found]).collect()} if found else set()
