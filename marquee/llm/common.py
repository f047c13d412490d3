"""Helpers that several operators share: shared scratch tables, words, digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.session import shared_folder

# Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[ \x09-\x0D]+"
NON_SPACE = r"[^ \x09-\x0D]"


class Scratch:
    """Tables written to the folder that all executors share, so that a lost executor costs nothing
    that was finished. They go when the application ends, or earlier by `drop`."""

    def __init__(self, spark: SparkSession, batch_rows: int | None = None):
        """`batch_rows`: tasks hand Python so many rows at a time while a table is written."""
        self.spark, self.batch_rows = spark, batch_rows
        self.folder = f"{shared_folder(spark)}/marquee-{uuid.uuid4().hex}"
        self._path("").getFileSystem(self._conf()).deleteOnExit(self._path(""))

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        usual = self.spark.conf.get(key)
        if self.batch_rows:
            self.spark.conf.set(key, str(self.batch_rows))
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        finally:
            self.spark.conf.set(key, usual)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def put(self, name: str, data: bytes) -> str:
        """A file of bytes in the folder; returns its whole path."""
        path = self._path(name)
        system = path.getFileSystem(self._conf())
        out = system.create(path, True)
        out.write(bytearray(data))
        out.close()
        return system.makeQualified(path).toString()

    def named_apart(self, name: str, mark: str) -> list[str]:
        """The Parquet files of a stored table, under names that no other file of the application has, as
        files that are sent to tasks must."""
        path = self._path(name)
        system = path.getFileSystem(self._conf())
        found = sorted(f.getPath().toString() for f in system.listStatus(path)) if system.exists(path) else []
        out = []
        for i, file in enumerate(f for f in found if f.endswith(".parquet")):
            to = f"{file.rpartition('/')[0]}/{self.folder.rpartition('/')[2]}-{mark}-{i}.parquet"
            system.rename(self.spark._jvm.org.apache.hadoop.fs.Path(file), self.spark._jvm.org.apache.hadoop.fs.Path(to))
            out.append(to)
        return out

    def drop(self, name: str) -> None:
        """Free a table that no later plan reads."""
        path = self._path(name)
        path.getFileSystem(self._conf()).delete(path, True)


def whole_text(column: str = "text") -> Column:
    """The text of a row; no text counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A task works on so many rows of an Arrow batch at once.
SLICE = 256


def sliced(batches):
    """The rows of Arrow batches in small portions, so that Python holds few texts at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


#: A stored table of at most so many bytes may be broadcast; in memory it can be a few times larger.
BROADCAST_BYTES = 8 << 20


def bounded_side(scratch: Scratch, stored: DataFrame, name: str) -> DataFrame:
    """A stored table for the right side of a join: broadcast when its files are few bytes, else the
    join shuffles, and adaptive execution splits hot keys of the other side."""
    path = scratch._path(name)
    held = path.getFileSystem(scratch._conf()).getContentSummary(path).getLength()
    return F.broadcast(stored) if held <= BROADCAST_BYTES else stored
