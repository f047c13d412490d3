from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.contracts import NA_TOKENS, SOURCE_ORDER, Table
from marquee.functions.text import is_blank, na_to_null

_RECORD = "_record"


def header(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> list[str]:
    """Column names in the order of the header line."""
    return spark.read.csv(paths, header=True, multiLine=multi_line, escape='"').columns


def read_raw(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: Table,
    na_tokens: Iterable[str] = NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV as text columns in declared order, with the position of each row in its source.

    Columns are matched by header name, and every file must carry the same header. Blank lines
    are skipped, short rows are padded with NULL, a row with too many fields fails the read.
    A file with line breaks inside quotes cannot be split, so land many files; pass
    `multi_line=False` when no value holds a line break and large files should be split.
    """
    found = header(spark, paths, multi_line)
    if sorted(found) != sorted(table.names):
        raise ValueError(f"{table.name}: header {found} does not match {table.names}")
    fields = [T.StructField(name, T.StringType()) for name in found]
    lines = (
        spark.read.option("columnPruning", False)
        .csv(
            paths,
            schema=T.StructType([*fields, T.StructField(_RECORD, T.StringType())]),
            header=True,
            enforceSchema=False,
            multiLine=multi_line,
            escape='"',
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=_RECORD,
        )
        .select(
            "*",
            F.col("_metadata.file_path").alias(SOURCE_ORDER[0]),
            F.col("_metadata.file_block_start").alias(SOURCE_ORDER[1]),
            F.monotonically_increasing_id().alias(SOURCE_ORDER[2]),
        )
    )
    # The reader reports the text of every row whose field count differs from the schema.
    record = F.col(_RECORD)
    separators = F.length(F.regexp_replace(F.regexp_replace(record, '"[^"]*+"', ""), "[^,]", ""))
    too_long = record.isNotNull() & (separators >= len(found))
    message = F.concat(F.lit(f"{table.name}: expected {len(found)} fields in record: "), record)
    blank = record.isNotNull() & is_blank(record) & is_blank(F.col(found[0]))
    kept = lines.where(F.when(too_long, F.raise_error(message)).otherwise(~blank))
    tokens = tuple(na_tokens)
    texts = [(na_to_null(F.col(c), tokens) if tokens else F.col(c)).alias(c) for c in table.names]
    return kept.select(*texts, *SOURCE_ORDER)
