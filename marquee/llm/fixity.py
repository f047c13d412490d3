"""Fixity audit of web-archive replicas with Merkle trees.

Records are hashed where they lie; ranges of a fixed number of bytes, by offset, hash the records that
begin in them, in order; sixteen neighbouring ranges make one of the next level, up to a single root.
Two replicas with equal roots are equal. Else the audit descends level by level, and only below ranges
that differ, down to the records. Payloads are never shuffled, only digests are, and a range holds a
bounded number of records however many there are in all.

Defined cases: a record that one replica lacks is missing or extra; a record stored twice at an offset
is one, or a conflict if the copies differ, which is reported for either replica and whatever the other
one holds; all different copies are sealed, in no order, so a third one does not go unseen; null payloads
are empty; two empty replicas are equal; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import Scratch, bounded_side

RANGE_BYTES = 1 << 18
FAN_OUT = 16


def warc_record(url: Column, body: Column) -> Column:
    """A resource record of the WARC 1.1 format."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def digest(payload: Column) -> Column:
    return F.sha2(F.coalesce(payload.cast("binary"), F.lit(b"")), 256)


def laid_out(scratch: Scratch, records: DataFrame, order: list[str]) -> DataFrame:
    """The rows with `offset`, the sum of `length` of all rows before, in this order. Rows are sorted
    over all tasks; the sums of the tasks before are added to those inside a task."""
    ranged = scratch.keep(records.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_part").agg(F.sum("length").alias("_sum"))
    # One row per task.
    before = sums.withColumn("_before", F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).drop("_sum")
    inside = F.sum("length").over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    rows = ranged.withColumn("_inside", inside).join(F.broadcast(before), "_part")
    return rows.withColumn("offset", F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


class Tree:
    """The levels of one replica: (id, hash) of each range; level 0 are the ranges of records."""

    def __init__(self, scratch: Scratch, replica: DataFrame, name: str, levels: int):
        # Equal copies are one. The sums of four parts of their hashes stand for all copies of an offset, however
        # many there are, without bringing them together.
        copies = replica.groupBy("offset", "length", "digest").agg(F.min("record").alias("record")).withColumn(
            "_hash", F.sha2(F.concat_ws("|", F.col("length"), F.coalesce("digest", F.lit("-"))), 256))
        parts = [F.sum(F.conv(F.substring("_hash", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"_p{i}") for i in range(4)]
        leaves = copies.groupBy("offset").agg(
            F.count("*").alias("n"), F.min(F.struct("length", "digest")).alias("low"), F.min("record").alias("record"), *parts)
        seal = F.sha2(F.concat_ws("|", "offset", "n", "low.length", F.coalesce("low.digest", F.lit("-")), *[f"_p{i}" for i in range(4)]), 256)
        self.leaves = scratch.keep(leaves.select(
            "offset", "record", F.col("low.length").alias("length"), (F.col("n") > 1).alias("conflict"),
            seal.alias("hash"), F.floor(F.col("offset") / RANGE_BYTES).alias("range")), f"{name}-leaves")
        self.levels, ids = [], ("range", "offset")
        below = self.leaves
        for level in range(levels):
            group, place = ids
            nodes = below.groupBy(F.col(group).alias("id")).agg(F.sha2(F.array_join(F.transform(
                F.sort_array(F.collect_list(F.struct(place, "hash"))), lambda x: x["hash"]), ""), 256).alias("hash"))
            below = scratch.keep(nodes.withColumn("up", F.floor(F.col("id") / FAN_OUT)), f"{name}-{level}")
            self.levels.append(below)
            ids = ("up", "id")


def audit(scratch: Scratch, left: DataFrame, right: DataFrame) -> DataFrame:
    """record, offset, length, fault of every record in which two replicas (record, offset, length,
    digest) differ: missing or extra on the right, changed, or conflict."""
    top = left.select("offset").union(right.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels, ranges = 1, top // RANGE_BYTES + 1
    while ranges > 1:
        levels, ranges = levels + 1, -(-ranges // FAN_OUT)
    a, b = Tree(scratch, left, "left", levels), Tree(scratch, right, "right", levels)
    differing = None
    for level in reversed(range(levels)):
        sides = [t.levels[level] for t in (a, b)]
        if differing is not None:
            sides = [s.join(differing, "up", "left_semi") for s in sides]
        x, y = (s.select("id", F.col("hash").alias(h)) for s, h in zip(sides, ("x", "y")))
        apart = x.join(y, "id", "full").where(~F.col("x").eqNullSafe(F.col("y"))).select(F.col("id").alias("up"))
        differing = bounded_side(scratch, scratch.keep(apart, f"apart{level}"), f"apart{level}")
    wanted = differing.select(F.col("up").alias("range"), F.lit(True).alias("wanted"))
    # Below ranges that differ, and wherever the copies of one replica conflict.
    x, y = (t.leaves.join(wanted, "range", "left").where("wanted OR conflict").select(
        "offset", *[F.col(c).alias(f"{c}{n}") for c in ("record", "length", "hash", "conflict")]) for t, n in ((a, 1), (b, 2)))
    both = x.join(y, "offset", "full").where(~F.col("hash1").eqNullSafe(F.col("hash2")) | F.col("conflict1") | F.col("conflict2"))
    fault = (F.when(F.col("hash2").isNull(), "missing").when(F.col("hash1").isNull(), "extra")
             .when(F.col("conflict1") | F.col("conflict2"), "conflict").otherwise("changed"))
    return both.select(F.coalesce("record1", "record2").alias("record"), "offset", F.coalesce("length1", "length2").alias("length"), fault.alias("fault"))


# Which records of the second replica are damaged, by the number of the page.
FLIPPED, CUT, LOST = (97, 13), (311, 5), (499, 7)


def pages_audit(pages: DataFrame) -> DataFrame:
    """page_id, offset, length, fault: the pages as an archive, against a replica of it in which some
    records have a changed byte, are cut or are lost."""
    scratch = Scratch(pages.sparkSession)

    def hit(rule):
        return F.coalesce(F.pmod(F.col("page_id"), F.lit(rule[0])) == rule[1], F.lit(False))
    whole = warc_record(F.col("url").cast("string"), F.col("html").cast("string"))
    rows = pages.select("page_id", whole.alias("_record"))
    other = F.when(hit(CUT), F.substring("_record", F.lit(1), F.length("_record") - 9)).when(
        hit(FLIPPED), F.overlay("_record", F.lit("\u0001"), F.lit(30))).otherwise(F.col("_record"))
    rows = rows.select("page_id", F.octet_length("_record").cast("long").alias("length"), digest(F.col("_record")).alias("first"),
                       F.when(~hit(LOST), F.struct(F.octet_length(other).cast("long").alias("length"), digest(other).alias("digest"))).alias("second"))
    rows = scratch.keep(laid_out(scratch, rows, ["page_id", "first"]), "records")
    left = rows.select(F.col("page_id").alias("record"), "offset", "length", F.col("first").alias("digest"))
    right = rows.where("second is not null").select(F.col("page_id").alias("record"), "offset", "second.length", "second.digest")
    return audit(scratch, left, right).withColumnRenamed("record", "page_id")
