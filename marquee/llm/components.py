"""Connected components of a graph given as links, without bringing them together anywhere."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch


def _forest(batches):
    """A spanning forest of the links of one partition, by union-find: each node with its least root."""
    parent: dict[bytes, bytes] = {}

    def root(x):
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, r) for x in list(parent) if (r := root(x)) != x]
    for i in range(0, len(rows), 100_000):
        part = rows[i:i + 100_000]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in part], pa.binary()), "b": pa.array([r for _, r in part], pa.binary())})


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Move links to the least neighbour. Large: every larger neighbour of a node is linked with the
    node's least one; small: every smaller-or-equal one is. Hot nodes stand left in the join, where
    adaptive execution splits them; the least neighbour is found by a map-side aggregate."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = both.join(least, both["a"] == least["u"])
    if large:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).where("a <> b").distinct()


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """node, root for every node of the links (a, b; binary): root is the least node it reaches and is
    listed too. Partitions join what they can by union-find; then large and small star steps alternate
    until nothing moves, in a number of rounds logarithmic in the size of a component."""
    current = scratch.keep(links.select("a", "b").where("a <> b").mapInArrow(_forest, "a binary, b binary"), f"{name}0")
    mark, step = None, 0
    while True:
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark, step = seen, step + 1
        nxt = scratch.keep(_star(_star(current, True), False), f"{name}{step}")
        scratch.drop(f"{name}{step - 1}")
        current = nxt
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return scratch.keep(current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), f"{name}-nodes")
