"""Divergence between the sources of a language, and the terms that set a source apart.

A group is a source within a language. Its distribution over the language's kept terms is smoothed by one
occurrence each and held in whole billionths, so every figure is exact. The comparison of all groups of a
language is a cube of cells (group block, group block, term block): a cell holds the slices of its two group
blocks in its term block, adds up the part of every divergence that its terms make, in both directions, and a
sum along the term axis gives the whole. Slices are replicated once per group block they meet; the size of a
cell is bounded (GROUPS groups a side, about TERMS terms) however many groups and terms there are.

Terms are counted in tasks, in tables of a bounded size that are flushed when full, and then by group and
term, so a source that holds a third of all rows is spread over its terms.

Defined cases: a null text, lang or source is empty; every row is a document, repeated rows too; a group
without terms takes part with its smoothed distribution; without kept terms all divergences of a language are
0; ties are ordered by the UTF-8 bytes of the item; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import Scratch, sliced

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Groups in a block, and terms in a block on average.
GROUPS = 16
TERMS = 1 << 15
#: A task holds so many counted terms before it hands them on.
HELD = 300_000
PIECE = 1 << 20

# Letters A-Z count as a-z; all other ASCII characters part terms; bytes of other characters stay.
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("df", pa.int64())])


def pieces(text: bytes):
    """A text in parts of about PIECE bytes that end where a term ends."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        cut = text.rfind(b" ", at + 1, end)
        if cut < 0:
            cut = text.find(b" ", end)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def _count(batches):
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush():
        for (lang, source), (n, df) in held.items():
            terms = list(n)
            for i in range(0, len(terms), 50_000):
                part = terms[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part)), pa.array([source] * len(part)), pa.array(part, pa.binary()),
                    pa.array([n[t] for t in part], pa.int64()), pa.array([df[t] for t in part], pa.int64())], schema=_COUNTS)
        held.clear()

    for batch in sliced(batches):
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            n, df = held.setdefault((lang, source), (Counter(), Counter()))
            seen = set()
            for piece in pieces(text.translate(_FOLDED)):
                terms = piece.split()
                n.update(terms)
                seen.update(terms)
            df.update(seen)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * count / total) in whole numbers: long division by three digits of base 1,000, so
    that nothing overflows for totals up to 9e15."""
    out, rest = F.lit(1).cast("long"), count
    for digit in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", rest * 1000, total) * digit
        rest = (rest * 1000) % total
    return out


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(count: np.ndarray, total: int) -> np.ndarray:
    """As `share`, of count + 1."""
    out, rest = np.ones(len(count), np.int64), count + 1
    for digit in (1_000_000, 1_000, 1):
        out += rest * 1000 // total * digit
        rest = rest * 1000 % total
    return out


def _gains(p, q):
    return (p - q) * (p - q) // q


class _Slice:
    """The counts of one group in one term block."""

    def __init__(self, row: dict, width: int):
        self.source, self.block = row["source"], row["block"]
        total = max(row["total"] + row["kept"], 1)
        self.at = row["at"]
        self.none = int(_shares(np.zeros(1, np.int64), total)[0])
        self.p = _shares(row["n"], total)
        self.dense = np.full(width, self.none, np.int64)
        self.dense[self.at] = self.p

    def against(self, other: _Slice, terms: int) -> int:
        """The sum over the block's terms: all as if this group had none of them, then its own put right."""
        rest = (terms - len(other.at)) * _gains(self.none, other.none)
        theirs = other.dense[self.at]
        return int(rest + _gains(self.none, other.p).sum() + (_gains(self.p, theirs) - _gains(self.none, theirs)).sum())


def _cell(key, table):
    lang, low, high, _ = (k.as_py() for k in key)
    rows = table.select(["source", "block", "total", "kept"]).to_pylist()
    for column in ("at", "n"):
        for row, held in zip(rows, table[column]):
            row[column] = held.values.to_numpy(zero_copy_only=False).astype(np.int64) if held.is_valid else np.empty(0, np.int64)
    terms = table["terms"][0].as_py()
    slices = [_Slice(r, terms) for r in rows]
    left, right = ([s for s in slices if s.block == b] for b in (low, high))
    out = [(a.source, b.source, a.against(b, terms)) for x, y in ({(low, high), (high, low)})
           for a in (left if x == low else right) for b in (left if y == low else right) if a is not b]
    return pa.table({
        "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array([x[0] for x in out], pa.string()),
        "item": pa.array([x[1] for x in out], pa.string()), "value": pa.array([x[2] for x in out], pa.int64())})


class _Audit:
    """The steps of one run; everything that is used more than once is stored."""

    def __init__(self, docs: DataFrame):
        scratch = Scratch(docs.sparkSession)
        named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
        texts = docs.select(*named, F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
        counted = texts.mapInArrow(_count, "lang string, source string, term binary, n long, df long")
        counts = scratch.keep(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "counts")
        groups = scratch.keep(docs.select(*named).distinct(), "groups")
        kept = scratch.keep(counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("df").alias("df")).where(
            F.col("df") >= MIN_DOCUMENTS).select("lang", "term", "all"), "kept")
        # One row per language: kept terms V, their occurrences N, and the number of blocks on both axes.
        langs = groups.groupBy("lang").agg(F.count("*").alias("groups")).join(
            kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total")), "lang", "left").select(
            "lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
            F.ceil(F.col("groups") / GROUPS).alias("blocks"), F.greatest(F.lit(1), F.ceil(F.coalesce("kept", F.lit(0)) / TERMS)).alias("term_blocks"))
        langs = scratch.keep(langs, "langs")
        # A term's place within its block; blocks are dealt by hash, so each holds about TERMS.
        in_block = kept.join(langs.select("lang", "term_blocks"), "lang").withColumn(
            "term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")))
        numbered = scratch.keep(in_block.withColumn("at", F.row_number().over(Window.partitionBy("lang", "term_block").orderBy("term")) - 1).select(
            "lang", "term", "all", "term_block", "at"), "numbered")
        rows = scratch.keep(counts.select("lang", "source", "term", "n").join(numbered, ["lang", "term"]), "rows")
        totals = rows.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        self.groups = scratch.keep(groups.join(langs, "lang").join(totals, ["lang", "source"], "left").withColumn(
            "total", F.coalesce("total", F.lit(0))).withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))), "sized")
        self.scratch, self.rows, self.numbered = scratch, rows, numbered

    def pairs(self) -> DataFrame:
        """lang, source, item, value for every ordered pair of groups of a language."""
        sizes = self.numbered.groupBy("lang", "term_block").agg(F.count("*").alias("terms"))
        held = self.rows.groupBy("lang", "source", "term_block").agg(F.collect_list(F.struct("at", "n")).alias("held"))
        # Every group has a slice in every term block, an empty one if need be.
        slices = self.groups.select("lang", "source", "block", "blocks", "total", "kept", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)).alias("term_block"))
        slices = slices.join(sizes, ["lang", "term_block"], "left").join(held, ["lang", "source", "term_block"], "left").select(
            "lang", "source", "block", "blocks", "total", "kept", "term_block", F.coalesce("terms", F.lit(0)).alias("terms"),
            F.col("held.at").alias("at"), F.col("held.n").alias("n"))
        met = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        cells = slices.withColumn("met", met).withColumn("low", F.least("block", "met")).withColumn("high", F.greatest("block", "met"))
        partial = cells.select("lang", "low", "high", "term_block", "source", "block", "total", "kept", "terms", "at", "n").groupBy(
            "lang", "low", "high", "term_block").applyInArrow(_cell, "lang string, source string, item string, value long")
        return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def terms(self, top: int) -> DataFrame:
        """lang, source, item, value, rank of the terms that a group has more of than its language."""
        sized = self.rows.join(self.groups.select("lang", "source", "total", "kept", "lang_total"), ["lang", "source"])
        p = share(F.col("n") + 1, F.col("total") + F.col("kept"))
        q = share(F.col("all") + 1, F.col("lang_total") + F.col("kept"))
        above = sized.select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q")).where("p > q").select(
            "lang", "source", "item", gain(F.col("p"), F.col("q")).alias("value"))
        # Each task keeps the first ranks of a group before the shuffle.
        return above.withColumn("rank", _rank()).where(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def audit(docs: DataFrame, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: the divergence of a source from each other source
    of its language; part `term`: what each term that it has more of adds to its divergence from the language."""
    run = _Audit(docs)
    pairs = run.scratch.keep(run.pairs(), "pairs").withColumn("rank", _rank())
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).union(
        run.terms(top_terms).withColumn("part", F.lit("term")).select(columns))
