"""Near-duplicate documents by SuperMinHash.

A document is its set of distinct five-word shingles. Documents with equal sets form a class; only
classes are compared. Each element of a set walks through its own permutation of the signature's
slots, rank by rank: at rank j it offers j plus a random fraction to a slot, which keeps the least
offer. As soon as all slots of a document hold less than j + 1, no later rank can win, and the
document stops; a long document stops after the first rank. Signatures are cut into bands, classes
that share a band are candidates, candidates are confirmed on their full sets, and confirmed links are
grouped by union-find.

Within a band bucket, all members are first compared with the bucket's most central one, the member
whose bands lead to the largest buckets; then those of other components with the most central one of
these; what still stands apart is compared with all members of other components. So a group of
thousands of copies costs a few comparisons per member, and no link between components is left out.

In large buckets that last comparison is a prefix filter on what the members do not share with the
bucket's central member. Copies of one text have most elements in common and differ in few, which others
seldom share, so thousands of copies that are too far apart for links give hardly any candidate pairs.

The random sources are fixed, so results are repeatable. The threshold is a parameter, and a lower one
takes more bands: at the similarity of the threshold itself a pair shares no band with a chance of at
most 10 in a million (7 at 85 %, 9 at 80 %).

Defined cases: a text of fewer than five words is one shingle; without words it is empty, linked with
nothing, its own component; a null text is empty; a null id takes part but never names a component
unless all ids of it are null; repeated rows belong to one class; an empty table gives an empty
result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import SLICE, Scratch, bounded_side, sliced
from marquee.llm.components import components

SHINGLE = 5
THRESHOLD_PERCENT = 85
ROWS = 4
#: The chance that a pair at the threshold shares no band is at most this.
MISSED = 1e-5


def bands_at(threshold_percent: int) -> int:
    """The fewest bands that miss no more than that: 16 at 85 %, 22 at 80 %."""
    return math.ceil(math.log(MISSED) / math.log(1 - (threshold_percent / 100) ** ROWS))


BANDS = bands_at(THRESHOLD_PERCENT)
#: In a bucket of at most so many members all pairs of different components are compared.
DIRECT = 24
SLOTS = BANDS * ROWS
REMEMBERED = 200_000
CHUNK = 200_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed random bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; A-Z count as a-z."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size))
    for i in range(size):
        total = mix(total + own[i:len(words) - size + 1 + i] + _STEP)
    return np.unique(total)


def signatures(sets: list[np.ndarray], n_slots: int = SLOTS) -> np.ndarray:
    """The SuperMinHash signature of each set, as one row of slots; an empty set has infinite slots."""
    slots = np.full((len(sets), n_slots), np.inf)
    begin = 0
    while begin < len(sets):
        end, size = begin, 0
        while end < len(sets) and (end == begin or size + len(sets[end]) <= CHUNK):
            size += len(sets[end])
            end += 1
        _fill(sets[begin:end], slots[begin:end])
        begin = end
    return slots


def _fill(sets: list[np.ndarray], slots: np.ndarray) -> None:
    n_slots = slots.shape[1]
    seeds = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    walk = None
    steps = np.arange(1, 2 * n_slots + 1, dtype=np.uint64) * _STEP
    for rank in range(n_slots):
        if not len(seeds):
            return
        draw = mix(seeds + steps[2 * rank])
        pick = rank + (mix(seeds + steps[2 * rank + 1]) >> np.uint64(33)).astype(np.int64) % (n_slots - rank)
        value = rank + (draw >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        if walk is None:
            slot = pick
        else:
            at = np.arange(len(seeds))
            slot = walk[at, pick].astype(np.int64)
            walk[at, pick] = walk[:, rank]
        np.minimum.at(slots.reshape(-1), owner * n_slots + slot, value)
        going = (slots.max(axis=1) >= rank + 1)[owner]
        seeds, owner = seeds[going], owner[going]
        if walk is None:
            walk = np.tile(np.arange(n_slots, dtype=np.uint8), (len(seeds), 1))
            walk[np.arange(len(seeds)), pick[going]] = 0
        else:
            walk = walk[going]


def bands(slots: np.ndarray) -> np.ndarray:
    """One hash per band of each signature."""
    count = slots.shape[1] // ROWS
    bits = slots.view(np.uint64).reshape(len(slots), count, ROWS)
    out = np.broadcast_to(np.arange(1, count + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for r in range(ROWS):
        out = mix(out + bits[:, :, r] + _STEP)
    return out.view(np.int64)


def _sign(batches, n_bands):
    hashes = WordHashes()
    for batch in sliced(batches):
        sets = [shingles(t, hashes) for t in batch.column("text").to_pylist()]
        banded = bands(signatures(sets, n_bands * ROWS))
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "class": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
            "bands": pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sets) + 1) * n_bands, n_bands), pa.int32()), pa.array(banded.reshape(-1))),
        })


def _confirm(batches, threshold):
    hashes = WordHashes()
    last, wide = None, None
    for batch in sliced(batches):
        keep = []
        for b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b"))):
            if b != last:
                last, wide = b, shingles(text_b, hashes)
            narrow = shingles(text_a, hashes)
            both = len(np.intersect1d(narrow, wide, assume_unique=True))
            keep.append(100 * both >= threshold * (len(narrow) + len(wide) - both))
        yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")})


def _differences(batches):
    hashes = WordHashes()
    last, wide = None, None
    for batch in sliced(batches):
        apart = []
        for b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b"))):
            if b != last:
                last, wide = b, shingles(text_b, hashes)
            apart.append(np.setxor1d(shingles(text_a, hashes), wide, assume_unique=True).view(np.int64))
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b", "n", "root")} | {"elements": pa.array(apart, pa.list_(pa.int64()))})


class _Search:
    """The steps of one run; everything that is used more than once is stored."""

    def __init__(self, docs: DataFrame, threshold_percent: int = THRESHOLD_PERCENT):
        self.threshold = threshold_percent
        self.scratch = Scratch(docs.sparkSession, SLICE)
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
        self.step = 0

    def sign(self) -> None:
        kind = self.docs.schema["doc_id"].dataType.simpleString()
        n_bands = bands_at(self.threshold)
        self.members = self.scratch.keep(self.docs.mapInArrow(
            lambda batches: _sign(batches, n_bands), f"doc_id {kind}, text_hash long, n_shingles long, class binary, bands array<long>"), "members")
        # One document stands for its class: its text confirms the links of the class.
        self.classes = self.scratch.keep(self.members.where("class is not null").groupBy("class").agg(
            F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"),
            F.min(F.struct("doc_id", "text_hash")).alias("text")), "classes")

    def bucket(self) -> None:
        """Classes by bucket; buckets of one class are dropped before anything is joined."""
        rows = self.classes.select("class", "n", F.explode("bands").alias("bucket"))
        full = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        shared = rows.join(full, "bucket")
        central = shared.groupBy("class").agg(F.sum("size").alias("weight"))
        self.buckets = self.scratch.keep(
            shared.select("bucket", "class", "n").join(central, "class"), "buckets")

    def _with_texts(self, pairs: DataFrame) -> DataFrame:
        """Pairs of classes (a, b) with a text of each, text_a and text_b."""
        self.step += 1
        pairs = self.scratch.keep(pairs, f"pairs{self.step}")
        near = bounded_side(self.scratch, pairs, f"pairs{self.step}")
        of = self.classes.select("class", F.col("text.doc_id").alias("i"), F.col("text.text_hash").alias("h"))
        same = self.docs["doc_id"].eqNullSafe(F.col("i")) & (self.docs["text_hash"] == F.col("h"))

        def texts(side: DataFrame, name: str) -> DataFrame:
            side = self.scratch.keep(side, f"{name}{self.step}")
            found = self.docs.join(bounded_side(self.scratch, side, f"{name}{self.step}"), same)
            # Repeated rows of one document must not repeat a pair.
            return found.select(*[c for c in side.columns if c not in "ih"], F.col("text").alias(f"text_{name}"))
        left = texts(near.join(of.withColumnRenamed("class", "a"), "a").select(*pairs.columns, "i", "h"), "a")
        right = texts(near.select("b").distinct().join(of.withColumnRenamed("class", "b"), "b").select("b", "i", "h"), "b")
        return left.join(right, "b").select(*pairs.columns, "text_a", "text_b")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes (a, b) that reach the threshold on their full sets."""
        threshold = self.threshold
        checked = self._with_texts(pairs).mapInArrow(lambda batches: _confirm(batches, threshold), "a binary, b binary")
        return self.scratch.keep(checked, f"links{self.step}")

    def link(self) -> DataFrame:
        """node, root of all classes that have links."""
        center = F.max_by("class", F.struct("weight", "class"))
        near = F.least("n", "n2") * 100 >= F.greatest("n", "n2") * self.threshold
        member = self.buckets
        first = self.scratch.keep(member.groupBy("bucket").agg(
            center.alias("b"), F.max_by("n", F.struct("weight", "class")).alias("n2")), "first")
        pairs = member.join(first, "bucket").where((F.col("class") != F.col("b")) & near)
        links = self.confirmed(pairs.select(F.col("class").alias("a"), "b").distinct())
        roots = components(self.scratch, links, f"roots{self.step}-")
        for full in (False, True):
            open_rows = self._apart(roots)
            if full:
                pairs = self._direct(open_rows, near).union(self._by_prefix(open_rows, first))
            else:
                # The most central member outside the component of the first center.
                heads = open_rows.groupBy("bucket").agg(F.max_by("root", F.struct("weight", "class")).alias("head"))
                rest = open_rows.join(heads, "bucket").where("root <> head").groupBy("bucket").agg(
                    center.alias("b"), F.max_by("n", F.struct("weight", "class")).alias("n2"),
                    F.max_by("root", F.struct("weight", "class")).alias("root2"))
                pairs = open_rows.join(rest, "bucket").where((F.col("root") != F.col("root2")) & near).select(F.col("class").alias("a"), "b")
            more = self.confirmed(pairs.distinct())
            if not more.isEmpty():
                links = links.union(more)
                roots = components(self.scratch, links, f"roots{self.step}-")
        return roots

    def _apart(self, roots: DataFrame) -> DataFrame:
        """Rows of the buckets that still hold more than one component, with their component."""
        rooted = self.buckets.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class"))
        rooted = self.scratch.keep(rooted, f"rooted{self.step}")
        apart = rooted.groupBy("bucket").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).where("low <> high").select("bucket", "size")
        return rooted.join(apart, "bucket")

    @staticmethod
    def _direct(open_rows: DataFrame, near: Column) -> DataFrame:
        rows = open_rows.where(F.col("size") <= DIRECT)
        other = rows.select("bucket", F.col("class").alias("b"), F.col("n").alias("n2"), F.col("root").alias("root2"))
        return rows.join(other, "bucket").where((F.col("root") < F.col("root2")) & near).select(F.col("class").alias("a"), "b")

    def _by_prefix(self, open_rows: DataFrame, first: DataFrame) -> DataFrame:
        """All pairs of different components that can reach the threshold, among the members of large
        buckets; a pair that shares no rare difference is never made.

        Members were compared with the bucket's first center. Of two members, d and d2 elements are the
        differences from it; if their sets, of n and n2 elements, reach the threshold t, at most
        (n + n2) * (100 - t) / (100 + t) of all differences are not common to both. If d + d2 were no more
        than that, both would be linked with the center and be of one component. So two members of
        different components that reach the threshold share a difference, and the prefix filter holds for
        the sets of differences. Differences that one component alone holds come first in the order of all
        differences and make no rows: members of different components never meet in them."""
        held = open_rows.where(F.col("size") > DIRECT).join(first.select("bucket", "b"), "bucket").where(
            F.col("class") != F.col("b")).select(F.col("class").alias("a"), "b", "n", "root").distinct()
        sets = self._with_texts(held).mapInArrow(
            _differences, "a binary, b binary, n long, root binary, elements array<long>").dropDuplicates(["a", "b"])
        sets = self.scratch.keep(sets.withColumn("d", F.size("elements").cast("long")), "differences")
        rows = sets.select("a", "b", "n", "root", "d", F.explode("elements").alias("element"))
        often = rows.groupBy("b", "element").agg(
            F.count("*").alias("f"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("b", "element", "f")
        ordered = rows.join(often, ["b", "element"]).groupBy("a", "b", "n", "root", "d").agg(
            F.sort_array(F.collect_list(F.struct("f", "element"))).alias("elements"))
        # So many differences a partner of any number, or of at least this number, can lack.
        t = self.threshold
        lack = F.floor(F.col("n") * (100 - t) / t)
        own = F.col("d") - F.size("elements")
        prefix = F.greatest(lack + 1 - own, F.lit(0)).cast("int")
        rows = self.scratch.keep(ordered.withColumn("own", own).select(
            "a", "b", "n", "root", "d", "own", F.posexplode(F.slice("elements", F.lit(1), prefix)).alias("at", "e")).select(
            "a", "b", "n", "root", "d", (F.col("own") + F.col("at")).alias("at"), "e.element"), "prefixes")
        long = rows.select("b", "element", F.col("a").alias("a2"), F.col("n").alias("n2"), F.col("root").alias("root2"),
                           F.col("d").alias("d2"), F.col("at").alias("at2"))
        short = rows.where(F.col("at") <= F.floor(lack / 2))
        left = F.least(F.col("d") - F.col("at"), F.col("d2") - F.col("at2"))
        fits = (F.struct("d", "a") < F.struct("d2", "a2")) & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * t) & (
            (F.col("d") + F.col("d2") - 2 * left) * (100 + t) <= (F.col("n") + F.col("n2")) * (100 - t))
        return short.join(long, ["b", "element"]).where((F.col("root") != F.col("root2")) & fits).select(
            "a", F.col("a2").alias("b")).distinct()

    def result(self) -> DataFrame:
        """doc_id, text_hash, n_shingles, component_id, kept of every row."""
        self.sign()
        self.bucket()
        roots = self.link()
        least = self.classes.select("class", "least").join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class"))
        least = self.scratch.keep(least, "least")
        named = least.groupBy("root").agg(F.min("least").alias("component_id"))
        named = self.scratch.keep(least.select("class", "root").join(named, "root").select("class", "component_id"), "named")
        rows = self.members.drop("bands").join(bounded_side(self.scratch, named, "named"), "class", "left")
        rows = rows.withColumn("component_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row."""
    return _Search(docs).result().select("doc_id", "n_shingles", "component_id", "kept")


def deduplicate(docs: DataFrame, threshold_percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One document of each group, the one of the smallest id; documents without words all stay, but
    for repeated rows."""
    search = _Search(docs, threshold_percent)
    rows = search.scratch.keep(search.result().select("doc_id", "text_hash", "kept"), "verdicts")
    gone = search.scratch.keep(rows.where("not kept").select("doc_id", "text_hash").distinct(), "gone")
    twice = search.scratch.keep(rows.where("kept").groupBy("doc_id", "text_hash").count().where("count > 1").drop("count"), "twice")
    whole = docs.withColumn("_text_hash", F.xxhash64(F.col("text").cast("string")))

    def same(side):
        return whole["doc_id"].eqNullSafe(side["doc_id"]) & (whole["_text_hash"] == side["text_hash"])
    gone, twice = bounded_side(search.scratch, gone, "gone"), bounded_side(search.scratch, twice, "twice")
    left = whole.join(gone, same(gone), "left_anti")
    once = left.join(twice, same(twice), "left_semi").dropDuplicates(["doc_id", "_text_hash"])
    return left.join(twice, same(twice), "left_anti").union(once).drop("_text_hash")
