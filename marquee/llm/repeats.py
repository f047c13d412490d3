"""Exact repeats of at least a given number of bytes, inside and across documents.

A repeat is found where it must be anchored: of all short cores inside a window of the minimum length,
the one of least hash is the window's anchor, and equal windows have equal anchors at equal places.
The windows that share an anchor are consecutive, so one row stands for all of them: the hash of the
core and the hash of the hull, the bytes that these windows cover together. Rows are counted, never
gathered. Hulls that occur twice are repeats as a whole; a core that occurs once has none. What lies
between, equal cores in different hulls, is where a repeat begins or ends. There the windows are split
into a few narrower ranges with longer cores, which are counted in the same way, and what is still
open is decided by threshold-bounded interval expansion on a Burrows-Wheeler transform: the common
core of a group, known to be equal, is one sign of the text; intervals of the suffix array are extended
backwards breadth-first, which gives the common prefixes by increasing length, and the expansion
stops at the minimum length. Positions that have no value by then are repeats.

A group that is too large for one task is split into narrower ranges once more instead, down to
single windows, for which counting decides. Equal contexts inside a group are counted first and stand
for each other. So neither a group of copies nor a common passage is ever brought together.

Hashes that are trusted have 128 bits; within such a key, the 64 bits of an anchor's hash stand for the core itself.

Defined cases: a null text is empty; a text below the minimum has no repeats; overlapping repeats
count; repeated rows are repeats of each other; null ids are ids like any other; an empty table gives
an empty result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch, bounded_side, sliced

MIN_BYTES = 400
CORE = 80
#: An open range of windows is split into so many narrower ones.
WAYS = 8
#: So many different contexts of one core go into one transform.
GROUP = 512
#: So many bytes of text, or signs of a transform, are worked on at once; a longer text comes in pieces.
CHUNK = 1 << 20
SIGNS = 1 << 18

_TABLE = np.random.default_rng(20).integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))


class Anchors:
    """The anchors of texts; keeps the powers of the rolling hash between calls."""

    def __init__(self, least: int = MIN_BYTES, core: int = CORE):
        self.least, self.core, self.window = least, core, least - core + 1
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            steps = np.full(n, _BASE)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _INVERSE
            self.down = np.multiply.accumulate(steps)

    def find(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(number of the text, place of the core, first window, last window) of every anchor."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts])
        ends = np.cumsum(sizes)
        count = len(data) - self.core + 1
        if count < self.window:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_TABLE[data] * self.up[:len(data)], out=total[1:])
        grams = (total[self.core:] - total[:-self.core]) * self.down[:count]
        grams ^= grams >> np.uint64(29)
        grams *= _BASE
        # The place in the low bits makes the leftmost of equal hashes the least, and is read back.
        bits = np.uint64(max(1, int(count).bit_length()))
        grams = (grams >> bits << bits) | np.arange(count, dtype=np.uint64)
        padded = np.full(-(-count // self.window) * self.window, np.uint64(2 ** 64 - 1))
        padded[:count] = grams
        rows = padded.reshape(-1, self.window)
        before = np.minimum.accumulate(rows, axis=1).reshape(-1)
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        starts = count - self.window + 1
        least = np.minimum(after[:starts], before[self.window - 1:self.window - 1 + starts])
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # Windows that reach over the end of a text are none.
        valid = np.zeros(len(data) + 1, np.int64)
        own = sizes >= self.least
        np.add.at(valid, (ends - sizes)[own], 1)
        np.add.at(valid, (ends - self.least + 1)[own], -1)
        valid = np.flatnonzero(np.cumsum(valid)[:starts])
        if not len(valid):
            return tuple(np.empty(0, np.int64) for _ in range(4))
        at = place[valid]
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)))
        last = np.append(first[1:], len(valid)) - 1
        text = np.searchsorted(ends, valid[first], side="right")
        base = (ends - sizes)[text]
        return text, at[first] - base, valid[first] - base, valid[last] - base


def _pieces(texts: list[bytes]):
    """Texts in portions of bounded size, each as a list of (number of the text, place, piece). Pieces of
    a long text overlap by all but one byte of a window, so that each window lies in just one."""
    portion, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < MIN_BYTES:
            continue
        for at in range(0, len(text) - MIN_BYTES + 1, CHUNK):
            piece = text[at:at + CHUNK + MIN_BYTES - 1]
            if portion and size + len(piece) > CHUNK:
                yield portion
                portion, size = [], 0
            portion.append((number, at, piece))
            size += len(piece)
    if portion:
        yield portion


def _anchor_rows(batches):
    anchors = Anchors()
    for batch in sliced(batches):
        texts = [(t or "").encode("utf-8") for t in batch.column("text").to_pylist()]
        places: list[list] = [[] for _ in texts]
        for portion in _pieces(texts):
            for t, p, lo, hi in zip(*(a.tolist() for a in anchors.find([x[2] for x in portion]))):
                number, at, _ = portion[t]
                own = places[number]
                if own and own[-1][0] == p + at and own[-1][2] == lo + at - 1:
                    own[-1][2] = hi + at  # goes on from the piece before
                else:
                    own.append([p + at, lo + at, hi + at])
        found = []
        for text, own in zip(texts, places):
            view = memoryview(text)
            found.append([{"pos": p, "lo": lo, "hi": hi, "core": xxhash.xxh3_64_intdigest(view[p:p + CORE]) - 2 ** 63,
                           "hull": xxhash.xxh3_64_intdigest(view[lo:hi + MIN_BYTES], seed=p - lo + 1) - 2 ** 63} for p, lo, hi in own])
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            "anchors": pa.array(found, ANCHORS)})


ANCHORS = pa.list_(pa.struct([("pos", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("core", pa.int64()), ("hull", pa.int64())]))
# A context: an open range of `width` windows of one document. The k-th of them starts `k` bytes before
# the core, whose left end is at byte `pos`; only those from `near` to `far` are the anchor's own.
CONTEXT = ("doc_id {}, text_hash long, judge boolean, key binary, pos int, near int, far int, "
           "left binary, right binary, hull binary")


def _contexts(batches):
    """The texts around open anchors, split once."""
    for batch in sliced(batches):
        rows = []
        for i, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("open").to_pylist())):
            data = text.encode("utf-8")
            for a in found:
                p, lo, hi = a["pos"], a["lo"], a["hi"]
                key = a["core"].to_bytes(8, "little", signed=True)
                context = (a["judge"], key, p, p - hi, p - lo, data[lo:p], data[p + CORE:hi + MIN_BYTES])
                rows += [(i, *x) for x in split(*context, MIN_BYTES - CORE + 1)]
        yield _context_batch(batch, rows)


def _context_batch(batch, rows):
    columns = list(zip(*rows)) or [()] * 8
    at = pa.array(columns[0], pa.int64())
    hulls = [xxhash.xxh3_128_digest(len(x).to_bytes(4, "little") + x + y) for x, y in zip(columns[6], columns[7])]
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id").take(at), "text_hash": batch.column("text_hash").take(at),
        "judge": pa.array(columns[1], pa.bool_()), "key": pa.array(columns[2], pa.binary()),
        **{n: pa.array(columns[3 + k], pa.int32()) for k, n in enumerate(("pos", "near", "far"))},
        "left": pa.array(columns[6], pa.binary()), "right": pa.array(columns[7], pa.binary()), "hull": pa.array(hulls, pa.binary())})


def split(judge, key, pos, near, far, left, right, width):
    """The narrower contexts, all of one width, of a context whose windows number `width`; the last one
    overlaps the one before, and its windows are judged twice."""
    step = -(-width // WAYS)
    for start in range(0, width, step):
        low = min(start, width - step)
        high = low + step - 1
        a, b = max(near, low), min(far, high)
        if a > b:
            continue
        # All of these windows hold `low` bytes left of the core and `fixed` bytes right of it.
        fixed, span = width - 1 - high, high - low
        inner_left, inner_right = left[len(left) - low:], right[:fixed]
        outer_left, outer_right = left[max(0, len(left) - low - (b - low)):len(left) - low], right[fixed:fixed + span - (a - low)]
        yield (judge, xxhash.xxh3_128_digest(b"%s|%d|%d|" % (key, low, len(inner_left)) + inner_left + inner_right),
               pos - low, a - low, b - low, outer_left, outer_right)


def _split_again(width: int):
    def again(batches):
        for batch in sliced(batches):
            rows = []
            columns = (batch.column(n).to_pylist() for n in ("judge", "key", "pos", "near", "far", "left", "right"))
            for i, context in enumerate(zip(*columns)):
                rows += [(i, *x) for x in split(*context, width)]
            yield _context_batch(batch, rows)
    return again


def transform(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and Burrows-Wheeler transform of a text of whole numbers, by prefix doubling. The
    suffixes are in full order: terminators must be different numbers, all less than the others."""
    n = len(signs)
    rank = np.unique(signs, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        ahead = np.full(n, -1)
        ahead[:-step or n] = rank[step:] if step < n else []
        both = rank * (n + 1) + ahead + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, ordered[1:] != ordered[:-1]))
        rank, step = new, step * 2
        if rank[order[-1]] == n - 1 or step >= n:
            return order, signs[order - 1]


def expanded(signs: np.ndarray, least_sign: int, stop: int) -> np.ndarray:
    """The places of the text at which a string of `stop` signs starts that also starts elsewhere.

    Intervals of the suffix array are extended backwards, all those of one length at once: an interval
    of a string s gives, for every sign c before its suffixes, the interval of cs. The first interval of
    length k that ends at a boundary gives the boundary the value k; an interval whose boundary has a
    value is not followed. Signs below `least_sign` are terminators and are never part of a string.
    """
    order, before = transform(signs)
    n = len(signs)
    # The place in the order of each suffix, and that of the suffix one sign longer.
    longer = np.empty(n, np.int64)
    longer[np.argsort(before, kind="stable")] = np.arange(n)
    value = np.full(n + 1, -1, np.int64)
    value[0] = value[n] = 0
    sorted_signs = signs[order]
    edge = np.flatnonzero(sorted_signs[1:] != sorted_signs[:-1]) + 1
    value[edge] = 0
    value[1:n][sorted_signs[1:] < least_sign] = 0
    low = np.append(0, edge)
    high = np.append(edge, n)
    use = sorted_signs[low] >= least_sign
    low, high = low[use], high[use]
    for length in range(1, stop):
        if not len(low):
            break
        # All members of all intervals, each with the sign before it.
        width = high - low
        group = np.repeat(np.arange(len(low)), width)
        member = np.arange(len(group)) - np.repeat(np.cumsum(width) - width, width) + low[group]
        sign, target = before[member], longer[member]
        use = sign >= least_sign
        group, sign, target = group[use], sign[use], target[use]
        if not len(group):
            break
        # A sign keeps the order of its suffixes, so an interval of targets is found by its ends.
        both = group * (int(signs.max()) + 1) + sign
        turn = np.argsort(both, kind="stable")
        both, target = both[turn], target[turn]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        low, high = target[first], target[np.append(first[1:], len(both)) - 1] + 1
        new = (value[high] < 0) | (value[low] < 0)
        value[high[value[high] < 0]] = length
        value[low[value[low] < 0]] = length
        low, high = low[new], high[new]
    # Suffixes next to a boundary without a value share at least `stop` signs, or both end before: a
    # string with a terminator is never extended, so boundaries between such suffixes have no value.
    places = order[(value[:n] < 0) | (value[1:] < 0)]
    ends = np.flatnonzero(signs < least_sign)
    return places[ends[np.searchsorted(ends, places)] - places >= stop]


def _decide(width: int):
    """Repeats inside groups of bounded size; the rows come sorted by key."""
    def judged(rows):
        keys = {k: i for i, k in enumerate(dict.fromkeys(r[3] for r in rows))}
        terminators = len(rows)
        parts, starts, at = [], [], 0
        for i, (_, _, _, key, _, _, _, left, right) in enumerate(rows):
            part = np.empty(len(left) + len(right) + 2, np.int64)
            part[:len(left)] = np.frombuffer(left, np.uint8)
            part[len(left)] = 256 + keys[key]
            part[len(left) + 1:-1] = np.frombuffer(right, np.uint8)
            part += terminators
            part[-1] = i
            parts.append(part)
            starts.append(at)
            at += len(part)
        places = np.sort(expanded(np.concatenate(parts), terminators, width))
        owner = np.searchsorted(starts, places, side="right") - 1
        for i, place in zip(owner.tolist(), places.tolist()):
            doc_id, text_hash, judge, _, pos, _, _, left, right = rows[i]
            if judge and place - starts[i] <= len(left):
                start = pos - len(left) + place - starts[i]
                yield doc_id, text_hash, start, start

    names = ("doc_id", "text_hash", "judge", "key", "pos", "near", "far", "left", "right")

    def decide(batches):
        held, signs, kind = [], 0, None

        def emit(rows):
            found = list(judged(rows))
            columns = list(zip(*found)) or [()] * 4
            return pa.RecordBatch.from_pydict({
                "doc_id": pa.array(columns[0], kind), "text_hash": pa.array(columns[1], pa.int64()),
                "lo": pa.array(columns[2], pa.int32()), "hi": pa.array(columns[3], pa.int32())})
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for row in zip(*(batch.column(n).to_pylist() for n in names)):
                if signs >= SIGNS and row[3] != held[-1][3]:
                    yield emit(held)
                    held, signs = [], 0
                held.append(row)
                signs += len(row[7]) + len(row[8]) + 2
        if held:
            yield emit(held)
    return decide


class _Search:
    def __init__(self, docs: DataFrame):
        self.scratch = Scratch(docs.sparkSession)
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
        self.kind = self.docs.schema["doc_id"].dataType.simpleString()

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return self.scratch.keep(df, name)

    def _with_text(self, side: DataFrame, name: str) -> DataFrame:
        """The texts of the documents of a stored table of (doc_id, text_hash, ...), one row each."""
        other = bounded_side(self.scratch, side, name)
        same = self.docs["doc_id"].eqNullSafe(other["doc_id"]) & (self.docs["text_hash"] == other["text_hash"])
        return self.docs.join(other, same).select(
            self.docs["*"], *[other[c] for c in side.columns if c not in ("doc_id", "text_hash")])

    @staticmethod
    def _count(rows: DataFrame, key: str, rep: list[str]) -> DataFrame:
        """Per (key, hull): n rows, one of them, and how many hulls the key has; single ones are left out."""
        groups = rows.groupBy(key, "hull").agg(F.count("*").alias("n"), F.min(F.struct(*rep)).alias("rep"))
        keys = groups.groupBy(key).agg(F.count("*").alias("hulls")).where("hulls > 1")
        return groups.join(keys, key, "left").where("n > 1 or hulls > 1")

    def windows(self) -> list[DataFrame]:
        """Tables (doc_id, text_hash, lo, hi) that together hold all repeated windows by first byte."""
        self.members = self._keep(self.docs.mapInArrow(_anchor_rows, (
            f"doc_id {self.kind}, text_hash long, n_bytes long, sha256 string, "
            "anchors array<struct<pos:int,lo:int,hi:int,core:bigint,hull:bigint>>")), "members")
        rows = self.members.select("doc_id", "text_hash", F.explode("anchors").alias("a")).select("doc_id", "text_hash", "a.*")
        groups = self._keep(self._count(rows, "core", ["doc_id", "text_hash", "pos", "lo", "hi"]), "groups")
        found = [rows.join(groups.where("n > 1").select("core", "hull"), ["core", "hull"]).select("doc_id", "text_hash", "lo", "hi")]
        open_anchors = groups.where("hulls > 1").select("rep.doc_id", "rep.text_hash", F.struct(
            "rep.pos", "rep.lo", "rep.hi", "core", (F.col("n") == 1).alias("judge")).alias("a"))
        opened = self._keep(open_anchors.groupBy("doc_id", "text_hash").agg(F.collect_list("a").alias("open")), "open")
        width = -(-(MIN_BYTES - CORE + 1) // WAYS)
        contexts = self._with_text(opened, "open").select("doc_id", "text_hash", "text", "open").mapInArrow(
            _contexts, CONTEXT.format(self.kind))
        level = 0
        while True:
            contexts = self._keep(contexts, f"contexts{level}")
            groups = self._keep(self._count(contexts, "key", [
                "doc_id", "text_hash", "judge", "pos", "near", "far", "left", "right"]), f"groups{level}")
            twice = groups.where("n > 1").select("key", "hull")
            found.append(contexts.where("judge").join(twice, ["key", "hull"]).select(
                "doc_id", "text_hash", (F.col("pos") - F.col("far")).alias("lo"), (F.col("pos") - F.col("near")).alias("hi")))
            if width == 1:
                return found
            still = groups.where("hulls > 1").select(
                "rep.doc_id", "rep.text_hash", (F.col("rep.judge") & (F.col("n") == 1)).alias("judge"), "key",
                "rep.pos", "rep.near", "rep.far", "rep.left", "rep.right", "hulls")
            small = still.where(F.col("hulls") <= GROUP).drop("hulls").repartition("key").sortWithinPartitions("key")
            found.append(self._keep(small.mapInArrow(
                _decide(width), f"doc_id {self.kind}, text_hash long, lo int, hi int"), f"decided{level}"))
            large = still.where(F.col("hulls") > GROUP).drop("hulls")
            if large.isEmpty():
                return found
            contexts = large.mapInArrow(_split_again(width), CONTEXT.format(self.kind))
            width, level = -(-width // WAYS), level + 1

    def result(self) -> DataFrame:
        """doc_id, text_hash, n_bytes, n_removed, n_spans, kept_sha256, runs of every row."""
        found = self.windows()
        windows = found[0]
        for more in found[1:]:
            windows = windows.union(more)
        cuts = self._keep(windows.groupBy("doc_id", "text_hash").agg(
            F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("ranges")).withColumn("runs", _runs()).drop("ranges"), "cuts")
        cuts = bounded_side(self.scratch, cuts, "cuts")
        rows = self.members.drop("anchors")
        same = rows["doc_id"].eqNullSafe(cuts["doc_id"]) & (rows["text_hash"] == cuts["text_hash"])
        rows = rows.join(cuts, same, "left").select(rows["*"], F.coalesce(cuts["runs"], F.array().cast(RUNS)).alias("runs"))
        rows = rows.withColumn("n_removed", F.aggregate(
            "runs", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"]))
        rows = self._keep(rows.withColumn("n_spans", F.size("runs").cast("long")), "judged")
        partly = self._keep(rows.where("n_removed > 0 and n_removed < n_bytes").select("doc_id", "text_hash", "runs"), "partly")
        rest = self._keep(self._with_text(partly, "partly").select("doc_id", "text_hash", "text", "runs").mapInArrow(
            _rest, f"doc_id {self.kind}, text_hash long, rest_sha256 string"), "rest")
        rest = bounded_side(self.scratch, rest, "rest")
        same = rows["doc_id"].eqNullSafe(rest["doc_id"]) & (rows["text_hash"] == rest["text_hash"])
        kept = F.when(F.col("n_removed") == 0, F.col("sha256")).when(
            F.col("n_removed") == F.col("n_bytes"), F.sha2(F.lit(""), 256)).otherwise(rest["rest_sha256"])
        return rows.join(rest, same, "left").select(
            rows["doc_id"], rows["text_hash"], "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"), "runs")


RUNS = "array<struct<start:int,end:int>>"


def _runs():
    """Maximal runs of removed bytes from sorted ranges of windows."""
    start = F.array().cast(RUNS)

    def add(runs, r):
        end = r["hi"] + MIN_BYTES
        last = F.try_element_at(runs, F.lit(-1))
        fresh = F.concat(runs, F.array(F.struct(r["lo"].alias("start"), end.alias("end"))))
        longer = F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))))
        return F.when(F.coalesce(last["end"] >= r["lo"], F.lit(False)), longer).otherwise(fresh).cast(RUNS)
    return F.aggregate("ranges", start, add)


def _rest(batches):
    for batch in sliced(batches):
        digests = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            data, at, digest = text.encode("utf-8"), 0, hashlib.sha256()
            for r in runs:
                digest.update(data[at:r["start"]])
                at = r["end"]
            digest.update(data[at:])
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("doc_id", "text_hash")} | {"rest_sha256": pa.array(digests, pa.string())})


def repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, runs (byte offsets, end exclusive) per row."""
    return _Search(docs).result().drop("text_hash")
