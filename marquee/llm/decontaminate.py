"""Benchmark decontamination: BM25 over an inverted index of the test items, with block-max WAND.

The index is over the items, cut into segments of bounded length; the queries are all passages of all
training documents, overlapping windows of words. Terms are pairs of neighbouring words: single words
tell a passage from another one too badly for any bound to skip much. A score is the BM25 score divided by the score that
the segment has with itself, so one threshold fits all. WAND keeps the postings of a passage's terms in
item order and jumps to the first item whose upper bounds can reach the threshold; bounds per block
of items let it skip whole blocks. The very first of these tests, whether the bounds of all terms of a
passage together reach the threshold, is made for all passages of a batch at once. Everything at or
above the threshold is retrieved, with no cut at a number of results. A retrieved item is confirmed in
the document by its overlap: shared five-word shingles of its question and of its answer, or of the whole
item if it has no answer of its own.

Items are dealt to parts of bounded size, each an index that all documents pass one after the other. How
many segments there are, how long they are on average and how many of them hold a term is counted once, by
Spark, over all items, so scores do not depend on the number of parts. A part is a file in the shared
folder; a task loads the part that it works on, and nothing of the benchmark passes through the driver.

Words of scripts that put no spaces between words are single characters.

Defined cases: null or empty texts and items match nothing; the answer of an item is what follows an
answer mark, or a question mark if that is one sentence; an item without these is one text, its answer
overlap is null; an item of one word is not searched; a single item that is larger than the bound makes
a part of that size; repeated
rows give repeated results, and an item that is listed twice is one; an item without an id is found
under a null id; an empty table gives an empty result. Other columns, also ones named like a result,
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import Scratch, sliced

K1, B = 1.2, 0.75
STRIDE = 64
#: A passage has two strides of words and overlaps its neighbours by one, so every segment of at most
#: a stride lies whole in some passage.
SEGMENT = STRIDE
#: Share of a segment's own score that retrieves it.
THRESHOLD = 0.4
BLOCK = 16
SHINGLE = 5
MIN_OVERLAP = 0.5
#: Bytes of item text in one index.
INDEX_BYTES = 4 << 20

# Thai, Lao, Burmese, Khmer, kana and Chinese characters.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u3096\u30a1-\u30fa\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\W_{UNSPACED}]+")
ANSWER = re.compile(r"\banswer\s*:|\n\s*a\s*:|\?(?!.*[.!?]\s+\S)", re.I | re.S)


def terms_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before and after the last answer mark; without an answer all words are the first part."""
    marks = list(ANSWER.finditer(text))
    if marks and WORD.search(text, marks[-1].end()):
        return terms_of(text[:marks[-1].start()]), terms_of(text[marks[-1].end():])
    return terms_of(text), []


def shingles(words: list[str]) -> set[tuple]:
    size = min(SHINGLE, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if words else set()


def segments_of(question: list[str], answer: list[str]) -> list[Counter]:
    """The terms of each segment of an item."""
    words, out = question + answer, []
    for i in range(0, len(words), SEGMENT):
        # A short rest would be found by few words; the last segment reaches back instead.
        own = words[max(0, min(i, len(words) - SEGMENT)):][:SEGMENT]
        if len(own) > 1:
            out.append(Counter(zip(own, own[1:])))
    return out


@dataclass(frozen=True)
class Statistics:
    """Of all segments of all items: their number, their terms, and how many of them hold a term."""

    segments: int
    terms: int
    holders: dict[tuple[str, str], int]

    @classmethod
    def of(cls, items: list[tuple]) -> Statistics:
        found = [s for _, t in items for s in segments_of(*question_and_answer(t))]
        return cls(len(found), sum(sum(s.values()) for s in found), Counter(t for s in found for t in s))


class Index:
    """Postings of the segments with their impacts, and upper bounds of each term per block and in all. The
    statistics are those of these items, or of all items of which these are a part."""

    def __init__(self, items: list[tuple], statistics: Statistics | None = None):
        statistics = statistics or Statistics.of(items)
        self.items = [(i, *question_and_answer(t)) for i, t in items]
        self.owner, segments = [], []
        for number, (_, question, answer) in enumerate(self.items):
            own = segments_of(question, answer)
            segments += own
            self.owner += [number] * len(own)
        count = len(segments)
        held = dict.fromkeys(t for s in segments for t in s)
        idf = {t: math.log(1 + (statistics.segments - n + 0.5) / (n + 0.5)) for t in held for n in (statistics.holders[t],)}
        mean = statistics.terms / max(1, statistics.segments)
        self.words = {w: i for i, w in enumerate(dict.fromkeys(w for t in held for w in t))}
        # Terms are numbered in the order of their keys, so a key is found by bisection.
        keyed = sorted((self._key(*map(self.words.get, t)), t) for t in held)
        self.keys = np.array([k for k, _ in keyed], np.int64)
        self.ids = {t: i for i, (_, t) in enumerate(keyed)}
        postings = [[] for _ in held]
        for number, s in enumerate(segments):
            norm = K1 * (1 - B + B * sum(s.values()) / mean)
            impact = {t: idf[t] * n * (K1 + 1) / (n + norm) for t, n in s.items()}
            own = sum(impact.values())
            for t, x in impact.items():
                postings[self.ids[t]].append((number, x / own))
        self.segments = [[n for n, _ in p] for p in postings]
        self.impacts = [[x for _, x in p] for p in postings]
        self.blocks = -(-count // BLOCK)
        self.block_bounds = [{} for _ in held]
        for bounds, p in zip(self.block_bounds, postings):
            for n, x in p:
                bounds[n // BLOCK] = max(bounds.get(n // BLOCK, 0.0), x)
        self.bounds = np.array([max(b.values()) for b in self.block_bounds])
        self.parts = [(shingles(q), shingles(a)) for _, q, a in self.items]

    def _key(self, first, second):
        return first * (len(self.words) + 1) + second

    def find(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, term) of every indexed term of the documents."""
        none = len(self.words)
        ids = np.concatenate([np.fromiter(map(self.words.get, d, repeat(none)), np.int64, len(d)) for d in docs] or [np.empty(0, np.int64)])
        lengths = np.array([len(d) for d in docs], np.int64)
        if len(ids) < 2 or not len(self.keys):
            return tuple(np.empty(0, np.int64) for _ in range(3))
        inside = (ids[:-1] < none) & (ids[1:] < none)
        ends = np.cumsum(lengths)
        inside[ends[(ends > 0) & (ends < len(ids))] - 1] = False
        places = np.flatnonzero(inside)
        keys = self._key(ids[places], ids[places + 1])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[at] == keys
        places, terms = places[held], at[held]
        doc = np.searchsorted(ends, places, side="right")
        return doc, places - (ends - lengths)[doc], terms

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(segment, score) of every segment that scores at least the threshold, by block-max WAND."""
        slack = threshold - 1e-6
        bounds = self.bounds
        cursors = [[self.segments[t][0], 0, t] for t in terms if self.segments[t]]
        out = []
        while cursors:
            cursors.sort()
            reach, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                reach += bounds[t]
                if reach >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            block = target // BLOCK
            in_block = sum(self.block_bounds[c[2]].get(block, 0.0) for c in cursors[:pivot + 1])
            if in_block < slack:
                # No segment before the end of the block, or before the next cursor, can reach it.
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                moving = pivot + 1
            elif cursors[0][0] == target:
                score = sum(self.impacts[t][at] for s, at, t in cursors[:pivot + 1])
                if score >= slack:
                    out.append((target, score))
                target, moving = target + 1, pivot + 1
            else:
                moving = pivot
            for c in cursors[:moving]:
                own = self.segments[c[2]]
                at = c[1]
                while at < len(own) and own[at] < target:
                    at += 1
                c[0], c[1] = (own[at] if at < len(own) else -1), at
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def passages(self, docs: list[list[str]]):
        """(document, terms) of the passages whose bounds together can reach the threshold."""
        doc, place, term = self.find(docs)
        if not len(doc):
            return
        chunks = np.array([-(-len(d) // STRIDE) for d in docs], np.int64)
        base = np.cumsum(chunks) - chunks
        chunk = base[doc] + place // STRIDE
        # A term counts once in a chunk; in both chunks of a passage it counts twice, which only loosens the bound.
        both = np.unique(chunk * len(self.keys) + term)
        chunk, term = both // len(self.keys), both % len(self.keys)
        sums = np.bincount(chunk, self.bounds[term], int(chunks.sum()) + 1)
        first = np.searchsorted(chunk, np.arange(len(sums) + 1))
        last = np.zeros(len(sums), bool)
        last[(base + chunks - 1)[chunks > 0]] = True
        # The last chunk of a document has no right neighbour, and lies in the passage before, if there is one.
        pairs = sums.copy()
        pairs[:-1] += np.where(last[:-1], 0.0, sums[1:])
        starts = np.zeros(len(sums), bool)
        starts[base[chunks > 0]] = True
        for k in np.flatnonzero((pairs >= THRESHOLD - 1e-6) & (starts | ~last)):
            until = first[k + 1] if last[k] else first[k + 2]
            yield int(np.searchsorted(base, k, side="right")) - 1, np.unique(term[first[k]:until]).tolist()

    def retrieve(self, docs: list[list[str]]) -> dict[tuple[int, int], float]:
        """The best score of every retrieved (document, item)."""
        found: dict[tuple[int, int], float] = defaultdict(float)
        for number, terms in self.passages(docs):
            for segment, score in self.search(terms, THRESHOLD):
                key = number, self.owner[segment]
                found[key] = max(found[key], score)
        return found

    def overlaps(self, words: list[str], items: list[int]) -> list[tuple[float, float | None]]:
        """The shares of each item's question and answer shingles that the words hold, none for no answer."""
        wanted: dict[int, set[tuple]] = defaultdict(set)
        for item in items:
            for part in self.parts[item]:
                for s in part:
                    wanted[len(s)].add(s)
        held = {s for size, some in wanted.items() for s in zip(*[words[i:] for i in range(size)]) if s in some}

        def share(part: set[tuple]) -> float | None:
            return len(part & held) / len(part) if part else None
        return [(1.0 if not self.parts[item][0] else share(self.parts[item][0]), share(self.parts[item][1])) for item in items]

    def leaks(self, texts: list[str | None]):
        """(document, item id, score, question overlap, answer overlap) of every confirmed match."""
        docs = [terms_of(t or "") for t in texts]
        by_doc = defaultdict(list)
        for (number, item), score in self.retrieve(docs).items():
            by_doc[number].append((item, score))
        for number in sorted(by_doc):
            pairs = sorted(by_doc[number])
            for (item, score), (q, a) in zip(pairs, self.overlaps(docs[number], [i for i, _ in pairs])):
                if q >= MIN_OVERLAP and (a is None or a >= MIN_OVERLAP):
                    yield number, self.items[item][0], score, q, a


def _term_rows(batches):
    """Per item: each term with the number of segments that hold it, and one row for the segments themselves."""
    for batch in sliced(batches):
        parts, terms, holders, lengths = [], [], [], []
        for part, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist()):
            own = segments_of(*question_and_answer(text))
            rows = [(" ".join(t), n, 0) for t, n in Counter(t for s in own for t in s).items()]
            rows.append((None, len(own), sum(sum(s.values()) for s in own)))
            parts += [part] * len(rows)
            for column, values in zip((terms, holders, lengths), zip(*rows)):
                column += values
        yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.int64()), "term": pa.array(terms, pa.string()),
                                          "holders": pa.array(holders, pa.int64()), "length": pa.array(lengths, pa.int64())})


#: The part that a worker of a task has loaded last.
_LOADED: dict[str, Index] = {}


class Part:
    """Names the files of one part; tasks make its index from them."""

    def __init__(self, files: list[str], segments: int, terms: int):
        self.files, self.segments, self.terms = files, segments, terms

    def index(self) -> Index:
        name = " ".join(self.files)
        if name not in _LOADED:
            _LOADED.clear()
            rows = [r for f in self.files for r in pq.read_table(SparkFiles.get(f)).to_pylist()]
            holders = {tuple(r["term"].split(" ")): r["holders"] for r in rows if r["term"] is not None}
            items = sorted(((r["item_id"], r["text"]) for r in rows if r["term"] is None), key=str)
            _LOADED[name] = Index(items, Statistics(self.segments, self.terms, holders))
        return _LOADED[name]


def parts(benchmark: DataFrame) -> list[Part]:
    """The benchmark as files of items with the statistics of their terms, of bounded size each."""
    spark = benchmark.sparkSession
    scratch = Scratch(spark)
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("length(text) > 0").distinct()
    items = scratch.keep(items, "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // INDEX_BYTES) * (2 if total > INDEX_BYTES else 1))
    items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    terms = scratch.keep(items.select("part", "text").mapInArrow(_term_rows, "part long, term string, holders long, length long"), "terms")
    sizes = terms.where("term is null").agg(F.sum("holders"), F.sum("length")).first()
    everywhere = terms.where("term is not null").groupBy("term").agg(F.sum("holders").alias("holders"))
    own = terms.where("term is not null").select("part", "term").distinct().join(everywhere, "term")
    rows = items.select("part", "item_id", "text", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("holders")).unionByName(
        own, allowMissingColumns=True)
    rows.repartition(n, "part").write.partitionBy("part").parquet(f"{scratch.folder}/parts")
    out = []
    for k in range(n):
        files = scratch.named_apart(f"parts/part={k}", f"part{k}")
        for file in files:
            spark.sparkContext.addFile(file)
        if files:
            out.append(Part([f.rpartition("/")[2] for f in files], sizes[0], sizes[1]))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap of every item found in a document."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kinds = [d.schema[c].dataType.simpleString() for d, c in ((rows, "doc_id"), (benchmark, "item_id"))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double"

    def scan(batches, part):
        index = part.index()
        for batch in sliced(batches):
            hits = list(index.leaks(batch.column("text").to_pylist()))
            columns = list(zip(*hits)) or [()] * 5
            wanted = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(wanted), pa.array(columns[1], ITEM_TYPES.get(kinds[1])),
                 *[pa.array([x if x is None else round(x, 9) for x in c], pa.float64()) for c in columns[2:]]],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
    found = [rows.mapInArrow(lambda batches, part=part: scan(batches, part), schema) for part in parts(benchmark)]
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], schema)


ITEM_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found, unchanged."""
    def drop(batches, part):
        index = part.index()
        for batch in sliced(batches):
            clean = np.ones(batch.num_rows, bool)
            clean[[hit[0] for hit in index.leaks(batch.column("text").to_pylist())]] = False
            yield batch.filter(pa.array(clean))
    left = docs
    for part in parts(benchmark):
        left = left.mapInArrow(lambda batches, part=part: drop(batches, part), left.schema)
    return left
