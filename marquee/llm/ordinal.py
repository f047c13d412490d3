"""Quality grades by ordinal cumulative-link regression on hashed text.

Documents have ordered grades: 0 toxic, 1 poor, 2 good. One weight vector over hashed features is
shared by all grades, P(grade <= k) = sigmoid(threshold_k - score), with ordered thresholds. Features
are the distinct words of the whole text, their beginnings, the signs around their letters and how
often words repeat. The model is fitted on a bounded sample of rated documents (FIT_ROWS, by hash of
the id); every document is scored, with its expected grade and the probability of the best grade, by
which documents are selected.

Defined cases: a null text is empty and has the score 0; ratings that are null, or belong to no
document, are not used; without ratings all weights are 0; repeated rows give repeated results; an
empty table gives an empty result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import whole_text

BITS = 18
GRADES = 3
#: The model is fitted on at most so many rated documents.
FIT_ROWS = 8192
#: A feature must occur in so many of them.
MIN_DOCUMENTS = 3
STEPS = 120
PENALTY = 1e-4
#: The weight of a rated row is the share of its grade to this power, turned round: 0 none, 1 all grades alike.
BALANCE = 0.25
MIN_TAIL = 0.5
REMEMBERED = 500_000
LETTERS = re.compile(r"[^\W\d_]+")


class Features:
    """Hashed features of texts; remembers those of words, up to a bound."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, 3), np.int32)

    def _add(self, word: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        number = self.known[word] = len(self.known)
        if number >= len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        core = "".join(LETTERS.findall(word)).lower()
        shape = LETTERS.sub("a", word) + ("U" if len(word) > 1 and word.isupper() else "")
        for i, feature in enumerate(("w" + core, "b" + core[:5], "s" + shape)):
            self.table[number, i] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
        return number

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a text and their values."""
        words = text.split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        distinct = dict.fromkeys(words)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known.clear()
        known, add = self.known.get, self._add
        numbers = [n if (n := known(w)) is not None else add(w) for w in distinct]
        repeat = zlib.crc32(b"r%d" % min(9, 2 * len(words) // len(distinct))) & ((1 << BITS) - 1)
        buckets, counts = np.unique(np.append(self.table[numbers].reshape(-1), np.int32(repeat)), return_counts=True)
        values = np.log1p(counts)
        return buckets, (values * (np.log1p(len(distinct)) / 3 / np.sqrt((values ** 2).sum()))).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every k but the last."""
        return 1 - _sigmoid(self.thresholds[None, :] - np.asarray(scores)[:, None])


def ordered(free: np.ndarray) -> np.ndarray:
    """Thresholds from free numbers: the first, and the logarithms of the gaps after it."""
    return np.cumsum(np.append(free[0], np.exp(free[1:])))


class Likelihood:
    """The penalised negative log-likelihood of rated rows, given as (row, bucket, value) entries. `shares` are
    the weights of the rows, 1 on average."""

    def __init__(self, row: np.ndarray, at: np.ndarray, x: np.ndarray, grades: np.ndarray, shares: np.ndarray):
        self.row, self.at, self.x, self.grades, self.shares = row, at, x, grades, shares

    def of(self, weights: np.ndarray, free: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Its value and its derivatives by the weights and by the free numbers."""
        n, every, grades = len(self.grades), np.arange(len(self.grades)), self.grades
        score = np.bincount(self.row, weights[self.at] * self.x, n)
        below = _sigmoid(ordered(free)[:, None] - score)
        slope = below * (1 - below)
        edges = np.vstack([np.zeros(n), below, np.ones(n)])
        slopes = np.vstack([np.zeros(n), slope, np.zeros(n)])
        p = np.maximum(edges[grades + 1, every] - edges[grades, every], 1e-12)
        by_score = self.shares * (slopes[grades, every] - slopes[grades + 1, every]) / p
        by_threshold = np.array([(self.shares * ((grades == k) * slope[k] - (grades == k + 1) * slope[k]) / p) for k in range(GRADES - 1)]).mean(axis=1)
        by_free = np.cumsum(by_threshold[::-1])[::-1] * np.append(1.0, np.exp(free[1:]))
        value = PENALTY / 2 * float((weights.astype(np.float64) ** 2).sum()) - float((self.shares * np.log(p)).mean())
        return value, PENALTY * weights - np.bincount(self.at, by_score[self.row] * self.x, len(weights)).astype(weights.dtype) / n, -by_free


def balanced(grades: np.ndarray, power: float = BALANCE) -> np.ndarray:
    """Weights of rows, 1 on average: the rarer its grade, the more a row counts."""
    often = np.bincount(grades, minlength=GRADES)
    weight = (len(grades) / np.maximum(often, 1)) ** power
    return weight[grades] / weight[grades].mean()


def fit(buckets: list[np.ndarray], values: list[np.ndarray], grades: np.ndarray) -> Model:
    """Penalised maximum likelihood by adaptive gradient steps; the gaps between thresholds are
    exponentials, so they stay ordered."""
    size, n = 1 << BITS, len(grades)
    weights, free = np.zeros(size, np.float32), np.append(-2.0, np.zeros(GRADES - 2))
    if not n:
        return Model(weights, ordered(free))
    row = np.repeat(np.arange(n, dtype=np.int32), [len(b) for b in buckets])
    at, x = np.concatenate(buckets), np.concatenate(values)
    use = np.bincount(at, minlength=size)[at] >= MIN_DOCUMENTS
    likelihood = Likelihood(row[use], at[use], x[use], grades, balanced(grades))
    moments = [np.zeros(size, np.float32), np.zeros(size, np.float32), np.zeros(GRADES - 1), np.zeros(GRADES - 1)]
    for step in range(1, STEPS + 1):
        gradients = likelihood.of(weights, free)[1:]
        for k, (gradient, rate) in enumerate(zip(gradients, (0.3 if step < STEPS // 2 else 0.1, 0.1))):
            moments[2 * k] = 0.9 * moments[2 * k] + 0.1 * gradient
            moments[2 * k + 1] = 0.99 * moments[2 * k + 1] + 0.01 * gradient ** 2
            move = rate * (moments[2 * k] / (1 - 0.9 ** step)) / (np.sqrt(moments[2 * k + 1] / (1 - 0.99 ** step)) + 1e-6)
            if k:
                free = free - move
            else:
                weights = (weights - move).astype(np.float32)
    return Model(weights, ordered(free))


def _vectors(batches):
    features = Features()
    for batch in batches:
        found = [features.of(t) for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "grade": batch.column("grade"), "at": pa.array([b for b, _ in found], pa.list_(pa.int32())),
            "x": pa.array([v for _, v in found], pa.list_(pa.float32()))})


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from `labels` (doc_id, quality, toxic)."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    rated = labels.select("doc_id", grade.alias("grade")).where("grade is not null and doc_id is not null").dropDuplicates(["doc_id"])
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    texts = docs.select("doc_id", whole_text().alias("_text")).join(F.broadcast(sample), "doc_id").select("grade", "_text")
    rows = texts.mapInArrow(_vectors, "grade int, at array<int>, x array<float>").toArrow().combine_chunks()

    def lists(name):
        column = rows.column(name).combine_chunks()
        return [column[i].values.to_numpy() for i in range(len(column))]
    return fit(lists("at"), lists("x"), rows.column("grade").to_numpy().astype(np.int64))


def grade(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, p_best (the probability of the best grade), kept per row."""
    model = train(docs, labels)

    def score(batches):
        features = Features()
        for batch in batches:
            scores = [float(model.weights[b] @ v) for b, v in map(features.of, batch.column("_text").to_pylist())]
            tails = model.tails(np.array(scores))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "expected_grade": pa.array(tails.sum(axis=1)), "p_best": pa.array(tails[:, -1]),
                "kept": pa.array(tails[:, -1] >= MIN_TAIL)})
    rows = docs.select("doc_id", whole_text().alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, expected_grade double, p_best double, kept boolean")
