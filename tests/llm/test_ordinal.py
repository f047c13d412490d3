import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import ordinal as o


def test_gradient_and_thresholds():
    rng = np.random.default_rng(1)
    buckets, values, grades = [], [], []
    for _ in range(600):
        g = int(rng.integers(0, 3))
        b = np.unique(np.append(rng.integers(100, 400, 20), rng.integers(10 * g, 10 * g + 6, 2))).astype(np.int32)
        buckets.append(b)
        values.append(np.full(len(b), 0.3, np.float32))
        grades.append(g)
    model = o.fit(buckets[:400], values[:400], np.array(grades[:400]))
    assert model.thresholds[0] < model.thresholds[1]
    scores = np.array([model.weights[b] @ v for b, v in zip(buckets[400:], values[400:])])
    tails = model.tails(scores)
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == np.array(grades[400:])).mean() > 0.9
    # With the same features only, the thresholds give the shares of the grades.
    flat = o.fit([np.array([1], np.int32)] * 400, [np.zeros(1, np.float32)] * 400, np.array(grades[:400]))
    shares = 1 - flat.tails(np.zeros(1))[0]
    assert abs(shares[0] - np.mean(np.array(grades[:400]) == 0)) < 0.03 and abs(shares[1] - np.mean(np.array(grades[:400]) <= 1)) < 0.03


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fitted = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) > 0)
    held = labels.join(fitted, "doc_id", "left_anti")
    rows = o.grade(docs, fitted).join(held, "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("k"), F.avg("expected_grade").alias("g")).collect()
    kept = {(r.quality, r.toxic): r for r in rows}
    print(kept)
    assert kept[1, 0].k > 0.98 and kept[0, 0].k < 0.25 and kept[1, 1].k < 0.35
    assert kept[1, 0].g > kept[0, 0].g > kept[0, 1].g


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (None, "a b", 0), (2, "", 1), (1, None, 1)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, None, None), (9, 1, 0), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert o.grade(docs, labels).count() == 4 and o.grade(docs, labels.limit(0)).count() == 4
    assert o.grade(docs.limit(0), labels).count() == 0


def rated(seed, n=60, size=40):
    rng = np.random.default_rng(seed)
    lists = [np.unique(rng.integers(0, size, 8)).astype(np.int32) for _ in range(n)]
    values = [rng.random(len(b)).astype(np.float32) for b in lists]
    return lists, values, rng.integers(0, o.GRADES, n)


def test_derivatives_equal_differences():
    lists, values, grades = rated(3)
    row = np.repeat(np.arange(len(grades)), [len(b) for b in lists])
    rng = np.random.default_rng(4)
    for shares in (np.ones(len(grades)), o.balanced(grades, 1.0)):
        likelihood = o.Likelihood(row, np.concatenate(lists), np.concatenate(values), grades, shares)
        weights, free = rng.normal(size=40), rng.normal(size=o.GRADES - 1)
        # By plain sums over rows.
        edges = np.concatenate([[-np.inf], o.ordered(free), [np.inf]])
        plain = 0.0
        for b, v, g, s in zip(lists, values, grades, shares):
            score = sum(weights[k] * x for k, x in zip(b, v))
            upper, lower = 1 / (1 + np.exp(score - edges[g + 1])), 1 / (1 + np.exp(score - edges[g]))
            plain -= s * np.log(upper - lower) / len(grades)
        value, by_weights, by_free = likelihood.of(weights, free)
        assert abs(value - plain - o.PENALTY / 2 * (weights ** 2).sum()) < 1e-9
        h = 1e-4
        for k in range(40):
            step = np.eye(40)[k] * h
            numeric = (likelihood.of(weights + step, free)[0] - likelihood.of(weights - step, free)[0]) / (2 * h)
            assert abs(numeric - by_weights[k]) < 1e-5, k
        for k in range(o.GRADES - 1):
            step = np.eye(o.GRADES - 1)[k] * h
            numeric = (likelihood.of(weights, free + step)[0] - likelihood.of(weights, free - step)[0]) / (2 * h)
            assert abs(numeric - by_free[k]) < 1e-5, k


def test_fit_ends_near_the_least_likelihood():
    lists, values, grades = rated(5, 400)
    model = o.fit(lists, values, grades)
    row = np.repeat(np.arange(len(grades)), [len(b) for b in lists])
    likelihood = o.Likelihood(row, np.concatenate(lists), np.concatenate(values), grades, o.balanced(grades))
    free = np.append(model.thresholds[0], np.log(np.diff(model.thresholds)))
    value, by_weights, by_free = likelihood.of(model.weights[:40].astype(float), free)
    assert np.abs(by_weights).max() < 2e-3 and np.abs(by_free).max() < 2e-3


def test_grades_equal_a_plain_scorer(spark):
    """Each row's result against a scorer that reads the text word by word and sums in a loop."""
    docs = [(i, " ".join(f"{w}{i % 5}!" if w == "bad" else w for w in ["one", "Two", "bad", "ÜBER", "7", "a-b"] * (i % 4 + 1))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "long " * 300_000 + "end"), (102, "long " * 300_000 + "end")]
    labels = [(i, i % 2, int(i % 7 == 0)) for i in range(50)]
    texts = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, kept int")
    rated_rows = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = o.train(texts, rated_rows)

    def plain(text):
        words = (text or "").split()
        score = 0.0
        if words:
            distinct, counts = list(dict.fromkeys(words)), {}
            for word in distinct:
                core = "".join(c for c in word if c.isalpha()).lower()
                shape, run = "", False
                for c in word:
                    shape += "" if c.isalpha() and run else "a" if c.isalpha() else c
                    run = c.isalpha()
                shape += "U" if len(word) > 1 and word.isupper() else ""
                for feature in ("w" + core, "b" + core[:5], "s" + shape):
                    bucket = zlib.crc32(feature.encode()) % (1 << o.BITS)
                    counts[bucket] = counts.get(bucket, 0) + 1
            bucket = zlib.crc32(b"r%d" % min(9, 2 * len(words) // len(distinct))) % (1 << o.BITS)
            counts[bucket] = counts.get(bucket, 0) + 1
            length = sum(math.log1p(n) ** 2 for n in counts.values()) ** 0.5
            score = sum(float(model.weights[b]) * math.log1p(n) * math.log1p(len(distinct)) / 3 / length for b, n in counts.items())
        tails = [1 - 1 / (1 + math.exp(score - t)) for t in model.thresholds]
        return sum(tails), tails[-1], tails[-1] >= o.MIN_TAIL
    got = sorted(o.grade(texts, rated_rows).collect(), key=lambda r: r.doc_id)
    assert len(got) == len(docs)
    for (i, text), r in zip(sorted(docs, key=lambda d: d[0]), got):
        expected = plain(text)
        assert r.doc_id == i and abs(r.expected_grade - expected[0]) < 1e-4 and abs(r.p_best - expected[1]) < 1e-4
        assert r.kept == expected[2] or abs(expected[1] - o.MIN_TAIL) < 1e-4
