import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marquee.llm import repeats as r


def brute(texts):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + 400] for d in datas for i in range(len(d) - 399))
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 399):
            if seen[d[i:i + 400]] > 1:
                gone[i:i + 400] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choice("abcdefghij é") for _ in range(n))
    shared = [prose(n) for n in (395, 400, 401, 450, 700, 1500)]
    texts = [None, "", "short", prose(399), "a" * 900, "ab" * 450]
    for _ in range(60):
        text = prose(rng.randint(0, 500))
        for _ in range(rng.randint(0, 2)):
            text += rng.choice(shared) + prose(rng.randint(0, 300))
        if rng.random() < 0.3:
            i = rng.randrange(len(text) + 1)
            text = text[:i] + "#" + text[i:]
        texts.append(text)
    base = prose(1200)
    for _ in range(25):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice("XYZ")
        texts.append("".join(copy))
    return texts + texts[20:24]


@pytest.mark.parametrize("seed,group,bound,chunk", [(1, 512, 8 << 20, 1 << 20), (2, 2, 8 << 20, 500), (3, 6, -1, 900)])
def test_equals_brute_force(spark, monkeypatch, seed, group, bound, chunk):
    monkeypatch.setattr(r, "CHUNK", chunk)
    monkeypatch.setattr(r, "GROUP", group)
    monkeypatch.setattr("marquee.llm.common.BROADCAST_BYTES", bound)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i if i else None, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int").repartition(4)
    got = {x.doc_id or 0: tuple(x)[1:5] for x in r.repeats(docs).collect()}
    expected = brute(texts)
    assert len(got) == len(texts)
    for i, e in enumerate(expected):
        assert got[i] == e, (i, (texts[i] or "")[:50])
    assert sum(e[1] > 0 for e in expected) > 30


def test_small_tables(spark):
    docs = spark.createDataFrame([(1, "x" * 500), (1, "x" * 500), (2, "y")], "doc_id long, text string")
    assert sorted(tuple(x)[:4] for x in r.repeats(docs).collect()) == [(1, 500, 500, 1), (1, 500, 500, 1), (2, 1, 0, 0)]
    assert r.repeats(docs.limit(0)).count() == 0


def test_expansion_equals_counting():
    rng = np.random.default_rng(4)
    for stop in (1, 2, 5, 9):
        for _ in range(30):
            parts = [rng.integers(0, 3, rng.integers(1, 30)) for _ in range(rng.integers(1, 8))]
            k = len(parts)
            text = np.concatenate([np.append(p + k, i) for i, p in enumerate(parts)])
            seen = Counter()
            for p in parts:
                seen.update(tuple(p[i:i + stop]) for i in range(len(p) - stop + 1))
            expected, at = [], 0
            for p in parts:
                expected += [at + i for i in range(len(p) - stop + 1) if seen[tuple(p[i:i + stop])] > 1]
                at += len(p) + 1
            assert sorted(r.expanded(text, k, stop).tolist()) == expected


def test_short_rows_over_many_partitions(spark):
    """Passages a little shorter and longer than the minimum, in rows of about their size, dealt thinly."""
    rng = random.Random(17)

    def words(k):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 9))) for _ in range(k))
    passages = [words(k) for k in (52, 55, 60, 64, 70, 90)]
    texts = [f"{words(rng.randint(0, 12))} {rng.choice(passages)} {words(rng.randint(0, 12))}" if rng.random() < 0.5 else words(rng.randint(5, 90))
             for _ in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(60)
    got = sorted((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in r.repeats(docs).collect())
    assert got == [(i, *row) for i, row in enumerate(brute(texts))]
    assert {len(p) >= 400 for p in passages} == {True, False} and sum(x[2] > 0 for x in got) > 20
