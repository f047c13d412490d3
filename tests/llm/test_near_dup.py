import random
import re

import numpy as np
import pytest

from marquee.llm import near_dup as n

SCHEMA = "doc_id long, text string, kept int"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(x)] = root(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        least.setdefault(root(x), []).append(i)
    return sorted((i, len(s), min(least[root(x)]), i == min(least[root(x)])) for x, (i, s) in enumerate(sets))


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(30):
        base = [rng.choice(vocab) for _ in range(rng.choice((6, 60, 300)))]
        rows.append(base)
        for _ in range(rng.randint(0, 9)):
            copy = list(rng.choice(rows[-4:]))
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append(copy)
    texts = [" ".join(r) for r in rows] + ["a b", "A  b", "a b c", "", " \n", "É x y z", "é x y z", "one two three four five"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("bound,direct", [(8 << 20, 24), (-1, 24), (8 << 20, 1)])
def test_components_equal_brute_force(spark, monkeypatch, bound, direct):
    monkeypatch.setattr(n, "DIRECT", direct)
    monkeypatch.setattr("marquee.llm.common.BROADCAST_BYTES", bound)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in n.near_duplicates(docs).collect())
    assert got == brute(rows)


def test_group_around_a_middle_text(spark):
    """Every copy is near the middle text, few are near each other."""
    rng = random.Random(9)
    base = [f"x{i}" for i in range(150)]
    rows = [(50, " ".join(base))]
    for i in range(120):
        copy = list(base if i < 60 else rng.choice(rows)[1].split())
        for at in rng.sample(range(3, 147), rng.choice((1, 2, 3, 4))):
            copy[at] = f"y{i}"
        rows.append((100 + i, " ".join(copy)))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    assert sorted(tuple(r) for r in n.near_duplicates(docs).collect()) == brute(rows)


def test_copies_too_far_apart_give_few_candidates(spark, monkeypatch):
    """A group of copies of a text that is not there itself, two changed words each, hardly any near another."""
    rng = random.Random(12)
    base = [f"z{i}" for i in range(150)]
    texts = []
    for i in range(300):
        copy = list(base if i % 10 else rng.choice(texts or [base]))
        for at in rng.sample(range(4, 146), 2 if i % 10 else 1):
            copy[at] = f"v{i}"
        texts.append(copy)
    rows = [(100 + i, " ".join(t)) for i, t in enumerate(texts)]
    found, inner = [], n._Search._by_prefix

    def counted(self, *args):
        pairs = inner(self, *args)
        found.append(pairs.count())
        return pairs
    monkeypatch.setattr(n._Search, "_by_prefix", counted)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    expected = brute(rows)
    assert sorted(tuple(r) for r in n.near_duplicates(docs).collect()) == expected
    assert len({e[2] for e in expected}) > 150 and not all(e[3] for e in expected)
    assert found[0] < 10 * len(rows)


def test_nulls_repeats_and_empty(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (None, "a b c d e f"), (3, "a b c d e f"), (4, ""), (4, "")]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], SCHEMA)
    got = sorted(map(str, n.near_duplicates(docs).collect()))
    assert len(got) == 7 and sum("component_id=1" in g for g in got) == 4
    out = n.deduplicate(docs)
    assert out.columns == docs.columns
    assert sorted(map(str, out.select("doc_id").collect())) == ["Row(doc_id=1)", "Row(doc_id=2)", "Row(doc_id=4)"]
    assert n.near_duplicates(docs.limit(0)).count() == 0 and n.deduplicate(docs.limit(0)).count() == 0


def test_signature_equals_the_plain_algorithm():
    """Element by element with whole permutations, as the method is defined."""
    rng = np.random.default_rng(1)
    for size in (1, 5, 70, 900):
        seeds = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
        expected = np.full(n.SLOTS, np.inf)
        for s in seeds:
            p = list(range(n.SLOTS))
            for j in range(n.SLOTS):
                draw = n.mix(np.array([s]) + n._STEP * np.uint64(2 * j + 1))[0]
                k = j + int(n.mix(np.array([s]) + n._STEP * np.uint64(2 * j + 2))[0] >> np.uint64(33)) % (n.SLOTS - j)
                p[j], p[k] = p[k], p[j]
                expected[p[j]] = min(expected[p[j]], j + float(draw >> np.uint64(11)) * 2.0 ** -53)
        assert (n.signatures([seeds])[0] == expected).all()


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        pool = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
        a, b = n.signatures([pool[:260], pool[40:]])
        errors.append((a == b).mean() - 220 / 300)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_threshold_is_a_parameter(spark):
    """Pairs at 0.80 to 0.85 are copies at 80 %, and none at 85 %."""
    rng = random.Random(6)
    rows = []
    for k in range(60):
        base = [f"p{k}x{i}" for i in range(204)]
        copy = list(base)
        for at in (20, 60, 100, 140):
            copy[at] = f"q{rng.randrange(10 ** 9)}"
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    a, b = shingle_set(rows[0][1]), shingle_set(rows[1][1])
    assert 0.80 <= len(a & b) / len(a | b) < 0.85
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    assert n.deduplicate(docs).count() == 120
    assert sorted(r.doc_id for r in n.deduplicate(docs, 80).collect()) == list(range(0, 120, 2))


def test_bands_miss_few_pairs_at_the_threshold():
    assert n.bands_at(85) == n.BANDS == 16 and n.bands_at(80) == 22
    for percent in (70, 80, 85, 90):
        assert (1 - (percent / 100) ** n.ROWS) ** n.bands_at(percent) <= n.MISSED
