import random
from collections import Counter, defaultdict

import pytest

from marquee.llm import divergence as d

SCHEMA = "doc_id long, text string, lang string, source string, rank int, item string"


def plain(rows, top=d.TOP_TERMS):
    docs = []
    for text, lang, source in rows:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c if "a" <= c <= "z" or c > "\x7f" else " " for c in text or "")
        docs.append((lang or "", source or "", [t for t in folded.split(" ") if t]))
    out = set()
    for lang in {x for x, _, _ in docs}:
        seen, groups = Counter(), defaultdict(Counter)
        for other, source, terms in docs:
            if other == lang:
                seen.update(set(terms))
                groups[source].update(terms)
        kept = [t for t, n in seen.items() if n >= 3]

        def share(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 1) // total for t in kept}
        p = {s: share(c) for s, c in groups.items()}
        q = share(sum(groups.values(), Counter()))
        for s in groups:
            parts = {"pair": [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s],
                     "term": [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if groups[s][t] and p[s][t] > q[t]]}
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i) for i, (value, item) in enumerate(found, 1) if part == "pair" or i <= top}
    return out


def rows_of(seed):
    rng = random.Random(seed)
    words = [a + b for a in ("Ab", "ü", "x", "Éa", "漢") for b in ("", "c", "DE", "ß")]
    rows = [(rng.choice([" ", "\n", "-", " 7"]).join(rng.choices(words[: rng.choice([3, 20])], k=rng.randint(0, 12))),
             rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "B", "é", None, "zz"])) for _ in range(90)]
    return [*rows, (None, "en", "only null"), ("", "xx", "y"), ("1 2", "xx", "z"), *[("same words here", "en", "a")] * 40]


@pytest.mark.parametrize("seed,groups,terms", [(1, 16, 1 << 15), (2, 2, 4), (3, 1, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, groups, terms):
    monkeypatch.setattr(d, "GROUPS", groups)
    monkeypatch.setattr(d, "TERMS", terms)
    monkeypatch.setattr(d, "PIECE", 8)
    monkeypatch.setattr(d, "HELD", 10)
    rows = rows_of(seed)
    got = d.audit(spark.createDataFrame([(i, t, la, s, 7, "x") for i, (t, la, s) in enumerate(rows)], SCHEMA), top_terms=3)
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows, 3)
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["value"] == "bigint"


def test_ties_nulls_and_empty(spark):
    twins = [("one two three four five six", "en", s) for s in ("b", "a", "é", "c")] * 3
    got = d.audit(spark.createDataFrame([(1, t, la, s, 1, "") for t, la, s in twins], SCHEMA)).collect()
    assert {(r.source, r.item, r["rank"]) for r in got if r.source == "b"} == {("b", "a", 1), ("b", "c", 2), ("b", "é", 3)}
    assert {r.value for r in got} == {0}
    frame = spark.createDataFrame([(None, None, None, None, None, None), (1, "x", None, "s", None, None)], SCHEMA)
    assert {(r.lang, r.source, r.part, r.item, r.value) for r in d.audit(frame).collect()} == {("", "", "pair", "s", 0), ("", "s", "pair", "", 0)}
    assert d.audit(frame.limit(0)).count() == 0


def test_long_text_in_pieces():
    text = (b"word " * 400_000) + b"x" * 2_500_000 + b" end"
    parts = list(d.pieces(text))
    assert b"".join(parts) == text and len(parts) > 2
    assert sum((p.split() for p in parts), []) == text.split()
    assert list(d.pieces(b"")) == [b""]


def test_large_totals(spark):
    count, total = 3 * 10 ** 14, 9 * 10 ** 14 + 7
    row = spark.range(1).select(d.share(d.F.lit(count), d.F.lit(total)).alias("p")).first()
    assert row.p == 1 + 10 ** 9 * count // total == d._shares(d.np.array([count - 1]), total)[0]
