import random

import pytest

from marquee.llm import fixity as f
from marquee.llm import queries
from marquee.llm.common import Scratch

from oracle import connect

SCHEMA = "record long, offset long, length long, digest string"


@pytest.mark.parametrize("seed,width", [(1, 300), (2, 5000), (3, 1 << 18)])
def test_equals_plain_comparison(spark, monkeypatch, seed, width):
    monkeypatch.setattr(f, "RANGE_BYTES", width)
    rng = random.Random(seed)
    left, at = {}, 0
    for i in range(400):
        left[at] = (i, rng.randint(100, 900), f"d{rng.random()}")
        at += left[at][1]
    right = dict(left)
    for o in rng.sample(list(left), 9):
        right[o] = (right[o][0], right[o][1], "bad")
    for o in rng.sample(list(left), 3):
        right.pop(o)
    right[at + 10 ** 6] = (None, 5, "new")
    a, b = ([(r, o, n, d) for o, (r, n, d) in x.items()] for x in (left, right))
    got = f.audit(Scratch(spark), spark.createDataFrame(a + a[:3], SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()
    expected = {o: "missing" if o not in right else "extra" if o not in left else "changed"
                for o in left.keys() | right.keys() if left.get(o) != right.get(o)}
    assert {r.offset: r.fault for r in got} == expected and len(got) == len(expected)


def test_equal_empty_and_conflict(spark):
    rows = spark.createDataFrame([(1, 0, 5, "a"), (2, 5, 5, "b")], SCHEMA)
    twice = rows.union(spark.createDataFrame([(2, 5, 5, "c")], SCHEMA))
    assert f.audit(Scratch(spark), rows, rows).count() == 0
    assert f.audit(Scratch(spark), rows.limit(0), rows.limit(0)).count() == 0
    assert [r.fault for r in f.audit(Scratch(spark), rows, twice).collect()] == ["conflict"]
    assert [r.fault for r in f.audit(Scratch(spark), rows, rows.limit(0)).collect()] == ["missing"] * 2


def test_query_equals_oracle(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted((r.page_id, r.offset, r.length, r.fault) for r in queries.op3_fixity(spark, sf).collect())
    expected = connect(sf).execute(f'SELECT page_id, "offset", length, fault FROM ({queries.ORACLES["op3_fixity"]})').fetchall()
    assert got == sorted(expected) and len(got) > 2


def test_null_pages(spark):
    pages = spark.createDataFrame([(13, None, None, 1), (None, "u", "x", 2), (13, None, None, 1)], "page_id long, url string, html string, offset int")
    assert {(r.page_id, r.fault) for r in f.pages_audit(pages).collect()} == {(13, "changed")}
    assert f.pages_audit(pages.limit(0)).count() == 0


def faults(spark, left, right):
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (left, right))
    return sorted((r.offset, r.fault) for r in f.audit(Scratch(spark), a, b).collect())


def test_conflicts_do_not_depend_on_neighbours(spark):
    rows = [(i, i * 10, 10, f"d{i}") for i in range(5)]
    twice = rows + [(2, 20, 10, "other")]
    assert faults(spark, twice, twice) == [(20, "conflict")]
    changed = [r if r[0] != 4 else (4, 40, 10, "bad") for r in twice]
    assert faults(spark, twice, changed) == [(20, "conflict"), (40, "changed")]
    assert faults(spark, rows, twice) == faults(spark, twice, rows) == [(20, "conflict")]


def test_every_copy_of_an_offset_is_sealed(spark):
    def copies(*digests):
        return [(1, 0, 5, d) for d in digests]
    assert faults(spark, copies("a"), copies("a", "a", "a")) == []
    assert faults(spark, copies("a", "b", "c"), copies("a", "c")) == [(0, "conflict")]
    scratch = Scratch(spark)
    seals = {f.Tree(scratch, spark.createDataFrame(copies(*d), SCHEMA), "t" + "".join(d), 1).levels[0].first()["hash"]
             for d in (("a", "b", "c"), ("a", "c"), ("a", "d", "c"), ("a", "b", "b", "c"))}
    assert len(seals) == 3  # copies that are equal count once
    assert faults(spark, [(1, 0, 5, None)], [(1, 0, 5, "a")]) == [(0, "changed")]
