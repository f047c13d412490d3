import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from marquee.operators import dedup, joins, lookup, ordering, profile, shares
from marquee.plans import gold


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def amounts(spark):
    """Two groups, one with a value that two thirds of its rows share, ties and NULLs included."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        year = 1990 if i % 10 else 1991
        value = None if i % 9 == 0 else 5.0 if i % 3 else round(rng.uniform(-50, 50), 1)
        data.append((i, year, value))
    return spark.createDataFrame(data, "id long, year int, value double").repartition(7)


def brute_ranks(data):
    out = {}
    for year in {y for _, y, _ in data}:
        group = sorted((r for r in data if r[1] == year), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        for place, (key, _, value) in enumerate(group):
            known = [r[2] for r in group if r[2] is not None]
            rank = len(known) + 1 if value is None else 1 + sum(v > value for v in known)
            out[key] = (
                rank,
                group[place - 1][2] if place else None,
                group[place + 1][2] if place + 1 < len(group) else None,
            )
    return out


def test_rank_against_brute_force(amounts):
    got = ordering.rank_descending(
        amounts, ["year"], "id", [ordering.Ranking("value", "rank", "higher", "lower")]
    )
    want = brute_ranks([tuple(r) for r in amounts.collect()])
    assert {r["id"]: (r["rank"], r["higher"], r["lower"]) for r in got.collect()} == want


def test_rank_with_many_groups(amounts, monkeypatch):
    """Too many groups for a broadcast go through a checkpoint and shuffle joins, same result."""
    ranking = [ordering.Ranking("value", "rank", "higher", "lower")]
    bounded = ordering.rank_descending(amounts, ["year"], "id", ranking)
    monkeypatch.setattr(ordering, "BROADCAST_GROUPS", 1)
    unbounded = ordering.rank_descending(amounts, ["year"], "id", ranking)
    assert bounded.exceptAll(unbounded).isEmpty() and unbounded.exceptAll(bounded).isEmpty()


def test_rank_fixture(spark):
    df = spark.createDataFrame(
        [(1, 2000, 3.0), (2, 2000, 3.0), (3, 2000, 1.0), (4, 2000, None), (5, 2000, None), (6, 2001, None)],
        "id long, year int, value double",
    )
    got = ordering.rank_descending(df, ["year"], "id", [ordering.Ranking("value", "rank", "higher", "lower")])
    assert [(r["id"], r["rank"], r["higher"], r["lower"]) for r in got.orderBy("id").collect()] == [
        (1, 1, None, 3.0), (2, 1, 3.0, 1.0), (3, 3, 3.0, None), (4, 4, 1.0, None), (5, 4, None, None),
        (6, 1, None, None),
    ]


@pytest.mark.parametrize("partitions", [1, 13])
@pytest.mark.parametrize("limit", [1, 200])
def test_percentiles_match_spark(amounts, partitions, limit, monkeypatch):
    monkeypatch.setattr(ordering, "BROADCAST_GROUPS", limit)
    fractions = {"low": 0.05, "mid": 0.5, "top": 0.99, "max": 1.0}
    df = amounts.repartition(partitions)
    got = ordering.exact_percentiles(df, ["year"], "value", fractions)
    want = df.groupBy("year").agg(*[F.percentile("value", f).alias(n) for n, f in fractions.items()])
    for left, right in zip(rows(got, "year"), rows(want, "year")):
        assert left == pytest.approx(right)


def test_percentiles_small(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 10.0, None)], "v double")
    assert rows(ordering.exact_percentiles(df, [], "v", {"median": 0.5})) == [(3.0,)]
    nothing = df.where("v IS NULL")
    assert rows(ordering.exact_percentiles(nothing, [], "v", {"median": 0.5})) == [(None,)]


def test_percentiles_of_repeated_values(spark):
    """One value holds a third of the rows and more, and stands at a wanted position."""
    values = [float(i) for i in range(4000)] + [2500.0] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7)
    fractions = {"p40": 0.4, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    got = ordering.exact_percentiles(df, [], "v", fractions).first()
    want = df.agg(*[F.percentile("v", f).alias(n) for n, f in fractions.items()]).first()
    assert tuple(got) == pytest.approx(tuple(want))


@pytest.mark.parametrize("partitions", [1, 5, 32])
def test_keep_first_ignores_partitioning(spark, partitions):
    data = [(i % 10 if i % 3 else 0, i, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(data, "k long, o long, v string").repartition(partitions, "v")
    got = {r["k"]: r["v"] for r in dedup.keep_first(df, ["k"], ["o"]).collect()}
    want = {}
    for key, _, value in data:
        want.setdefault(key, value)
    assert got == want
    assert rows(dedup.removed_by_dedup(df, ["k"])) == [(300, len(want), 300 - len(want))]


def test_keep_first_drops_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k long, o long, v string")
    plan = dedup.keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_fills(spark):
    left = spark.createDataFrame([(1, None), (2, 7.0), (3, None), (4, None)], "id long, budget double")
    right = spark.createDataFrame([(1, 500.0), (2, 9.0), (3, 0.0)], "id long, budget double")
    assert rows(joins.fill_amounts(left, right, "id", ["budget"]), "id") == [(1, 500.0), (2, 7.0), (3, None), (4, None)]
    texts = spark.createDataFrame([(1, " "), (2, " x "), (3, None)], "id long, genres string")
    found = spark.createDataFrame([(1, "War"), (2, "y"), (3, " ")], "id long, genres string")
    assert rows(joins.fill_texts(texts, found, "id", {"genres": "genres"}), "id") == [(1, "War"), (2, "x"), (3, None)]


def test_orphans_with_null_parent(spark):
    parent = spark.createDataFrame([(1,), (None,)], "movie_id long")
    child = spark.createDataFrame([(1,), (2,), (2,)], "movie_id long")
    got = joins.orphans({"a": child, "b": child.where("movie_id = 1")}, parent, "movie_id", "t")
    assert rows(got) == [("a", 2), ("a", 2)]


def test_lookup(spark):
    standard = spark.createDataFrame([("US", "United States"), ("CS", "Standard")], "code string, name string")
    manual = spark.createDataFrame([("SU", "Soviet Union"), ("CS", "Manual")], "code string, name string")
    names = lookup.merge_names(standard, manual, "code", "name")
    codes = spark.createDataFrame([("US",), ("SU",), ("CS",), ("ZZ",)], "code string")
    got = dict(rows(lookup.lookup_name(codes, names, "code", "name")))
    assert got == {"US": "United States", "SU": "Soviet Union", "CS": "Standard", "ZZ": "ZZ"}


def test_large_dimension_is_not_broadcast(spark):
    big = spark.range(50).selectExpr("cast(id as string) code", "id")
    assert "broadcast" in lookup.small_side(big, 50)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in lookup.small_side(big, 49)._jdf.queryExecution().logical().toString().lower()


def test_shares(spark):
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "id long, k string")
    scope = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    def pct(d):
        return {r["k"]: float(r["share_pct"]) for r in shares.shares(pairs, ["k"], "id", d, scope).collect()}
    assert pct("scope") == {"a": 50.0, "b": 25.0}
    assert pct("having") == {"a": 100.0, "b": 50.0}
    assert pct("rows") == {"a": 75.0, "b": 25.0}
    with pytest.raises(ValueError):
        shares.shares(pairs, ["k"], "id", "other")
    with pytest.raises(ValueError):
        shares.shares(pairs, ["k"], "id", "scope")


def test_yearly_windows(spark):
    counts = [(1990, 10), (1991, 20), (1992, 60), (1993, 1)]
    yearly = spark.createDataFrame(
        [(y, n, 0, 0, None, None, None, None) for y, n in counts],
        "release_year int, movie_count long, movies_with_budget long, movies_with_revenue long, "
        "avg_budget decimal(15,0), avg_revenue decimal(15,0), median_budget double, median_revenue double",
    )
    got = gold.yearly_trends_from(yearly).orderBy("release_year").collect()
    assert [float(r["rolling_3yr_avg_movies"]) for r in got] == [10.0, 15.0, 30.0, 27.0]
    assert [r["yoy_movie_count_delta"] for r in got] == [None, 10, 40, -59]
    assert [r["yoy_movie_count_pct"] and float(r["yoy_movie_count_pct"]) for r in got] == [None, 100.0, 200.0, -98.33]
    assert [r["next_year_movie_count"] for r in got] == [20, 60, 1, None]


def test_year_without_amounts(spark):
    scope = spark.createDataFrame(
        [(1, "a", dt.date(1990, 1, 1), 1990, None, None), (2, "b", dt.date(1990, 1, 1), 1990, None, None)],
        "movie_id long, movie_title string, release_date date, release_year int, budget decimal(15,2), revenue decimal(15,2)",
    )
    for unique in (True, False):
        row = gold.yearly_movie_trends(scope, unique).first()
        assert (row["movie_count"], row["movies_with_budget"]) == (2, 0)
        assert row["avg_budget"] is None and row["median_budget"] is None


def test_count_summary(spark):
    pairs = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "id long")
    got = profile.values_per_entity(pairs, "id").first()
    assert (got["n"], got["min"], got["max"], got["p50"], got["mean"]) == (3, 1.0, 3.0, 2.0, 2.0)
    assert got["stddev"] == pytest.approx(statistics.stdev([3, 1, 2]))


def test_windows_overlap(spark):
    df = spark.createDataFrame([(dt.date(1995, 1, 1),), (dt.date(2005, 1, 1),)], "d date")
    windows = {"a": (dt.date(1990, 1, 1), dt.date(2010, 1, 1)), "b": (dt.date(2000, 1, 1), dt.date(2010, 1, 1))}
    assert rows(profile.in_windows(df, "d", windows), "d", "window") == [
        (dt.date(1995, 1, 1), "a"), (dt.date(2005, 1, 1), "a"), (dt.date(2005, 1, 1), "b"),
    ]


def test_groups_without_a_key(spark):
    """NULL is a group of its own, also beside other keys, and so is the whole frame without keys."""
    rows = [(None, "a", 1.0, 1), (None, "a", 3.0, 2), (1, "a", 2.0, 3), (1, None, None, 4), (None, None, 5.0, 5)]
    df = spark.createDataFrame(rows, "k int, g string, v double, id int")
    ranked = ordering.rank_descending(df, ["k", "g"], "id", [ordering.Ranking("v", "place", "higher", "lower")])
    assert sorted((r.id, r.place, r.higher, r.lower) for r in ranked.collect()) == [
        (1, 2, 3.0, None), (2, 1, None, 1.0), (3, 1, None, None), (4, 1, None, None), (5, 1, None, None)]
    everything = ordering.rank_descending(df, [], "id", [ordering.Ranking("v", "place")]).collect()
    assert {r.id: r.place for r in everything} == {5: 1, 2: 2, 3: 3, 1: 4, 4: 5}
    middle = ordering.exact_percentiles(df, ["k"], "v", {"p50": 0.5}).collect()
    assert {r.k: r.p50 for r in middle} == {None: 3.0, 1: 2.0}
    assert {r.k for r in profile.numeric_summary(df, ["v"], ["k"]).collect()} == {None, 1}


def test_window_comparison_equals_brute_force(spark):
    """Overlapping, nested, equal and empty windows, tied and missing values, days on the bounds."""
    rng = random.Random(3)
    day = dt.date(2000, 1, 1)
    data = [(day + dt.timedelta(rng.randrange(400)), rng.choice([None, 1.0, 7.0, rng.random() * 50]), rng.choice([None, float(rng.randrange(5))]))
            for _ in range(900)] + [(None, 5.0, 5.0), (dt.date(1990, 1, 1), 9.0, 9.0)] + [(day, 3.0, None)] * 300
    windows = {name: (day + dt.timedelta(a), day + dt.timedelta(b)) for name, (a, b) in {
        "all": (0, 400), "early": (0, 150), "late": (100, 400), "inner": (120, 140), "same": (120, 140), "one day": (77, 78),
        "nothing": (5000, 5100), "ends": (399, 400)}.items()}
    frame = spark.createDataFrame(data, "d date, a double, b double")
    got = {r["window"]: (r["rows_in_window"], r["a_skew"], r["b_skew"]) for r in profile.window_comparison(frame, "d", ["a", "b"], windows).collect()}
    want = {}
    for name, (lo, hi) in windows.items():
        inside = [r for r in data if r[0] and lo <= r[0] < hi]
        skews = []
        for i in (1, 2):
            known = [r[i] for r in inside if r[i] is not None]
            middle = statistics.median(known) if known else 0
            skews.append(round(sum(known) / len(known) / middle, 2) if middle else None)
        if inside:
            want[name] = (len(inside), *skews)
    assert got.keys() == want.keys()
    for name, (n, *skews) in want.items():
        assert got[name][0] == n
        for x, y in zip(got[name][1:], skews):
            assert (x is None) == (y is None) and (x is None or abs(x - y) <= 0.011), name
