import datetime as dt
import pathlib
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F, types as T

from marquee.contracts import CLEAN, Column, Table
from marquee.operators.checks import same_rows
from marquee.operators.fingerprint import fingerprint, row_differences
from marquee.sources import audit, catalog, tables, versions


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def stored(spark, path):
    return sorted(r.n for r in tables.read_table(spark, path).collect())


@pytest.mark.parametrize("step", ["put_aside", "described", "announce", "expire"])
@pytest.mark.parametrize("after", [False, True])
def test_a_stop_at_any_step_leaves_one_whole_table(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 1, 2), path)
    whole = getattr(versions, step)

    def broken(*args, **kwargs):
        if after:
            whole(*args, **kwargs)
        raise KeyboardInterrupt
    with monkeypatch.context() as patch:
        patch.setattr(versions, step, broken)
        with pytest.raises(KeyboardInterrupt):
            tables.write_table(numbers(spark, 3), path)
    seen = stored(spark, path)
    assert seen == ([3] if (step, after) in {("announce", True), ("expire", False), ("expire", True)} else [1, 2])
    versions.recover(spark, path, older_than_sec=-60)
    assert stored(spark, path) == seen
    named = {p.folder for v in versions.versions(spark, path) for p in v.parts}
    assert {f"data/{f.name}" for f in pathlib.Path(path, "data").iterdir()} == named
    tables.write_table(numbers(spark, 4), path)
    assert stored(spark, path) == [4]


def test_a_manifest_without_its_end_counts_for_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 1), path)
    for text in ("", '{"parts": ['):
        (tmp_path / "t" / "manifest" / "00000002").write_text(text)
        assert stored(spark, path) == [1]
    tables.write_table(numbers(spark, 2), path)  # takes the next number
    assert stored(spark, path) == [2] and versions.current(spark, path).number == 3
    assert "manifest/00000002" in versions.recover(spark, path, older_than_sec=-60)


def test_two_writers_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    part = tables.write_version(numbers(spark, 1), path).parts[0]
    taken = versions._numbers
    answers = iter([[], [1]])  # what the slower writer saw before the other took number 1
    monkeypatch.setattr(versions, "_numbers", lambda spark, path: next(answers, None) or taken(spark, path))
    assert versions.announce(spark, path, (part,)).number == 2


def test_old_versions_stay_for_readers_then_go(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 1), path)
    reader = tables.read_table(spark, path)
    tables.write_table(numbers(spark, 2), path)
    assert [r.n for r in reader.collect()] == [1]
    tables.write_table(numbers(spark, 3), path)
    assert [v.number for v in versions.versions(spark, path)] == [2, 3]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_damaged_files_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(numbers(spark, 1, 2, 3), path)
    assert versions.verify(spark, path) == 3
    folder = versions.current(spark, path).parts[0].folder
    numbers(spark, 1, 2, 4).write.mode("overwrite").parquet(f"{path}/{folder}")
    with pytest.raises(versions.Damaged):
        versions.verify(spark, path)


def test_parts_in_older_layouts(spark, tmp_path):
    path = str(tmp_path / "t")
    row = (1, "a", dt.date(2000, 1, 1), 5, None)
    kind = "movie_id long, {} string, release_date date, budget int, revenue double"
    tables.write_table(spark.createDataFrame([row], kind.format("title")), path)
    tables.append_table(spark.createDataFrame([(2, *row[1:])], kind.format("movie_title")), path)
    tables.append_table(spark.createDataFrame([(3, *row[1:])], kind.format("title")), path)
    got = tables.read_table(spark, path, CLEAN["movies"])
    assert sorted((r.movie_id, r.movie_title, int(r.budget)) for r in got.collect()) == [(1, "a", 5), (2, "a", 5), (3, "a", 5)]
    assert len(versions.read_parts(spark, path, versions.current(spark, path))) == 2


def test_mixed_folder_reads_as_one(spark, tmp_path):
    path = str(tmp_path / "t")
    layouts = [("title", "double"), ("title", "string"), ("movie_title", "double"), ("movie_title", "decimal(15,2)"), ("title", "double")]
    for i, (title, money) in enumerate(layouts):
        spark.createDataFrame([(i, f"t{i}", None)], f"movie_id long, {title} string, release_date date").withColumn(
            "budget", F.lit(i).cast(money)).coalesce(1).write.mode("append").parquet(path)
    got = tables.read_mixed(spark, path, CLEAN["movies"])
    assert sorted((r.movie_id, r.movie_title, int(r.budget), r.revenue) for r in got.collect()) == [(i, f"t{i}", i, None) for i in range(5)]
    spark.createDataFrame([(9, "new", "old")], "movie_id long, movie_title string, title string").write.mode("append").parquet(path)
    with pytest.raises(Exception, match="both movie_title and title"):
        tables.read_mixed(spark, path, CLEAN["movies"]).collect()


def test_fingerprint_ignores_order_and_sees_everything_else(spark):
    rows = [(1, "a", None), (2, None, "b"), (2, None, "b"), (3, "x", "y")]
    kind = "k long, a string, b string"
    base = fingerprint(spark.createDataFrame(rows, kind))
    assert base == fingerprint(spark.createDataFrame(rows[::-1], kind).repartition(5))
    for other in (rows[:-1], rows + rows[:1], [(1, None, "a"), *rows[1:]], [rows[1], *rows[1:]], [(1, "b", None), *rows[1:]]):
        assert fingerprint(spark.createDataFrame(other, kind)) != base
    assert fingerprint(spark.createDataFrame([], kind))[0] == 0


def test_row_differences_equal_brute_force(spark):
    rng = random.Random(5)
    kind = "k long, v string"
    left = [(rng.choice([None, *range(40)]), rng.choice("abc")) for _ in range(300)] + [(7, "hot")] * 200
    left += [(3, "a")]
    right = [r for r in left if rng.random() > 0.05 and r != (3, "a")] + rng.choices(left, k=6) + [(1, "zz"), (99, "new"), (3, "q")]
    got = {r.k: (r.fault, r.lost_rows, r.extra_rows) for r in row_differences(
        spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), "k").collect()}
    a, b, want = Counter(left), Counter(right), {}
    for key in {k for k, _ in left + right}:
        lost = sum(n for r, n in (a - b).items() if r[0] == key)
        extra = sum(n for r, n in (b - a).items() if r[0] == key)
        foreign = any(r not in a for r in b if r[0] == key)
        if lost or extra:
            want[key] = ("lost" if not extra else "changed" if lost else "extra" if foreign else "doubled", lost, extra)
    assert got == want and {f for f, _, _ in want.values()} >= {"lost", "changed", "extra"}


def test_verify_rows_and_check(spark):
    assert tables.verify_rows(spark.range(3), spark.range(3).repartition(2)) == 3
    with pytest.raises(tables.CountMismatch):
        tables.verify_rows(spark.range(3), spark.range(2))
    with pytest.raises(tables.RowMismatch):
        tables.verify_rows(spark.range(3), spark.range(1, 4))
    report = same_rows("t", spark.range(3), spark.range(1, 4), ["id"]).union(same_rows("u", spark.range(3), spark.range(5), ["id"]))
    assert [(r.check, r.violations) for r in report.collect()] == [
        ("t.row_count", 0), ("t.row_fingerprint", 1), ("u.row_count", 2), ("u.row_fingerprint", 1)]


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 7)
    first = {r.id for r in tables.sample_rows(df, "id", 100).collect()}
    assert first == {r.id for r in tables.sample_rows(df.repartition(13, "v"), "id", 100).collect()} and len(first) == 100
    assert first != {r.id for r in tables.sample_rows(df, "id", 100, "other").collect()}


@pytest.fixture
def database(spark, tmp_path):
    catalog.create_database(spark, "sink_test", str(tmp_path / "db"))
    yield "sink_test"
    spark.sql("DROP DATABASE sink_test CASCADE")


def test_declared_table_is_recreated_in_a_new_layout(spark, database):
    row = (1, "t", None, 1.5, None)
    movies = spark.createDataFrame([row], "movie_id long, movie_title string, release_date date, budget double, revenue double")
    older = Table("movies", CLEAN["movies"].columns[:2])
    assert catalog.store_declared(movies, database, older).columns == ["movie_id", "movie_title"]
    stored = catalog.store_declared(movies.union(movies), database, CLEAN["movies"])
    assert stored.count() == 2 and stored.columns == CLEAN["movies"].names
    assert {r.column_name: r.description for r in catalog.descriptions(spark, database, "movies").collect()}["budget"] == "Budget; unknown is NULL"
    assert catalog.store_declared(movies, database, CLEAN["movies"]).count() == 1
    with pytest.raises(Exception, match="cannot store"):
        catalog.store_declared(movies.withColumn("movie_id", F.lit(None).cast("long")), database, CLEAN["movies"])
    assert spark.table(f"{database}.movies").count() == 1
    quoted = replace(CLEAN["movies"], name="quoted", columns=(Column("n", T.LongType(), comment="it's a \\ mark"),))
    catalog.store_declared(numbers(spark, 1), database, quoted)
    assert catalog.descriptions(spark, database, "quoted").first().description == "it's a \\ mark"


def test_views_follow_publications(spark, database, tmp_path):
    kind = "movie_id long, movie_title string, release_date date, budget double, revenue double"
    for run, years in (("one", [1990]), ("two", [1990, 2010, 2020])):
        path = f"{tmp_path}/{run}/movies"
        tables.write_table(spark.createDataFrame([(y, "t", dt.date(y, 1, 1), None, None) for y in years], kind), path, CLEAN["movies"])
        catalog.point(spark, database, "movies", path)
        catalog.define_staging(spark, database, names=("stg_movies",))
        seen = sorted(r.release_year for r in spark.table(f"{database}.stg_movies").collect())
        assert seen == [y for y in years if y < 2017]
    with pytest.raises(ValueError, match="no version"):
        catalog.point(spark, database, "movies", f"{tmp_path}/nowhere")


def test_history_of_checks(spark, tmp_path):
    root = str(tmp_path)
    assert audit.history(spark, root).count() == 0
    audit.record(spark, root, "r1", "bronze", [("a", "error", 0), ("b", "warn", 3)], False)
    audit.record(spark, root, "r1", "silver", [("c", "error", 2), ("d", "error", 0)], True)
    audit.record(spark, root, "r2", "bronze", [("a", "error", 0)], False)
    assert [tuple(r) for r in audit.stops(spark, root).collect()] == [("r1", "silver", "c", 2)]
    found = {r.run: (r.gates_passed, r.times_stopped, r.stopped_at, r.checks) for r in audit.outcomes(spark, root).collect()}
    assert found == {"r1": (1, 1, "silver", 4), "r2": (1, 0, None, 1)}
