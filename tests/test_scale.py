"""Plans that keep a task's memory and the time of a run in bounds, with the results of the plainer ones."""

from __future__ import annotations

import re
from threading import Barrier

from marquee.contracts import RAW, SOURCE_ORDER
from marquee.operators.fingerprint import row_differences
from marquee.operators.joins import orphans
from marquee.plans import gold, quality, silver
from marquee.plans.run import Layers


def _plan(df) -> str:
    """The plan as first laid out, whether or not it has run."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def _rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bronze_checks_ask_python_once_about_a_list(spark):
    technical = ", ".join(f"{c} string" for c in SOURCE_ORDER)

    def raw(name, rows):
        return spark.createDataFrame([(*r, "f", "0", str(i)) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in RAW[name].names) + ", " + technical)
    usual = "[{'iso_3166_1': 'US', 'name': 'x'}]"
    tables = {
        "movies_main": raw("movies_main", [("1", "a", None, None, None)]),
        "movie_extended": raw("movie_extended", [
            ("1", "g", "c", usual, "[{'iso_639_1': 5}]"), ("2", "g", "c", "[{'iso_3166_1'", "[1]"), ("3", "g", "c", None, ""), ("3.5", "g", "c", "[7]", "[")]),
    }
    checks = quality.bronze_checks(spark, tables, tables)
    found = {r["check"]: (r["severity"], r["violations"]) for r in checks.collect()}
    assert {k.split(".")[1]: v for k, v in found.items() if "_list" in k or k == "movie_extended.fractional_id"} == {
        "fractional_id": ("error", 1), "odd_country_list": ("error", 1), "odd_language_list": ("error", 2),
        "broken_country_list": ("warn", 1), "broken_language_list": ("warn", 1)}
    assert _plan(checks).count("ArrowEvalPython") == 1


def test_differences_count_both_sides_in_one_aggregate(spark):
    row = "k long, v string"
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "e")], row)
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "x"), (None, "n"), (None, "m"), (5, "e")], row)
    found = row_differences(source, stored, "k")
    assert _rows(found) == sorted([(1, "lost", 1, 0), (2, "doubled", 0, 1), (3, "changed", 1, 1), (None, "extra", 0, 1)], key=str)
    # Rows of a key are dealt once by key and row, not once a side and once more together.
    assert len(re.findall(r"hashpartitioning\(_key#\d+L?, _row#", _plan(found))) == 1


def test_orphans_pass_unsorted(spark):
    children = {"a": spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long"), "b": spark.createDataFrame([(2,), (3,), (3,)], "k long")}
    parent = spark.createDataFrame([(2,), (2,), (None,)], "k long")
    found = orphans(children, parent, "k", "t")
    assert _rows(found) == sorted([("a", 1), ("a", 1), ("a", None), ("b", 3), ("b", 3)], key=str)
    assert "ShuffledHashJoin" in _plan(found) and "Sort [" not in _plan(found)


def test_country_summary_of_unique_pairs_keeps_no_pair(spark):
    pair = "movie_id long, iso_country_code string, country_name string, country_region string, country_subregion string, is_service_restricted boolean"
    rows = [(1, "FR", "France", "EMEA", None, False), (1, "FR", "France", "EMEA", None, False), (2, "FR", "France", "EMEA", None, False),
            (2, "US", "United States", None, None, True), (None, "US", "United States", None, None, True), (9, "US", "United States", None, None, True)]
    scope = spark.createDataFrame([(1,), (2,), (2,), (None,)], "movie_id long")
    unique = gold.distinct_in_scope(spark.createDataFrame(rows, pair), scope, gold.COUNTRY)
    mart = gold.mart_country_summary(unique, unique_pairs=True)
    assert _rows(mart) == _rows(gold.mart_country_summary(unique)) == [
        ("FR", "France", "EMEA", None, False, 2), ("US", "United States", None, None, True, 1)]
    assert "SortMergeJoin" not in _plan(mart)
    # One partial and one final aggregate hold pairs: those of the distinct step.
    assert len(re.findall(r"HashAggregate\(keys=\[movie_id|HashAggregate\(keys=\[[^]]*, movie_id#", _plan(mart))) == 2


def test_independent_tables_are_stored_side_by_side(spark, tmp_path):
    both = Barrier(2, timeout=60)  # breaks if one table waits for the other

    def frame(n):
        both.wait()
        return spark.range(n)
    stored = Layers(spark, str(tmp_path), "r").store_all("x", {"two": lambda: frame(2), "none": lambda: frame(0)}, allow_empty={"two": False, "none": True})
    assert {name: df.count() for name, df in stored.items()} == {"two": 2, "none": 0}


def test_tokens_are_trimmed_as_rows(spark):
    rows = [(1, " a, ,b\u2003,a", None), (2, "", "x,,y "), (3, None, None)]
    genres = silver.movie_genres(spark.createDataFrame(rows, "movie_id long, genres string, genres_found string"))
    assert _rows(genres) == [(1, "a"), (1, "a"), (1, "b"), (2, "x"), (2, "y")]
    assert "lambdafunction" not in _plan(genres)
