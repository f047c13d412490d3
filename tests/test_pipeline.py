"""The whole batch over hand-written files, and a broken input for every check."""

import csv
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.contracts import CLEAN, STAR_TABLES
from marquee.operators import checks
from marquee.plans import gold, kpi, quality, silver
from marquee.plans.run import Inputs, Layers, gold_views, publish_to_catalog, register_views, run, star
from marquee.sources import audit, catalog
from marquee.sources.tables import published

# One movie in every year of the scope keeps the completeness check quiet.
YEARS = [(1000 + y, f"Film {y}", f"6/15/{y}", "2000000", "3000000") for y in range(1980, 2017)]
MAIN = [
    (862, "\t Toy  ", "1/5/1999", "700", "0"),
    ("862.0", "Second copy", "1/5/2001", "1", "1"),
    (863, 'He said "hi", ok', "1999-1-5", "0", "0.0"),
    (864, "two\nlines", "5-1-1999", "0", ""),
    (865, "Old", "1979-12-31", "5", "5"),
    (866, "New", "2017-01-01", "5", "5"),
    (867, "No date", "2/30/1999", "abc", "1d"),
    ("1997-08-20", "shifted", "1", None, None),
    *YEARS,
]
US = "[{'iso_3166_1': 'US', 'name': 'United States of America'}]"
EN = "[{'iso_639_1': 'en', 'name': 'English'}]"
EXTENDED = [
    (862, "Drama, Comedy,,Drama ", "Columbia Pictures, The, Gaumont, Columbia Pictures Corporation", US + "", EN),
    (863, "", "the", "[]", "[]"),
    (864, "War", None, "[{'iso_3166_1': ' ', 'name': 'x'}]", "[{'iso_639_1': 'cn'}, {'iso_639_1': 'cn'}]"),
    (865, "Drama", "Gaumont", US, EN),
    ("867", "Drama", "Gaumont", "[{'iso_3166_1': 'CN'}, {'iso_3166_1': 'SU'}, {'iso_3166_1': 'ZZ'}]", EN),
    *[(1000 + y, "Drama, Comedy", "Gaumont", "[{'iso_3166_1': 'CN'}, {'iso_3166_1': 'CN'}]", EN) for y in range(1980, 2017)],
]
ANSWERS = [
    ("862", '{"budget": 500, "revenue": 900, "genres": [{"name": "Ignored"}]}'),
    ("863", '{"budget": 500, "revenue": 0, "genres": [{"name": "War"}, {"name": "Music"}], "production_countries": '
            '[{"iso_3166_1": "FR", "name": "France"}, {"iso_3166_1": "GB", "name": "a:b"}, {"iso_3166_1": ""}], '
            '"spoken_languages": [{"iso_639_1": "fr", "name": null}, {"iso_639_1": "qq"}]}'),
    ("864", '{"budget": 0, "revenue": 7, "production_countries": [{"iso_3166_1": "FR", "name": "France"}]}'),
    ("9999", '{"budget": 1, "revenue": 1}'),
    ("867", '{}'),
]


def _write(path, header, lines):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(lines)
    return str(path)


def _inputs(spark, folder, main=MAIN, extended=EXTENDED, answers=ANSWERS):
    folder.mkdir(exist_ok=True)
    return Inputs(
        _write(folder / "main.csv", ("id", "title", "release_date", "budget", "revenue"), main),
        _write(
            folder / "extended.csv",
            ("id", "genres", "production_companies", "production_countries", "spoken_languages"), extended,
        ),
        spark.createDataFrame(answers, "id string, payload string"),
        spark.createDataFrame(
            [("US", "United States"), ("FR", "France"), ("GB", "United Kingdom"), ("CN", "China")],
            "iso_country_code string, country_name string",
        ),
        spark.createDataFrame([("en", "English"), ("fr", "French")], "iso_language_code string, language_name string"),
    )


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    reports = run(spark, _inputs(spark, root / "raw"), str(root / "out"), "r1")
    return root, reports, Layers(spark, str(root / "out"), "r1")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def of(layers, layer, name, movie, *columns):
    return rows(layers.read(layer, name).where(F.col("movie_id") == movie), *columns)


def test_reports_pass(done):
    _, reports, _ = done
    assert set(reports) == {"bronze", "silver", "gold"}
    assert all(count == 0 for report in reports.values() for _, severity, count in report if severity == "error")
    assert len(reports["gold"]) == 46 + 8 + 3 + 9


def test_clean_movies(done):
    layers = done[2]
    day = dt.date(1999, 1, 5)
    want = {
        862: ("Toy", day, Decimal("700.00"), Decimal("900.00")),
        863: ('He said "hi", ok', day, Decimal("500.00"), None),
        864: ("two\nlines", day, None, Decimal("7.00")),
        867: ("No date", None, None, None),
    }
    for movie, values in want.items():
        assert of(layers, "silver", "movies", movie, "movie_title", "release_date", "budget", "revenue") == [values]
    assert layers.read("silver", "movies").count() == 6 + len(YEARS)


def test_attributes(done):
    layers = done[2]
    assert of(layers, "silver", "movie_genres", 862, "genre") == [("Comedy",), ("Drama",), ("Drama",)]
    assert of(layers, "silver", "movie_genres", 863, "genre") == [("Music",), ("War",)]
    assert of(layers, "silver", "production_companies", 862, "company_name") == [
        ("Columbia Pictures Corporation",), ("Columbia Pictures Corporation",), ("Gaumont",)
    ]
    assert of(layers, "silver", "production_companies", 863, "company_name") == []
    country = ("iso_country_code", "country_name", "country_region", "country_subregion", "is_service_restricted")
    assert of(layers, "silver", "producing_countries", 862, *country) == [
        ("US", "United States", "NA", "United States", False)
    ]
    assert of(layers, "silver", "producing_countries", 863, "iso_country_code") == [("FR",), ("GB",)]
    assert of(layers, "silver", "producing_countries", 864, "iso_country_code") == []
    assert of(layers, "silver", "producing_countries", 867, *country) == [
        ("CN", "China", "APAC", "Other APAC", True), ("SU", "Soviet Union", "EMEA", "CEE", False),
        ("ZZ", "ZZ", None, None, False),
    ]
    assert of(layers, "silver", "spoken_languages", 863, "iso_language_code", "language_name") == [
        ("fr", "French"), ("qq", "qq")
    ]
    assert of(layers, "silver", "spoken_languages", 864, "language_name") == [("Cantonese",), ("Cantonese",)]


def test_enriched(done):
    layers = done[2]
    enriched = layers.read("silver", "movies_enriched")
    # 862 lacks a revenue, so it is asked too; 9999 is no candidate, 867 has no useful answer.
    assert rows(enriched, "movie_id") == [(862,), (863,), (864,)]
    assert of(layers, "silver", "movies_enriched", 863, "genres", "production_countries", "spoken_languages") == [
        ("War, Music", "FR:France|GB:a:b", "fr:None|qq:")
    ]


def test_star(spark, done):
    root, _, layers = done
    tables = star(spark, str(root / "out"), "r1")
    assert set(tables) == set(STAR_TABLES)
    counts = ("genre_count", "company_count", "country_count", "language_count")
    fact = tables["fact_movies"]
    assert rows(fact.where("movie_id = 862"), *counts) == [(2, 3, 1, 1)]
    assert rows(fact.where("movie_id = 864"), *counts) == [(1, 0, 0, 2)]
    assert rows(fact.where("movie_id = 2990"), *counts) == [(2, 1, 1, 1)]
    assert fact.where("movie_id IN (865, 866, 867)").isEmpty()
    assert published(spark, str(root / "out")) == "r1"
    financials = gold_views(layers)["int_movie_financials"]
    assert rows(financials.where("movie_id = 863"), "budget_tier", "revenue_tier") == [("Micro-Budget", "Unknown")]


def test_views_answer_sql(spark, done):
    register_views(spark, str(done[0] / "out"), "r1")
    row = spark.sql("""
        SELECT count(*), count(*) FILTER (WHERE release_year = 1999), min(release_year), max(release_year)
        FROM fact_movies""").first()
    assert tuple(row) == (40, 4, 1980, 2016)
    assert spark.sql("SELECT count(*) FROM stg_movies JOIN stg_movie_genres USING (movie_id)").first()[0] == 79


def test_kpis(spark, done):
    tables = star(spark, str(done[0] / "out"), "r1")
    row = kpi.kpis(tables).first()
    assert (row["films"], row["top_genre"]) == (40, "Comedy")
    narrowed = kpi.kpis(tables, kpi.Filters(countries=("US",), released_from=dt.date(1999, 1, 1))).first()
    assert (narrowed["films"], float(narrowed["language_pct"])) == (1, 100.0)
    nothing = kpi.kpis(tables, kpi.Filters(languages=("xx",))).first()
    assert (nothing["films"], nothing["language_pct"], nothing["top_genre"]) == (0, None, None)


def test_second_run_is_equal(spark, done):
    root, _, layers = done
    run(spark, _inputs(spark, root / "raw"), str(root / "out"), "r2")
    again = Layers(spark, str(root / "out"), "r2")
    for layer, names in (("silver", list(CLEAN)), ("gold", list(STAR_TABLES))):
        for name in names:
            one, two = layers.read(layer, name), again.read(layer, name)
            assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty(), name
    assert published(spark, str(root / "out")) == "r2"


def test_readers_keep_a_published_run(spark, done):
    root, _, _ = done
    latest = published(spark, str(root / "out"))
    before = star(spark, str(root / "out"))["fact_movies"].count()
    with pytest.raises(ValueError):
        run(spark, _inputs(spark, root / "raw"), str(root / "out"), latest)
    with pytest.raises(checks.GateFailure):
        run(spark, _inputs(spark, root / "bad", main=[("862.5", "t", "1/5/1999", "1", "1")]), str(root / "out"), "bad")
    assert published(spark, str(root / "out")) == latest
    assert star(spark, str(root / "out"))["fact_movies"].count() == before


@pytest.mark.parametrize("changes, failing", [
    ({"main": [("862.5", "t", "1/5/1999", "1", "1")]}, "movies_main.fractional_id"),
    ({"main": [(None, "t", "1/5/1999", "1", "1")]}, "movies_main.id_not_null"),
    ({"extended": [(1, "x", "y", "['US']", EN)]}, "movie_extended.odd_country_list"),
    ({"extended": [(1, "x", "y", US, "[{'iso_639_1': None}]")]}, "movie_extended.odd_language_list"),
    ({"main": [(862, "t", "1/5/1999", "-5", "1"), (863, "u", "1/5/1999", "0", "1")]}, "movies.budget_not_negative"),
    ({"answers": [("1", "{}")]}, "movies_enriched.not_empty"),
    ({"main": [(862, "t", "1/5/1999", "0", "1"), (863, "u", "1/5/1999", "0", "1")]}, "no_missing_years"),
])
def test_gate_stops_the_run(spark, tmp_path, changes, failing):
    with pytest.raises(checks.GateFailure) as stopped:
        run(spark, _inputs(spark, tmp_path / "raw", **changes), str(tmp_path / "out"), "r")
    assert failing in [name for name, _ in stopped.value.failed]
    assert not (tmp_path / "out" / "_published").exists()


def test_blank_row_only_warns(spark, tmp_path):
    df = spark.createDataFrame([("1", "x"), (None, " ")], "id string, title string")
    report = checks.table_checks(df, {"blank": checks.no_empty_rows(df.columns)}, checks.WARN)
    assert checks.gate("raw", report) == [("blank", "warn", 1)]


def violations(report):
    return {r["check"]: r["violations"] for r in report.collect() if r["violations"]}


BROKEN_SILVER = {
    "movies.types": lambda t: {"movies": t["movies"].withColumn("extra", F.lit(1))},
    "movies.movie_id_unique": lambda t: {"movies": t["movies"].union(t["movies"])},
    "movies.movie_id_not_null": lambda t: {"movies": t["movies"].withColumn("movie_id", F.lit(None).cast("long"))},
    "movies.revenue_not_negative": lambda t: {"movies": t["movies"].withColumn("revenue", F.lit(-1).cast("decimal(15,2)"))},
    "movie_genres.genre_not_blank": lambda t: {"movie_genres": t["movie_genres"].withColumn("genre", F.lit(" "))},
    "production_companies.company_not_blank": lambda t: {
        "production_companies": t["production_companies"].withColumn("company_name", F.lit(""))
    },
    "producing_countries.country_not_blank": lambda t: {
        "producing_countries": t["producing_countries"].withColumn("country_name", F.lit(""))
    },
    "spoken_languages.language_not_blank": lambda t: {
        "spoken_languages": t["spoken_languages"].withColumn("iso_language_code", F.lit(""))
    },
    "spoken_languages.not_empty": lambda t: {"spoken_languages": t["spoken_languages"].where("false")},
    "movies.types ": lambda t: {"movies": t["movies"].withColumn("budget", F.col("budget").cast("double"))},
}


@pytest.mark.parametrize("check", BROKEN_SILVER)
def test_silver_check_can_fail(spark, done, check):
    tables = {name: done[2].read("silver", name) for name in CLEAN}
    report = quality.silver_checks(spark, {**tables, **BROKEN_SILVER[check](tables)})
    assert check.strip() in violations(report)


def test_gold_checks_can_fail(spark, done):
    layers = done[2]
    tables = {**gold_views(layers), **star(spark, str(done[0] / "out"), "r1")}
    broken = {
        "stg_movies": tables["stg_movies"].withColumn("release_year", F.lit(2017)).withColumn("movie_title", F.lit(None).cast("string")),
        "int_movie_financials": tables["stg_movies"].withColumn(
            "budget_tier", F.when(F.col("movie_id") % 2 == 0, "Other")
        ),
        "fact_movies": tables["fact_movies"].where("movie_id <> 862").withColumn("genre_count", F.lit(-1)),
        "bridge_movie_genres": tables["bridge_movie_genres"].union(tables["bridge_movie_genres"]),
        "mart_genre_share": tables["mart_genre_share"].withColumn("pct_of_movies", F.lit(1)),
        "mart_country_summary": tables["mart_country_summary"].withColumn(
            "country_region", F.when(F.col("iso_country_code") != "CN", "Moon")
        ),
        "mart_yearly_trends": tables["mart_yearly_trends"].where("release_year <> 1990").withColumn(
            "yoy_movie_count_delta", F.lit(99)
        ),
    }
    found = violations(quality.gold_checks(spark, {**tables, **broken}))
    assert {
        "stg_movies.movie_title_not_null",
        "int_movie_financials.budget_tier_accepted", "mart_country_summary.country_region_accepted",
        "budget_tier_coverage", "fact_counts_not_negative", "no_orphan_bridge_rows", "genre_shares_over_100",
        "no_duplicate_genres", "scope_years", "restricted_have_region", "no_missing_years", "yearly_delta",
    } <= set(found)


def test_row_count_check_can_fail(spark):
    report = checks.report([
        checks.same_count("rows", spark.range(5), spark.range(3)),
        checks.unique("key", spark.range(3).union(spark.range(1)), ["id"]),
    ])
    assert violations(report) == {"rows": 2, "key": 1}


def test_partitioning_does_not_change_clean_movies(spark, done):
    layers = done[2]
    enriched = silver.unique_enriched(layers.read("silver", "movies_enriched"))
    want = None
    for parts in (1, 3, 16):
        main = layers.read("bronze", "movies_main").repartition(parts, "title")
        got = sorted(map(str, silver.movies(main, enriched).collect()))
        assert want is None or got == want
        want = got


def test_catalogue_shows_the_published_run(spark, done):
    root = str(done[0] / "out")
    database = "published_test"
    catalog.create_database(spark, database, str(done[0] / "db"))
    publish_to_catalog(spark, root, database)
    publish_to_catalog(spark, root, database)
    assert spark.table(f"{database}.fact_movies").count() == star(spark, root)["fact_movies"].count() == 40
    layers = Layers(spark, root, published(spark, root))
    for name in catalog.STAGING:
        view, frame = spark.table(f"{database}.{name}"), gold_views(layers)[name]
        assert view.columns == frame.columns and view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty(), name
    spark.sql(f"DROP DATABASE {database} CASCADE")
    assert star(spark, root)["fact_movies"].count() == 40  # dropping external tables leaves the run


def test_every_gate_is_recorded(spark, done, tmp_path):
    root = str(done[0] / "out")
    first = {r.run: (r.gates_passed, r.times_stopped, r.stopped_at) for r in audit.outcomes(spark, root).collect()}["r1"]
    assert first == (3, 0, None)
    with pytest.raises(checks.GateFailure) as stopped:
        run(spark, _inputs(spark, tmp_path / "raw", main=[("862.5", "t", "1/5/1999", "1", "1"), (None, "t", "1/5/1999", "1", "1")]), str(tmp_path / "out"), "odd")
    assert stopped.value.layer == "bronze"
    found = {(r.run, r.layer, r.check): r.violations for r in audit.stops(spark, str(tmp_path / "out")).collect()}
    assert found == {("odd", "bronze", "movies_main.fractional_id"): 1, ("odd", "bronze", "movies_main.id_not_null"): 1}
