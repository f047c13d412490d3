"""Sources and sinks: what is written to a fresh folder comes back the same."""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from marquee.contracts import CLEAN, RAW, Table
from marquee.operators.checks import GateFailure
from marquee.operators.fingerprint import row_differences
from marquee.session import shared_folder
from marquee.sources import audit, catalog, versions
from marquee.sources.csv import read_raw
from marquee.sources.tables import (
    EmptyResult, append_table, conform, publish, published, read_mixed, read_table, sample_rows, storage_cast, table_columns,
    write_table,
)
from marquee.plans.run import Inputs, run, star
from marquee.plans.silver import keyed
from workload import rawtext, standin
from workload.registry import END, START, query, table, using


def _fresh(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id,
           CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'He said "hi", ok' WHEN 2 THEN 'two' || chr(10) || 'lines'
                ELSE ' NA ' END AS title,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date,
           CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS budget, o_orderpriority AS revenue
    FROM orders""")
def raw_csv_roundtrip(spark, sf_dir):
    key = F.col("o_orderkey")
    title = (
        F.when(key % 4 == 0, F.when(key % 8 == 0, "NA").otherwise("None")).when(key % 4 == 1, 'He said "hi", ok')
        .when(key % 4 == 2, "two\nlines").otherwise(" NA ")
    )
    folder = _fresh(spark)
    table(spark, sf_dir, "orders").select(
        key.alias("id"), F.col("o_orderdate").cast("date").alias("release_date"), title.alias("title"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("budget"), F.col("o_orderpriority").alias("revenue"),
    ).write.csv(folder, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_raw(spark, folder, RAW["movies_main"]).select(*RAW["movies_main"].names)


@query(using("movies", body="""
    SELECT movie_id, movie_title, CAST(release_date AS VARCHAR) AS release_date,
           CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue FROM movies"""))
def overwrite_idempotent(spark, sf_dir):
    folder = _fresh(spark)
    movies = standin.movies(spark, sf_dir)
    first = write_table(movies, folder, CLEAN["movies"])
    second = write_table(movies, folder, CLEAN["movies"])
    assert first == second
    assert table_columns(spark, folder) == CLEAN["movies"].names
    return read_table(spark, folder)


@query("""
    SELECT l_orderkey AS movie_id, 'N' || s_nationkey AS iso_country_code, n_name AS country_name,
           CAST(NULL AS VARCHAR) AS country_region, CAST(NULL AS VARCHAR) AS country_subregion,
           false AS is_service_restricted
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""")
def schema_conform(spark, sf_dir):
    older = standin.countries(spark, sf_dir).select("country_name", "movie_id", "iso_country_code")
    return storage_cast(conform(older, CLEAN["producing_countries"]), CLEAN["producing_countries"])


@query("""SELECT o_orderkey AS movie_id, count(*) AS raw_rows FROM orders
    JOIN (VALUES (1), (5)) AS v(m) ON o_orderkey % m = 0 GROUP BY o_orderkey""")
def keyed_rows(spark, sf_dir):
    rows = keyed(rawtext.movies_main(spark, sf_dir))
    return rows.groupBy("movie_id").agg(F.count(F.lit(1)).alias("raw_rows"))


@query(using("movies", body="SELECT movie_id, 'Order#' || movie_id AS movie_title FROM movies"))
def declared_table_rename(spark, sf_dir):
    older = standin.movies(spark, sf_dir).withColumnRenamed("movie_title", "title")
    return conform(older, CLEAN["movies"]).select("movie_id", "movie_title")


@query(using("movies", body="SELECT movie_id, movie_title FROM movies"))
def empty_write_refused(spark, sf_dir):
    folder = _fresh(spark)
    movies = standin.movies(spark, sf_dir)
    write_table(movies, folder, CLEAN["movies"])
    with contextlib.suppress(EmptyResult):
        write_table(movies.where("movie_id IS NULL"), folder, CLEAN["movies"])
        raise AssertionError("an empty result was stored")
    return read_table(spark, folder).select("movie_id", "movie_title")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 7 > 0")
def latest_publication(spark, sf_dir):
    root = _fresh(spark)
    for run, least in (("first", 0), ("second", 1)):
        orders = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 7 >= least)
        write_table(orders.select("o_orderkey", "o_totalprice"), f"{root}/{run}/orders")
        publish(spark, root, run)
    return read_table(spark, f"{root}/{published(spark, root)}/orders")


@query(using("movies", body="""
    SELECT movie_id, movie_title, CAST(release_date AS VARCHAR) AS release_date,
           CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue FROM movies"""))
def versioned_table(spark, sf_dir):
    """Two parts, the first in the older layout; a third write breaks off before its manifest is complete."""
    folder, movies = _fresh(spark), standin.movies(spark, sf_dir)
    write_table(movies.where("movie_id % 3 = 0").withColumnRenamed("movie_title", "title"), folder)
    append_table(movies.where("movie_id % 3 > 0"), folder)
    versions.put_aside(movies.limit(1), folder)
    where, files = versions.hadoop(spark, f"{folder}/manifest/00000003")
    files.create(where, False).close()
    return read_table(spark, folder, CLEAN["movies"])


@query(using("movies", body="""
    SELECT movie_id, movie_title, CAST(release_date AS VARCHAR) AS release_date,
           CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue FROM movies"""))
def mixed_layout_folder(spark, sf_dir):
    """One folder of files: thirds with the former title and text amounts, as declared, and with the former title alone."""
    folder, movies = _fresh(spark), standin.movies(spark, sf_dir)
    movies.where("movie_id % 3 = 0").select(
        F.col("movie_title").alias("title"), "movie_id", "release_date", F.col("budget").cast("string").alias("budget"), F.col("revenue").cast("string").alias("revenue"),
    ).write.parquet(folder)
    movies.where("movie_id % 3 = 1").write.mode("append").parquet(folder)
    movies.where("movie_id % 3 = 2").withColumnRenamed("movie_title", "title").write.mode("append").parquet(folder)
    return read_mixed(spark, folder, CLEAN["movies"])


_DESCRIBED = [(i, c.name, c.type.simpleString(), c.comment) for i, c in enumerate(CLEAN["movies"].columns, 1)]


@query(using("movies", body=" UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS position, '{name}' AS column_name, '{kind}' AS data_type, '{text}' AS description, "
    f"(SELECT count({name}) FROM movies) AS filled_rows" for i, name, kind, text in _DESCRIBED)))
def declared_table_contents(spark, sf_dir):
    """A declared table in an older layout is recreated in the new one; its descriptions and filled rows."""
    database, movies = f"declared_{uuid.uuid4().hex[:12]}", standin.movies(spark, sf_dir)
    catalog.create_database(spark, database, _fresh(spark))
    older = Table("movies", tuple(replace(c, comment="") for c in CLEAN["movies"].columns[:3]))
    catalog.store_declared(movies.where("movie_id % 2 = 0"), database, older)
    stored = catalog.store_declared(movies, database, CLEAN["movies"])
    counts = stored.agg(*[F.count(c).alias(c) for c in stored.columns])
    filled = counts.unpivot([], stored.columns, "column_name", "filled_rows")
    return catalog.descriptions(spark, database, "movies").join(F.broadcast(filled), "column_name").select(
        "position", "column_name", "data_type", "description", "filled_rows")


@query(using("stg_genres", "genres", "scope", body="SELECT movie_id, genre FROM stg_genres"))
def staging_view(spark, sf_dir):
    """A view that was defined over the first publication, read after the second."""
    root, database = _fresh(spark), f"staging_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, database, _fresh(spark))
    for run_name, kept in (("first", "movie_id % 2 = 0"), ("second", "true")):
        for name, rows in (("movies", standin.movies(spark, sf_dir)), ("movie_genres", standin.genres(spark, sf_dir))):
            path = f"{root}/{run_name}/{name}"
            write_table(rows.where(kept), path)
            catalog.point(spark, database, name, path)
        catalog.define_staging(spark, database, START, END, ("stg_movies", "stg_movie_genres"))
    return spark.table(f"{database}.stg_movie_genres")


@query("""
    WITH l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
    f AS (
        SELECT *, CASE WHEN l_orderkey % 11 = 0 THEN 'lost' WHEN l_orderkey % 13 = 0 THEN 'doubled'
                       WHEN l_orderkey % 17 = 0 THEN 'changed' WHEN l_orderkey % 19 = 0 THEN 'extra' END AS fault FROM l)
    SELECT l_orderkey, fault, CAST(CASE WHEN fault IN ('lost', 'changed') THEN n ELSE 0 END AS BIGINT) AS lost_rows,
           CAST(CASE WHEN fault = 'lost' THEN 0 WHEN fault = 'extra' THEN 1 ELSE n END AS BIGINT) AS extra_rows
    FROM f WHERE fault IS NOT NULL""")
def stored_row_differences(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    key = F.col("l_orderkey")
    fault = F.when(key % 11 == 0, "lost").when(key % 13 == 0, "doubled").when(key % 17 == 0, "changed").when(key % 19 == 0, "extra").otherwise("")
    kept = lines.where(fault != "lost").withColumn("l_linenumber", F.when(fault == "changed", F.col("l_linenumber") + 100).otherwise(F.col("l_linenumber")))
    more = lines.where(fault == "extra").groupBy("l_orderkey").agg(F.lit(0).cast(lines.schema["l_linenumber"].dataType).alias("l_linenumber"))
    stored = kept.union(lines.where(fault == "doubled")).unionByName(more, allowMissingColumns=True)
    folder = _fresh(spark)
    write_table(stored, folder)
    return row_differences(lines, read_table(spark, folder), "l_orderkey")


@query("""
    SELECT o_orderkey, o_totalprice FROM (
        SELECT o_orderkey, o_totalprice, md5('look' || o_orderkey) AS digest FROM orders ORDER BY digest LIMIT 500)""")
def sampled_orders(spark, sf_dir):
    # The same rows whatever the partitions are.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").repartition(7, "o_totalprice")
    return sample_rows(orders, "o_orderkey", 500, "look")


@query("""
    SELECT o_orderkey AS movie_id, CAST(1980 + o_orderkey % 37 AS BIGINT) AS release_year,
           CAST(CASE WHEN o_orderkey % 10 = 9 THEN 1 ELSE 2 END AS BIGINT) AS genre_count, CAST(2 AS BIGINT) AS company_count,
           CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS country_count,
           CAST(CASE WHEN o_orderkey % 10 = 8 THEN 0 ELSE 1 END AS BIGINT) AS language_count
    FROM orders""")
def pipeline_star(spark, sf_dir):
    """Raw files through every layer and gate to the published fact table."""
    root = _fresh(spark)
    run(spark, _landed(spark, sf_dir, f"{root}/raw"), f"{root}/out", "whole")
    return star(spark, f"{root}/out")["fact_movies"].select(
        "movie_id", "release_year", "genre_count", "company_count", "country_count", "language_count")


def _landed(spark, sf_dir, folder, id=None, budget=None, years=37) -> Inputs:
    """The orders as raw files of movies; `id` and `budget` replace those columns to break a layer's gate."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    main = orders.select(
        (key if id is None else id).alias("id"), F.concat(F.lit("Order#"), key).alias("title"),
        F.make_date(1980 + key % years, 1 + key % 12, 1 + key % 28).alias("release_date"),
        (price if budget is None else budget).alias("budget"), F.when(key % 4 != 0, price).alias("revenue"))
    country = "{'iso_3166_1': '%s', 'name': 'x'}"
    extended = orders.select(
        key.alias("id"), F.when(key % 10 != 9, F.concat(F.lit("Drama, Type"), key % 6)).alias("genres"),
        F.concat(F.lit("Maker"), key % 7, F.lit(", Studio"), key % 5).alias("production_companies"),
        F.when(key % 3 == 0, f"[{country % 'US'}, {country % 'FR'}]").otherwise(f"[{country % 'BR'}]").alias("production_countries"),
        F.when(key % 10 == 8, "[]").otherwise("[{'iso_639_1': 'en', 'name': 'English'}]").alias("spoken_languages"))
    options = {"header": True, "quote": '"', "escape": '"'}
    main.write.csv(f"{folder}/main", **options)
    extended.write.csv(f"{folder}/extended", **options)
    answers = orders.select(key.cast("string").alias("id"), F.when(
        key % 10 == 9, '{"budget": 0, "revenue": 7, "genres": [{"name": "War"}]}').otherwise('{"revenue": 7}').alias("payload"))
    return Inputs(f"{folder}/main", f"{folder}/extended", answers, rawtext.country_names(spark, sf_dir),
                  rawtext.language_names(spark, sf_dir), multi_line=False)


@query("""
    SELECT 'keys' AS run, 'bronze' AS layer, 'movies_main.id_not_null' AS "check", count(*) AS violations FROM orders WHERE o_orderkey % 50 = 3
    UNION ALL SELECT 'keys', 'bronze', 'movies_main.fractional_id', count(*) FROM orders WHERE o_orderkey % 50 = 4
    UNION ALL SELECT 'amounts', 'silver', 'movies.budget_not_negative', count(*) FROM orders WHERE o_orderkey % 40 = 7
    UNION ALL SELECT 'years', 'gold', 'no_missing_years', 37 - count(DISTINCT 1980 + o_orderkey % 30) FROM orders""")
def gate_history(spark, sf_dir):
    """Three runs, each with an input that breaks one layer, and the layer before which each stopped."""
    root, key = _fresh(spark), F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(15,2)")
    broken = {
        "keys": {"id": F.when(key % 50 == 4, F.concat(key, F.lit(".5"))).when(key % 50 != 3, key.cast("string"))},
        "amounts": {"budget": F.when(key % 40 == 7, -price).otherwise(price)},
        "years": {"years": 30},
    }
    for name, changes in broken.items():
        with contextlib.suppress(GateFailure):
            run(spark, _landed(spark, sf_dir, f"{root}/raw/{name}", **changes), f"{root}/out", name)
            raise AssertionError(f"the run {name} was not stopped")
    return audit.stops(spark, f"{root}/out")
