"""Checks on inputs shaped so that violations come out, and the report over all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.contracts import CLEAN
from marquee.functions.numbers import TIER_LABELS, classify, to_key
from marquee.operators import checks
from marquee.operators.dedup import repeated
from marquee.operators.profile import scope_summary as summarise
from marquee.plans import gold, quality, silver
from workload import rawtext, standin
from workload.registry import query, table, using


@query(using("scope", "stg_genres", "countries", "companies", "languages", body="""
    SELECT 'bridge_movie_genres' AS bridge_table, movie_id FROM stg_genres
    WHERE movie_id IN (SELECT movie_id FROM scope WHERE release_year = 2000)
    UNION ALL
    SELECT 'bridge_movie_companies', movie_id FROM companies
    WHERE movie_id NOT IN (SELECT movie_id FROM scope WHERE release_year < 2000)
    UNION ALL
    SELECT 'bridge_movie_countries', movie_id FROM countries
    WHERE movie_id NOT IN (SELECT movie_id FROM scope WHERE release_year < 2000)
    UNION ALL
    SELECT 'bridge_movie_languages', movie_id FROM languages
    WHERE movie_id NOT IN (SELECT movie_id FROM scope WHERE release_year < 2000)"""))
def orphans(spark, sf_dir):
    # The fact table lacks the last year and holds a NULL key, which must not hide any orphan.
    fact = standin.scope(spark, sf_dir).select(
        F.when(F.col("release_year") < 2000, F.col("movie_id")).alias("movie_id")
    )
    bridges = {
        "bridge_movie_genres": standin.stg_genres(spark, sf_dir),
        "bridge_movie_companies": standin.companies(spark, sf_dir),
        "bridge_movie_countries": standin.countries(spark, sf_dir),
        "bridge_movie_languages": standin.languages(spark, sf_dir),
    }
    return quality.orphan_rows(bridges, fact)


@query("""
    SELECT CAST(y AS BIGINT) AS release_year FROM generate_series(1980, 2016) AS s(y)
    WHERE y NOT IN (SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000)""")
def missing_years(spark, sf_dir):
    trends = gold.yearly_aggregates(standin.scope(spark, sf_dir))
    return quality.missing_years(spark, trends)


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS occurrences FROM lineitem
    GROUP BY l_orderkey, lineitem.l_linenumber HAVING count(*) > 1""")
def duplicate_pairs(spark, sf_dir):
    return repeated(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(using("stg_companies", body="""
    SELECT CAST(round(sum(pct), 2) AS DOUBLE) AS total_pct FROM (
        SELECT CAST(round(count(DISTINCT movie_id) * 100.0 / (SELECT count(DISTINCT movie_id) FROM stg_companies), 2)
                    AS DECIMAL(15, 2)) AS pct
        FROM stg_companies WHERE right(company_name, 1) = '7' GROUP BY company_name)
    HAVING sum(pct) <= 100"""))
def share_sum_check(spark, sf_dir):
    mart = gold.share_of_having(
        standin.stg_companies(spark, sf_dir), ["company_name"], "movie_id", "movie_count", "total_movies",
        "pct_of_movies",
    )
    return quality.low_share_sum(mart.where(F.col("company_name").endswith("7")))


def _row(check: str, violations: str, source: str, severity: str = "error") -> str:
    return f"""SELECT '{check}' AS "check", '{severity}' AS severity, CAST({violations} AS BIGINT) AS violations {source}"""


_REPORT = " UNION ALL ".join([
    _row("movies.columns", "0", ""),
    _row("movies.columns_wrong", "2", ""),
    _row("raw.row_count", "count(*)", "FROM orders WHERE o_orderkey % 5 = 0"),
    _row("raw.id_not_null", "count(*)", "FROM orders WHERE o_orderkey % 10 = 3"),
    _row("raw.no_empty_rows", "count(*)", "FROM orders WHERE o_orderkey % 30 = 3", "warn"),
    _row("raw.fractional_id", "count(*)", "FROM orders WHERE o_orderkey % 10 = 4"),
    _row("extended.odd_country_list", "0", ""),
    _row("movies.not_empty", "0", ""),
    _row("nothing.not_empty", "1", ""),
    _row("movies.budget_known", "count(*)", "FROM scope WHERE budget IS NULL"),
    _row("movies.shifted_not_negative", "count(*)", "FROM scope WHERE revenue < 1000000"),
    _row("movies.tier_accepted", "count(*)", f"FROM scope WHERE budget >= 100000000"),
    _row("movies.tier_accepted_recent", "count(*)", f"FROM scope WHERE budget >= 100000000 AND release_year = 2000"),
    _row("companies.not_blank", "count(*)", "FROM companies WHERE right(company_name, 1) = '3'"),
    _row("lines.key_unique", "count(*)", "FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)"),
    _row("fact_counts_not_negative", "0", ""),
    _row("scope_years", "count(*)", "FROM movies WHERE year(release_date) NOT BETWEEN 1996 AND 2000"),
    _row("restricted_have_region", "count(DISTINCT iso_country_code)",
         "FROM countries WHERE is_service_restricted AND country_region IS NULL"),
    _row("yearly_delta", "count(*)", "FROM (SELECT DISTINCT release_year FROM scope) WHERE release_year > 1996"),
    _row("budget_tier_coverage", "0", ""),
])


@query(using("scope", "companies", "countries", body=_REPORT))
def check_report(spark, sf_dir):
    movies, scope = standin.movies(spark, sf_dir), standin.scope(spark, sf_dir)
    raw = rawtext.movies_main(spark, sf_dir).where(F.col("title").contains("Order#"))
    key = to_key(F.regexp_extract("title", "[0-9]+", 0))
    damaged = raw.select(
        F.when(key % 10 == 4, F.concat(key, F.lit(".5"))).when(key % 10 != 3, F.col("id")).alias("id"),
        *[F.when(key % 30 != 3, F.col(c)).alias(c) for c in ("title", "release_date", "budget", "revenue")],
    )
    fewer = raw.where(key % 5 != 0)
    tier = classify(F.col("budget"))
    tagged = scope.withColumn("tier", tier).withColumn("shifted", F.col("revenue") - 1_000_000)
    companies = standin.companies(spark, sf_dir).withColumn(
        "company_name", F.when(F.col("company_name").endswith("3"), F.lit("  ")).otherwise(F.col("company_name"))
    )
    wrong = movies.withColumnRenamed("budget", "cost")
    trends = gold.yearly_trends_from(gold.yearly_aggregates(scope)).withColumn(
        "yoy_movie_count_delta", F.col("yoy_movie_count_delta") + 1
    )
    rest = silver.raw_faults()["movie_extended"]
    without_top = [label for label in TIER_LABELS if label != "Blockbuster"]
    return checks.report([
        checks.contract(spark, "movies.columns", movies.schema, CLEAN["movies"]),
        checks.contract(spark, "movies.columns_wrong", wrong.schema, CLEAN["movies"]),
        checks.same_count("raw.row_count", raw, fewer),
        checks.table_checks(damaged, {
            "raw.id_not_null": checks.not_null("id"),
            "raw.fractional_id": silver.raw_faults()["movies_main"]["fractional_id"],
        }),
        checks.table_checks(damaged, {"raw.no_empty_rows": checks.no_empty_rows(damaged.columns)}, checks.WARN),
        checks.table_checks(rawtext.movie_extended(spark, sf_dir), {
            "extended.odd_country_list": rest["odd_country_list"],
        }),
        checks.table_checks(tagged, {
            "movies.not_empty": checks.not_empty(),
            "movies.budget_known": checks.not_null("budget"),
            "movies.shifted_not_negative": checks.not_negative("shifted"),
            "movies.tier_accepted": checks.accepted("tier", without_top),
            "movies.tier_accepted_recent": checks.accepted("tier", without_top, F.col("release_year") == 2000),
        }),
        checks.table_checks(scope.where("release_year = 1900"), {"nothing.not_empty": checks.not_empty()}),
        checks.table_checks(companies, {"companies.not_blank": checks.not_blank("company_name")}),
        checks.unique("lines.key_unique", table(spark, sf_dir, "lineitem"), ["l_orderkey"]),
        checks.expect_none("fact_counts_not_negative", quality.negative_counts(standin.fact(spark, sf_dir))),
        checks.expect_none("scope_years", quality.years_outside(
            movies.withColumn("release_year", F.year("release_date")), range(1996, 2001)
        )),
        checks.expect_none("restricted_have_region", quality.restricted_without_region(
            gold.mart_country_summary(standin.countries(spark, sf_dir))
        )),
        checks.expect_none("yearly_delta", quality.wrong_deltas(trends)),
        checks.expect_none("budget_tier_coverage", quality.untiered(scope.withColumn("budget_tier", tier))),
    ])


@query(using("scope", body="""
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE release_year = 2000) AS rows_in_focus_year,
           min(release_year) AS min_year, max(release_year) AS max_year FROM scope"""))
def scope_summary(spark, sf_dir):
    return summarise(standin.scope(spark, sf_dir), "release_year", 2000)


_SEEDED = " UNION ALL ".join([
    _row("budget_tier_coverage", "count(*)", "FROM scope WHERE movie_id % 7 = 0"),
    _row("fact_counts_not_negative", "count(*)", "FROM scope WHERE movie_id % 12 IN (0, 1, 2, 3)"),
    _row("scope_years", "count(*)", "FROM scope WHERE movie_id % 9 IN (1, 2)"),
    _row("restricted_have_region", "count(DISTINCT (iso_country_code, movie_id % 5))",
         "FROM countries WHERE iso_country_code <> 'N24' AND is_service_restricted AND movie_id % 5 IN (2, 3)"),
    _row("yearly_delta", "count(*)", "FROM (SELECT DISTINCT release_year FROM scope) WHERE release_year > 1996 AND release_year % 2 = 0"),
])


@query(using("scope", "countries", body=_SEEDED))
def seeded_violations(spark, sf_dir):
    """Every rule of the star schema over rows of which a part was damaged by rule."""
    scope, key = standin.scope(spark, sf_dir), F.col("movie_id")
    tiers = gold.movie_financials(scope).withColumn("budget_tier", F.when(key % 7 != 0, F.col("budget_tier")))
    counts = ("genre_count", "company_count", "country_count", "language_count")
    fact = standin.fact(spark, sf_dir)
    for i, name in enumerate(counts):
        fact = fact.withColumn(name, F.when(key % 12 == i, F.lit(-1)).otherwise(F.col(name)))
    years = scope.withColumn("release_year", F.when(key % 9 == 1, 1995).when(key % 9 == 2, 2001).otherwise(F.col("release_year")))
    # Each country counts five times, and two of the five lack one part of their region.
    fifth = standin.countries(spark, sf_dir).where("iso_country_code <> 'N24'").withColumn("fifth", key % 5)
    fifth = fifth.withColumn("iso_country_code", F.concat("iso_country_code", F.lit("/"), "fifth")).withColumn(
        "country_region", F.when(F.col("fifth") != 2, F.col("country_region"))).withColumn(
        "country_subregion", F.when(F.col("fifth") != 3, F.col("country_subregion")))
    trends = gold.yearly_trends_from(gold.yearly_aggregates(scope)).withColumn("yoy_movie_count_delta", F.col("yoy_movie_count_delta") + F.when(
        F.col("release_year") % 2 == 0, 1).otherwise(0))
    return checks.report([
        checks.expect_none("budget_tier_coverage", quality.untiered(tiers)),
        checks.expect_none("fact_counts_not_negative", quality.negative_counts(fact)),
        checks.expect_none("scope_years", quality.years_outside(years, range(1996, 2001))),
        checks.expect_none("restricted_have_region", quality.restricted_without_region(gold.mart_country_summary(fifth))),
        checks.expect_none("yearly_delta", quality.wrong_deltas(trends)),
    ])
