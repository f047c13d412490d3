"""Star schema: staging, intermediate frames, fact, bridges and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.numbers import classify
from marquee.operators.ordering import Ranking, exact_percentiles, rank_descending
from marquee.plans import gold
from workload import standin
from workload.registry import query, sql_pct, table, using

_MOVIE = """movie_id, movie_title, CAST(release_date AS VARCHAR) AS release_date, release_year,
            CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue"""


@query(using("scope", body=f"SELECT {_MOVIE} FROM scope"))
def scoped_orders(spark, sf_dir):
    return standin.scope(spark, sf_dir)


_YEARLY = f"""
    , yearly AS (
        SELECT release_year,
               count(DISTINCT movie_id) AS movie_count,
               count(DISTINCT movie_id) FILTER (WHERE budget IS NOT NULL) AS movies_with_budget,
               count(DISTINCT movie_id) FILTER (WHERE revenue IS NOT NULL) AS movies_with_revenue,
               round(CAST(sum(budget) AS DOUBLE) / count(budget), 0) AS avg_budget,
               round(CAST(sum(revenue) AS DOUBLE) / count(revenue), 0) AS avg_revenue,
               quantile_cont(CAST(budget AS DOUBLE), 0.5) AS median_budget,
               quantile_cont(CAST(revenue AS DOUBLE), 0.5) AS median_revenue
        FROM scope GROUP BY release_year
    ), trends AS (
        SELECT y.*,
               p.movie_count AS prev_year_movie_count,
               p.avg_budget AS prev_year_avg_budget,
               p.avg_revenue AS prev_year_avg_revenue,
               n.movie_count AS next_year_movie_count,
               y.movie_count - p.movie_count AS yoy_movie_count_delta,
               {sql_pct("(y.movie_count - p.movie_count)", "p.movie_count")} AS yoy_movie_count_pct,
               round((SELECT avg(b.movie_count) FROM yearly b
                      WHERE b.release_year BETWEEN y.release_year - 2 AND y.release_year), 1)
                   AS rolling_3yr_avg_movies
        FROM yearly y
        LEFT JOIN yearly p ON p.release_year = y.release_year - 1
        LEFT JOIN yearly n ON n.release_year = y.release_year + 1
    )"""


@query(using("scope", body=f"{_YEARLY} SELECT * FROM trends"))
def yearly_trends(spark, sf_dir):
    return gold.yearly_movie_trends(standin.scope(spark, sf_dir))


@query(using("scope", body=f"""{_YEARLY}
    SELECT * EXCLUDE (prev_year_avg_budget, prev_year_avg_revenue) FROM trends ORDER BY release_year"""))
def yearly_trends_mart(spark, sf_dir):
    trends = gold.yearly_movie_trends(standin.scope(spark, sf_dir), unique_ids=False)
    return gold.for_display(gold.mart_yearly_trends(trends), "release_year", descending=False)


_TIER = """CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} >= 100000000 THEN 'Blockbuster'
    WHEN {0} >= 20000000 THEN 'Mid-Range' WHEN {0} >= 1000000 THEN 'Low-Budget' ELSE 'Micro-Budget' END"""


@query(using("scope", body=f"""
    SELECT movie_id, movie_title, release_year,
           CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue,
           rank() OVER (PARTITION BY release_year ORDER BY revenue DESC NULLS LAST) AS revenue_rank_in_year,
           rank() OVER (PARTITION BY release_year ORDER BY budget DESC NULLS LAST) AS budget_rank_in_year,
           CAST(lag(budget) OVER w AS DOUBLE) AS higher_budget,
           CAST(lead(budget) OVER w AS DOUBLE) AS lower_budget,
           {_TIER.format("budget")} AS budget_tier, {_TIER.format("revenue")} AS revenue_tier
    FROM scope
    WINDOW w AS (PARTITION BY release_year ORDER BY budget DESC NULLS LAST, movie_id)"""))
def order_financials(spark, sf_dir):
    return gold.movie_financials(standin.scope(spark, sf_dir))


@query(using("movies", body=f"""
    SELECT {_TIER.format("budget")} AS budget_tier, {_TIER.format("revenue")} AS revenue_tier,
           count(*) AS movie_count FROM movies GROUP BY 1, 2"""))
def tier_counts(spark, sf_dir):
    tiered = standin.movies(spark, sf_dir).select(
        classify(F.col("budget")).alias("budget_tier"), classify(F.col("revenue")).alias("revenue_tier")
    )
    return tiered.groupBy("budget_tier", "revenue_tier").agg(F.count(F.lit(1)).alias("movie_count"))


@query(using("scope", "genres", "companies", "countries", "languages", body=f"""
    SELECT {_MOVIE},
           (SELECT count(DISTINCT genre) FROM genres g WHERE g.movie_id = m.movie_id) AS genre_count,
           (SELECT count(*) FROM companies c WHERE c.movie_id = m.movie_id) AS company_count,
           (SELECT count(DISTINCT iso_country_code) FROM countries c WHERE c.movie_id = m.movie_id) AS country_count,
           (SELECT count(*) FROM languages l WHERE l.movie_id = m.movie_id) AS language_count
    FROM scope m"""))
def fact_orders(spark, sf_dir):
    return standin.fact(spark, sf_dir)


@query(using("stg_genres", body="SELECT movie_id, genre FROM stg_genres"))
def stg_types(spark, sf_dir):
    return standin.stg_genres(spark, sf_dir)


@query(using("stg_companies", body="SELECT movie_id, company_name FROM stg_companies"))
def stg_suppliers(spark, sf_dir):
    return standin.stg_companies(spark, sf_dir)


_COUNTRY = "iso_country_code, country_name, country_region, country_subregion, is_service_restricted"


@query(using("stg_countries", body=f"SELECT movie_id, {_COUNTRY} FROM stg_countries"))
def stg_nations(spark, sf_dir):
    return standin.stg_countries(spark, sf_dir)


@query(using("stg_languages", body="SELECT movie_id, iso_language_code, language_name FROM stg_languages"))
def stg_flags(spark, sf_dir):
    return standin.stg_languages(spark, sf_dir)


@query(using("scope", "genres", body="""
    SELECT movie_id, genre FROM genres JOIN scope USING (movie_id) GROUP BY movie_id, genre"""))
def bridge_types(spark, sf_dir):
    return gold.bridge(standin.stg_genres(spark, sf_dir))


@query(using("scope", body="""
    SELECT l_orderkey AS movie_id, s_name AS company_name FROM lineitem, supplier
    WHERE s_suppkey = l_suppkey AND EXISTS (SELECT 1 FROM scope WHERE movie_id = l_orderkey)"""))
def bridge_suppliers(spark, sf_dir):
    return gold.bridge(standin.stg_companies(spark, sf_dir))


@query(using("scope", "countries", body=f"""
    SELECT movie_id, {_COUNTRY} FROM countries WHERE movie_id IN (SELECT movie_id FROM scope)"""))
def bridge_nations(spark, sf_dir):
    return gold.bridge(standin.stg_countries(spark, sf_dir))


@query(using("scope", "languages", body="""
    SELECT movie_id, iso_language_code, language_name FROM languages
    WHERE movie_id IN (SELECT movie_id FROM scope)"""))
def bridge_flags(spark, sf_dir):
    return gold.bridge(standin.stg_languages(spark, sf_dir))


def _share(block: str, keys: str) -> str:
    return using(block, body=f"""
        , counted AS (SELECT {keys}, count(DISTINCT movie_id) AS movie_count FROM {block} GROUP BY {keys}),
        total AS (SELECT count(DISTINCT movie_id) AS total_movies FROM {block})
        SELECT {keys}, movie_count, total_movies, {sql_pct("movie_count", "total_movies")} AS pct_of_movies
        FROM counted, total ORDER BY movie_count DESC, {keys}""")


@query(_share("stg_genres", "genre"))
def type_share(spark, sf_dir):
    return gold.for_display(gold.mart_genre_share(standin.stg_genres(spark, sf_dir)), "movie_count", "genre")


@query(_share("stg_languages", "iso_language_code, language_name"))
def flag_share(spark, sf_dir):
    pairs = gold.distinct_in_scope(standin.languages(spark, sf_dir), standin.scope(spark, sf_dir), gold.LANGUAGE)
    mart = gold.mart_language_share(pairs)
    return gold.for_display(mart, "movie_count", *gold.LANGUAGE)


@query(using("stg_countries", body=f"""
    SELECT {_COUNTRY}, count(DISTINCT movie_id) AS movie_count FROM stg_countries
    GROUP BY ALL ORDER BY movie_count DESC, iso_country_code"""))
def nation_summary(spark, sf_dir):
    pairs = gold.distinct_in_scope(standin.countries(spark, sf_dir), standin.scope(spark, sf_dir), gold.COUNTRY)
    mart = gold.mart_country_summary(pairs, unique_pairs=True)
    return gold.for_display(mart, "movie_count", "iso_country_code")


# Orders of the lowest priority have no key.
_GROUP = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END"


def _nullable_group(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))


@query(f"""
    SELECT o_orderkey, {_GROUP} AS priority, CAST(o_totalprice AS DOUBLE) AS price,
           rank() OVER (PARTITION BY {_GROUP} ORDER BY o_totalprice DESC) AS place,
           CAST(lag(o_totalprice) OVER (PARTITION BY {_GROUP} ORDER BY o_totalprice DESC, o_orderkey) AS DOUBLE) AS higher
    FROM orders""")
def ranks_with_null_group(spark, sf_dir):
    return rank_descending(_nullable_group(spark, sf_dir), ["priority"], "o_orderkey", [Ranking("price", "place", "higher")])


@query(f"""
    SELECT {_GROUP} AS priority, round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.5), 6) AS p50,
           round(quantile_cont(CAST(o_totalprice AS DOUBLE), 0.9), 6) AS p90
    FROM orders GROUP BY 1""")
def percentiles_with_null_group(spark, sf_dir):
    found = exact_percentiles(_nullable_group(spark, sf_dir), ["priority"], "price", {"p50": 0.5, "p90": 0.9})
    return found.select("priority", F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"))
