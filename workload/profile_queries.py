"""Profiling and dashboard figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marquee.operators import profile, shares
from marquee.plans import gold, kpi
from workload import standin
from workload.registry import query, sql_pct, table, using


def _rounded(df, decimals=2):
    """Round every floating column, since sums of doubles depend on the order of addition."""
    return df.select(*[
        F.round(c, decimals).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes
    ])


def _union(rows):
    return " UNION ALL ".join(rows)


@query(using("scope", body=_union(
    f"""SELECT '{c}' AS column_name, count({c}) AS filled, count(*) - count({c}) AS nulls,
        {sql_pct(f"count({c})", "count(*)", 1)} AS fill_pct FROM scope"""
    for c in ("movie_id", "release_date", "budget", "revenue")
).replace("SELECT 'movie_id'", ", x AS (SELECT 1) SELECT 'movie_id'", 1)))
def profile_coverage(spark, sf_dir):
    return profile.coverage(standin.scope(spark, sf_dir), ["movie_id", "release_date", "budget", "revenue"])


def _summary(column: str, source: str, value: str, label: str) -> str:
    q = ", ".join(
        f"round(quantile_cont({value}, {f}), 2) AS {n}"
        for n, f in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p99", 0.99))
    )
    mean = f"CAST(sum(CAST({column} AS DECIMAL(22, 4))) AS DOUBLE) / count({column})"
    return f"""SELECT '{label}' AS column_name, count({column}) AS n, round(min({value}), 2) AS min, {q},
        round({mean}, 2) AS mean, round(max({value}), 2) AS max, round(stddev_samp({value}), 2) AS stddev,
        round({mean} / nullif(quantile_cont({value}, 0.5), 0), 2) AS mean_median_ratio {source}"""


def _double(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


@query(using("scope", body=_union(_summary(c, "FROM scope", _double(c), c) for c in ("budget", "revenue"))))
def profile_numeric(spark, sf_dir):
    return _rounded(profile.numeric_summary(standin.scope(spark, sf_dir), ["budget", "revenue"]))


@query(using("scope", body=_union(
    f"""SELECT '{c}' AS column_name, round(CAST(sum({c}) AS DOUBLE) / count({c})
        / quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS skew FROM scope""" for c in ("budget", "revenue"))))
def profile_skew(spark, sf_dir):
    return profile.skew(standin.scope(spark, sf_dir), ["budget", "revenue"])


# Shipped values have no tail; the square of the event value does.
_TAIL = """, tail AS (SELECT event_id, CAST(value * value AS DECIMAL(15, 2)) AS amount FROM events),
    stats AS (SELECT CAST(sum(amount) AS DOUBLE) / count(amount) AS mean,
                     stddev_samp(CAST(amount AS DOUBLE)) AS sd FROM tail)"""


def _tail(spark, sf_dir):
    amount = (F.col("value") * F.col("value")).cast("decimal(15,2)")
    return table(spark, sf_dir, "events").select("event_id", amount.alias("amount"))


@query(f"""WITH{_TAIL[1:]}
    SELECT event_id, CAST(amount AS DOUBLE) AS amount, round((CAST(amount AS DOUBLE) - mean) / sd, 1) AS z_score
    FROM tail, stats WHERE CAST(amount AS DOUBLE) > mean + 3 * sd""")
def profile_outliers(spark, sf_dir):
    return profile.outliers(_tail(spark, sf_dir), "amount")


@query(f"""WITH{_TAIL[1:]}
    SELECT event_id, CAST(amount AS DOUBLE) AS amount FROM tail
    ORDER BY tail.amount DESC, event_id LIMIT 8""")
def profile_top_values(spark, sf_dir):
    return profile.top_n(_tail(spark, sf_dir), 8, "amount", "event_id")


_WINDOWS = {"five": (1996, 2001), "three": (1998, 2001), "early": (1995, 1997), "all": (1990, 2010)}


@query(using("movies", body=f"""
    , windows(name, lo, hi) AS (VALUES {", ".join(f"('{n}', DATE '{a}-01-01', DATE '{b}-01-01')" for n, (a, b) in _WINDOWS.items())})
    SELECT name AS "window", count(*) AS rows_in_window,
           round(CAST(sum(budget) AS DOUBLE) / count(budget) / quantile_cont(CAST(budget AS DOUBLE), 0.5), 2) AS budget_skew,
           round(CAST(sum(revenue) AS DOUBLE) / count(revenue) / quantile_cont(CAST(revenue AS DOUBLE), 0.5), 2) AS revenue_skew
    FROM movies JOIN windows ON release_date >= lo AND release_date < hi GROUP BY name"""))
def profile_windows(spark, sf_dir):
    windows = {name: (dt.date(a, 1, 1), dt.date(b, 1, 1)) for name, (a, b) in _WINDOWS.items()}
    return profile.window_comparison(standin.movies(spark, sf_dir), "release_date", ["budget", "revenue"], windows)


@query(using("stg_countries", body=f"""
    SELECT 'scope' AS denominator, iso_country_code, count(DISTINCT movie_id) AS frequency,
           (SELECT count(*) FROM scope) AS total,
           {sql_pct("count(DISTINCT movie_id)", "(SELECT count(*) FROM scope)", 1)} AS share_pct
    FROM stg_countries GROUP BY iso_country_code
    UNION ALL
    SELECT 'having', iso_country_code, count(DISTINCT movie_id), (SELECT count(DISTINCT movie_id) FROM stg_countries),
           {sql_pct("count(DISTINCT movie_id)", "(SELECT count(DISTINCT movie_id) FROM stg_countries)", 1)}
    FROM stg_countries GROUP BY iso_country_code
    UNION ALL
    SELECT 'rows', iso_country_code, count(*), (SELECT count(*) FROM stg_countries),
           {sql_pct("count(*)", "(SELECT count(*) FROM stg_countries)", 1)}
    FROM stg_countries GROUP BY iso_country_code"""))
def profile_shares(spark, sf_dir):
    countries, scope = standin.countries(spark, sf_dir), standin.scope(spark, sf_dir)
    distinct = gold.distinct_in_scope(countries, scope, ["iso_country_code"])
    pairs = {"scope": distinct, "having": distinct, "rows": standin.stg_countries(spark, sf_dir)}
    parts = [
        shares.shares(df, ["iso_country_code"], "movie_id", d, scope).withColumn("denominator", F.lit(d))
        for d, df in pairs.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(using("stg_companies", body=_summary(
    "values_per_entity", "FROM (SELECT movie_id, count(*) AS values_per_entity FROM stg_companies GROUP BY movie_id)",
    "values_per_entity", "values_per_entity",
).replace("round(min(values_per_entity), 2)", "CAST(min(values_per_entity) AS DOUBLE)")
 .replace("round(max(values_per_entity), 2)", "CAST(max(values_per_entity) AS DOUBLE)")))
def values_per_entity(spark, sf_dir):
    return _rounded(profile.values_per_entity(standin.stg_companies(spark, sf_dir), "movie_id"))


@query(using("genres", body="""
    SELECT movie_id, count(*) AS row_count, count(DISTINCT genre) AS distinct_count FROM genres
    GROUP BY movie_id HAVING count(*) > count(DISTINCT genre)"""))
def duplicate_inflation(spark, sf_dir):
    return profile.duplicate_inflation(standin.genres(spark, sf_dir), "movie_id", "genre")


@query(using("stg_companies", body="""
    , per AS (SELECT movie_id, count(*) AS company_count FROM stg_companies GROUP BY movie_id)
    SELECT movie_id, company_count,
           round(least(CAST(company_count AS DOUBLE), (SELECT quantile_cont(company_count, 0.99) FROM per)), 2) AS capped
    FROM per"""))
def cap_p99(spark, sf_dir):
    per = standin.stg_companies(spark, sf_dir).groupBy("movie_id").agg(F.count(F.lit(1)).alias("company_count"))
    return _rounded(profile.cap_at_percentile(per, "company_count", 0.99, "capped", derived=True))


_COUNTED = ("l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate")


@query(_union(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem" for c in _COUNTED))
def cardinality(spark, sf_dir):
    return profile.cardinality(table(spark, sf_dir, "lineitem"), _COUNTED)


@query(using("scope", body="""
    SELECT count(*) AS periods, CAST(min(n) AS DOUBLE) AS min, CAST(max(n) AS DOUBLE) AS max, round(avg(n), 2) AS mean,
           round(quantile_cont(n, 0.5), 2) AS median, round(avg(n) / quantile_cont(n, 0.5), 2) AS mean_median_ratio
    FROM (SELECT release_year, count(*) AS n FROM scope GROUP BY release_year)"""))
def period_counts(spark, sf_dir):
    return _rounded(profile.period_counts(standin.scope(spark, sf_dir), "release_year"))


@query(using("movies", body=_union(
    f"""SELECT '{c}' AS column_name, count({c}) AS before,
        count(*) FILTER (WHERE {c} IS NULL AND movie_id % 3 = 0) AS added,
        count({c}) + count(*) FILTER (WHERE {c} IS NULL AND movie_id % 3 = 0) AS after,
        {sql_pct(f"count({c})", "count(*)", 1)} AS before_pct,
        {sql_pct(f"(count({c}) + count(*) FILTER (WHERE {c} IS NULL AND movie_id % 3 = 0))", "count(*)", 1)} AS after_pct
        FROM movies""" for c in ("budget", "revenue"))))
def fill_gain(spark, sf_dir):
    before = standin.movies(spark, sf_dir)
    filled = [
        F.coalesce(F.col(c), F.when(F.col("movie_id") % 3 == 0, F.lit(1).cast("decimal(15,2)"))).alias(c)
        for c in ("budget", "revenue")
    ]
    return profile.fill_gain(before, before.select("movie_id", *filled), ["budget", "revenue"])


@query(using("movies", body=f"""
    SELECT count(*) FILTER (WHERE budget IS NOT NULL AND revenue IS NOT NULL) AS cohort, count(*) AS total_rows,
           {sql_pct("count(*) FILTER (WHERE budget IS NOT NULL AND revenue IS NOT NULL)", "count(*)", 1)} AS share_pct
    FROM movies"""))
def both_known(spark, sf_dir):
    return profile.known_cohort(standin.movies(spark, sf_dir), ["budget", "revenue"])


_FILTERED = """, filtered AS (
        SELECT movie_id FROM scope WHERE release_date BETWEEN DATE '1997-03-01' AND DATE '2000-06-30'
        AND movie_id IN (SELECT movie_id FROM stg_countries
                         WHERE country_region IN ('ASIA', 'EUROPE') AND NOT is_service_restricted)
        AND movie_id IN (SELECT movie_id FROM stg_languages WHERE iso_language_code IN ('A', 'R'))
        AND movie_id IN (SELECT movie_id FROM stg_genres WHERE genre IN ('PROMO', 'SMALL', 'LARGE')))"""


def _kpi(filtered: str, language: str) -> str:
    return using("stg_genres", "stg_countries", "stg_languages", body=f"""{filtered},
    spoken AS (SELECT movie_id, max(CASE WHEN iso_language_code = '{language}' THEN 1 ELSE 0 END) AS speaks
               FROM stg_languages WHERE movie_id IN (SELECT movie_id FROM filtered) GROUP BY movie_id),
    typed AS (SELECT * FROM stg_genres WHERE movie_id IN (SELECT movie_id FROM filtered)),
    first_type AS (SELECT genre, count(*) AS n FROM typed GROUP BY genre ORDER BY n DESC, genre LIMIT 1),
    spoken_n AS (SELECT count(*) AS n, CAST(sum(speaks) AS BIGINT) AS k FROM spoken),
    typed_n AS (SELECT count(DISTINCT movie_id) AS m FROM typed)
    SELECT (SELECT count(*) FROM filtered) AS films,
           {sql_pct("k", "spoken_n.n")} AS language_pct, genre AS top_genre,
           {sql_pct("first_type.n", "m")} AS top_genre_pct
    FROM spoken_n, typed_n, first_type""")


@query(_kpi(_FILTERED, "R"))
def kpis_filtered(spark, sf_dir):
    filters = kpi.Filters(
        released_from=dt.date(1997, 3, 1), released_to=dt.date(2000, 6, 30), regions=("ASIA", "EUROPE"),
        restricted=False, languages=("A", "R"), genres=("PROMO", "SMALL", "LARGE"),
    )
    return kpi.kpis(standin.star(spark, sf_dir), filters, "R")


@query(_kpi(", filtered AS (SELECT movie_id FROM scope)", "A"))
def kpis_default(spark, sf_dir):
    return kpi.kpis(standin.star(spark, sf_dir), language="A")


# Target weights per type, from the retail prices of its parts; one type is left out.
@query(using("stg_genres", body=f"""
    , total AS (SELECT count(DISTINCT movie_id) AS t FROM stg_genres),
    catalogue AS (SELECT genre, {sql_pct("count(*)", "any_value(t)")} AS pct FROM stg_genres, total GROUP BY genre),
    priced AS (SELECT p_type, sum(CAST(p_retailprice AS DECIMAL(15, 2))) AS s FROM part GROUP BY p_type),
    weights AS (SELECT p_type AS genre, CAST(round(CAST(s AS DOUBLE) / 1000, 2) AS DOUBLE) AS w FROM priced
                WHERE p_type <> 'PROMO')
    SELECT coalesce(c.genre, w.genre) AS genre, CAST(coalesce(pct, 0) AS DOUBLE) AS catalogue_pct,
           CAST(coalesce(w, 0) AS DOUBLE) AS target_pct,
           round(CAST(coalesce(w, 0) AS DOUBLE) - CAST(coalesce(pct, 0) AS DOUBLE), 2) AS gap_pct
    FROM catalogue c FULL JOIN weights w ON w.genre = c.genre"""))
def share_gap(spark, sf_dir):
    weights = (
        table(spark, sf_dir, "part").where("p_type <> 'PROMO'").groupBy(F.col("p_type").alias("genre"))
        .agg((F.sum(F.col("p_retailprice").cast("decimal(15,2)")) / 1000).alias("weight"))
    )
    mart = gold.mart_genre_share(standin.stg_genres(spark, sf_dir))
    return shares.share_gap(mart, weights, "genre", "pct_of_movies", "weight")
