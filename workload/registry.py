from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The stand-in scope drops the first and the last, partial, year of the orders.
START, END = dt.date(1996, 1, 1), dt.date(2001, 1, 1)


def plain(df: DataFrame) -> DataFrame:
    """Column types that both engines print alike: bigint, double, string, boolean."""
    def simple(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column
    return df.select(*[simple(f) for f in df.schema.fields])


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, under its function's name if no other is given, with the SQL that gives
    the same rows."""
    def register(build: Query) -> Query:
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: plain(build(spark, sf_dir))
        ORACLES[key] = sql
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Building blocks of the oracle SQL, written against the given tables.
CTES = {
    "movies": """
        SELECT o_orderkey AS movie_id, 'Order#' || o_orderkey AS movie_title,
               CAST(o_orderdate AS DATE) AS release_date,
               CASE WHEN o_orderpriority <> '5-LOW'
                    THEN CAST(floor(o_totalprice / 1000) * 400000 AS DECIMAL(15, 2)) END AS budget,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN CAST(CAST(o_totalprice AS DECIMAL(15, 2)) * 400 AS DECIMAL(15, 2)) END AS revenue
        FROM orders""",
    "scope": """
        SELECT *, CAST(year(release_date) AS BIGINT) AS release_year FROM movies
        WHERE year(release_date) BETWEEN 1996 AND 2000""",
    "genres": "SELECT l_orderkey AS movie_id, p_type AS genre FROM lineitem JOIN part ON p_partkey = l_partkey",
    "companies": """
        SELECT l_orderkey AS movie_id, s_name AS company_name
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "countries": """
        SELECT l_orderkey AS movie_id, 'N' || n_nationkey AS iso_country_code, n_name AS country_name,
               CASE WHEN n_nationkey <> 24 THEN r_name END AS country_region,
               CASE WHEN n_nationkey <> 24 THEN r_name || '/' || (n_nationkey % 2) END AS country_subregion,
               n_nationkey IN (3, 7, 24) AS is_service_restricted
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "languages": """
        SELECT l_orderkey AS movie_id, l_returnflag AS iso_language_code,
               CASE l_returnflag WHEN 'A' THEN 'Alpha' WHEN 'N' THEN 'November' ELSE 'Romeo' END AS language_name
        FROM lineitem""",
    "stg_genres": "SELECT DISTINCT movie_id, genre FROM genres WHERE movie_id IN (SELECT movie_id FROM scope)",
    "stg_companies": "SELECT companies.* FROM companies JOIN scope USING (movie_id)",
    "stg_countries": "SELECT countries.* FROM countries JOIN scope USING (movie_id)",
    "stg_languages": "SELECT languages.* FROM languages JOIN scope USING (movie_id)",
}
# The blocks above in the order in which they depend on each other.
_ORDER = list(CTES)


def using(*names: str, body: str) -> str:
    """Prefix a query with the named blocks and whatever those need."""
    needs = {"scope": {"movies"}, **{f"stg_{a}": {a, "scope", "movies"} for a in ("genres", "companies", "countries", "languages")}}
    wanted = set(names)
    for name in names:
        wanted |= needs.get(name, set())
    blocks = ", ".join(f"{name} AS ({CTES[name]})" for name in _ORDER if name in wanted)
    return f"WITH {blocks} {body}"


# Exact rounded percentage in integers, half away from zero.
def sql_pct(part: str, total: str, decimals: int = 2) -> str:
    scale = 10 ** decimals
    return (
        f"CASE WHEN ({total}) <> 0 THEN sign({part}) * "
        f"((abs({part}) * {200 * scale} + ({total})) // (2 * ({total}))) / {scale}.0 END"
    )
