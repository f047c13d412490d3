"""The given tables in the roles of the catalogue: an order is a movie, its lines carry the
attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.plans import gold
from workload.registry import END, START, table


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"),
        F.concat(F.lit("Order#"), "o_orderkey").alias("movie_title"),
        F.col("o_orderdate").cast("date").alias("release_date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(price / 1000) * 400_000)
        .cast("decimal(15,2)").alias("budget"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", price.cast("decimal(15,2)") * 400)
        .cast("decimal(15,2)").alias("revenue"),
    )


def scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_movies(movies(spark, sf_dir), START, END)


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")
    )
    return lines.select(F.col("l_orderkey").alias("movie_id"), F.col("p_type").alias("genre"))


def _supplied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supplied(spark, sf_dir).select(
        F.col("l_orderkey").alias("movie_id"), F.col("s_name").alias("company_name")
    )


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country dimension, one row per nation; one nation has no region."""
    region = F.when(F.col("n_nationkey") != 24, F.col("r_name"))
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")
    ).select(
        "n_nationkey",
        F.concat(F.lit("N"), "n_nationkey").alias("iso_country_code"),
        F.col("n_name").alias("country_name"),
        region.alias("country_region"),
        F.concat(region, F.lit("/"), F.col("n_nationkey") % 2).alias("country_subregion"),
        F.col("n_nationkey").isin(3, 7, 24).alias("is_service_restricted"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplied = _supplied(spark, sf_dir).select("l_orderkey", "s_nationkey")
    dimension = nations(spark, sf_dir)
    return supplied.join(dimension, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("l_orderkey").alias("movie_id"), *gold.COUNTRY
    )


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.col("l_returnflag")
    name = F.when(code == "A", "Alpha").when(code == "N", "November").otherwise("Romeo")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("movie_id"),
        code.alias("iso_language_code"),
        name.alias("language_name"),
    )


def stg_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_movie_genres(genres(spark, sf_dir), scope(spark, sf_dir))


def stg_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_movie_companies(companies(spark, sf_dir), scope(spark, sf_dir))


def stg_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_movie_countries(countries(spark, sf_dir), scope(spark, sf_dir))


def stg_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.stg_movie_languages(languages(spark, sf_dir), scope(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_movies(
        scope(spark, sf_dir), genres(spark, sf_dir), companies(spark, sf_dir),
        countries(spark, sf_dir), languages(spark, sf_dir),
    )


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables that the dashboard figures read."""
    return {
        "fact_movies": scope(spark, sf_dir),
        "bridge_movie_genres": stg_genres(spark, sf_dir),
        "bridge_movie_companies": stg_companies(spark, sf_dir),
        "bridge_movie_countries": stg_countries(spark, sf_dir),
        "bridge_movie_languages": stg_languages(spark, sf_dir),
    }
