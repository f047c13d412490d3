"""The given tables rendered as the messy raw texts that the cleaner is made for.

An order becomes a row of the main file, and some orders become two or three; a line becomes a
row of the extended file. Every row is rendered from itself alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.contracts import SOURCE_ORDER
from workload.registry import table

# Country and language codes that stand for the nations and return flags.
NATION_CODES = (
    "US", "CA", "BM", "BR", "AR", "CU", "GB", "FR", "DE", "XG", "SE", "SU", "RU", "SY", "IR",
    "ZA", "NA", "AQ", "IN", "JP", "KP", "ID", "AU", "KZ", "ZZ",
)
FLAG_CODES = {"A": "en", "R": "cn", "N": "qq"}


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _position(row: Column) -> list[Column]:
    return [
        F.lit("orders").alias(SOURCE_ORDER[0]),
        F.lit(0).cast("bigint").alias(SOURCE_ORDER[1]),
        row.alias(SOURCE_ORDER[2]),
    ]


def movies_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three date layouts, padded titles, unknown amounts in several spellings; orders divisible
    by 5 come again later with other values, those divisible by 97 with a key that is a date."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    unknown = _pick(key % 4, ("0", "0.0", "", "abc"))
    first = orders.select(
        key.cast("string").alias("id"),
        F.concat(F.lit("\t Order#"), key, F.lit("  ")).alias("title"),
        F.when(key % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .when(key % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "d-M-yyyy")).alias("release_date"),
        F.coalesce(known, unknown).alias("budget"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(15,2)")))
        .alias("revenue"),
        *_position(key * 3),
    )
    later = orders.where(key % 5 == 0).select(
        F.concat(key, F.lit(".0")).alias("id"), F.lit("later copy").alias("title"),
        F.lit("1999-01-05").alias("release_date"), F.lit("1").alias("budget"), F.lit("1").alias("revenue"),
        *_position(key * 3 + 1),
    )
    odd = orders.where(key % 97 == 0).select(
        F.lit("1997-08-20").alias("id"), F.lit("shifted").alias("title"), F.lit("1").alias("release_date"),
        F.lit(None).cast("string").alias("budget"), F.lit(None).cast("string").alias("revenue"),
        *_position(key * 3 + 2),
    )
    return first.unionByName(later).unionByName(odd)


def movie_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line: comma lists and list-of-mapping texts. Line numbers 4 to 7 are the odd ones:
    malformed, blank code, missing, and empty lists."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    )
    key, number = F.col("l_orderkey").cast("string"), F.col("l_linenumber")
    nation = _pick(F.col("s_nationkey"), NATION_CODES)
    flag = F.col("l_returnflag")
    language = F.when(flag == "A", FLAG_CODES["A"]).when(flag == "R", FLAG_CODES["R"]).otherwise(FLAG_CODES["N"])
    missing = F.lit(None).cast("string")

    def listed(entry: Column, blank: str, cut: str) -> Column:
        return (
            F.when(number == 7, F.lit("[]")).when(number == 6, missing)
            .when(number == 5, F.lit(blank)).when(number == 4, F.lit(cut)).otherwise(entry)
        )

    return lines.select(
        F.when(number % 3 == 0, key).when(number % 3 == 1, F.concat(key, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), key, F.lit(" "))).alias("id"),
        F.when(number == 7, F.lit("  ")).when(number == 6, missing)
        .otherwise(F.concat("p_type", F.lit(", "), "p_brand", F.lit(",, "), "p_type", F.lit(" "))).alias("genres"),
        F.when(number == 7, missing).otherwise(F.concat(
            "s_name", F.lit(", The ,THE, "),
            F.when(F.col("s_suppkey") % 10 == 0, F.lit("Columbia Pictures"))
            .otherwise(F.lit("Columbia Pictures Corporation")),
        )).alias("production_companies"),
        listed(
            F.concat(
                F.lit("[{'iso_3166_1': '"), nation,
                F.lit("', 'name': \"Cote D'Ivoire\"}, {'iso_3166_1': ' US', 'name': None}]"),
            ),
            "[{'iso_3166_1': ' ', 'name': 'x'}]", "[{'iso_3166_1': 'XX'",
        ).alias("production_countries"),
        listed(
            F.concat(F.lit("[{'iso_639_1': '"), language, F.lit("', 'name': 'It\\'s'},]")),
            "[{'iso_639_1': '', 'name': 'x'}]", "[{'iso_639_1': 'en'}] junk",
        ).alias("spoken_languages"),
        F.col("l_orderkey").alias("_order"),
        number.alias("_line"),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup answers for the even orders, unique by order; every third of them without a budget."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").where(key % 2 == 0).select(
        key.alias("movie_id"),
        F.when(key % 6 == 0, 0).otherwise(key + 500).cast("decimal(15,2)").alias("budget"),
        F.lit(900).cast("decimal(15,2)").alias("revenue"),
        F.lit("War, Music").alias("genres"),
        F.lit("FR:France|:x|DE|GB:a:b").alias("production_countries"),
        F.lit("fr:French|xx:None").alias("spoken_languages"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON answer per order, in the spellings a metadata service uses; some are unusable."""
    key = F.col("o_orderkey")
    entry = "struct<iso_3166_1:string,name:string>"
    full = F.to_json(
        F.struct(
            F.when(key % 5 != 0, F.col("o_totalprice").cast("bigint")).alias("budget"),
            (key % 3).alias("revenue"),
            F.array(
                F.struct(F.col("o_orderpriority").alias("name")), F.struct(F.col("o_orderstatus").alias("name"))
            ).alias("genres"),
            F.array(
                F.struct(F.lit("FR").alias("iso_3166_1"), F.lit("France").alias("name")),
                F.struct(F.lit("").alias("iso_3166_1"), F.lit("Nowhere").alias("name")),
                F.struct(F.concat(F.lit("C"), F.col("o_custkey")).alias("iso_3166_1"), F.lit("a:b").alias("name")),
            ).cast(f"array<{entry}>").alias("production_countries"),
        )
    )
    return table(spark, sf_dir, "orders").select(
        F.when(key % 11 == 0, F.concat(key, F.lit(".0"))).otherwise(key.cast("string")).alias("id"),
        F.when(key % 7 == 1, F.lit("{}"))
        .when(key % 7 == 2, F.lit("not json"))
        .when(key % 7 == 3, F.lit('{"budget": 5, "genres": [{"id": 1, "name": null}]}'))
        .when(key % 7 == 4, F.lit(
            '{"budget": null, "spoken_languages": [{"iso_639_1": "xx", "name": null}, {"iso_639_1": "fr"}, {"name": "q"}]}'
        ))
        .otherwise(full).alias("payload"),
    )


def country_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard names: the nations under their codes, without the codes that need the manual list."""
    code = _pick(F.col("n_nationkey"), NATION_CODES)
    return table(spark, sf_dir, "nation").select(
        code.alias("iso_country_code"), F.col("n_name").alias("country_name")
    ).where(~F.col("iso_country_code").isin("SU", "XG", "ZZ"))


def language_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard names of the languages of the documents."""
    code = F.col("lang")
    name = F.when(code == "en", "English").when(code == "fr", "French").otherwise(F.concat(F.lit("Language "), code))
    return table(spark, sf_dir, "documents").select(code.alias("iso_language_code"), name.alias("language_name")).distinct()
