"""Cleaning functions, dedup, fills, multi-valued texts, enrichment and the clean tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions.collections import coded_pairs, join_texts, literal_codes, prefer_list, split_tokens
from marquee.functions.dates import parse_date
from marquee.functions.numbers import to_key, to_number, zero_to_null
from marquee.functions.text import same_word, trim_unicode
from marquee.operators.dedup import keep_first, removed_by_dedup
from marquee.operators.joins import fill_amounts, fill_texts
from marquee.operators.lookup import flag_members, lookup_columns, lookup_name, merge_names
from marquee.plans import enrichment, silver
from marquee.plans.dimensions import (
    RESTRICTED_COUNTRIES, manual_countries, manual_languages, region_dimension,
)
from workload import rawtext
from workload.registry import query, table

_CENTS = "CAST(o_totalprice AS DECIMAL(15, 2))"


@query(f"""
    SELECT o_orderkey, CAST({_CENTS} AS DOUBLE) AS plain, CAST({_CENTS} AS DOUBLE) AS padded,
           CAST(o_custkey AS DOUBLE) * 1000 AS exponent, CAST(NULL AS DOUBLE) AS suffixed,
           CAST(NULL AS DOUBLE) AS dated, o_orderkey AS whole_key,
           CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS mixed_key
    FROM orders""")
def number_cast(spark, sf_dir):
    cents = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    half = F.when(F.col("o_orderkey") % 2 == 0, ".0").otherwise(".5")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        to_number(cents).alias("plain"),
        to_number(F.concat(F.lit(" \t"), cents, F.lit(" "))).alias("padded"),
        to_number(F.concat(F.col("o_custkey"), F.lit("e3"))).alias("exponent"),
        to_number(F.concat(cents, F.lit("d"))).alias("suffixed"),
        to_number(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dated"),
        to_key(F.concat(F.lit("+"), F.col("o_orderkey"))).alias("whole_key"),
        to_key(F.concat(F.col("o_custkey"), half)).alias("mixed_key"),
    )


@query("""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed,
           CAST(NULL AS VARCHAR) AS short_year, CAST(NULL AS VARCHAR) AS trailing,
           CASE WHEN day(o_orderdate) <= 12
                THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS VARCHAR)
           END AS swapped
    FROM orders""")
def date_multi_format(spark, sf_dir):
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    text = (
        F.when(key % 3 == 0, F.date_format(date, "MM/dd/yyyy"))
        .when(key % 3 == 1, F.date_format(date, "yyyy-M-d"))
        .otherwise(F.date_format(date, "d-M-yyyy"))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        parse_date(text).alias("parsed"),
        parse_date(F.date_format(date, "M/d/yy")).alias("short_year"),
        parse_date(F.concat(text, F.lit("T00:00"))).alias("trailing"),
        parse_date(F.date_format(date, "dd/MM/yyyy")).alias("swapped"),
    )


@query("""
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE WHEN l_tax <> 0 THEN l_tax END AS tax,
           CASE WHEN l_discount <> 0 THEN l_discount END AS discount FROM lineitem""", name="zero_to_null")
def zero_to_null_line(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        zero_to_null(F.col("l_tax")).alias("tax"), zero_to_null(F.col("l_discount")).alias("discount"),
    )


@query("SELECT doc_id, trim(source) AS padded, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5 FROM documents", name="trim_unicode")
def trim_unicode_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        trim_unicode(F.concat(F.lit(" \t "), "source", F.lit(" \r\n\x1f"))).alias("padded"),
        F.md5(trim_unicode(F.concat(F.lit("\n"), "text", F.lit("\u00a0\u3000"))).cast("binary")).alias("text_md5"),
    )


@query("""
    SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations c
    WHERE turn = (SELECT min(turn) FROM conversations d WHERE d.conv_id = c.conv_id)""")
def keep_first_conversation(spark, sf_dir):
    first = keep_first(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])
    return first.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def keep_first_document(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").withColumn("text_md5", F.md5(F.col("text").cast("binary")))
    return keep_first(documents.select("doc_id", "text_md5"), ["text_md5"], ["doc_id"])


@query("""
    SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after,
           count(*) - count(DISTINCT text) AS rows_removed FROM documents""")
def dedup_report(spark, sf_dir):
    return removed_by_dedup(table(spark, sf_dir, "documents"), ["text"])


@query(f"""
    SELECT o_orderkey AS movie_id, o_custkey,
           CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN {_CENTS}
                WHEN o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0 THEN o_orderkey + 500 END AS DOUBLE) AS budget,
           CAST(CASE WHEN o_orderstatus <> 'P' THEN {_CENTS}
                WHEN o_orderkey % 2 = 0 THEN 900 END AS DOUBLE) AS revenue
    FROM orders""")
def left_fill(spark, sf_dir):
    cents = F.col("o_totalprice").cast("decimal(15,2)")
    gaps = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"), "o_custkey",
        F.when(F.col("o_orderpriority") != "5-LOW", cents).alias("budget"),
        F.when(F.col("o_orderstatus") != "P", cents).alias("revenue"),
    )
    return fill_amounts(gaps, rawtext.enriched(spark, sf_dir), "movie_id", ["budget", "revenue"])


@query("""
    SELECT o_orderkey AS movie_id,
           CASE o_orderstatus WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'War, Music' END
                WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'War, Music' END
                ELSE o_orderpriority END AS genres
    FROM orders""")
def text_fallback(spark, sf_dir):
    status = F.col("o_orderstatus")
    texts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("movie_id"),
        F.when(status == "F", F.lit(" \t")).when(status == "O", F.concat(F.lit(" "), "o_orderpriority"))
        .alias("genres"),
    )
    return fill_texts(texts, rawtext.enriched(spark, sf_dir), "movie_id", {"genres": "genres"})


# Only the first row of an order can lack an amount, in a spelling that counts as missing.
@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
    WHERE o_orderstatus = 'P' OR (o_orderpriority = '5-LOW' AND o_orderkey % 4 IN (0, 2))
    UNION SELECT '1997-08-20' FROM orders WHERE o_orderkey % 97 = 0
    UNION
    SELECT CASE l_linenumber WHEN 6 THEN l_orderkey || '' ELSE l_orderkey || '.0' END
    FROM lineitem WHERE l_linenumber IN (6, 7)""")
def candidates(spark, sf_dir):
    return enrichment.candidates(rawtext.movies_main(spark, sf_dir), rawtext.movie_extended(spark, sf_dir))


@query("""
    SELECT p_partkey, CASE WHEN token = 'red' THEN 'crimson' ELSE token END AS token, count(*) AS occurrences
    FROM (SELECT p_partkey, trim(unnest(string_split(p_name || ' ' || p_type, ' '))) AS token FROM part)
    WHERE token <> '' AND lower(token) <> 'economy' GROUP BY ALL""")
def split_explode_names(spark, sf_dir):
    text = F.concat(F.regexp_replace("p_name", " ", " ,, "), F.lit(", "), "p_type", F.lit(","))
    tokens = table(spark, sf_dir, "part").select("p_partkey", F.explode(split_tokens(text)).alias("token"))
    kept = tokens.where(~same_word(F.col("token"), "Economy")).replace({"red": "crimson"}, subset=["token"])
    return kept.groupBy("p_partkey", "token").agg(F.count(F.lit(1)).alias("occurrences"))


@query("""
    SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN r_name ELSE 'fallback' END AS code
    FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
    UNION ALL
    SELECT s_suppkey, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey WHERE s_suppkey % 4 = 0""")
def literal_list_nations(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    suppliers = table(spark, sf_dir, "supplier").join(nations, F.col("n_nationkey") == F.col("s_nationkey"))
    row = F.col("s_suppkey") % 4
    text = (
        F.when(row == 0, F.concat(
            F.lit("[{'iso': '"), "n_name", F.lit("', 'name': \"it's, [ok]\"}, {'name': None, 'iso': \""),
            "r_name", F.lit('"}, ]'),
        ))
        .when(row == 1, F.concat(F.lit("[{'iso': '"), "r_name", F.lit("', 'known': True}]")))
        .when(row == 2, F.concat(F.lit("[{'iso': '"), "n_name", F.lit("'}][]")))
        .otherwise(F.concat(F.lit("{'iso': '"), "n_name", F.lit("'}")))
    )
    chosen = prefer_list(literal_codes(text, "iso"), F.array(F.lit("fallback")))
    return suppliers.select("s_suppkey", F.explode(chosen).alias("code"))


@query("""
    SELECT o_orderkey, o_orderstatus || '|' || o_custkey AS codes FROM orders""", name="coded_pairs")
def pairs_roundtrip(spark, sf_dir):
    pairs = join_texts(F.array(
        F.concat(F.lit(" "), "o_orderstatus", F.lit(":a:b")), F.lit(" :blank"), F.lit("colonless"),
        F.concat(F.col("o_custkey"), F.lit(":")),
    ), "|")
    return table(spark, sf_dir, "orders").select("o_orderkey", join_texts(coded_pairs(pairs), "|").alias("codes"))


# Usable answers: the odd spellings of rows 2 (unparsable), 3 (null genre name) are gone.
_FLAT = """
    SELECT o_orderkey AS movie_id,
           CASE WHEN o_orderkey % 7 IN (0, 5, 6) AND o_orderkey % 5 <> 0
                THEN CAST(trunc(o_totalprice) AS DOUBLE) ELSE 0.0::DOUBLE END AS budget,
           CASE WHEN o_orderkey % 7 IN (0, 5, 6) THEN CAST(o_orderkey % 3 AS DOUBLE) ELSE 0.0::DOUBLE END AS revenue,
           CASE WHEN o_orderkey % 7 IN (0, 5, 6) THEN o_orderpriority || ', ' || o_orderstatus ELSE '' END AS genres,
           CASE WHEN o_orderkey % 7 IN (0, 5, 6) THEN 'FR:France|C' || o_custkey || ':a:b' ELSE '' END
               AS production_countries,
           CASE WHEN o_orderkey % 7 = 4 THEN 'xx:None|fr:' ELSE '' END AS spoken_languages
    FROM orders WHERE o_orderkey % 7 NOT IN (2, 3) AND o_orderkey % 11 <> 0"""


@query(_FLAT)
def payload_flatten(spark, sf_dir):
    return enrichment.flatten_answers(rawtext.payloads(spark, sf_dir))


@query(f"SELECT * FROM ({_FLAT}) WHERE movie_id % 7 <> 1")
def useful_rows(spark, sf_dir):
    return enrichment.flatten_answers(rawtext.payloads(spark, sf_dir)).where(enrichment.is_useful())


_ASKED = """(o_orderstatus = 'P' OR (o_orderpriority = '5-LOW' AND o_orderkey % 4 IN (0, 2))
             OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 6))"""


@query(f"""
    SELECT * FROM ({_FLAT}) WHERE movie_id % 7 <> 1
    AND movie_id IN (SELECT o_orderkey FROM orders WHERE {_ASKED})""")
def enriched_flat(spark, sf_dir):
    asked = enrichment.candidates(rawtext.movies_main(spark, sf_dir), rawtext.movie_extended(spark, sf_dir))
    return enrichment.movies_enriched(rawtext.payloads(spark, sf_dir), asked)


@query(f"""
    WITH asked AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders
        WHERE o_orderstatus = 'P' OR (o_orderpriority = '5-LOW' AND o_orderkey % 4 IN (0, 2))
        UNION SELECT '1997-08-20' FROM orders WHERE o_orderkey % 97 = 0
        UNION SELECT CASE l_linenumber WHEN 6 THEN l_orderkey || '' ELSE l_orderkey || '.0' END
        FROM lineitem WHERE l_linenumber IN (6, 7)),
    kept AS (
        SELECT count(*) AS kept FROM ({_FLAT}) WHERE movie_id % 7 <> 1
        AND movie_id IN (SELECT o_orderkey FROM orders WHERE {_ASKED}))
    SELECT count(*) AS candidates, any_value(kept) AS kept, count(*) - any_value(kept) AS skipped
    FROM asked, kept""")
def enrichment_counts(spark, sf_dir):
    asked = enrichment.candidates(rawtext.movies_main(spark, sf_dir), rawtext.movie_extended(spark, sf_dir))
    return enrichment.enrichment_summary(asked, enrichment.movies_enriched(rawtext.payloads(spark, sf_dir), asked))


@query("""
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def payload_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.from_json("props", "k bigint")["k"].alias("k")
    )


@query(f"""
    SELECT o_orderkey AS movie_id, 'Order#' || o_orderkey AS movie_title,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date,
           CAST(CASE WHEN o_orderpriority <> '5-LOW' THEN {_CENTS}
                WHEN o_orderkey % 2 = 0 AND o_orderkey % 6 <> 0 THEN o_orderkey + 500 END AS DOUBLE) AS budget,
           CAST(CASE WHEN o_orderstatus <> 'P' THEN {_CENTS}
                WHEN o_orderkey % 2 = 0 THEN 900 END AS DOUBLE) AS revenue
    FROM orders""")
def silver_orders(spark, sf_dir):
    return silver.movies(rawtext.movies_main(spark, sf_dir), silver.unique_enriched(rawtext.enriched(spark, sf_dir)))


def _attached(spark, sf_dir):
    return silver.attach_enrichment(rawtext.movie_extended(spark, sf_dir), rawtext.enriched(spark, sf_dir))


@query("""
    SELECT l_orderkey AS movie_id, unnest([p_type, p_brand, p_type]) AS genre
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber < 6
    UNION ALL
    SELECT l_orderkey, unnest(['War', 'Music']) FROM lineitem WHERE l_linenumber >= 6 AND l_orderkey % 2 = 0""")
def silver_types(spark, sf_dir):
    return silver.movie_genres(_attached(spark, sf_dir))


@query("""
    SELECT l_orderkey AS movie_id, unnest([s_name, 'Columbia Pictures Corporation']) AS company_name
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber <> 7""")
def silver_suppliers(spark, sf_dir):
    return silver.production_companies(_attached(spark, sf_dir))


_PLACES = """places(nationkey, code, region, subregion, restricted) AS (VALUES
    (0, 'US', 'NA', 'United States', false), (1, 'CA', 'NA', 'Canada', false), (2, 'BM', 'NA', 'Canada', false),
    (3, 'BR', 'LATAM', 'Brazil', false), (4, 'AR', 'LATAM', 'Hispanic LATAM', false),
    (5, 'CU', 'LATAM', 'Hispanic LATAM', true), (6, 'GB', 'EMEA', 'Western Europe', false),
    (7, 'FR', 'EMEA', 'Western Europe', false), (8, 'DE', 'EMEA', 'DACH', false), (9, 'XG', 'EMEA', 'DACH', false),
    (10, 'SE', 'EMEA', 'Nordics', false), (11, 'SU', 'EMEA', 'CEE', false), (12, 'RU', 'EMEA', 'CEE', true),
    (13, 'SY', 'EMEA', 'MENA', true), (14, 'IR', 'EMEA', 'MENA', true),
    (15, 'ZA', 'EMEA', 'Sub-Saharan Africa', false), (16, 'NA', 'EMEA', 'Sub-Saharan Africa', false),
    (17, 'AQ', 'EMEA', 'Sub-Saharan Africa', true), (18, 'IN', 'APAC', 'South Asia', false),
    (19, 'JP', 'APAC', 'North Asia', false), (20, 'KP', 'APAC', 'North Asia', true),
    (21, 'ID', 'APAC', 'SEA', false), (22, 'AU', 'APAC', 'ANZ', false), (23, 'KZ', 'APAC', 'Central Asia', false),
    (24, 'ZZ', NULL, NULL, false))"""
_NAMED = """CASE code WHEN 'SU' THEN 'Soviet Union' WHEN 'XG' THEN 'East Germany' WHEN 'ZZ' THEN 'ZZ'
            ELSE n_name END"""


@query(f"""
    WITH {_PLACES}, codes AS (
        SELECT l_orderkey AS movie_id, s_nationkey AS nationkey FROM lineitem
        JOIN supplier ON s_suppkey = l_suppkey WHERE l_linenumber < 4
        UNION ALL SELECT l_orderkey, 0 FROM lineitem WHERE l_linenumber < 4
        UNION ALL SELECT l_orderkey, unnest([6, 7]) FROM lineitem
        WHERE l_linenumber IN (4, 6, 7) AND l_orderkey % 2 = 0)
    SELECT movie_id, code AS iso_country_code, {_NAMED} AS country_name, region AS country_region,
           subregion AS country_subregion, restricted AS is_service_restricted
    FROM codes JOIN places USING (nationkey) JOIN nation ON n_nationkey = nationkey""")
def silver_nations(spark, sf_dir):
    names = merge_names(
        rawtext.country_names(spark, sf_dir), manual_countries(spark), "iso_country_code", "country_name"
    )
    return silver.producing_countries(_attached(spark, sf_dir), names, region_dimension(spark))


@query("""
    SELECT l_orderkey AS movie_id,
           CASE l_returnflag WHEN 'A' THEN 'en' WHEN 'R' THEN 'cn' ELSE 'qq' END AS iso_language_code,
           CASE l_returnflag WHEN 'A' THEN 'English' WHEN 'R' THEN 'Cantonese' ELSE 'qq' END AS language_name
    FROM lineitem WHERE l_linenumber < 4
    UNION ALL
    SELECT l_orderkey, unnest(['fr', 'xx']), unnest(['French', 'No Language']) FROM lineitem
    WHERE l_linenumber IN (4, 6, 7) AND l_orderkey % 2 = 0""")
def silver_flags(spark, sf_dir):
    names = merge_names(
        rawtext.language_names(spark, sf_dir), manual_languages(spark), "iso_language_code", "language_name"
    )
    return silver.spoken_languages(_attached(spark, sf_dir), names)


def _supplier_codes(spark, sf_dir):
    code = F.get(F.array(*[F.lit(c) for c in rawtext.NATION_CODES]), F.col("s_nationkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", code.alias("iso_country_code"))


@query(f"""
    WITH {_PLACES} SELECT s_suppkey, code AS iso_country_code, {_NAMED} AS country_name
    FROM supplier JOIN places ON nationkey = s_nationkey JOIN nation ON n_nationkey = s_nationkey""")
def dim_lookup_fallback(spark, sf_dir):
    names = merge_names(
        rawtext.country_names(spark, sf_dir), manual_countries(spark), "iso_country_code", "country_name"
    )
    return lookup_name(_supplier_codes(spark, sf_dir), names, "iso_country_code", "country_name")


@query(f"""
    WITH {_PLACES} SELECT s_suppkey, code AS iso_country_code, region AS country_region,
    subregion AS country_subregion FROM supplier JOIN places ON nationkey = s_nationkey""")
def region_lookup(spark, sf_dir):
    return lookup_columns(_supplier_codes(spark, sf_dir), region_dimension(spark), "iso_country_code")


@query(f"""
    WITH {_PLACES} SELECT s_suppkey, code AS iso_country_code, restricted AS is_service_restricted
    FROM supplier JOIN places ON nationkey = s_nationkey""")
def restricted_flag(spark, sf_dir):
    return flag_members(
        _supplier_codes(spark, sf_dir), "iso_country_code", RESTRICTED_COUNTRIES, "is_service_restricted"
    )
