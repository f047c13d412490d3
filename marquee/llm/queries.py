"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, chat_format, decontaminate, divergence, fixity, html_text, near_dup, ordinal, pii, prefix_trie, quality_rules, repeats, secret_scan
from marquee.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.assess(table(spark, sf_dir, "documents"), extra=("doc_id",)).drop("cleaned")


_SPACE = r"[ \x09-\x0D]+"


def _sql_count(text: str, pattern: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"


_SENTENCE_END = quality_rules.END_OF_SENTENCE.replace("'", "''")
_LINE_FAILS = f"""
    {_sql_count("line", quality_rules.SYMBOLS)} * 10 > length(line)
    OR ({_sql_count("line", "!")} * 20 > length(line) AND length(line) >= 40)
    OR ({_sql_count("line", quality_rules.SEPARATORS)} >= 3
        AND {_sql_count("line", quality_rules.SEPARATORS)} * 4 >= len(regexp_split_to_array(line, '{_SPACE}')))
    OR (length(line) <= {quality_rules.BOILERPLATE_CHARS} AND regexp_matches(line, '{quality_rules.BOILERPLATE}'))
    OR (len(regexp_split_to_array(line, '{_SPACE}')) <= {quality_rules.FRAGMENT_WORDS} AND NOT regexp_matches(line, '{_SENTENCE_END}'))
"""
ORACLES["op8_quality_rules"] = f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS w FROM documents),
    x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    g AS (
        SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram
        FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    again AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram IS NOT NULL)
        WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
    l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
    lines AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS dup, sum(length(line)) AS chars,
               sum(CASE WHEN {_LINE_FAILS} THEN length(line) ELSE 0 END) AS lost
        FROM l WHERE regexp_matches(line, '[^ \\x09-\\x0D]') GROUP BY doc_id),
    r AS (
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST({_sql_count("t", quality_rules.SYMBOLS)} AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars, coalesce(chars, 0) AS chars
        FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_chars,
           n_words < {quality_rules.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality_rules.MAX_REPEAT_PERCENT} AS base_failed,
           NOT (n_words < {quality_rules.MIN_WORDS} OR n_repeat_words * 100 > n_words * {quality_rules.MAX_REPEAT_PERCENT})
               AND lost_chars * 100 <= chars * {quality_rules.MAX_LOST_PERCENT} AS kept
    FROM r
"""


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"], with_ids=False)


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages")).drop("path")


@query
def op5_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents")).drop("runs")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op3_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.pages_audit(table(spark, sf_dir, "pages"))


ORACLES["op3_fixity"] = """
    WITH r AS (
        SELECT page_id, length('WARC/1.1__WARC-Type: resource__WARC-Target-URI: ') + strlen(coalesce(url, ''))
               + length('__Content-Type: text/html__Content-Length: ') + length(CAST(strlen(coalesce(html, '')) AS VARCHAR))
               + 4 + strlen(coalesce(html, '')) + 4 AS length
        FROM pages),
    o AS (
        SELECT page_id, CAST(length AS BIGINT) AS length,
               CAST(sum(length) OVER (ORDER BY page_id ROWS UNBOUNDED PRECEDING) - length AS BIGINT) AS "offset"
        FROM r)
    SELECT page_id, "offset", length, CASE WHEN page_id % 499 = 7 THEN 'missing' ELSE 'changed' END AS fault
    FROM o WHERE page_id % 97 = 13 OR page_id % 311 = 5 OR page_id % 499 = 7
"""


@query
def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op11_source_divergence"] = f"""
    WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
        FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    one AS (SELECT lang, source, unnest(list_distinct(w)) AS term FROM d),
    k AS (SELECT lang, term FROM one GROUP BY 1, 2 HAVING count(*) >= {divergence.MIN_DOCUMENTS}),
    c AS (
        SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN k USING (lang, term)
        GROUP BY 1, 2, 3),
    v AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM g) g LEFT JOIN k USING (lang) GROUP BY 1),
    t AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
    p AS (
        SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n,
               CAST(1 + {divergence.SCALE}::HUGEINT * (coalesce(n, 0) + 1) // (total + v) AS BIGINT) AS p
        FROM t JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    l AS (
        SELECT lang, term, CAST(1 + {divergence.SCALE}::HUGEINT * (n + 1) // (total + v) AS BIGINT) AS q
        FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY 1, 2)
        JOIN (SELECT lang, sum(total) AS total FROM t GROUP BY 1) USING (lang) JOIN v USING (lang)),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    every AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM every)
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}
"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


# The CRC-32 of the decimal id, bit by bit; a prefix of turns is named by a digest of its turns.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                 lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))"""
ORACLES["op12_prefix_trie"] = f"""
    WITH t AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
               sha256(coalesce(role, '') || chr(10) || length(coalesce(role, '')) || chr(10) || coalesce(text, '')) AS id,
               len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) AS words
        FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (
        SELECT c.conv_id, place, id, words FROM c JOIN t ON t.conv_id = c.base AND place <= h
        UNION ALL SELECT conv_id, least(h, n) + place - h, id, words
        FROM t JOIN c USING (conv_id) JOIN (
            SELECT c.conv_id, count(t.conv_id) AS n FROM c LEFT JOIN t ON t.conv_id = c.base AND place <= h GROUP BY 1) USING (conv_id)
        WHERE place > h),
    paths AS (
        SELECT conv_id, place AS depth, words, sha256(string_agg(id, ',') OVER (PARTITION BY conv_id ORDER BY place)) AS key FROM r
        UNION ALL SELECT conv_id, 0, 0, '' FROM c),
    lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY 1),
    n AS (
        SELECT key, depth, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs
        FROM paths GROUP BY 1, 2),
    ends AS (
        SELECT key, depth, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
        FROM paths JOIN lengths USING (conv_id, depth) GROUP BY 1, 2),
    up AS (
        SELECT n.key, n.depth, p.key AS parent FROM n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
    kids AS (SELECT parent AS key, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY 1),
    below AS (
        SELECT p.key, p.depth, sum(CASE WHEN k.key IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
        FROM n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.key = n.key GROUP BY 1, 2)
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
           CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
    FROM n JOIN up USING (key, depth) LEFT JOIN n a ON a.key = up.parent LEFT JOIN kids ON kids.key = n.key
    JOIN below ON below.key = n.key LEFT JOIN ends ON ends.key = n.key
"""


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.round_trip(table(spark, sf_dir, "conversations"))


def _sql_escaped(text: str) -> str:
    return f"regexp_replace({text}, '{chat_format.GUARDED}', '\\1\\2\\\\\\3', 'g')"


_MARKS = sum(map(len, (chat_format.START, chat_format.SEP, chat_format.END)))
ORACLES["op13_chat_format"] = f"""
    WITH r AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{chat_format.PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{chat_format.PROBE}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, encode(role), encode(text))) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, encode(role), encode(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {_MARKS}) AS BIGINT) AS formatted_chars
    FROM r GROUP BY conv_id
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The stages stand at the top of the repository and use this subpackage.
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
