"""Secrets in documents, told from published examples by who owns their copies.

Tasks find candidates in whole texts: assignments of secrets, access keys, long hex strings, and
other long random-looking strings. Candidate hashes are counted over the whole corpus by distinct
repositories and owners. A value that many owners hold was copied from somewhere (documentation, a
tutorial): an example. A value of few owners looks live. A random-looking string is reported only
when it looks live; the three base kinds are always reported.

Defined cases: a null text is the empty text; a null owner or repository counts as one owner or one
repository; repeated rows give repeated results and do not raise the counts of owners; an empty table
gives an empty result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import Scratch, bounded_side, sliced, whole_text

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")
MIN_VALUE = 6
MIN_ENTROPY = 3.5
#: A value that more distinct owners hold is an example.
MAX_OWNERS = 2
MASK = "[SECRET]"

FOUND = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int8()), ("end", pa.int32()), ("value", pa.string())]))


def _looks_random(value: str) -> bool:
    if not (any(c.isdigit() for c in value) and any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value)):
        return False
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts) >= MIN_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of every candidate by start, then kind; offsets in code points."""
    found = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted(found)
    for m in RANDOM.finditer(text):
        if _looks_random(m[0]) and not any(s < m.end() and m.start() < e for s, _, e, _ in base):
            found.append((m.start(), 3, m.end(), m[0]))
    return sorted(found)


def spans_text(found) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in found)


def _scan(batches):
    for batch in sliced(batches):
        rows = [candidates(t) for t in batch.column("_text").to_pylist()]
        base = [[f for f in r if f[1] < 3] for r in rows]
        counts = [Counter(f[1] for f in r) for r in base]
        sealed = [[(s, k, e, hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()) for s, k, e, v in r] for r in rows]
        out = {name: batch.column(name) for name in batch.schema.names if name != "_text"}
        out |= {f"n_{KINDS[i]}": pa.array([c[i] for c in counts], pa.int64()) for i in range(3)}
        out["base_sha256"] = pa.array([hashlib.sha256(spans_text(r).encode()).hexdigest() for r in base], pa.string())
        out["found"] = pa.array([[dict(zip(("start", "kind", "end", "value"), f)) for f in r] for r in sealed], FOUND)
        yield pa.RecordBatch.from_pydict(out)


def scan(docs: DataFrame, key: dict[str, Column]) -> DataFrame:
    """One row per document: the columns of `key`, counts, the digest of the base spans and `found`,
    its candidates; a value is kept as its hash only."""
    rows = docs.select(*[c.alias(n) for n, c in key.items()], whole_text().alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    return rows.mapInArrow(_scan, (
        f"{kinds}, n_assign long, n_access long, n_hex long, base_sha256 string, "
        "found array<struct<start:int,kind:tinyint,end:int,value:string>>"))


def ownership(found: DataFrame) -> DataFrame:
    """value, owners, repositories, occurrences, live: from rows (value, owner, repository). Copies are
    summed up in the map tasks, so a value that a third of all rows hold shuffles few rows."""
    return (
        found.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
        .groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
        .groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
                              F.sum("n").alias("occurrences"))
        .withColumn("live", F.col("owners") <= MAX_OWNERS)
    )


def _judged(scratch: Scratch, docs: DataFrame, key: dict[str, Column], owner: str, repository: list[str]):
    """The stored scan, and its candidates one per row with what the corpus says about their value."""
    of = F.to_json(F.array(*[F.col(c).cast("string") for c in repository]))
    scanned = scratch.keep(scan(docs, key | {"owner": F.col(owner).cast("string"), "repository": of}), "scan")
    rows = scanned.select(*key, "owner", "repository", F.explode("found").alias("f")).select(
        *key, "owner", "repository", "f.*")
    verdicts = scratch.keep(ownership(rows.select("value", "owner", "repository")), "values")
    return scanned, rows.join(bounded_side(scratch, verdicts, "values"), "value")


def report(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example per document."""
    scratch = Scratch(docs.sparkSession)
    key = {"doc_id": F.col("doc_id"), "_row": F.monotonically_increasing_id()}
    scanned, rows = _judged(scratch, docs, key, owner, list(repository))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind").cast("int") + 1)
    shown = rows.where("kind < 3 or live").select("_row", "live", F.struct(
        "start", "kind", F.concat_ws(":", name, F.col("start"), F.col("end")).alias("s")).alias("span"))
    spans = scratch.keep(shown.groupBy("_row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("span")), lambda x: x["s"]), ",").alias("spans"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example")), "spans")
    return scanned.join(bounded_side(scratch, spans, "spans"), "_row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with these ascending spans replaced; overlapping spans make one mask."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate(spans, start, lambda a, s: F.struct(
        F.when(s["start"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(MASK))).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")))
    return F.concat(cut["out"], F.substring(text, cut["at"] + 1, F.length(text)))


def redact(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """The documents with every live-looking secret masked, n_chars brought up to date."""
    scratch = Scratch(docs.sparkSession)
    key = {"_id": F.to_json(F.struct(F.col("doc_id").alias("i"))), "_text_hash": F.xxhash64("text")}
    _, rows = _judged(scratch, docs, key, owner, list(repository))
    live = scratch.keep(rows.where("live").groupBy(*key).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans")), "live")
    side = bounded_side(scratch, live, "live")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(n) for n, c in key.items()])
    joined = whole.join(side, list(key), "left").withColumn("_new", F.when(
        F.col("_spans").isNotNull(), _masked(F.col("_row.text"), F.col("_spans"))).otherwise(F.col("_row.text")))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_new").alias(name)
        if name == "n_chars":
            return F.length("_new").cast(docs.schema[name].dataType).alias(name)
        return F.col("_row")[name].alias(name)
    return joined.select(*[column(c) for c in docs.columns])
