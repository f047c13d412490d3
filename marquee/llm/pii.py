"""Personal data, and the terms that give it away, in DataFrame functions only.

Base patterns find e-mail and network addresses, card and phone numbers. Each distinct value is a
protected entity. What stands in a document with an entity may identify it as well: for all terms of
these documents, co-occurrence over the whole corpus tells how much of the entity's information
I(e) = -log2 p(e) a reader of the term gains, PMI(t, e) = log2 p(t, e) / (p(t) p(e)). The share
PMI / I is the disclosure, 1 for a term that occurs with this entity alone. Terms above the upper
threshold are removed, those above the lower one generalised, wherever they stand in any document: a
reader of the term alone learns the entity. All frequencies are numbers of distinct texts, of all
texts, so copies of one text are one piece of evidence however many there are. As a term stands
with an entity at most as often as the entity occurs, terms that are too frequent to disclose any are
left out before terms and entities are paired; this changes no result.

Defined cases: a null text is empty; a term needs to stand with its entity in MIN_DOCUMENTS distinct
texts, as fewer may be coincidence, so an entity of fewer texts gives no evidence and only its own
matches are spans; terms inside base matches are none; repeated rows and copies give repeated results;
an empty table gives an empty result. Other columns, also ones named like a result, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import Scratch, bounded_side, whole_text

# A match begins where the one before ended, or where no run of its own characters is cut in two. This
# finds the same leftmost matches as the plain patterns, without trying every place of a long run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A text without this has no match.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9][0-9 -]{14}", "phone": r"\+[0-9]"}
KINDS = (*PATTERNS, "removed", "general")
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
TERM = r"\p{L}{3,}"
#: In texts whose matches were replaced by their first and last characters around a mark: a term that no
#: match touches.
MARK = "\x01"
FREE_TERM = rf"(?<![\p{{L}}{MARK}])\p{{L}}{{3,}}+(?!{MARK})"
#: So many distinct texts must hold an entity and a term before the term can disclose it.
MIN_DOCUMENTS = 3
REMOVE, GENERALISE = 0.9, 0.75

PLACES = "array<struct<kind:int,start:int,end:int>>"
SPANS = "array<struct<start:int,end:int,value:string>>"


def _places(matches: str, gaps: str) -> Column:
    """Offsets of matches from the pieces between them."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.array().cast(SPANS).alias("out"))

    def add(a, m):
        begin = a["at"] + F.length(F.get(gaps, a["k"]))
        end = begin + F.length(m)
        span = F.struct(begin.alias("start"), end.alias("end"), m.alias("value"))
        return F.struct(end.alias("at"), (a["k"] + 1).alias("k"), F.concat(a["out"], F.array(span)).alias("out"))
    return F.aggregate(matches, start, add, lambda a: a["out"])


def _kind_places(matches: str, gaps: str, kinds: str) -> Column:
    """(kind, start, end) of the matches that have a kind."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.array().cast(PLACES).alias("out"))

    def add(a, m):
        begin = a["at"] + F.length(F.get(gaps, a["k"]))
        end = begin + F.length(m)
        kind = F.get(kinds, a["k"])
        place = F.struct(kind.alias("kind"), begin.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), (a["k"] + 1).alias("k"), F.when(
            kind.isNotNull(), F.concat(a["out"], F.array(place))).otherwise(a["out"]).alias("out"))
    return F.aggregate(matches, start, add, lambda a: a["out"])


def _lowered(matches: str | Column) -> Column:
    return F.transform(matches, lambda t: F.xxhash64(F.lower(t)))


def _hashes(text: Column, pattern: str) -> Column:
    """A hash for each term of a text."""
    return _lowered(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _marked(text: Column, spans: Column) -> Column:
    """The text with each span cut down to its first and last character around a mark."""
    text = F.translate(text, MARK, " ")

    def one(at):
        return F.substring(text, at, F.lit(1))

    def add(a, s):
        before = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(
            F.when(s["end"] <= a["at"], a["out"]).otherwise(F.concat(a["out"], before, one(s["start"] + 1), F.lit(MARK), one(s["end"]))).alias("out"),
            F.greatest(a["at"], s["end"]).alias("at"))
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), add, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _plain(kind: str, value: Column) -> Column:
    """One form for all ways to write a value."""
    return F.lower(value) if kind == "email" else value if kind == "ip" else _digits(value)


def _holds(kind: str):
    return lambda span: _valid(kind, span["value"])


def _is(kind: int):
    return lambda span: span["kind"] == kind


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), _luhn(digits))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """The rows with one array of spans (start, end, value) per kind, named as the kinds."""
    rows = docs.withColumns({f"_m_{k}": F.when(F.col(text).rlike(NEEDS[k]), F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(
        F.array().cast("array<string>")) for k, p in PATTERNS.items()})
    rows = rows.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)) for k, p in PATTERNS.items()})
    rows = rows.withColumns({f"_p_{k}": _places(f"_m_{k}", f"_g_{k}") for k in PATTERNS})
    return rows.withColumns({k: F.filter(f"_p_{k}", _holds(k)) for k in PATTERNS}).drop(
        *[f"_{x}_{k}" for x in "mgp" for k in PATTERNS])


def _joined(spans: Column) -> Column:
    """kind:start:end of an array of (kind number, start, end), comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _key() -> dict[str, Column]:
    """What names a text: equal texts are one."""
    return {"_hash": F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))}


class _Search:
    def __init__(self, docs: DataFrame):
        self.scratch = Scratch(docs.sparkSession)
        self.rows = docs.select("doc_id", *[c.alias(n) for n, c in _key().items()], whole_text().alias("_text"))
        found = base_spans(self.rows, "_text")

        def entity(kind: str, number: int):
            return lambda s: F.struct(F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                      F.xxhash64(F.lit(kind), _plain(kind, s["value"])).alias("entity"))
        spans = F.concat(*[F.transform(k, entity(k, i)) for i, k in enumerate(PATTERNS)])
        found = found.select("doc_id", *_key(), "_text", spans.alias("base")).withColumn(
            "_free", F.when(F.size("base") > 0, _marked(F.col("_text"), F.col("base"))))
        self.base = self.scratch.keep(found.select(
            "doc_id", "_hash", "base", F.array_distinct(_hashes(F.col("_free"), FREE_TERM)).alias("free")), "base")

    def count_documents(self) -> None:
        """The number of distinct texts, and the copies of repeated ones."""
        self.copies = self.scratch.keep(self.base.groupBy("_hash").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
        self.repeated = self.copies.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
        self.total = self.base.count() - self.repeated

    def counted_terms(self) -> DataFrame:
        """term, n_term: the number of distinct texts of each term."""
        rows = self.rows.withColumn("weight", F.lit(1))
        if self.repeated:
            # A hot text stands on the left side, which adaptive execution splits.
            rows = self.rows.join(bounded_side(self.scratch, self.copies, "copies"), "_hash", "left").withColumn(
                "weight", 1 / F.coalesce("copies", F.lit(1)))
        terms = rows.select("weight", F.explode(F.array_distinct(_hashes(F.col("_text"), TERM))).alias("term"))
        return terms.groupBy("term").agg(F.round(F.sum("weight")).cast("long").alias("n_term"))

    def together(self) -> DataFrame:
        """_hash, term, n_term, entity, n_entity: terms and entities of a text, but for terms that are too
        frequent to disclose the entity."""
        n = F.lit(max(self.total, 1))
        held = self.scratch.keep(self.base.where(F.size("base") > 0).dropDuplicates(["_hash"]).select("_hash", "base", "free"), "held")
        entities = held.select("_hash", F.explode(F.array_distinct(F.transform("base", lambda b: b["entity"]))).alias("entity"))
        often = entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where(
            (F.col("n_entity") >= MIN_DOCUMENTS) & (F.col("n_entity") < n))
        # From PMI >= GENERALISE * I with a co-occurrence of n_entity; the margin is for rounding.
        often = self.scratch.keep(often.withColumn(
            "most", n * F.pow(F.col("n_entity") / n, F.lit(GENERALISE)) * (1 + 1e-9)), "often")
        most = often.agg(F.max("most")).first()[0] or 0.0
        entities = self.scratch.keep(entities.join(bounded_side(self.scratch, often, "often"), "entity"), "entities")
        counted = self.counted_terms().where((F.col("n_term") >= MIN_DOCUMENTS) & (F.col("n_term") <= F.lit(most)))
        counted = self.scratch.keep(counted, "counted")
        terms = held.select("_hash", F.explode("free").alias("term")).join(bounded_side(self.scratch, counted, "counted"), "term")
        self.held = held
        return terms.join(entities, "_hash").where(F.col("n_term") <= F.col("most")).select("_hash", "term", "n_term", "entity", "n_entity")

    def disclosing(self) -> DataFrame:
        """term, entity, disclosure of those that disclose."""
        self.count_documents()
        n = F.lit(max(self.total, 1))
        pairs = self.together().groupBy("term", "entity", "n_term", "n_entity").agg(F.count("*").alias("both")).where(
            F.col("both") >= MIN_DOCUMENTS)
        gain = F.log2(F.col("both") * n / (F.col("n_term") * F.col("n_entity")))
        told = pairs.withColumn("disclosure", gain / F.log2(n / F.col("n_entity"))).where(F.col("disclosure") >= GENERALISE)
        return self.scratch.keep(told.select("term", "entity", "disclosure"), "told")

    def term_spans(self) -> DataFrame:
        """_hash, terms: the places to remove or generalise of each text that has any."""
        told = self.disclosing().groupBy("term").agg(F.max("disclosure").alias("d")).select(
            "term", F.when(F.col("d") >= REMOVE, KINDS.index("removed")).otherwise(KINDS.index("general")).alias("kind"))
        told = self.scratch.keep(told, "terms-told")
        # Terms that disclose are rare; every text is searched for them.
        hit = self.rows.select("_hash", F.explode(F.array_distinct(_hashes(F.col("_text"), TERM))).alias("term")).join(
            bounded_side(self.scratch, told, "terms-told"), "term").distinct()
        hit = hit.groupBy("_hash").agg(F.collect_list(F.struct("term", "kind")).alias("hits"))
        own = self.held.select("_hash", F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))).alias("own"))
        hit = self.scratch.keep(hit.join(own, "_hash", "left"), "hits")
        rows = self.rows.join(bounded_side(self.scratch, hit, "hits"), "_hash").select(
            "_hash", F.coalesce("own", F.array().cast("array<struct<start:int,end:int>>")).alias("own"), F.map_from_entries("hits").alias("kinds"),
            F.regexp_extract_all("_text", F.lit(TERM), F.lit(0)).alias("m"), F.split("_text", TERM, -1).alias("g"))
        rows = rows.withColumn("k", F.transform(_lowered("m"), lambda t: F.try_element_at("kinds", t)))
        rows = rows.select("_hash", "own", _kind_places("m", "g", "k").alias("p"))
        free = F.filter("p", lambda p: ~F.exists("own", lambda o: (o["start"] < p["end"]) & (p["start"] < o["end"])))
        places = rows.select("_hash", F.sort_array(free).alias("terms"))
        return self.scratch.keep(places.dropDuplicates(["_hash"]), "terms")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_removed, n_general per row."""
    search = _Search(docs)
    terms = search.term_spans()
    rows = search.base.join(bounded_side(search.scratch, terms, "terms"), list(_key()), "left").withColumns({
        "base": F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end"))),
        "terms": F.coalesce("terms", F.array().cast("array<struct<kind:int,start:int,end:int>>"))})
    return rows.select(
        "doc_id",
        *[F.size(F.filter("base", _is(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(PATTERNS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "terms")).alias("spans"),
        *[F.size(F.filter("terms", _is(KINDS.index(k)))).cast("long").alias(f"n_{k}") for k in ("removed", "general")])


MASKS = {"removed": "", "general": "[TERM]"} | {k: f"[{k.upper()}]" for k in PATTERNS}


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked, disclosing terms removed or generalised."""
    search = _Search(docs)
    terms = search.term_spans()
    simple = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind")))
    side = search.base.dropDuplicates(list(_key())).join(bounded_side(search.scratch, terms, "terms"), list(_key()), "left").select(
        *_key(), F.sort_array(F.concat(simple, F.coalesce(F.transform(
            "terms", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), t["kind"].alias("kind"))),
            F.array().cast("array<struct<start:int,end:int,kind:int>>")))).alias("_spans")).where(F.size("_spans") > 0)
    side = search.scratch.keep(side, "side")
    masks = F.array(*[F.lit(MASKS[k]) for k in KINDS])
    text = F.col("_row.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    cut = F.aggregate("_spans", start, lambda a, s: F.struct(
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(
            a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(masks, s["kind"]))).alias("out"),
        F.greatest(a["at"], s["end"]).alias("at")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[c.alias(n) for n, c in _key().items()])
    joined = whole.join(bounded_side(search.scratch, side, "side"), list(_key()), "left").withColumn("_cut", cut)
    new = F.when(F.col("_spans").isNotNull(), F.concat("_cut.out", F.substring(text, F.col("_cut.at") + 1, F.length(text)))).otherwise(text)
    return joined.select(*[new.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
