import hashlib
import math
import random
import re

from marquee.llm import pii as p

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    found = []
    for k, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[k]
            if good:
                found.append((k, m.start(), m.end()))
    return found


TEXTS = [
    None, "", "none", "é😀 a@b.c and x@y@z.com a@b.c_d@e.f a@b. .@-.-", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.3.255 1.2.3", "4539 1488 0343 6467 x 4539148803436468",
    "+1 (555) 123-4567. +123 +49 30 1234567890123456", "9" * 40 + " " + "4" * 18, "a" * 30000 + "@b", "@".join("ab" * 20 for _ in range(50)) + ".c",
    "1" * 20000 + "." + "2" * 9, "z@" + "q.q" * 3000, "12- 3 4-5",
]


def fuzz(n):
    rng = random.Random(8)
    return ["".join(rng.choice("ab1234 5678..@@++-()_é") for _ in range(rng.randint(1, 120))) for _ in range(n)]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = TEXTS + fuzz(400)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, TEXTS[3], "x"), (None, TEXTS[3], None)], "doc_id long, text string, n_email string")
    rows = p.report(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        found = brute(texts[3 if r.doc_id is None else r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(f[0] == k for f in found) for k in PLAIN), r
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), r
        assert r.spans.startswith(joined)


def test_disclosing_terms(spark):
    rng = random.Random(1)
    common = [f"common{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}" for i in range(64)]
    rows = [(i, " ".join(rng.choices(common, k=40))) for i in range(200)]
    rows += [(1000 + i, f"{rng.choice(common)} the Zorblax engineer, mail bob@corp.io {rng.choice(common)} done") for i in range(3)]
    rows += [(2000 + i, f"we saw Zorblax once {rng.choice(common)}") for i in range(1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in p.report(docs).collect()}
    assert got[1000].n_email == 1 and got[1000].n_removed >= 2
    # The name alone gives the address away, also where the address does not stand.
    assert got[2000].n_removed == 1 and f"removed:7:14" in got[2000].spans
    assert all(got[i].n_removed + got[i].n_general == 0 for i in range(200))
    text = dict(rows)[1000]
    at = text.index("engineer")
    assert f"removed:{at}:{at + 8}" in got[1000].spans
    clean = {r.doc_id: r.text for r in p.sanitise(docs).collect()}
    assert "engineer" not in clean[1000] and "bob@" not in clean[1000] and "[EMAIL]" in clean[1000]
    assert len(clean) == len(rows) and all(clean[i] == t for i, t in rows[:200])


def test_empty_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.cd", 7, "q")], "doc_id long, text string, base int, _x string")
    assert p.report(docs.limit(0)).count() == 0 and p.sanitise(docs.limit(0)).count() == 0
    out = p.sanitise(docs)
    assert out.columns == docs.columns and out.first().text == "[EMAIL]" and out.first().base == 7


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    assert "Python" not in p.report(docs)._jdf.queryExecution().executedPlan().toString()


def test_terms_far_from_the_match(spark):
    """Co-occurrence is counted in whole documents, and terms are marked in all of the document."""
    rng = random.Random(3)
    common = [f"common{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8]}" for i in range(64)]

    def fill(k):
        return " ".join(rng.choices(common, k=k))
    rows = [(i, fill(40)) for i in range(200)]
    rows += [(1000 + i, f"the Quillfarer {fill(60)} mail éabc@corp.io or abc@corp.io, {fill(60)} Quillfarer again{fill(1)}") for i in range(3)]
    docs = spark.createDataFrame(rows + rows[200:201] * 2, "doc_id long, text string")
    result = p.report(docs).collect()
    assert len(result) == 205
    for r in result:
        if r.doc_id >= 1000:
            text = dict(rows)[r.doc_id]
            for m in re.finditer("Quillfarer", text):
                assert f"removed:{m.start()}:{m.end()}" in r.spans
            assert r.n_email == 2 and r.n_removed == 4, r
        else:
            assert r.n_removed + r.n_general == 0
    clean = {r.doc_id: r.text for r in p.sanitise(docs).collect()}
    assert all("Quillfarer" not in clean[1000 + i] for i in range(3))


def test_disclosure_equals_counting(spark):
    """Every disclosing pair of term and entity, against plain counting of documents."""
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    rows = []
    for i in range(150):
        words = rng.choices(vocab[:340], k=rng.randint(5, 60))
        for _ in range(rng.choice((0, 0, 1, 2))):
            u = rng.randrange(25)
            words.insert(rng.randrange(len(words)), f"u{u}@x.org")
            words += [vocab[325 + 3 * u + k] for k in range(3) if rng.random() < 0.8]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string")
    entities = {i: set(re.findall(r"u\d+@x\.org", t)) for i, t in rows}
    terms = {i: set(re.findall(r"\b[a-h]{5}\b", t)) for i, t in rows}
    expected = 0
    marked = {i: {} for i, _ in rows}
    for e in set().union(*entities.values()):
        own = [i for i in entities if e in entities[i]]
        for t in set().union(*[terms[i] for i in own]):
            n_term, both = sum(t in s for s in terms.values()), sum(t in terms[i] for i in own)
            if both >= p.MIN_DOCUMENTS:
                share = math.log2(both * len(rows) / (n_term * len(own))) / math.log2(len(rows) / len(own))
                assert abs(share - p.REMOVE) > 1e-9 and abs(share - p.GENERALISE) > 1e-9
                if share >= p.GENERALISE:
                    expected += 1
                    for i in terms:
                        if t in terms[i]:
                            marked[i][t] = max(share, marked[i].get(t, 0))
    assert p._Search(docs).disclosing().count() == expected > 10
    for r in p.report(docs).collect():
        text = dict(rows)[r.doc_id]
        places = [(t, m.start(), m.end()) for t in marked[r.doc_id] for m in re.finditer(rf"\b{t}\b", text)]
        wanted = {f"{'removed' if marked[r.doc_id][t] >= p.REMOVE else 'general'}:{a}:{b}" for t, a, b in places}
        assert {s for s in r.spans.split(",") if s.startswith(("removed", "general"))} == wanted


def test_copies_are_one_piece_of_evidence(spark):
    """Copies of one text disclose nothing, however many; three different texts do."""
    rng = random.Random(8)
    common = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(60)]

    def fill(k):
        return " ".join(rng.choices(common, k=k))
    rows = [(i, fill(30)) for i in range(150)]
    copied = f"only here are Fennimarsh and Tolliver with ann@copied.org {fill(10)}"
    rows += [(500 + i, copied) for i in range(40)]
    rows += [(600 + i, f"{fill(20)} Harlequist {fill(3)} bea@three.org {fill(12)}") for i in range(3)]
    rows += [(700 + i, f"{fill(20)} Wendelbury {fill(3)} cid@twice.org {fill(12)}") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r for r in p.report(docs).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        at = text.find("Harlequist")
        wanted = [f"removed:{at}:{at + 10}"] if at >= 0 else []
        assert [s for s in got[i].spans.split(",") if s.startswith(("removed", "general"))] == wanted, i
    assert got[500].n_email == 1 and got[700].n_removed == 0


def test_very_long_text(spark):
    long = "word " * 200_000 + "ann@long.org " + "tail " * 200_000
    docs = spark.createDataFrame([(1, long), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: r for r in p.report(docs).collect()}
    assert got[1].n_email == 1 and got[1].spans == "email:1000000:1000012" and got[2].spans == ""
