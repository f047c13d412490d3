import re
from collections import Counter

import pytest

from marquee.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The quick brown fox jumps over one lazy dog and then walks home again, slowly. "
TEXTS = [
    None, "", " \n\t", "one", "a b c a b c", "a b c a b c a b c",
    " ".join(f"w{i}" for i in range(60)) + ".",
    "x y z " * 40,
    "same line here.\nsame line here.\n\nother é😀 line.\n \nsame line here.",
    "\n".join(f"Sentence number {i} talks about thing {i * 7} in place {i * 3}." for i in range(20)),
    "\n".join(f"Home {i} | About {i} | News {i} | Shop {i}" for i in range(30)),
    " ".join(f"word{i}%%%" for i in range(80)),
    "\n".join([" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(12)]
              + ["All rights reserved."]),
    " ".join(f"u{i}" for i in range(20000)) + " u1 u2 u3",
    "a a a a", "# * $ % & | < >",
]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_base_columns_equal_brute_force(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(3, "one", 1), (None, PROSE, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = q.assess(docs, extra=("doc_id",)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize("text,kept", [
    (TEXTS[9], True), (TEXTS[12], True), (TEXTS[10], False), (TEXTS[11], False), (TEXTS[6], True),
])
def test_verdict(spark, text, kept):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = q.assess(docs, extra=("doc_id",)).first()
    assert row.kept is kept
    if text is TEXTS[12]:
        assert "All rights" not in row.cleaned and row.cleaned.count("\n") == 11


def test_clean_keeps_the_columns_of_documents(spark):
    docs = spark.createDataFrame([(1, TEXTS[12], "en", "s", 7, 1), (2, None, None, None, None, None)],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept int")
    out = q.clean(docs)
    assert out.schema.names == docs.schema.names and out.dtypes == docs.dtypes
    assert [(r.doc_id, len(r.text)) for r in out.collect()] == [(1, r.n_chars) for r in out.collect()]
    assert q.clean(docs.limit(0)).count() == 0


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = q.assess(docs, extra=("doc_id",))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
