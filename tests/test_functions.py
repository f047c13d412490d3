import ast
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marquee.functions import collections, dates, numbers, text


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


@pytest.mark.parametrize("raw, number", [
    ("862", 862.0), ("862.0", 862.0), (" 862 ", 862.0), ("1e3", 1000.0), ("\t7\n", 7.0), (".5", 0.5), ("5.", 5.0),
    ("-5", -5.0), ("+5", 5.0), ("1997-08-20", None), ("0x10", None), ("1_000", None), ("", None), ("1d", None),
    ("1f", None), ("abc", None), ("inf", None), ("nan", None), ("1e400", None), ("1,000", None), ("٣", None), (None, None),
])
def test_number(spark, raw, number):
    assert apply(spark, numbers.to_number, [raw]) == [number]


def test_key(spark):
    raw = ["862", "862.0", " 862 ", "862.", "1e3", "+7", "862.5", "1997-08-20", "", None, "9007199254740993", ".0", "x", "1e30"]
    want = [862, 862, 862, 862, 1000, 7, None, None, None, None, 9007199254740993, 0, None, None]
    assert apply(spark, numbers.to_key, raw) == want


def test_fractional(spark):
    assert apply(spark, numbers.is_fractional, ["862.5", "862.0", "x", None]) == [True, False, False, False]


def test_money(spark):
    raw = ["0", "0.0", "", "abc", "1d", "700", "-5", None]
    assert apply(spark, numbers.to_money, raw) == [None] * 5 + [700.0, -5.0, None]


def test_tiers(spark):
    amounts = ["99999999.99", "100000000", "20000000", "1000000", "999999", None, "-1", "0"]
    got = apply(spark, numbers.classify, [a and Decimal(a) for a in amounts], "decimal(15,2)")
    assert got == [
        "Mid-Range", "Blockbuster", "Mid-Range", "Low-Budget", "Micro-Budget", "Unknown", "Micro-Budget", "Micro-Budget",
    ]


def test_percent(spark):
    df = spark.createDataFrame([(1, 800), (2, 3), (1, 0), (0, 5), (-59, 60)], "n long, d long")
    got = [r[0] for r in df.select(numbers.pct_of_total(F.col("n"), F.col("d"))).collect()]
    assert got == [Decimal("0.13"), Decimal("66.67"), None, Decimal("0.00"), Decimal("-98.33")]


@pytest.mark.parametrize("raw", ["1/5/1999", "01/05/1999", "1999-1-5", "1999-01-05", "5-1-1999"])
def test_date_layouts(spark, raw):
    assert apply(spark, dates.parse_date, [raw]) == [dt.date(1999, 1, 5)]


def test_date_rejects(spark):
    raw = [
        "13/05/1999", "2/30/1999", "1/5/99", "1/5/1999 ", " 1/5/1999", "1999-01-05T00:00", "1/5/1600", "9/21/1677",
        "4/12/2262", "1/5/10000", "001/5/1999", "2015-02-29", "", None,
    ]
    assert apply(spark, dates.parse_date, raw) == [None] * len(raw)
    assert apply(spark, dates.parse_date, ["9/22/1677", "4/11/2262", "2016-02-29"]) == [
        dt.date(1677, 9, 22), dt.date(2262, 4, 11), dt.date(2016, 2, 29)
    ]


def test_scope(spark):
    days = [dt.date(1979, 12, 31), dt.date(1980, 1, 1), dt.date(2016, 12, 31), dt.date(2017, 1, 1), None]
    assert apply(spark, dates.in_scope, days, "date") == [False, True, True, False, None]
    assert list(dates.scope_years())[0] == 1980 and list(dates.scope_years())[-1] == 2016
    assert len(dates.scope_years(dt.date(1996, 1, 1), dt.date(2001, 1, 1))) == 5


def test_trim(spark):
    assert apply(spark, text.trim_unicode, ["\t a b  ", "\x1f　", None]) == ["a b", "", None]


def test_missing_predicates(spark):
    assert apply(spark, text.is_missing_amount, [None, "", "  ", "0", " 0 ", "0.0", "5"]) == [True] * 5 + [False] * 2
    assert apply(spark, text.is_empty_list, [None, "", " ", "[]", " []", "[1]"]) == [True] * 4 + [False] * 2


def test_na_tokens(spark):
    raw = ["NA", " NA ", "None", "null", "NaN", "n/a", "", "Nadine", None]
    assert apply(spark, text.na_to_null, raw) == [None, " NA ", None, None, None, None, None, "Nadine", None]


def test_split(spark):
    got = apply(spark, collections.split_tokens, ["Drama, Comedy,,Drama ", " ", None, "x"])
    assert got == [["Drama", "Comedy", "Drama"], [], None, ["x"]]


@pytest.mark.parametrize("raw, codes", [
    ("[{'iso': 'US', 'name': 'United States of America'}]", ["US"]),
    ("[{'iso': 'CI', 'name': \"Cote D'Ivoire\"}]", ["CI"]),
    ("[{'iso': 'US', 'name': None}]", ["US"]),
    ("[{'iso': 'US', 'name': 'x'},]", ["US"]),
    ("[{'iso': 'US', 'name': 'It\\'s'}, {'name': 'a', 'iso': 'FR'}]", ["US", "FR"]),
    ("[{'iso': 'US', 'name': 'null, true'}]", ["US"]),
    ("[{'iso': ' ', 'name': 'x'}]", [" "]),
    ("[{'name': 'x'}]", [None]),
    (" [{'iso': 'US'}] ", ["US"]),
    ("[{'iso': 'US', 'ok': True, 'n': 3}]", ["US"]),
    ("[]", []), (None, []), ("", []), ("  ", []), ("6.0", []), ("{'iso': 'US'}", []), ("({'iso': 'US'},)", []),
    ("[{'iso': 'US'", []), ("[{'iso': 'US'}] junk", []), ("[{'iso': 'US'}][]", []),
    ("[{'iso': 'US', 'name': null}]", []), ("[{'iso': 'US', 'x': true}]", []),
])
def test_literal_list(spark, raw, codes):
    assert apply(spark, lambda c: collections.literal_codes(c, "iso"), [raw]) == [codes]


def test_literal_list_against_python(spark):
    """Lists printed by Python itself come back with their codes."""
    names = ["plain", "it's", 'say "x"', "a, b}", "[x]", "None", ": None, ", "tab\t", "\\", "Ünï", None]
    lists = [[{"iso": f"C{i}", "name": n}, {"name": n, "iso": f"D{i}"}] for i, n in enumerate(names)]
    got = apply(spark, lambda c: collections.literal_codes(c, "iso"), [repr(v) for v in lists])
    assert got == [[d["iso"] for d in v] for v in lists]


def test_literal_faults(spark):
    raw = ["['US']", "[{'iso': None}]", "[{'iso': 5}]", "[1, {'iso': 'US'}]", "[{'iso': 'US'}]", "[]", None, "['US'",
           "[{'name': 'x'}]", "[{'iso': 'US', 'name': None}]"]
    got = apply(spark, lambda c: collections.literal_fault(c, "iso"), raw)
    assert got == [True, True, True, True] + [False] * 6


def test_coded_pairs(spark):
    got = apply(spark, collections.coded_pairs, ["FR:France|:x|DE|GB:a:b", "", None, " US :x| :y"])
    assert got == [["FR", "GB"], [], [], ["US"]]


FORMS = [
    "[{u'iso': u'US'}]", "[{'iso': r'U\\S'}]", "[{'iso': b'US'}]", "[{'iso': '''US'''}]", "[{'iso': 'U' 'S'}]", "[{'iso': 'US', 't': (1, 2)}]",
    "[{'iso': 'US', 's': {1, 2}}]", "[{'iso': 'US', 'l': [None, True]}]", "[{'iso': 'US', 'n': +5}]", "[{'iso': 'US', 'n': .5}]",
    "[{'iso': 'US', 'n': 5.}]", "[{'iso': 'US', 'n': 0x10}]", "[{'iso': 'US', 'n': 1_000}]", "[{1: 'a', 'iso': 'US'}]", "[{'iso': 'US'}] # note",
    "[{'iso': '\\x55S'}]", "[{'iso': 'US', 'n': NaN}]", "[['US']]", "[('iso', 'US')]", "[[]]", "([{'iso': 'US'}])", "[{'iso': 'US'},\n {'iso': 'FR'}]",
    "\n[{'iso': 'US'}]", "[{'iso': 'US', 'iso': 'FR'}]", "[{\"iso\": \"US\"}]", "[{'a': \"'iso': 'XX'\", 'iso': 'US'}]", "[{'a': ', ', 'iso': 'US'}]",
    "[{'iso' : 'US' ,}]", "[{'iso': 'US', 'n': 007}]", "[{'iso': 'US', 'n': -3}]", "[{'iso': 'US', 'n': 1e5}]", "[{'iso': ''}]", "[{}]", "[{'iso': 'US'} {'iso': 'FR'}]",
    "[{'iso': 'US', **{}}]", "[dict(iso='US')]", "[{'iso': 'U{S}'}]", "[{'iso': 'US', 'x': 'a\nb'}]", "[{'iso': 'US'}, None]", "[ ]", "[,]", "[{'iso': 'é', 'n': None}]",
    "[{'name': 'It\\'s', 'iso': 'US'}]", "[{'n': 'a\\', \\'iso\\': \\'XX', 'iso': 'US'}]", "[{'n': \"x\\\"'iso': 'XX'\", 'iso': 'US'}]",
    "[{'n': \", \\'iso': 'XX'\", 'iso': 'US'}]", "[{'n': 'bad \\x4', 'iso': 'US'}]", "[{'n': '\\u00e9\\t', 'iso': 'US'}]", "[{'n': 'end\\\\', 'iso': 'US'}]",
    "[{'iso': 'US', 'is\\x6f': 'FR'}]", "[{'n': '\\N{BULLET}', 'iso': 'US'}]", "[{'n': 'open\\', 'iso': 'US'}]", "[{'n': 'a\\'b' 'c', 'iso': 'US'}]",
    "[{'iso': 'US', 'm': {'iso': 'FR'}}]", "[{'iso': f'US'}]", "\t[{'iso': 'US'}]\n", "[{'iso': 'US', 'k': 1j}]",
]


def test_literal_forms(spark):
    """Every form of a list gives what Python's parser gives, or is reported."""
    def read(raw):
        try:
            value = ast.literal_eval(raw)
        except Exception:
            return [], False, raw.lstrip().startswith("[")
        if not isinstance(value, list):
            return [], False, False
        found = [e.get("iso") for e in value if isinstance(e, dict)]
        return ([c if isinstance(c, str) else None for c in found],
                any(not isinstance(e, dict) or "iso" in e and not isinstance(e["iso"], str) for e in value), False)
    assert len(FORMS) >= 40
    expected = [read(raw) for raw in FORMS]
    for build, at in ((collections.literal_codes, 0), (collections.literal_fault, 1), (collections.literal_broken, 2)):
        assert apply(spark, lambda c, f=build: f(c, "iso"), FORMS) == [e[at] for e in expected], build.__name__


def test_escaped_texts_need_no_python(spark):
    """Lists as Python prints them match the one pattern, also with escapes and very long texts."""
    long = "It's \"x\" \\\\ and " * 20_000
    lists = [repr([{"iso": "US", "name": n}, {"name": n, "iso": "FR"}]) for n in ("it's", "it's \"x\"", "tab\t\\", "\x01é", long)]
    pattern = collections._plain_list("iso")
    assert apply(spark, lambda c: c.rlike(pattern), lists) == [True] * len(lists)
    assert apply(spark, lambda c: collections.literal_codes(c, "iso"), lists) == [["US", "FR"]] * len(lists)
