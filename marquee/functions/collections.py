from __future__ import annotations

import ast
import functools
import re
import warnings

import pandas as pd
from pyspark.sql import Column, functions as F

from marquee.functions.text import trim_unicode


def split_tokens(text: Column, separator: str = ",") -> Column:
    """Trimmed, non-empty parts in order, duplicates kept; separator is taken literally."""
    parts = F.transform(F.split(text, re.escape(separator)), trim_unicode)
    return F.filter(parts, lambda part: part != "")


def join_texts(texts: Column, separator: str) -> Column:
    return F.array_join(texts, separator)


# What a backslash may stand before in a string of a usual list.
_ESCAPED = r"\\(?:['\"\\abfnrtv]|x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4})"


def _plain_list(code: str) -> str:
    """The pattern of a list of mappings as Python usually prints it: strings without braces, whole numbers and
    the three words as values, and the code, a string without escapes, just once in each mapping. The values of
    other entries may hold escapes; the quote that ends a string of their kind stands in them only behind a
    backslash, so the code's entry cannot be found inside one."""
    key = re.escape(f"'{code}'")
    gap, bare = r"[ \t\n]*+", r"'[^'\\{}\n\r\x00]*+'"
    single = rf"'[^'\\{{}}\n\r\x00]*+(?:{_ESCAPED}[^'\\{{}}\n\r\x00]*+)*+'"
    free = rf'(?:(?!{key})[^"\\{{}}\n\r\x00])*+'
    double = rf'"{free}(?:{_ESCAPED}{free})*+"'
    other = rf"(?!{key}){bare}{gap}:{gap}(?:{single}|{double}|None|True|False|-?(?:0|[1-9][0-9]*+)){gap}"
    entry = rf"\{{{gap}(?:{other},{gap})*+{key}{gap}:{gap}{bare}{gap}(?:,{gap}{other})*+,?{gap}\}}{gap}"
    return rf"^[ \t]*+\[{gap}(?:{entry}(?:,{gap}{entry})*+,?{gap})?+\][ \t\n]*+$"


@functools.cache
def _python_list(code: str):
    """Any other text, read by Python's own literal parser. One function a code, so that a step which asks twice
    about a text hands it to Python once."""
    def read(text: str):
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                value = ast.literal_eval(text)
        except Exception:  # the parser raises many kinds; each means that this is no literal
            return {"codes": [], "fault": False, "broken": text.lstrip().startswith("[")}
        if not isinstance(value, list):
            return {"codes": [], "fault": False, "broken": False}
        mappings = [entry for entry in value if isinstance(entry, dict)]
        codes = [entry.get(code) for entry in mappings]
        odd = len(mappings) < len(value) or any(code in m and not isinstance(m[code], str) for m in mappings)
        return {"codes": [c if isinstance(c, str) else None for c in codes], "fault": odd, "broken": False}

    @F.pandas_udf("codes array<string>, fault boolean, broken boolean")
    def parsed(texts: pd.Series) -> pd.DataFrame:
        # Most rows hand over no text; only those that do cost anything here.
        found: dict[str, list] = {name: [None] * len(texts) for name in ("codes", "fault", "broken")}
        for place, text in enumerate(texts):
            if text is not None:
                for name, value in read(text).items():
                    found[name][place] = value
        return pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in found.items()})
    return parsed


def _unusual(text: Column, code: str) -> Column:
    """What Python makes of a list in an unusual form; NULL, and hardly any work, for the other rows."""
    return _python_list(code)(F.when(text.contains("[") & ~text.rlike(_plain_list(code)), text))


def literal_codes(text: Column, code: str) -> Column:
    """The `code` entry of each mapping in a Python-literal list of mappings.

    Never NULL: a missing, blank, malformed or non-list text gives an empty array. A mapping
    without the entry gives NULL in its place, so callers can tell "no list" from "no code". Lists
    in the usual form are read by one regular expression, all others by Python's literal parser.
    """
    usual = F.regexp_extract_all(text, F.lit(rf"[{{,][ \t\n]*'{re.escape(code)}'[ \t\n]*:[ \t\n]*'([^']*)'"), F.lit(1))
    # A text with a bracket that Python was not asked about is a usual list.
    return F.coalesce(_unusual(text, code)["codes"], F.when(text.contains("["), usual), F.array().cast("array<string>"))


def literal_fault(text: Column, code: str) -> Column:
    """True where a list holds an entry that is no mapping, or a code that is no string."""
    return F.coalesce(_unusual(text, code)["fault"], F.lit(False))


def literal_broken(text: Column, code: str) -> Column:
    """True where a text starts like a list but is no literal; it counts as an empty list."""
    return F.coalesce(_unusual(text, code)["broken"], F.lit(False))


def coded_pairs(text: Column) -> Column:
    """The codes of `code:name` pairs joined by a pipe; parts without a colon or code are dropped."""
    pairs = F.transform(F.split(text, r"\|"), lambda part: F.split(part, ":", 2))
    kept = F.filter(pairs, lambda pair: (F.size(pair) == 2) & (trim_unicode(pair[0]) != ""))
    return F.coalesce(
        F.transform(kept, lambda pair: trim_unicode(pair[0])),
        F.array().cast("array<string>"),
    )


def prefer_list(first: Column, second: Column) -> Column:
    """`first` unless it is empty. Blank entries inside `first` do not make it empty."""
    return F.when(F.size(first) > 0, first).otherwise(second)
