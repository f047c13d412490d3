from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from marquee.contracts import NA_TOKENS

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_unicode(text: Column) -> Column:
    """Strip all Unicode white space from both ends, not only blanks."""
    return F.trim(text, F.lit(WHITESPACE))


def na_to_null(text: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """NULL where the whole text is one of the missing-value tokens."""
    return F.when(~text.isin(*tokens), text)


def is_blank(text: Column) -> Column:
    """NULL or nothing but blanks."""
    return text.isNull() | (F.trim(text) == "")


def is_missing_amount(text: Column) -> Column:
    """Raw amount that counts as not given. A text test: '0' is missing, '0.0' is not."""
    return text.isNull() | F.trim(text).isin("", "0")


def is_empty_list(text: Column) -> Column:
    """Raw list that holds nothing; the brackets must stand alone, without blanks."""
    return is_blank(text) | (text == "[]")


def all_blank(columns: Iterable[str]) -> Column:
    """True where every named column is NULL or blank."""
    return reduce(lambda left, right: left & right, (is_blank(F.col(c)) for c in columns))


def first_filled(*texts: Column) -> Column:
    """The first text that is not empty after trimming, trimmed; NULL if there is none."""
    return F.coalesce(*(F.nullif(trim_unicode(t), F.lit("")) for t in texts))


def same_word(text: Column, word: str) -> Column:
    """Case-insensitive equality."""
    return F.lower(text) == F.lit(word.lower())
