from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Accepted layouts in order of preference, each with the shape that selects it.
# The shape test keeps the parser from being called, and failing, on every other layout.
DATE_LAYOUTS = (
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("d-M-yyyy", r"^\d{1,2}-\d{1,2}-\d{4}$"),
)

# The range of dates that fit a 64-bit count of nanoseconds.
FIRST_DATE = dt.date(1677, 9, 22)
LAST_DATE = dt.date(2262, 4, 11)

# The catalogue scope, from inclusive, to exclusive.
SCOPE_FROM = dt.date(1980, 1, 1)
SCOPE_TO = dt.date(2017, 1, 1)


def parse_date(text: Column) -> Column:
    """Text in one of the accepted layouts to a date, NULL for anything else."""
    parsed = F.coalesce(*(
        F.when(text.rlike(shape), F.try_to_date(text, layout)) for layout, shape in DATE_LAYOUTS
    ))
    return F.when(parsed.between(F.lit(FIRST_DATE), F.lit(LAST_DATE)), parsed)


def in_scope(date: Column, start: dt.date = SCOPE_FROM, end: dt.date = SCOPE_TO) -> Column:
    """Half-open date window; a NULL date is outside."""
    return (date >= F.lit(start)) & (date < F.lit(end))


def scope_years(start: dt.date = SCOPE_FROM, end: dt.date = SCOPE_TO) -> range:
    """The calendar years a half-open window touches."""
    return range(start.year, (end - dt.timedelta(days=1)).year + 1)
