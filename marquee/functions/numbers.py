from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Lower bounds of the money tiers and their labels, highest first.
MONEY_TIERS = (
    (100_000_000, "Blockbuster"),
    (20_000_000, "Mid-Range"),
    (1_000_000, "Low-Budget"),
)
LOWEST_TIER = "Micro-Budget"
UNKNOWN_TIER = "Unknown"
TIER_LABELS = tuple(label for _, label in MONEY_TIERS) + (LOWEST_TIER, UNKNOWN_TIER)

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain finite decimal number becomes NULL."""
    value = text.try_cast("double")
    return F.when(text.rlike(_NUMBER) & (F.abs(value) < F.lit(float("inf"))), value)


def is_fractional(text: Column) -> Column:
    """True where the text is a number but not a whole one."""
    number = to_number(text)
    return F.coalesce(number != F.floor(number), F.lit(False))


def to_key(text: Column) -> Column:
    """Text to a 64-bit key: whole numbers in any spelling, NULL for everything else."""
    usual = F.regexp_replace(text, r"\.0*(\s*)$", "$1").try_cast("bigint")
    exact = text.try_cast("decimal(38,18)")
    unusual = F.when(text.rlike(_NUMBER) & (exact % 1 == 0), exact.try_cast("bigint"))
    return F.coalesce(usual, unusual)


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def to_money(text: Column) -> Column:
    """Text to double with zero read as unknown; storage rounding happens at the table contract."""
    return zero_to_null(to_number(text))


def classify(
    value: Column,
    tiers: Sequence[tuple[float, str]] = MONEY_TIERS,
    lowest: str = LOWEST_TIER,
    unknown: str = UNKNOWN_TIER,
) -> Column:
    """Tier label by lower bounds, given highest first."""
    out = F.when(value.isNull(), F.lit(unknown))
    for bound, label in tiers:
        out = out.when(value >= F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(lowest))


def pct_of_total(part: Column, total: Column, decimals: int = 2) -> Column:
    """Rounded percentage in decimal arithmetic; NULL for a zero total."""
    whole = F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    return F.round(part.cast("decimal(20,0)") / whole * 100, decimals)


def mean_of(value: Column, decimals: int) -> Column:
    """Rounded mean as sum over count, so a decimal sum keeps its exact halves."""
    return F.round(F.sum(value) / F.nullif(F.count(value), F.lit(0)).cast("decimal(20,0)"), decimals)


def ratio(part: Column, total: Column) -> Column:
    return part / F.nullif(total, F.lit(0))
