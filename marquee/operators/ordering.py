"""Exact order statistics and ranks that never put a whole group into one task.

Percentiles take two bounds around each wanted position from a sketch and order only the rows between
them. Ranks need all rows: a first pass sketches each group's value
distribution and derives bucket bounds from it. Rows then get a bucket number that depends on
their value only. Counts per bucket, a table of at most groups x buckets rows, tell how many
values lie before each bucket, so exact positions need ordering inside single buckets only.
Equal values are counted before they are ordered: a value shared by a third of all rows is one
row when it is sorted.

The bounds are an estimate whose value may differ between two runs of the same plan, while all
uses within one result must agree on them. They are therefore computed once, when the operator
is called. Up to BROADCAST_GROUPS groups they are kept on the driver and broadcast, as are the
other per-group tables; with more groups they go to a checkpoint and joins shuffle.

A group key may be NULL: the keys of a row are packed into one struct, and structs with NULL in the
same places are equal, also as join keys. So rows without a key are a group of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import checkpointed

# 2^10 buckets; the steps of a binary search over their 1023 inner bounds.
_STEPS = tuple(1 << i for i in reversed(range(10)))
BUCKETS = 2 * _STEPS[0]
_FRACTIONS = [i / BUCKETS for i in range(1, BUCKETS)]
# Parts of the rows by which a sketch may be off.
ACCURACY = 10_000

# With this many groups the bounds take 2 MB and the counts per bucket 200,000 rows at most.
BROADCAST_GROUPS = 200


def _settled(df: DataFrame) -> tuple[DataFrame, bool]:
    """A per-group frame computed now, so that every use of it sees the same values, and
    whether it is small enough for it and its like to be broadcast."""
    found = df.limit(BROADCAST_GROUPS + 1).toArrow()
    if found.num_rows <= BROADCAST_GROUPS:
        return F.broadcast(df.sparkSession.createDataFrame(found, df.schema)), True
    return checkpointed(df), False


def _hinted(df: DataFrame, few_groups: bool) -> DataFrame:
    return F.broadcast(df) if few_groups else df


def _doubles(values: Sequence[float]) -> Column:
    """A constant array written as one text literal, which plans faster than a thousand literals."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _packed(keys: Sequence[str]) -> Column:
    """The group keys as one value that is never NULL; without keys all rows are one group."""
    return F.struct(*[F.col(k) for k in keys] or [F.lit(0).alias("all")]).alias("_key")


def _unpacked(keys: Sequence[str]) -> list[Column]:
    return [F.col("_key")[k].alias(k) for k in keys]


def _bounds(value: str) -> Column:
    return F.percentile_approx(value, _doubles(_FRACTIONS), F.lit(ACCURACY))


def _bucket(bounds: Column, value: str) -> Column:
    """How many of the ascending bounds lie below the value."""
    below = F.aggregate(
        F.array(*[F.lit(s) for s in _STEPS]),
        F.lit(0),
        lambda pos, step: F.when(F.get(bounds, pos + step - 1) < F.col(value), pos + step).otherwise(pos),
    )
    return F.coalesce(below, F.lit(0))


def bucket_bounds(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, _bounds: bucket bounds of each group's values, computed now, for `bucket_of`."""
    return _settled(df.groupBy(*keys).agg(_bounds(value).alias("_bounds")))[0]


def bucket_of(value: str) -> Column:
    """The bucket of a value; all values of a bucket lie below those of the next."""
    return _bucket(F.col("_bounds"), value)


def _brackets(fractions: Sequence[float]) -> list[float]:
    """Fractions safely below and above each wanted one. The sketch is off by one part in ACCURACY of
    the rows at most, so its values at these fractions enclose the wanted positions."""
    margin = 2 / ACCURACY
    return [min(1.0, max(0.0, f + side)) for f in fractions for side in (-margin, margin)]


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Mapping[str, float],
    derived: bool = False,
) -> DataFrame:
    """Interpolated percentiles per group, one column per entry of `fractions`, NULLs ignored.

    Groups without any value do not appear. A sketch gives two bounds around each wanted position;
    rows below the lower one are counted in place, and only rows between the bounds, a few in ten
    thousand besides repeated values, are shuffled and put in order. The input is read three times;
    say `derived` if it comes out of joins or aggregations, and its keys and values are stored once
    instead.
    """
    names, keys = list(keys), ["_key"]
    numeric = df.select(_packed(names), F.col(value).cast("double").alias("_value"))
    if derived:
        numeric = checkpointed(numeric)
    known = numeric.where(F.col("_value").isNotNull())
    settled, few_groups = _settled(known.groupBy("_key").agg(
        F.percentile_approx("_value", _doubles(_brackets(list(fractions.values()))), F.lit(ACCURACY)).alias("_bounds")))
    tagged = known.join(settled, "_key")
    v, sides = F.col("_value"), [(F.get("_bounds", F.lit(2 * i)), F.get("_bounds", F.lit(2 * i + 1))) for i in range(len(fractions))]

    # In a small group a wanted position may be the next one outside the bounds.
    places = tagged.groupBy("_key").agg(F.count(F.lit(1)).alias("_total"), *[
        fact.alias(f"_{name}_{i}")
        for i, (low, high) in enumerate(sides)
        for name, fact in (
            ("below", F.count_if(v < low)), ("upto", F.count_if(v <= high)),
            ("before", F.max(F.when(v < low, v))), ("after", F.min(F.when(v > high, v))),
        )
    ])
    held = F.array(*[F.when((v >= low) & (v <= high), F.lit(i)) for i, (low, high) in enumerate(sides)])
    inside = tagged.select("_key", "_value", F.explode(F.array_compact(held)).alias("_i"))
    by_value = Window.partitionBy("_key", "_i").orderBy("_value")
    ladder = (
        inside.groupBy("_key", "_i", "_value").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_until", F.sum("_n").over(by_value)).withColumn("_from", F.col("_until") - F.col("_n"))
        .join(_hinted(places, few_groups), "_key")
    )

    def at(i: int, position: Column) -> Column:
        """The value at a position of the whole group, among the rows between the i-th bounds or next to them."""
        position = position.cast("bigint")
        below, upto = F.col(f"_below_{i}"), F.col(f"_upto_{i}")
        own = (F.col("_i") == i) & (position - below >= F.col("_from")) & (position - below < F.col("_until"))
        return F.max(F.when(own, F.col("_value")).when(position == below - 1, F.col(f"_before_{i}")).when(
            position == upto, F.col(f"_after_{i}")))

    picked = ladder.groupBy("_key").agg(
        F.max("_total").alias("_total"),
        *[
            at(i, side(F.lit(fraction) * (F.col("_total") - 1))).alias(f"_{name}_{end}")
            for i, (name, fraction) in enumerate(fractions.items())
            for side, end in ((F.floor, "low"), (F.ceil, "high"))
        ],
    )
    out = []
    for name, fraction in fractions.items():
        exact = F.lit(fraction) * (F.col("_total") - 1)
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        found = low + (high - low) * (exact - F.floor(exact))
        # The sketch promises that both are there.
        out.append(F.when(low.isNull() | high.isNull(), F.raise_error(F.lit("a percentile lies outside its bounds")))
                   .otherwise(found).cast("double").alias(name))
    picked = picked.select(*_unpacked(names), *out)
    # Without keys there is always one row.
    return picked if names else picked.agg(*[F.max(name).alias(name) for name in fractions])


@dataclass(frozen=True)
class Ranking:
    """What to rank by and the names of the columns to add. `higher` and `lower` hold the value
    of the row before and after in the ranked order."""

    value: str
    rank: str
    higher: str | None = None
    lower: str | None = None


def _value_ladder(
    df: DataFrame, keys: list[str], value: str, tie: str, stats: DataFrame, few_groups: bool
) -> DataFrame:
    """One row per group and distinct value: competition rank from the top, the neighbouring
    distinct values, and the first and last tie-break of the rows that share the value."""
    bounds = stats.select(*keys, F.col(f"_bounds_{value}").alias("_bounds"))
    tagged = (
        df.select(*keys, value, tie)
        .where(F.col(value).isNotNull())
        .join(_hinted(bounds, few_groups), keys)
        .select(*keys, value, tie, _bucket(F.col("_bounds"), value).alias("_bucket"))
    )
    down = Window.partitionBy(*keys).orderBy(F.desc("_bucket"))
    spans = (
        tagged.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(value).alias("_min"), F.max(value).alias("_max"))
        .select(
            *keys,
            "_bucket",
            (F.sum("_n").over(down) - F.col("_n")).alias("_above"),
            F.lag("_min").over(down).alias("_up"),
            F.lead("_max").over(down).alias("_down"),
        )
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(F.desc(value))
    return (
        tagged.groupBy(*keys, "_bucket", value)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(tie).alias("_first"), F.max(tie).alias("_last"))
        .join(_hinted(spans, few_groups), [*keys, "_bucket"])
        .select(
            *keys,
            value,
            F.struct(
                (F.col("_above") + F.sum("_n").over(inside) - F.col("_n") + 1).alias("rank"),
                F.coalesce(F.lag(value).over(inside), F.col("_up")).alias("higher"),
                F.coalesce(F.lead(value).over(inside), F.col("_down")).alias("lower"),
                F.col("_first").alias("first"),
                F.col("_last").alias("last"),
            ).alias(f"_step_{value}"),
        )
    )


def rank_descending(
    df: DataFrame,
    keys: Sequence[str],
    tie: str,
    rankings: Sequence[Ranking],
) -> DataFrame:
    """Rank within the group by each value, highest first and NULLs last, ties sharing a rank
    and leaving a gap. Rows with equal values stand in the order of the unique column `tie`.
    Without keys all rows are one group."""
    packed = _packed(keys)
    keys, shown = ["_key"], df.columns
    df = df.withColumn("_key", packed)
    stats, few_groups = _settled(
        df.groupBy(*keys).agg(*[
            column
            for value in {r.value: None for r in rankings}
            for column in (
                _bounds(value).alias(f"_bounds_{value}"),
                F.count(value).alias(f"_known_{value}"),
                F.min(value).alias(f"_lowest_{value}"),
                F.min(F.when(F.col(value).isNull(), F.col(tie))).alias(f"_first_unknown_{value}"),
            )
        ])
    )
    out = df
    for r in rankings:
        ladder = _value_ladder(df, keys, r.value, tie, stats, few_groups)
        # Rows without a value match nothing; spreading them keeps them out of a single task.
        spread = F.when(F.col(r.value).isNull(), F.pmod(F.xxhash64(tie), F.lit(8192)).cast("int")).otherwise(-1)
        out = (
            out.withColumn("_spread", spread)
            .join(ladder.withColumn("_spread", F.lit(-1)), [*keys, "_spread", r.value], "left")
            .drop("_spread")
        )
    facts = stats.drop(*[f"_bounds_{r.value}" for r in rankings])
    out = out.join(_hinted(facts, few_groups), keys)

    columns = [F.col(c) for c in shown]
    for r in rankings:
        value, place, step = F.col(r.value), F.col(tie), F.col(f"_step_{r.value}")
        known = value.isNotNull()
        columns.append(F.when(known, step["rank"]).otherwise(F.col(f"_known_{r.value}") + 1).alias(r.rank))
        if r.higher:
            columns.append(
                F.when(known & (place > step["first"]), value)
                .when(known, step["higher"])
                .when(place == F.col(f"_first_unknown_{r.value}"), F.col(f"_lowest_{r.value}"))
                .alias(r.higher)
            )
        if r.lower:
            columns.append(
                F.when(known & (place < step["last"]), value).when(known, step["lower"]).alias(r.lower)
            )
    return out.select(*columns)
