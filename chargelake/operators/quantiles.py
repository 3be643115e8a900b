"""Exact order statistics, cumulative shares and histograms without a global sort.

Values are first counted in narrow slots that grow with the value. The slot counts, a
small table, tell which slot holds a wanted rank, and only the values of those slots are
looked at, in ever narrower parts and at last as counts per distinct value. Neither a group
nor a slot of many near-equal values is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.functions.scalar import floor_time, ratio
from chargelake.operators.ordered import running_total

_VALUE, _SLOT, _FROM = "_value", "_slot", "_from"
_PARTS = 65_536
# distinct values that one task puts in order
_RUN = 10_000


def magnitude_slot(value: Column) -> Column:
    """Slot of a number: never falls when the value rises, about half a percent wide."""
    size = F.log1p(F.least(F.abs(value), F.lit(1e300)) * 1000.0) * 200.0
    return F.floor(F.signum(value) * size)


def day_slot(value: Column) -> Column:
    return floor_time(value, "day")


def _values(df: DataFrame, column: str, by: Sequence[str],
            slot: Callable[[Column], Column]) -> DataFrame:
    rows = df.select(*by, F.col(column).alias(_VALUE)).na.drop()
    return rows.withColumn(_SLOT, slot(F.col(_VALUE)))


def _part(parts: Column) -> Column:
    """Which of equally wide parts between `_low` and `_high` the value lies in."""
    place = F.floor(ratio(F.col(_VALUE) - F.col("_low"), F.col("_high") - F.col("_low")) * parts)
    return F.coalesce(F.least(place, parts - 1), F.lit(0)).cast("bigint")


def values_at_ranks(df: DataFrame, column: str, ranks: dict[str, Callable[[Column], Column]],
                    by: Sequence[str] = (),
                    slot: Callable[[Column], Column] = magnitude_slot,
                    narrow: int = 1) -> DataFrame:
    """One row per group: `rows` and, per name, the value at a zero-based rank.

    Each entry of `ranks` computes the rank from the number of rows in the group. A slot
    that holds a wanted rank is cut into 65,536 parts between its smallest and its
    largest value, `narrow` times over, so near-equal values don't stay together. The input
    is read `narrow` + 2 times: pass a stored one if it is dear.
    """
    by = list(by)
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), make(F.col("rows")).cast("bigint").alias("rank"))
        for name, make in ranks.items()
    ])
    inside = lambda w, first, end: (w["rank"] >= first) & (w["rank"] < end)
    # without groups there is at most one slot per rank; else the size decides
    held = (lambda targets: targets) if by else F.broadcast
    key, carried = [*by, _FROM, _SLOT], []
    rows = _values(df, column, by, slot).withColumn(_FROM, F.lit(0).cast("bigint"))
    for level in range(narrow + 1):
        in_order = Window.partitionBy(*by, _FROM).orderBy(_SLOT)
        sizes = rows.groupBy(*key, *carried).agg(
            F.count(F.lit(1)).alias("_n"), F.min(_VALUE).alias("_low"),
            F.max(_VALUE).alias("_high"))
        if not carried:
            carried = ["rows", "_wanted"]
            sizes = sizes.withColumn(
                "rows", F.sum("_n").over(Window.partitionBy(*by))).withColumn("_wanted", wanted)
        end = F.col(_FROM) + F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        targets = (
            sizes.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_n"))
            .withColumn("_wanted", F.filter(
                "_wanted", lambda w: inside(w, F.col("_start"), F.col("_end"))))
            .filter(F.size("_wanted") > 0).drop("_end", "_n")
        )
        inner = _part(F.lit(_PARTS)) if level < narrow else F.lit(0).cast("bigint")
        rows = rows.select(*key, _VALUE).join(held(targets), key).select(
            *by, _VALUE, F.col("_start").alias(_FROM), inner.alias(_SLOT), *carried)
    counted = rows.groupBy(*by, _FROM, _VALUE, *carried).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by, _FROM).orderBy(_VALUE).rowsBetween(
        Window.unboundedPreceding, 0)
    last = F.col(_FROM) + F.col("_seen")
    hits = (
        counted.withColumn("_seen", F.sum("_n").over(upto))
        .withColumn("_wanted", F.filter(
            "_wanted", lambda w: inside(w, last - F.col("_n"), last)))
        .select(*by, "rows", _VALUE, F.explode("_wanted.name").alias("_name"))
    )
    return hits.groupBy(*by).agg(
        F.max("rows").alias("rows"),
        *[F.max(F.when(F.col("_name") == name, F.col(_VALUE))).alias(name) for name in ranks],
    )


def neighbours(df: DataFrame, column: str, shares: dict[str, float],
               by: Sequence[str] = ()) -> DataFrame:
    """Per group and share: the two values around the quantile, `<name>_low`, `<name>_high`."""
    ranks = {}
    for name, share in shares.items():
        ranks[f"{name}_low"] = lambda n, s=share: F.floor((n - 1) * F.lit(s))
        ranks[f"{name}_high"] = lambda n, s=share: F.ceil((n - 1) * F.lit(s))
    return values_at_ranks(df, column, ranks, by)


def between(name: str, share: float, bound: Column | None = None) -> Column:
    """The interpolated quantile from its neighbours, of the values bounded above if asked."""
    low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
    if bound is not None:
        low, high = F.least(low, bound), F.least(high, bound)
    place = (F.col("rows") - 1) * F.lit(share)
    return low + (high - low) * (place - F.floor(place))


def quantiles(df: DataFrame, column: str, shares: dict[str, float],
              by: Sequence[str] = ()) -> DataFrame:
    """Exact, linearly interpolated quantiles: one row per group."""
    return neighbours(df, column, shares, by).select(
        *by, "rows", *[between(n, s).alias(n) for n, s in shares.items()]
    )


def cumulative_share(df: DataFrame, column: str) -> DataFrame:
    """Empirical distribution: each distinct value with the share of rows up to it.

    Slots of many distinct values are cut into parts between their ends.
    """
    counts = (
        _values(df, column, [], magnitude_slot)
        .groupBy(_SLOT, _VALUE).agg(F.count(F.lit(1)).alias("rows"))
    )
    total = counts.agg(F.sum("rows")).scalar()
    spans = counts.groupBy(_SLOT).agg(
        F.ceil(F.count(F.lit(1)) / _RUN).alias("_parts"), F.min(_VALUE).alias("_low"),
        F.max(_VALUE).alias("_high"))
    runs = counts.join(spans, _SLOT).select(
        _VALUE, "rows", F.struct(F.col(_SLOT), _part(F.col("_parts")).alias("part")).alias(_SLOT))
    return running_total(runs, [], _SLOT, _VALUE, {"rows_up_to": "rows"}).select(
        F.col(_VALUE).alias(column), "rows",
        (F.col("rows_up_to") / total).alias("cumulative_share"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Rows in equally wide bins between the smallest and the largest value.

    The last bin includes the maximum. Empty bins are not listed. A column with a single
    value gets a range of one around it.
    """
    values = df.select(F.col(column).cast("double").alias(_VALUE)).na.drop()
    limits = values.agg(F.min(_VALUE).alias("low"), F.max(_VALUE).alias("high"))
    same = F.col("low") == F.col("high")
    limits = limits.select(F.struct(
        F.when(same, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(same, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
    )).scalar()
    low, high = limits["low"], limits["high"]
    place = F.floor(ratio(F.col(_VALUE) - low, high - low) * bins)
    width = (high - low) / bins
    return (
        values.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "bin", (low + width * F.col("bin")).alias("bin_start"),
            (low + width * (F.col("bin") + 1)).alias("bin_end"), "rows",
        )
    )


def winsorise(df: DataFrame, column: str, share: float, by: Sequence[str] = ()) -> DataFrame:
    """Bound a column to [0, quantile(share)] of its group; null stays null."""
    caps = quantiles(df, column, {"_cap": share}, by).drop("rows")
    bound = lambda cap: F.when(
        F.col(column).isNotNull(), F.greatest(F.least(F.col(column), cap), F.lit(0.0))
    )
    if not by:
        return df.withColumn(column, bound(caps.scalar()))
    return (
        df.join(caps, list(by), "left")
        .withColumn(column, bound(F.col("_cap"))).select(*df.columns)
    )
