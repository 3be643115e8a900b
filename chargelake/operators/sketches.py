"""Quantiles and distinct counts of any period from small stored sketches per day.

One pass over the rows makes, per day and group, a KLL sketch of every measure and an HLL
sketch of every key; sketches of days are merged to those of longer periods without the rows.
Use them where the exact operators (`quantiles`, `quality_report`) are too dear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chargelake.functions.scalar import floor_time

#: size of a KLL sketch; the rank of a quantile is off by RANK_ERROR at most, in 99 of 100
KLL_K = 400
RANK_ERROR = 0.0075
#: 2**HLL_LG registers; a count is off by DISTINCT_ERROR (three standard errors) at most
HLL_LG = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_LG / 2)
DAY = "day"


def daily_sketches(df: DataFrame, measures: Sequence[str] = (), keys: Sequence[str] = (),
                   by: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """One row per group and day: `rows`, and per column its values, sketch and (for
    measures) smallest and largest value.

    Nulls and NaN are not in a sketch; rows without a time have the day null. A day of any
    size is sketched before the shuffle.
    """
    sums = [F.count(F.lit(1)).alias("rows")]
    for c in measures:
        value = F.col(f"`{c}`").cast("double")
        value = F.when(~F.isnan(value), value)
        sums += [F.count(value).alias(f"{c}_n"), F.min(value).alias(f"{c}_min"),
                 F.max(value).alias(f"{c}_max"),
                 F.kll_sketch_agg_double(value, KLL_K).alias(f"{c}_kll")]
    for c in keys:
        sums.append(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), HLL_LG).alias(f"{c}_hll"))
    return df.groupBy(*by, floor_time(ts, "day").cast("date").alias(DAY)).agg(*sums)


def merged(daily: DataFrame, by: Sequence[str] = (), unit: str | None = None,
           first: object = None, last: object = None) -> DataFrame:
    """Sketches of months or years, or of all days from `first` to `last`, both included."""
    rows = daily
    if first is not None:
        rows = rows.filter(F.col(DAY) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col(DAY) <= F.lit(last).cast("date"))
    how = {"rows": F.sum, "_n": F.sum, "_min": F.min, "_max": F.max,
           "_kll": F.kll_merge_agg_double, "_hll": F.hll_union_agg}
    kind = lambda c: next((k for k in how if c == k or (k != "rows" and c.endswith(k))), None)
    period = [floor_time(DAY, unit).cast("date").alias(unit)] if unit else []
    return rows.groupBy(*by, *period).agg(
        *[how[kind(c)](f"`{c}`").alias(c) for c in daily.columns
          if c not in by and c != DAY and kind(c)])


def quantile(column: str, share: float) -> Column:
    """A quantile of a measure from its sketch; null without values."""
    return F.when(F.col(f"`{column}_n`") > 0,
                  F.kll_sketch_get_quantile_double(F.col(f"`{column}_kll`"), F.lit(float(share))))


def distinct(column: str) -> Column:
    """The number of distinct values of a key from its sketch."""
    return F.coalesce(F.hll_sketch_estimate(F.col(f"`{column}_hll`")), F.lit(0))


def rank_bounds(df: DataFrame, column: str, found: DataFrame, names: Sequence[str],
                by: Sequence[str] = ()) -> DataFrame:
    """For each of `names`, quantiles in `found` (a row per group): the share of values below
    it and up to it, as `<name>_below` and `<name>_upto`. What a quantile is judged by."""
    value = F.col(f"`{column}`").cast("double")
    rows = df.filter(value.isNotNull() & ~F.isnan(value)).select(*by, value.alias("_value"))
    limits = found.select(*by, *names)
    joined = rows.join(limits, list(by)) if by else rows.crossJoin(F.broadcast(limits))
    shares = []
    for name in names:
        shares += [F.avg((F.col("_value") < F.col(name)).cast("int")).alias(f"{name}_below"),
                   F.avg((F.col("_value") <= F.col(name)).cast("int")).alias(f"{name}_upto")]
    return joined.groupBy(*by).agg(*shares)
