"""Quality reports and distribution profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chargelake import config
from chargelake.functions.scalar import floor_time, half_even, ratio
from chargelake.operators.cleaning import numeric_columns
from chargelake.operators.quantiles import between, neighbours, quantiles


def _per_column(row: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn one row of `<field>_<i>` aggregates into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[
            F.col(f"{field}_{i}").cast(kind).alias(field) for field, kind in fields.items()
        ])
        for i, c in enumerate(columns)
    ]
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def quality_report(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Per column: type, rows with and without value, null share, distinct values, a sample.

    All from one aggregate. Exact distinct counts shuffle every distinct value of every
    column; pass exact_distinct=False for a sketch on very wide or very large tables.
    The sample is the smallest value, so that it does not depend on row order.
    """
    distinct = F.count_distinct if exact_distinct else F.approx_count_distinct
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        column = F.col(f"`{c}`")
        aggregates += [
            F.count(column).alias(f"non_null_{i}"),
            distinct(column).alias(f"unique_{i}"),
            F.min(column).cast("string").alias(f"sample_{i}"),
        ]
    row = df.agg(*aggregates)
    nulls = {
        f"null_count_{i}": F.col("_rows") - F.col(f"non_null_{i}")
        for i in range(len(df.columns))
    }
    shares = {
        f"null_pct_{i}": half_even(ratio(F.col(f"null_count_{i}") * 100.0, F.col("_rows")), 2)
        for i in range(len(df.columns))
    }
    types = {f"dtype_{i}": F.lit(f.dataType.simpleString())
             for i, f in enumerate(df.schema.fields)}
    fields = {"dtype": "string", "non_null": "bigint", "null_count": "bigint",
              "null_pct": "double", "unique": "bigint", "sample": "string"}
    return _per_column(
        row.withColumns(nulls).withColumns(shares).withColumns(types), df.columns, fields
    )


def numeric_summary(df: DataFrame) -> DataFrame:
    """Number of values and mean of every numeric column."""
    names = numeric_columns(df)
    row = df.agg(*[
        agg for i, c in enumerate(names)
        for agg in (F.count(F.col(f"`{c}`")).alias(f"non_null_{i}"),
                    F.avg(F.col(f"`{c}`")).alias(f"mean_{i}"))
    ])
    return _per_column(row, names, {"non_null": "bigint", "mean": "double"})


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("rows")).na.drop()


def range_profile(df: DataFrame, ts: str = "timestamp", station: str = "station_id",
                  energy: str = "energy_kwh", by: Sequence[str] = ()) -> DataFrame:
    """Rows, period, stations, and range and gaps of energy."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_timestamp"), F.max(ts).alias("last_timestamp"),
        F.count_distinct(station).alias("stations"),
        F.min(energy).alias("min_energy"), F.max(energy).alias("max_energy"),
        F.count_if(F.col(energy).isNull()).alias("missing_energy"),
    )


def grid_profile(attributes: DataFrame) -> DataFrame:
    """Number of grids and totals of their chargers and flags."""
    sums = {"total_chargers": "total_chargers", "fast_count": "fast_chargers",
            "is_cbd": "cbd_grids", "dynamic_pricing": "dynamic_pricing_grids"}
    return attributes.agg(
        F.count(F.lit(1)).alias("grids"),
        *[F.sum(c).alias(n) for c, n in sums.items() if c in attributes.columns],
    )


def energy_by_time(df: DataFrame, unit: str, energy: str = "energy_kwh",
                   ts: str = "timestamp", by: Sequence[str] = ()) -> DataFrame:
    """Total energy per month or day."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*by, floor_time(ts, unit).cast("date").alias(unit))
        .agg(F.coalesce(F.sum(energy), F.lit(0.0)).alias("energy_kwh"))
    )


_BOX = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def box_statistics(df: DataFrame, by: Sequence[str], column: str = "energy_kwh",
                   cap_share: float = 0.95) -> DataFrame:
    """Box-plot statistics per group of the values bounded to [0, quantile(cap_share)].

    Bounding keeps the order of values, so the order statistics of the raw values,
    bounded afterwards, give the result in one pass over the data.
    """
    ends = {"low": 0.0, "high": 1.0}
    near = neighbours(df, column, _BOX | ends | {"cap": cap_share}, by)
    cap = between("cap", cap_share)
    floor0 = lambda c: F.greatest(c, F.lit(0.0))
    near = near.withColumn("_cap", cap).select(
        *by, "rows", "_cap",
        *[floor0(F.least(F.col(c), F.col("_cap"))).alias(c)
          for c in near.columns if c.endswith(("_low", "_high"))],
    )
    return near.select(
        *by, "rows",
        F.col("low_low").alias("minimum"),
        *[between(n, s).alias(n) for n, s in _BOX.items()],
        F.col("high_high").alias("maximum"),
    )


def period_distribution(df: DataFrame, column: str = "energy_kwh",
                        cap_share: float = 0.95) -> DataFrame:
    """Mean and median per tariff period of the values bounded to [0, quantile(cap_share)]."""
    by = "time_period"
    caps = quantiles(df, column, {"median": 0.5, "cap": cap_share}, [by])
    floor0 = lambda c: F.greatest(c, F.lit(0.0))
    # one row per tariff period, of which there are three
    bounded = df.select(by, column).na.drop().join(F.broadcast(caps), by)
    return bounded.groupBy(by).agg(
        F.max("rows").alias("rows"),
        F.avg(floor0(F.least(F.col(column), F.col("cap")))).alias("mean"),
        floor0(F.max("median")).alias("median"),
        floor0(F.max("cap")).alias("cap"),
    )


def volatility(df: DataFrame, by: str = "time_period", column: str = "energy_kwh") -> DataFrame:
    """Mean, sample standard deviation and coefficient of variation in percent."""
    return df.filter(F.col(column).isNotNull()).groupBy(by).agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
    ).withColumn("cv", ratio("std", "mean") * 100)


def band_shares(df: DataFrame, column: str = "charger_utilization_rate") -> DataFrame:
    """Percent of values below the discount, above the surge threshold and between."""
    value = F.col(column)
    share = lambda condition: F.avg(condition.cast("int")) * 100
    return df.filter(value.isNotNull()).agg(
        share(value < config.DISCOUNT_UTILISATION).alias("discount_pct"),
        share(value > config.SURGE_UTILISATION).alias("surge_pct"),
    ).withColumn("normal_pct", 100 - F.col("discount_pct") - F.col("surge_pct"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, over the rows where both have a value.

    Each row meets the sums once per column, not once per pair, and all sums are made before
    the shuffle. One aggregate of all pairs would spare that, but its code gets too long to
    be compiled well. Moments are merged around running means, so large offsets do not
    cancel; a constant column gives null instead of a division error.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "a STRING, b STRING, r DOUBLE")
    values = df.select(*[F.col(c).cast("double").alias(f"v{j}") for j, c in enumerate(present)])
    firsts = F.explode(F.array(*[
        F.struct(F.lit(c).alias("a"), F.col(f"v{i}").alias("x")) for i, c in enumerate(present)]))
    x, sums, cells = F.col("x"), [], []
    for j, name in enumerate(present):
        y = F.col(f"v{j}")
        sums += [F.covar_pop(x, y).alias(f"xy{j}"),
                 F.stddev_pop(F.when(y.isNotNull(), x)).alias(f"x{j}"),
                 F.stddev_pop(F.when(x.isNotNull(), y)).alias(f"y{j}")]
        r = ratio(f"xy{j}", F.col(f"x{j}") * F.col(f"y{j}"))
        cells.append(F.struct(F.lit(name).alias("b"), F.when(
            F.col("a") == name, F.when(F.col(f"x{j}") > 0, 1.0)).otherwise(r).alias("r")))
    return (
        values.select("*", firsts.alias("f")).select(*values.columns, "f.a", "f.x")
        .groupBy("a").agg(*sums)
        .select("a", F.explode(F.array(*cells)).alias("c")).select("a", "c.b", "c.r")
    )


def mean_by(df: DataFrame, by: str, column: str, name: str) -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.avg(column).alias(name))
