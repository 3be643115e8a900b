"""Wide matrices to long readings, calendar and grid attributes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake import config, schemas

_CALENDAR = ["year", "month", "day", "hour", "minute", "second"]


def assemble_timestamp(calendar: DataFrame) -> Column:
    parts = [F.col(c).cast("int") if c in calendar.columns else F.lit(0) for c in _CALENDAR]
    return F.make_timestamp_ntz(*parts)


def calendar_by_index(calendar: DataFrame, index: str = "timestamp") -> DataFrame:
    """Interval index and its timestamp.

    A calendar without an index column is numbered in time order from zero; it has one
    row per interval, so its size depends on the period covered only.
    """
    stamped = calendar.withColumn("_ts", assemble_timestamp(calendar))
    if index not in calendar.columns:
        stamped = stamped.withColumn(
            index, F.row_number().over(Window.orderBy("_ts")).cast("bigint") - 1
        )
    return stamped.select(F.col(index).cast("bigint").alias(index), "_ts")


def _by_interval(wide: DataFrame, calendar: DataFrame, index: str) -> DataFrame:
    """A wide matrix with its interval index as the calendar counts it."""
    if index not in wide.columns:
        raise ValueError(f"the matrix needs its interval index in column {index!r}")
    rows = wide.withColumn(index, F.col(index).cast("bigint"))
    if index not in calendar.columns:
        first = rows.agg(F.min(index)).scalar()
        rows = rows.withColumn(index, F.col(index) - first)
    return rows


def attach_calendar(wide: DataFrame, calendar: DataFrame, index: str = "timestamp") -> DataFrame:
    """Replace the interval index of a wide matrix by its timestamp.

    The match is by key, never by file position. If only the matrix carries an index,
    its smallest value belongs to the first interval.
    """
    rows = _by_interval(wide, calendar, index)
    joined = rows.join(calendar_by_index(calendar, index), index, "left")
    values = [c for c in wide.columns if c != index]
    return joined.select(F.col("_ts").alias("timestamp"), *[F.col(f"`{c}`") for c in values])


def wide_to_long(wide: DataFrame, value: str, grids: Sequence[str] | None = None) -> DataFrame:
    """One row per timestamp and grid; empty cells are kept as null."""
    grids = list(grids or [c for c in wide.columns if c != "timestamp"])
    cells = [F.col(f"`{g}`").cast("double").alias(g) for g in grids]
    return wide.select("timestamp", *cells).unpivot(
        ["timestamp"], [F.col(f"`{g}`") for g in grids], "grid_id", value
    )


def combine_measures(parts: dict[str, DataFrame]) -> DataFrame:
    """Full outer combination of long measures on (timestamp, grid_id).

    Stacking the measures and taking the one value per cell needs a single shuffle,
    whatever the number of measures; a chain of outer joins needs one per measure.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.select("timestamp", "grid_id", name) for name, df in parts.items()],
    )
    return stacked.groupBy("timestamp", "grid_id").agg(*[F.max(n).alias(n) for n in parts])


def grid_attributes(information: DataFrame) -> DataFrame:
    """One row per grid with the known attributes under their clean names."""
    key = "grid" if "grid" in information.columns else "num"
    order = "num" if "num" in information.columns else key
    present = [c for c in schemas.GRID_ATTRIBUTES if c in information.columns]
    typed = information.select(
        F.col(key).cast("string").alias("grid_id"),
        F.struct(
            F.col(order).cast("bigint").alias("order"),
            *[F.col(c).cast(schemas.ATTRIBUTE_TYPES[c]).alias(schemas.GRID_ATTRIBUTES[c])
              for c in present],
        ).alias("first"),
    )
    return typed.groupBy("grid_id").agg(
        F.min_by("first", "first.order").alias("first")
    ).select("grid_id", *[f"first.{schemas.GRID_ATTRIBUTES[c]}" for c in present])


def build_grid_readings(tables: dict[str, DataFrame], index: str = "timestamp") -> DataFrame:
    """Long readings of every measure present, with the attributes of their grid.

    Measures meet by interval index; the calendar is joined once, to all of them.
    """
    measures = {k: v for k, v in schemas.GRID_MEASURES.items() if k in tables}
    if not measures:
        raise ValueError("no table of grid measures")
    # every table brings the grids it has: one may lack some that another holds
    parts = {}
    for key, name in measures.items():
        rows = _by_interval(tables[key], tables["time"], index).withColumnRenamed(index, "timestamp")
        parts[name] = wide_to_long(rows, name, [c for c in tables[key].columns if c != index])
    calendar = calendar_by_index(tables["time"], index).withColumnRenamed(index, "timestamp")
    readings = combine_measures(parts).join(calendar, "timestamp", "left").select(
        F.col("_ts").alias("timestamp"), "grid_id", *parts)
    if "information" in tables:
        # no broadcast hint: the size of the dimension decides
        readings = readings.join(grid_attributes(tables["information"]), "grid_id", "left")
    return readings.withColumns({
        "data_source": F.lit(config.GRID_SOURCE),
        "station_id": F.concat(F.lit(config.GRID_PREFIX), F.col("grid_id")),
    })


def pivot_mean(df: DataFrame, row: str, column: str, value: str,
               labels: dict[object, str]) -> DataFrame:
    """Mean of `value` by row and column; `labels` fixes the columns and their names."""
    table = df.filter(F.col(row).isNotNull()).groupBy(row).pivot(column, list(labels)).agg(
        F.avg(value)
    )
    return table.withColumnsRenamed({str(k): v for k, v in labels.items()})


WEEKDAYS = dict(enumerate(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]))


def melt_pivot(table: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Long form of a pivoted table."""
    return table.unpivot([row], [c for c in table.columns if c != row], column, value)
