"""Row and column cleaning of sessions and grid readings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

from chargelake import config, schemas
from chargelake.functions.scalar import (
    clip, minutes_between, oid_text, parse_time, ratio, without_nan,
)
from chargelake.operators.ordered import carry_forward


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as null, which is what it stands for in the inputs."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: without_nan(c) for c in floats})


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without any value. Runs one aggregate that returns one row."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select([F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def flatten_id(df: DataFrame, column: str = "_id") -> DataFrame:
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, T.StructType):
        return df.withColumn(column, F.col(f"`{column}`.`$oid`"))
    return df.withColumn(column, oid_text(column))


def parse_session_times(df: DataFrame) -> DataFrame:
    wanted = [c for c in ("connectionTime", "disconnectTime", "doneChargingTime")
              if c in df.columns]
    text = [c for c in wanted if isinstance(df.schema[c].dataType, T.StringType)]
    other = [c for c in wanted if c not in text]
    return df.withColumns(
        {c: parse_time(c) for c in text}
        | {c: F.col(c).cast("timestamp_ntz") for c in other}
    )


def add_durations(df: DataFrame) -> DataFrame:
    """Minutes plugged in and minutes charging; a missing charging end counts as plugged in."""
    if not {"connectionTime", "disconnectTime"} <= set(df.columns):
        return df
    out = df.withColumn(
        "session_duration_min", minutes_between("connectionTime", "disconnectTime")
    )
    if "doneChargingTime" in df.columns:
        charging = minutes_between("connectionTime", "doneChargingTime")
        out = out.withColumn(
            "charging_duration_min", F.coalesce(charging, F.col("session_duration_min"))
        )
    return out


def drop_without_energy(df: DataFrame) -> DataFrame:
    """Rows without energy or with energy not above zero; reaches the file scan as a filter."""
    if "kWhDelivered" not in df.columns:
        return df
    return df.filter((F.col("kWhDelivered") > 0) & ~F.isnan("kWhDelivered"))


def drop_without_duration(df: DataFrame) -> DataFrame:
    """Rows that end by their start. A missing time stays.

    Comparing the times, not the minutes, keeps the filter cheap where it is pushed down.
    """
    if not {"connectionTime", "disconnectTime"} <= set(df.columns):
        return df
    ended = F.col("disconnectTime") <= F.col("connectionTime")
    return df.filter(~F.coalesce(ended, F.lit(False)))


def clean_sessions(df: DataFrame) -> DataFrame:
    return (
        drop_without_energy(df)
        .transform(nan_to_null)
        .transform(parse_session_times)
        .transform(drop_without_duration)
        .transform(add_durations)
        .withColumnsRenamed(schemas.SESSION_NAMES)
        .withColumn("data_source", F.lit(config.SESSION_SOURCE))
    )


def clean_grid(df: DataFrame, fill: Iterable[str] = tuple(schemas.GRID_MEASURES.values()),
               chunk: str = "month") -> DataFrame:
    """Carry measures forward per station, then add utilisation and energy."""
    measures = [c for c in fill if c in df.columns]
    out = nan_to_null(df)
    if measures and "station_id" in df.columns:
        out = carry_forward(out, ["station_id"], "timestamp", measures, chunk)
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in measures})
    if {"active_chargers", "total_chargers"} <= set(df.columns):
        share = clip(ratio("active_chargers", "total_chargers"), 0.0, 1.0)
        out = out.withColumn("charger_utilization_rate", F.coalesce(share, F.lit(0.0)))
    if "volume_kwh" in df.columns and "energy_kwh" not in df.columns:
        out = out.withColumn("energy_kwh", F.col("volume_kwh"))
    return out


def split_by_source(df: DataFrame, sources: Iterable[str] | None = None) -> dict[str, DataFrame]:
    wanted = sources or (config.SESSION_SOURCE, config.GRID_SOURCE)
    return {s: df.filter(F.col("data_source") == s) for s in wanted}


def complete_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows with a value in every given column, NaN counting as missing."""
    return nan_to_null(df).na.drop(subset=list(columns))
