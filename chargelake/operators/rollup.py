"""Station-hour facts and their union."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chargelake import config
from chargelake.functions.scalar import clip, floor_time

HOURLY_KEY = ["station_id", "timestamp"]


def _sum0(name: str):
    return F.coalesce(F.sum(name), F.lit(0.0))


def hourly_sessions(df: DataFrame) -> DataFrame:
    """Sessions per station and hour of their start. Rows without a key are left out.

    The queue of an hour is what `add_queue_length` gives each of its sessions, and the mean
    of `add_session_overlap` is kept where it has been added.
    """
    if "session_start" not in df.columns:
        return df
    aggregates = [
        F.count("energy_kwh").alias("session_count"),
        _sum0("energy_kwh").alias("total_energy_kwh"),
        F.avg("energy_kwh").alias("avg_energy_kwh"),
        F.greatest(F.count("session_start") - 1, F.lit(0)).alias("queue_length_proxy"),
    ]
    means = {"session_duration_min": "avg_duration_min",
             "charging_duration_min": "avg_charging_min",
             "overlapping_sessions": "avg_overlapping_sessions"}
    aggregates += [F.avg(c).alias(name) for c, name in means.items() if c in df.columns]
    out = (
        df.filter(F.col("station_id").isNotNull() & F.col("session_start").isNotNull())
        .withColumn("timestamp", floor_time("session_start", "hour"))
        .groupBy(*HOURLY_KEY).agg(*aggregates)
    )
    if "avg_charging_min" in out.columns:
        used = F.col("avg_charging_min") * F.col("session_count") / 60
        out = out.withColumn("charger_utilization_rate", clip(used, 0.0, 1.0))
    return out.withColumns({
        "energy_kwh": F.col("total_energy_kwh"),
        "data_source": F.lit(config.SESSION_SOURCE),
    })


def hourly_rollup(df: DataFrame, station: str = "station_id", ts: str = "timestamp",
                  energy: str = "energy_kwh", duration: str = "duration_min") -> DataFrame:
    """The same roll-up over any table, with its column names as parameters."""
    aggregates = []
    if energy in df.columns:
        aggregates += [
            F.count(energy).alias("session_count"),
            _sum0(energy).alias("total_energy_kwh"),
            F.avg(energy).alias("avg_energy_kwh"),
        ]
    if duration in df.columns:
        aggregates.append(F.avg(duration).alias("avg_duration_min"))
    if not aggregates:
        return df
    return (
        df.filter(F.col(station).isNotNull() & F.col(ts).isNotNull())
        .withColumn("hour_bucket", floor_time(ts, "hour"))
        .groupBy(station, "hour_bucket").agg(*aggregates)
    )


def hourly_grid(df: DataFrame) -> DataFrame:
    """Five-minute readings to station-hours: sums of energy, means of rates.

    Attributes are constant per station; max picks one without depending on row order.
    """
    how = {
        "energy_kwh": _sum0, "volume_kwh": _sum0,
        "active_chargers": F.avg, "price_per_kwh": F.avg, "avg_duration_min": F.avg,
        "charger_utilization_rate": F.avg,
        "total_chargers": F.max, "is_cbd": F.max, "data_source": F.max,
    }
    return (
        df.filter(F.col("station_id").isNotNull() & F.col("timestamp").isNotNull())
        .withColumn("timestamp", floor_time("timestamp", "hour"))
        .groupBy(*HOURLY_KEY)
        .agg(*[f(c).alias(c) for c, f in how.items() if c in df.columns])
    )


def merge_sources(sessions: DataFrame, grid: DataFrame) -> DataFrame:
    """Union under one schema; a column one side lacks is null there. Sort at the sink."""
    return sessions.unionByName(grid, allowMissingColumns=True)


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return sorted(set(left.columns) & set(right.columns))


def in_station_order(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in HOURLY_KEY])
