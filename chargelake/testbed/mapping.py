"""Charging data from the generic test tables, so that every query reads given data.

`events` stands for sessions (one event, one session) and, per five minutes and event
type, for the wide grid matrices; `region` gives the grids their attributes; `lineitem`
is a larger table of daily deliveries per supplier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake.functions.scalar import floor_minutes
from chargelake.operators.cleaning import clean_grid, clean_sessions
from chargelake.operators.features import build_features
from chargelake.operators.reshape import build_grid_readings
from chargelake.operators.rollup import hourly_grid, hourly_sessions, merge_sources
from chargelake.operators.tariff import price_table
from chargelake.session import stored

GRIDS = ["click", "error", "purchase", "signup", "view"]
# the sessions of the test tables are cut into chunks of a day, as they cover a month only
CHUNK = "day"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes() -> Column:
    """The number in props, {"k": 42}; a pattern is much cheaper here than a JSON parser."""
    return F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("int")


def station() -> Column:
    return F.concat(F.lit("ST_"), (F.col("user_id") % 10).cast("string"))


def raw_sessions(spark: SparkSession, sf_dir: str, time_type: str = "string") -> DataFrame:
    """Sessions the way CSV and JSON files hold them, where times are text."""
    after = lambda seconds: F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    events = table(spark, sf_dir, "events").withColumn("k", minutes())
    return events.select(
        F.concat(F.lit('{"$oid":"'), F.col("event_id"), F.lit('"}')).alias("_id"),
        F.col("event_id").cast("string").alias("sessionID"),
        station().alias("stationID"),
        F.col("user_id").cast("string").alias("userID"),
        F.col("ts").cast(time_type).alias("connectionTime"),
        after(F.col("k") * 60).cast(time_type).alias("disconnectTime"),
        F.when(F.col("event_type") != "error", after(F.col("k") * 45))
        .cast(time_type).alias("doneChargingTime"),
        F.col("value").alias("kWhDelivered"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean sessions, from a source with typed times."""
    return clean_sessions(raw_sessions(spark, sf_dir, "timestamp_ntz")).drop("_id")


def sessions_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_sessions(sessions(spark, sf_dir))


def grid_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The wide matrices, their calendar and the grid dimension.

    The matrices have a column for each of GRIDS; an event of another type, or of none,
    fails the query, as it would be in no figure.
    """
    grid = F.when(F.col("event_type").isin(GRIDS), F.col("event_type")).otherwise(F.raise_error(
        F.concat(F.lit("event type outside GRIDS: "), F.coalesce("event_type", F.lit("null")))))
    slot = floor_minutes("ts", 5)
    # number of five-minute steps since the start of 2024
    index = (
        F.datediff(slot, F.lit("2024-01-01")) * 288 + F.hour(slot) * 12
        + (F.minute(slot) / 5).cast("int")
    ).cast("bigint")
    measures = {"volume": F.sum("value"), "occupancy": F.count("value"), "price": F.avg("value"),
                "duration": F.avg("k")}
    # all matrices and the calendar come from one pass over the events
    cells = stored(
        table(spark, sf_dir, "events")
        .select(index.alias("timestamp"), grid.alias("event_type"), "value", minutes().alias("k"))
        .groupBy("timestamp").pivot("event_type", GRIDS)
        .agg(*[measure.cast("double").alias(name) for name, measure in measures.items()]), "cells")
    wide = lambda name: cells.select(
        "timestamp", *[F.col(f"{g}_{name}").alias(g) for g in GRIDS])
    at = F.timestamp_add("MINUTE", (F.col("timestamp") * 5).cast("int"),
                         F.lit("2024-01-01").cast("timestamp_ntz"))
    calendar = cells.select(
        "timestamp",
        *[f(at).alias(n) for n, f in {
            "year": F.year, "month": F.month, "day": F.dayofmonth,
            "hour": F.hour, "minute": F.minute, "second": F.second}.items()],
    )
    names = F.array(*[F.lit(g) for g in GRIDS])
    information = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("num"),
        F.element_at(names, F.col("r_regionkey") + 1).alias("grid"),
        (F.col("r_regionkey") + 1).alias("count"),
        (F.col("r_regionkey") == 0).cast("int").alias("CBD"),
    )
    return {
        "time": calendar,
        **{name: wide(name) for name in measures},
        "information": information,
    }


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_grid_readings(grid_tables(spark, sf_dir))


def readings_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_grid(stored(readings(spark, sf_dir), "readings"), chunk=CHUNK)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_sources(
        sessions_by_hour(spark, sf_dir), hourly_grid(readings_clean(spark, sf_dir))
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(stored(merged(spark, sf_dir), "merged"), CHUNK)


def forecast(df: DataFrame) -> DataFrame:
    """Rolling utilisation as the prediction that pricing works from."""
    return df.withColumns({
        "predicted_utilization": F.col("charger_rolling_24h"),
        "congestion_probability": F.col("charger_rolling_6h"),
    })


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_table(forecast(features(spark, sf_dir)))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sessions of a supplier station."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("SUP_"), F.col("l_suppkey")).alias("station_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("energy_kwh"),
        (F.col("l_extendedprice") / 1000).alias("duration_min"),
    )
