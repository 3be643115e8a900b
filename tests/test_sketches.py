"""Sketches per day, merged for any period, against exact results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chargelake.operators import sketches
from chargelake.operators.quantiles import quantiles
from chargelake.session import stored

SHARES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    """Skewed, constant, tied and missing values; one group holds most rows."""
    i = F.col("id")
    spread = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003
    df = spark.range(120_000).select(
        F.when(i % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), (i % 3).cast("string"))).alias("station_id"),
        F.timestamp_add("MINUTE", (i % 90_000).cast("int"), F.lit(dt.datetime(2024, 1, 1)).cast(
            "timestamp_ntz")).alias("timestamp"),
        F.exp(spread * 12).alias("skewed"), F.lit(7.0).alias("constant"),
        F.when(i % 7 > 0, F.floor(spread * 5)).cast("double").alias("tied"),
        F.when(i % 5 == 0, F.lit(float("nan"))).otherwise(spread).alias("gappy"),
        F.pmod(F.xxhash64("id"), F.lit(9_000)).cast("string").alias("user_id"),
        F.lit(None).cast("string").alias("nobody"))
    return stored(df, "sketch-rows")


@pytest.fixture(scope="module")
def daily(rows):
    return stored(sketches.daily_sketches(
        rows, ["skewed", "constant", "tied", "gappy"], ["user_id", "nobody"], ["station_id"]), "daily")


@pytest.mark.parametrize("column", ["skewed", "constant", "tied", "gappy"])
@pytest.mark.parametrize("unit", [None, "month"])
def test_quantiles_are_within_the_bound(rows, daily, column, unit):
    by = ["station_id"] + ([unit] if unit else [])
    found = sketches.merged(daily, ["station_id"], unit)
    found = found.select(*by, *[sketches.quantile(column, s).alias(n) for n, s in SHARES.items()])
    source = rows.withColumn("month", F.trunc("timestamp", "month"))
    bounds = sketches.rank_bounds(source, column, found, list(SHARES), by).collect()
    assert len(bounds) >= 4
    for row in bounds:
        for name, share in SHARES.items():
            assert row[f"{name}_below"] - sketches.RANK_ERROR <= share <= (
                row[f"{name}_upto"] + sketches.RANK_ERROR)


def test_constants_and_ends_are_exact(rows, daily):
    row = sketches.merged(daily).select(
        "rows", sketches.quantile("constant", 0.5).alias("constant"), "skewed_min", "skewed_max",
        "gappy_n", sketches.distinct("nobody").alias("nobody")).first()
    plain = rows.agg(F.min("skewed"), F.max("skewed"), F.count_if(~F.isnan("gappy"))).first()
    assert tuple(row) == (120_000, 7.0, plain[0], plain[1], plain[2], 0)


def test_distinct_counts_are_within_the_bound(rows, daily):
    exact = {r[0]: r[1] for r in rows.groupBy("station_id").agg(F.count_distinct("user_id")).collect()}
    for r in sketches.merged(daily, ["station_id"]).select(
            "station_id", sketches.distinct("user_id").alias("n")).collect():
        assert abs(r["n"] - exact[r["station_id"]]) <= sketches.DISTINCT_ERROR * exact[r["station_id"]]


def test_any_period_of_days(rows, daily, plan):
    part = sketches.merged(daily, first="2024-01-10", last="2024-01-19")
    inside = rows.filter("timestamp >= '2024-01-10' and timestamp < '2024-01-20'")
    got = part.select("rows", sketches.quantile("skewed", 0.5).alias("p50")).first()
    assert got["rows"] == inside.count()
    middle = quantiles(inside, "skewed", {"p50": 0.5}).first()["p50"]
    share = inside.filter(F.col("skewed") <= got["p50"]).count() / got["rows"]
    assert abs(share - 0.5) <= sketches.RANK_ERROR and middle > 0
    assert "skewed_kll" in daily.columns and daily.count() <= 4 * 63
    assert sketches.merged(daily.limit(0)).select(sketches.quantile("skewed", 0.5)).first()[0] is None
