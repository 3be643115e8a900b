import math

import pytest
from pyspark.sql import functions as F

from chargelake import config
from chargelake.functions.pricing import objective, reference_price
from chargelake.operators import metrics, monitor, tariff

# fixed values: published tariffs without congestion, by hour, for utilisation 0.0, 0.1 ... 1.0
PUBLISHED = {
    3: [9.0, 9.67, 9.88, 15.75, 16.36, 16.92, 17.44, 17.91, 18.35, 29.25, 29.25],
    8: [9.0, 11.77, 11.98, 18.81, 19.46, 20.06, 20.63, 21.15, 21.63, 30.0, 30.0],
    13: [9.0, 10.72, 10.93, 17.28, 17.92, 18.5, 19.04, 19.54, 20.0, 30.0, 30.0],
}


@pytest.fixture(scope="module")
def lookup(spark):
    return tariff.tariff_lookup(spark).cache()


def test_lookup_has_every_cell(lookup):
    assert lookup.count() == tariff.LOOKUP_CELLS == 24 * 11 * 11
    low, high = lookup.agg(F.min("tariff_inr"), F.max("tariff_inr")).first()
    assert (low, high) == (9.0, 30.0)


def test_published_schedule(lookup):
    rows = {(r["hour"], round(r["utilization"] * 10)): r["tariff_inr"]
            for r in tariff.pricing_schedule(lookup).collect()}
    assert len(rows) == 264
    same = {"off_peak": 3, "peak": 8, "shoulder": 13}
    for (hour, u), price in rows.items():
        period = ("peak" if hour in config.PEAK_HOURS
                  else "shoulder" if hour in config.SHOULDER_HOURS else "off_peak")
        assert price == PUBLISHED[same[period]][u]


def test_lookup_against_all_prices(spark, lookup):
    """The halving search finds the best of all 2,101 prices, for cells of each period."""
    cells = lookup.filter(F.col("hour").isin(0, 9, 14)).withColumn(
        "cents", F.explode(F.sequence(F.lit(900), F.lit(3000))))
    score = objective(F.col("cents") / 100, F.col("u_idx") / 10.0,
                      reference_price(F.col("hour")), F.col("c_idx") / 10.0)
    best = cells.groupBy("hour", "u_idx", "c_idx", "tariff_inr").agg(
        F.max(score).alias("best"),
        F.max(F.when(F.col("cents") == F.rint(F.col("tariff_inr") * 100), score)).alias("found"))
    assert best.filter("best - found > 1e-6").isEmpty()


@pytest.mark.parametrize("use, hour, congestion, expected", [
    (None, 13, 0.0, 18.5), (-0.1, 13, 0.0, 9.0), (0.05, 13, 0.0, 9.0), (0.25, 13, 0.0, 10.93),
    (0.3, 13, 0.0, 17.28), (1.2, 13, 0.0, 30.0), (0.5, None, None, 18.5),
    (0.5, -1, 0.0, 16.92), (0.5, 24, 0.0, 16.92), (float("nan"), 13, 0.0, 18.5),
])
def test_price_of_a_row(spark, lookup, use, hour, congestion, expected):
    df = spark.createDataFrame(
        [(use, hour, congestion)],
        "predicted_utilization DOUBLE, hour_of_day INT, congestion_probability DOUBLE")
    assert tariff.price_table(df, lookup).first()["dynamic_tariff"] == expected


def test_price_without_columns(spark, lookup):
    df = spark.range(2)
    assert {r["dynamic_tariff"] for r in tariff.price_table(df, lookup).collect()} == {18.5}
    own = df.withColumn("charger_utilization_rate", F.lit(0.9))
    assert tariff.price_table(own, lookup).first()["dynamic_tariff"] == 30.0


def test_lookup_join_is_broadcast(spark, lookup, plan):
    df = spark.range(10).withColumn("hour_of_day", (F.col("id") % 24).cast("int"))
    text = plan(tariff.price_table(df, lookup))
    assert "BroadcastHashJoin" in text and "Python" not in text


SCHEMA = ("energy_kwh DOUBLE, dynamic_tariff DOUBLE, charger_utilization_rate DOUBLE, "
          "is_peak_hour INT, queue_length_proxy BIGINT")


def report(df, make):
    return metrics.report(df, make(df)).first().asDict()


def test_tariff_metrics(spark):
    df = spark.createDataFrame(
        [(10.0, 30.0, 0.9, 1, 4), (20.0, 9.0, 0.1, 0, 0), (None, 15.0, 0.5, 1, 2)], SCHEMA)
    got = report(df, metrics.tariff_metric)
    assert got["baseline_revenue_INR"] == 450.0 and got["dynamic_revenue_INR"] == 480.0
    assert got["revenue_gain_pct"] == 6.67 and got["avg_dynamic_tariff"] == 18.0
    after = (0.9 * 0.7 + 0.1 * 1.12 + 0.5) / 3
    assert got["avg_util_after"] == round(after, 4)
    assert got["off_peak_slots"] == 1 and got["off_peak_pct"] == 33.33
    assert got["avg_discount_pct"] == 40.0 and got["estimated_session_uplift_pct"] == 12.0
    response = report(df, metrics.response_metric)
    assert response["pct_slots_price_increased"] == 33.33
    assert response["customer_response_rate"] == round(abs(-0.3 * 20.0), 4)
    efficiency = report(df, metrics.efficiency_metric)
    assert efficiency["dynamic_efficiency_per_kwh"] == 16.0
    assert efficiency["efficiency_improvement_pct"] == 6.67


def test_metrics_of_an_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    got = report(df, metrics.tariff_metric)
    assert got["revenue_gain_pct"] == float("inf") and got["off_peak_slots"] == 0
    assert got["off_peak_pct"] == 0.0 and got["util_change_pct"] == 0.0
    assert report(df, metrics.efficiency_metric)["dynamic_efficiency_per_kwh"] == 0.0


def test_no_off_peak_rows(spark):
    df = spark.createDataFrame([(1.0, 20.0, 0.9, 1, 0)], SCHEMA)
    got = report(df, metrics.off_peak_metric)
    assert got["avg_discount_pct"] == 0.0 and got["estimated_session_uplift_pct"] == 0.0


def test_waiting_from_queues(spark):
    df = spark.createDataFrame([(1.0, 20.0, 0.9, 1, 4), (1.0, 20.0, 0.9, 0, 8)], SCHEMA)
    got = report(df, metrics.waiting_metric)
    assert (got["baseline_avg_wait_min"], got["dynamic_avg_wait_min"]) == (20.0, 14.0)
    assert got["wait_time_reduction_pct"] == 30.0
    everyone = report(df.drop("is_peak_hour"), metrics.waiting_metric)
    assert everyone["baseline_avg_wait_min"] == 30.0
    nobody = report(df.filter("is_peak_hour = 0"), metrics.waiting_metric)
    assert nobody["baseline_avg_wait_min"] is None and nobody["wait_time_reduction_pct"] == 0.0


def test_waiting_from_utilisation(spark):
    df = spark.createDataFrame(
        [(1.0, 30.0, 0.8, 1, 0), (1.0, 15.0, 0.2, 0, 0)], SCHEMA).drop("queue_length_proxy")
    got = report(df, metrics.waiting_metric)
    assert (got["baseline_avg_wait_min"], got["dynamic_avg_wait_min"]) == (12.0, 6.0)
    # no peak rows: all rows count and the missing peak price gives the smallest factor
    unknown = report(df.drop("is_peak_hour"), metrics.waiting_metric)
    assert unknown["baseline_avg_wait_min"] == 7.5 and unknown["dynamic_avg_wait_min"] == 2.25
    free = report(df.drop("dynamic_tariff"), metrics.waiting_metric)
    assert free["dynamic_avg_wait_min"] == free["baseline_avg_wait_min"]
    nothing = report(df.select("energy_kwh"), metrics.waiting_metric)
    assert nothing["baseline_avg_wait_min"] == 0.0


def test_metrics_without_columns(spark):
    df = spark.createDataFrame([(1.0,)], "x DOUBLE")
    assert report(df, metrics.response_metric) == {"customer_response_rate": 0.0}
    assert report(df, metrics.efficiency_metric) == {"pricing_efficiency": 0.0}
    energy = df.withColumnRenamed("x", "energy_kwh")
    assert report(energy, metrics.efficiency_metric)["dynamic_efficiency_per_kwh"] == 15.0


def test_regression_metric(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0), (1.0, None)],
                               "actual DOUBLE, prediction DOUBLE")
    got = metrics.report(df, metrics.regression_metric()).first()
    assert got["RMSE"] == pytest.approx(math.sqrt(1.25 / 3)) and got["MAE"] == pytest.approx(0.5)
    assert got["R2"] == pytest.approx(1 - 1.25 / (14 / 3))
    constant = metrics.report(df.filter("actual = 2"), metrics.regression_metric()).first()
    assert constant["R2"] == 1.0


@pytest.mark.parametrize("gain, use, r2, rmse, demand, price", [
    (-1.26, 0.5, 0.5, 0.1, "RETRAIN", "REDUCE_SURGE"),
    (5.0, 0.2, 0.7, 0.3, "FINE_TUNE", "INCREASE_DISCOUNT"),
    (20.5, 0.3, 0.9, 0.1, "MAINTAIN", "MODERATE"),
    (20.0, 0.8, 0.6, 0.2, "MAINTAIN", "MAINTAIN"),
])
def test_feedback(spark, gain, use, r2, rmse, demand, price):
    df = spark.createDataFrame(
        [(gain, use, r2, rmse)],
        "revenue_gain_pct DOUBLE, avg_utilization DOUBLE, demand_r2 DOUBLE, demand_rmse DOUBLE")
    got = monitor.add_feedback(df).first()
    assert (got["demand_feedback"]["action"], got["tariff_feedback"]["action"]) == (demand, price)
    unknown = monitor.add_feedback(df.drop("demand_r2", "demand_rmse")).first()
    assert unknown["demand_feedback"]["reason"] == "R² = 0.000 is below 0.6 threshold"
    if price == "REDUCE_SURGE":
        assert got["tariff_feedback"]["reason"] == (
            "Revenue decreased by -1.3% — pricing may be too aggressive")


def test_multiplier_path_is_the_ordered_fold(spark):
    short = {"R": "REDUCE_SURGE", "D": "INCREASE_DISCOUNT", "M": "MAINTAIN"}
    actions = "RRDMRRRDDRRRRRDRMDDR"
    rows = [(i, (short[a], "")) for i, a in enumerate(actions)]
    df = spark.createDataFrame(
        rows, "period INT, tariff_feedback STRUCT<action: STRING, reason: STRING>")
    got = {(r["period"], r["tier"]): r["multiplier"]
           for r in monitor.multiplier_path(df).collect()}
    state = dict(config.TIER_MULTIPLIERS)
    for i, a in enumerate(actions):
        for tier, m in state.items():
            if (a == "R" and m > 1) or (a == "D" and m < 1):
                state[tier] = m * 0.95
        for tier, m in state.items():
            assert got[i, tier] == pytest.approx(m)
