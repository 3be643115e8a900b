"""Scenarios, the dense lookup, selected cuts, sketches and fall-backs against plain ways."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chargelake import config
from chargelake.operators import demand, features, monitor, scenarios, selection, tariff


@pytest.fixture(scope="module")
def priced(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"S{i % 5}", start + dt.timedelta(hours=i // 5), rng.random() * 40 if i % 9 else None,
             rng.choice([None, rng.random()]), rng.random(), i % 4, (start + dt.timedelta(
                 hours=i // 5)).hour in config.PEAK_HOURS) for i in range(900)]
    df = spark.createDataFrame(rows, (
        "station_id string, timestamp timestamp_ntz, energy_kwh double, "
        "predicted_utilization double, congestion_probability double, "
        "queue_length_proxy bigint, peak boolean"))
    df = df.withColumns({"hour_of_day": F.hour("timestamp"),
                         "is_peak_hour": F.col("peak").cast("int")}).drop("peak")
    return tariff.price_table(df).cache()


# scenarios

def test_tiers_follow_their_bounds(spark):
    df = spark.createDataFrame([(u,) for u in (None, -1.0, 0.0, 0.29, 0.3, 0.5, 0.7, 0.79, 0.8, 1.0, 3.0)],
                               "u double")
    assert [r[0] for r in df.select(scenarios.tier("u")).collect()] == [
        "off_peak", "off_peak", "off_peak", "off_peak", "low", "normal", "high", "high",
        "surge", "surge", "surge"]
    price = scenarios.tier_price("u", {**config.TIER_MULTIPLIERS, "surge": 2.0})
    assert df.select(price).collect()[-1][0] == 30.0


@pytest.mark.parametrize("unit,by", [(None, []), ("day", []), ("day", ["station_id"])])
def test_scenarios_in_one_pass_equal_runs_of_their_own(spark, priced, plan, unit, by):
    signals = monitor.add_feedback(monitor.period_metrics(priced, "day"))
    cases = {
        "baseline": scenarios.baseline_price(), "lookup": F.col("dynamic_tariff"),
        **scenarios.path_prices(monitor.multiplier_path(signals), "predicted_utilization"),
    }
    together = scenarios.scenario_metrics(priced, cases, unit=unit, by=by)
    text = plan(together)
    assert text.count("InMemoryTableScan") == 1 and "Join" not in text
    for name, price in cases.items():
        alone = monitor.period_metrics(priced.withColumn("dynamic_tariff", price), unit, by=by)
        own = together.filter(F.col("scenario") == name).drop("scenario")
        assert sorted(map(repr, own.select(alone.columns).collect())) == sorted(
            map(repr, alone.collect()))
    # no row is multiplied before the sums
    assert text.index("Generate") < text.index("HashAggregate")


# the lookup as an array

def test_own_lookup_is_not_joined(spark, plan):
    cells = tariff.tariff_lookup(spark).cache()
    rows = cells.select(F.col("hour").alias("hour_of_day"), (F.col("u_idx") / 10).alias(
        "predicted_utilization"), (F.col("c_idx") / 10).alias("congestion_probability"), "tariff_inr")
    priced = tariff.price_table(rows)
    assert "Join" not in plan(priced)
    assert priced.filter("not (dynamic_tariff <=> tariff_inr)").count() == 0
    odd = spark.createDataFrame([(None, None, None), (99, 7.0, -3.0), (-1, float("nan"), 0.5)],
                                "hour_of_day int, predicted_utilization double, "
                                "congestion_probability double")
    prices = lambda df: [r["dynamic_tariff"] for r in df.collect()]
    assert prices(tariff.price_table(odd)) == prices(tariff.price_table(odd, cells))


def test_foreign_lookups_are_checked(spark, plan):
    rows = spark.range(24).select(F.col("id").cast("int").alias("hour_of_day"))
    cell = lambda *prices: spark.createDataFrame(
        [(12, 5, 0, p) for p in prices] + [(77, 5, 0, 1.0)],
        "hour int, u_idx int, c_idx int, tariff_inr double")
    got = {r["hour_of_day"]: r["dynamic_tariff"] for r in
           tariff.price_table(rows, cell(20.0, 20.0)).collect()}
    assert len(got) == 24 and got[12] == 20.0 and got[3] == config.BASELINE_TARIFF
    with pytest.raises(Exception, match="several prices"):
        tariff.price_table(rows, cell(20.0, 21.0)).collect()


# places without a sort

NAMES = [None, "", "a", "aa", "ab", "aab", "S1", "S10", "S100", "é", "漢", "Station 000001",
         "Station 000002", "Station 000010", "Zz" * 20]


@pytest.mark.parametrize("seed", range(3))
def test_selected_cuts_are_those_of_the_sorted_table(spark, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    keys = {(rng.choice(NAMES), start + dt.timedelta(minutes=rng.randrange(90_000))) for _ in range(300)}
    keys |= {("S10", start + dt.timedelta(minutes=5 * i)) for i in range(250)}
    keys |= {(name, None) for name in rng.sample(NAMES, 4)}
    df = spark.createDataFrame(sorted(keys, key=repr), "station_id string, timestamp timestamp_ntz")
    order = sorted(keys, key=lambda k: (k[0] is None, (k[0] or "").encode(), k[1] is None,
                                        k[1] or start))
    ranks = {f"r{r}": r for r in {0, 1, len(keys) // 3, len(keys) - 1, len(keys), len(keys) + 5,
                                  *[rng.randrange(len(keys)) for _ in range(3)]}}
    cuts = selection.cuts_at(df, ranks)
    for name, rank in ranks.items():
        before = {tuple(r) for r in df.filter(cuts[name].after("station_id", "timestamp")).collect()}
        assert before == set(order[:rank])


def test_position_split_does_not_sort_the_table(spark, plan, priced):
    split = demand.split_by_position(priced.select("station_id", "timestamp", "energy_kwh"))
    assert not {"Sort", "Exchange", "Window"} & set(plan(split).replace("(", " ").split())
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"train": 630, "validation": 135, "test": 135}
    empty = demand.split_by_position(priced.limit(0))
    assert empty.count() == 0


# fall-backs of the features

def test_utilisation_null_throughout_is_worked_out(spark):
    rows = [("A", dt.datetime(2024, 1, 1, h), 1.0, None, 30.0, 60.0) for h in range(3)]
    schema = ("station_id string, timestamp timestamp_ntz, energy_kwh double, "
              "charger_utilization_rate double, charging_duration_min double, "
              "session_duration_min double")
    built = features.build_features(spark.createDataFrame(rows, schema), "day")
    assert {r["charger_utilization_rate"] for r in built.collect()} == {0.5}
    assert {r["charger_rolling_6h"] for r in built.collect()} == {0.5}
    some = [(*rows[0][:3], 0.25, *rows[0][4:]), *rows[1:]]
    built = features.build_features(spark.createDataFrame(some, schema), "day")
    assert sorted(r["charger_utilization_rate"] or 0 for r in built.collect()) == [0, 0, 0.25]


def test_lags_of_the_first_numeric_column(spark):
    rows = [("A", dt.datetime(2024, 1, 1, h), "x", h, 2.0 * h) for h in range(4)]
    df = spark.createDataFrame(rows, "station_id string, timestamp timestamp_ntz, note string, "
                                     "visits int, volume double")
    built = features.build_features(df, "day").orderBy("timestamp").collect()
    assert [r["demand_lag_1"] for r in built] == [None, 0, 1, 2]
    assert "energy_rolling_6h" not in built[0].asDict()


def test_engineered_columns_are_those_built(spark, priced):
    built = features.build_features(priced.drop("hour_of_day", "is_peak_hour"), "day")
    names = features.engineered_columns()
    assert set(names) <= set(built.columns) and len(names) == len(set(names)) == 21
    assert features.energy_columns() <= set(names)
