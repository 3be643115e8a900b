"""Models and the composed plans, end to end on small files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chargelake.operators import demand, rollup
from chargelake.operators.features import build_features
from chargelake.plans.pipeline import run_pipeline
from chargelake.plans.preprocess import preprocess
from chargelake.sources import readers, writers


@pytest.fixture(scope="module")
def hours(spark):
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for station in ("A", "B", "C"):
        for h in range(24 * 12):
            at = start + dt.timedelta(hours=h)
            level = 10 + 5 * (at.hour in (8, 9, 10, 17, 18)) + (station == "B") * 20
            rows.append((station, at, level + rng.random(), min(1.0, level / 40), "ACN"))
    return spark.createDataFrame(
        rows, "station_id STRING, timestamp TIMESTAMP_NTZ, energy_kwh DOUBLE, "
        "charger_utilization_rate DOUBLE, data_source STRING").cache()


@pytest.fixture(scope="module")
def featured(hours):
    return build_features(hours, "day").cache()


def test_features(featured):
    assert {"hour_of_day", "time_period", "revenue_per_session", "energy_cost_per_kwh",
            "queue_length_proxy", "occupancy_density", "demand_lag_24", "energy_rolling_24h",
            "charger_rolling_6h"} <= set(featured.columns)
    row = featured.filter("demand_lag_24 IS NOT NULL").first()
    assert row["revenue_per_session"] == pytest.approx(row["energy_kwh"] * 15)
    assert (row["queue_length_proxy"], row["occupancy_density"]) == (0, 0.1)


def test_model_features_do_not_leak(featured):
    names = demand.model_features(featured, "energy_kwh")
    assert "revenue_per_session" not in names and "demand_lag_1" in names
    assert "revenue_per_session" in demand.model_features(featured, "energy_kwh", leak_free=False)
    plain = featured.select("station_id", F.col("energy_kwh").alias("y"),
                            F.col("energy_kwh").alias("x"))
    assert demand.model_features(plain, "y") == ["x"]


@pytest.mark.parametrize("split", [demand.split_by_time, demand.split_by_position])
def test_split_is_complete_and_in_order(featured, split):
    rows = split(featured).collect()
    n = len(rows)
    counts = {s: sum(r["split"] == s for r in rows) for s in ("train", "validation", "test")}
    assert sum(counts.values()) == n == featured.count()
    key = (lambda r: r["timestamp"]) if split is demand.split_by_time else (
        lambda r: (r["station_id"], r["timestamp"]))
    parts = {s: [key(r) for r in rows if r["split"] == s] for s in counts}
    assert max(parts["train"]) < min(parts["validation"])
    assert max(parts["validation"]) < min(parts["test"])
    if split is demand.split_by_position:
        assert counts["train"] == int(n * 0.7)
        assert counts["validation"] == int(n * 0.15)


@pytest.fixture(scope="module")
def trained(featured):
    names = demand.model_features(featured, "energy_kwh")
    prepared = demand.prepare(featured, "energy_kwh", names).cache()
    models = {
        "random_forest": demand.train(prepared, names, demand.random_forest(10, 5)),
        "gradient_boosting": demand.train(
            prepared, names, demand.gradient_boosting(5, 3, 0.3, use_validation=True)),
    }
    return names, prepared, models


def test_models(spark, trained):
    names, prepared, models = trained
    table = demand.evaluate_all(models, prepared)
    rows = {r["model"]: r for r in table.collect()}
    assert set(rows) == set(models) and all(r["R2"] > 0.5 for r in rows.values())
    best = demand.best_model(table).first()
    assert best["RMSE"] == min(r["RMSE"] for r in rows.values())
    top = demand.feature_importance(spark, models["random_forest"], names, top=5).collect()
    weights = [r["importance"] for r in top]
    assert len(top) == 5 and weights == sorted(weights, reverse=True)


def test_model_errors_and_importances_are_those_of_the_predictions(spark):
    rng = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for h in range(1200):
        a, b, c = rng.random(), rng.random(), rng.random()
        rows.append((f"S{h % 3}", start + dt.timedelta(hours=h), 20 * a + 6 * (b > 0.5), a, b, c))
    table = spark.createDataFrame(rows, "station_id string, timestamp timestamp_ntz, "
                                        "energy_kwh double, strong double, weak double, none double")
    names = ["none", "strong", "weak"]
    prepared = demand.prepare(table, "energy_kwh", names).cache()
    for regressor in (demand.random_forest(20, 6), demand.gradient_boosting(20, 4, 0.3)):
        model = demand.train(prepared, names, regressor)
        got = demand.evaluate_all({"m": model}, prepared).first()
        test = [(r["actual"], r["prediction"]) for r in demand.predict(
            model, prepared.filter("split = 'test'")).collect()]
        assert len(test) == 180
        mean = sum(y for y, _ in test) / len(test)
        squares = sum((y - p) ** 2 for y, p in test)
        assert got["RMSE"] == pytest.approx((squares / len(test)) ** 0.5)
        assert got["MAE"] == pytest.approx(sum(abs(y - p) for y, p in test) / len(test))
        assert got["R2"] == pytest.approx(1 - squares / sum((y - mean) ** 2 for y, _ in test))
        assert got["R2"] > 0.8
        order = [r["feature"] for r in demand.feature_importance(spark, model, names).collect()]
        assert order == ["strong", "weak", "none"]
    early = demand.train(prepared, names, demand.gradient_boosting(200, 3, 0.5))
    assert early.stages[-1].getNumTrees < 200


def test_models_survive_a_round_trip(trained, tmp_path):
    _, prepared, models = trained
    writers.save_models(models, str(tmp_path))
    test = prepared.filter("split = 'test'")
    for name, model in models.items():
        back = writers.load_model(str(tmp_path), name)
        assert demand.predict(model, test).exceptAll(demand.predict(back, test)).isEmpty()


@pytest.fixture(scope="module")
def files(tmp_path_factory, spark):
    """A session file and a folder of grid matrices for eight days."""
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    lines = ["sessionID,stationID,connectionTime,disconnectTime,doneChargingTime,kWhDelivered"]
    for i in range(1500):
        a = start + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 8))
        lines.append(f"{i},ST{i % 4},{a},{a + dt.timedelta(minutes=rng.randint(10, 90))},,"
                     f"{rng.uniform(1, 30):.2f}")
    (folder / "sessions.csv").write_text("\n".join(lines))
    grid = folder / "grid"
    grid.mkdir()
    steps = [start + dt.timedelta(minutes=5 * i) for i in range(12 * 24 * 8)]
    (grid / "time.csv").write_text("year,month,day,hour,minute,second\n" + "\n".join(
        f"{t.year},{t.month},{t.day},{t.hour},{t.minute},{t.second}" for t in steps))
    for name, scale in (("volume", 10), ("occupancy", 8), ("price", 2)):
        (grid / f"{name}.csv").write_text("timestamp,101,102\n" + "\n".join(
            f"{i},{rng.random() * scale:.3f},{'' if rng.random() < 0.2 else round(rng.random() * scale, 3)}"
            for i in range(len(steps))))
    (grid / "information.csv").write_text("num,grid,count,CBD\n1,101,10,1\n2,102,5,0\n")
    return folder


def test_preprocess_needs_a_source():
    with pytest.raises(ValueError):
        preprocess(None, None)


def test_one_source_is_enough(spark, files):
    sessions = readers.read_sessions(spark, str(files / "sessions.csv"))
    only = preprocess(sessions, None)
    assert {r[0] for r in only.select("data_source").distinct().collect()} == {"ACN"}
    grid = preprocess(None, readers.read_grid_tables(spark, str(files / "grid")))
    assert grid.count() == 2 * 24 * 8


def test_pipeline_end_to_end(spark, files, tmp_path):
    regressors = {"random_forest": demand.random_forest(5, 4)}
    out = str(tmp_path / "run")
    result = run_pipeline(spark, out, str(files / "sessions.csv"), str(files / "grid"),
                          regressors=regressors)
    assert {r[0] for r in result.features.select("data_source").distinct().collect()} == {
        "ACN", "UrbanEV"}
    evaluation = result.tariff_metrics.first()
    gain = (evaluation["dynamic_revenue_INR"] / evaluation["baseline_revenue_INR"] - 1) * 100
    assert evaluation["revenue_gain_pct"] == pytest.approx(gain, abs=0.01)
    assert result.schedule.count() == 264
    periods = result.periods.collect()
    assert len(periods) in (8, 9)
    assert all(9 <= r["pricing_efficiency"] <= 30 for r in periods)
    r2 = result.demand_metrics.first()["R2"]
    expected = "RETRAIN" if r2 < 0.6 else "FINE_TUNE"
    assert {r["demand_feedback"]["action"] for r in periods} == {expected}
    assert result.multipliers.count() == 5 * len(periods)
    exported = spark.read.csv(f"{out}/feedback_signals", header=True)
    assert exported.count() == len(periods) and "tariff_feedback_action" in exported.columns

    again = run_pipeline(spark, out, skip_preprocessing=True, skip_features=True,
                         regressors=regressors)
    assert again.tariff_metrics.first() == evaluation


def test_facts_are_never_gathered_in_one_task(featured, plan):
    """No window without partition keys and no Python operator in the feature plan."""
    text = plan(build_features(featured.select(
        "station_id", "timestamp", "energy_kwh", "charger_utilization_rate", "data_source"), "day"))
    assert "SinglePartition" not in text and "Python" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_energy_survives_the_rollup(hours):
    total = hours.agg(F.sum("energy_kwh")).first()[0]
    again = rollup.hourly_rollup(hours).agg(F.sum("total_energy_kwh")).first()[0]
    assert again == pytest.approx(total)
