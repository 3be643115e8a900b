import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chargelake.operators import profile, quantiles


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    # group "hot" holds most rows and one value a third of them
    rows = [("hot", 7.25) for _ in range(300)]
    rows += [("hot", round(rng.lognormvariate(2, 2), 2)) for _ in range(500)]
    rows += [("small", rng.uniform(-50, 50)) for _ in range(101)]
    rows += [("one", 3.0), ("small", None)]
    return spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(6).cache()


def by_group(values):
    out = {}
    for r in values.collect():
        if r["v"] is not None:
            out.setdefault(r["g"], []).append(r["v"])
    return out


SHARES = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def test_quantiles_per_group(values):
    got = {r["g"]: r for r in quantiles.quantiles(values, "v", SHARES, ["g"]).collect()}
    for g, v in by_group(values).items():
        assert got[g]["rows"] == len(v)
        for name, share in SHARES.items():
            assert got[g][name] == pytest.approx(float(np.quantile(v, share)), abs=1e-9)


def test_quantiles_of_the_table(values):
    got = quantiles.quantiles(values, "v", SHARES).first()
    everything = [x for v in by_group(values).values() for x in v]
    for name, share in SHARES.items():
        assert got[name] == pytest.approx(float(np.quantile(everything, share)), abs=1e-9)


def test_magnitude_slot_never_falls(spark):
    rows = [-1e308, -1e9, -3.0, -1e-5, 0.0, 1e-9, 1e-4, 0.3, 0.3001, 1.0, 5e5, 1.7e9, 1e308]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i INT, v DOUBLE")
    slots = [r[0] for r in df.orderBy("i").select(quantiles.magnitude_slot(F.col("v"))).collect()]
    assert slots == sorted(slots)


def test_winsorise(values):
    got = quantiles.winsorise(values, "v", 0.95, ["g"]).collect()
    groups = by_group(values)
    for g, v in groups.items():
        cap = float(np.quantile(v, 0.95))
        expected = sorted(float(np.clip(x, 0, cap)) for x in v)
        assert sorted(r["v"] for r in got if r["g"] == g and r["v"] is not None) == pytest.approx(expected)
    assert sum(r["v"] is None for r in got) == 1
    whole = quantiles.winsorise(values, "v", 0.5).agg(F.max("v")).first()[0]
    assert whole == pytest.approx(float(np.quantile([x for v in groups.values() for x in v], 0.5)))


def test_cumulative_share(values):
    got = quantiles.cumulative_share(values, "v").orderBy("v").collect()
    everything = sorted(x for v in by_group(values).values() for x in v)
    assert [r["v"] for r in got] == sorted(set(everything))
    for r in got:
        upto = sum(x <= r["v"] for x in everything)
        assert r["cumulative_share"] == pytest.approx(upto / len(everything))
    assert got[-1]["cumulative_share"] == 1.0


def test_histogram(values):
    hot = values.filter("g = 'small'")
    got = {r["bin"]: r["rows"] for r in quantiles.histogram(hot, "v", 10).collect()}
    counts, _ = np.histogram(by_group(values)["small"], bins=10)
    assert [got.get(i, 0) for i in range(10)] == counts.tolist()


def test_histogram_of_a_constant_and_of_nothing(values):
    one = quantiles.histogram(values.filter("g = 'one'"), "v", 50).collect()
    assert [(r["bin"], r["rows"]) for r in one] == [(25, 1)]
    assert quantiles.histogram(values.filter("g = 'none'"), "v").isEmpty()


def test_box_statistics(values):
    got = {r["g"]: r for r in profile.box_statistics(values, ["g"], "v").collect()}
    for g, v in by_group(values).items():
        bounded = np.clip(v, 0, np.quantile(v, 0.95))
        expected = [bounded.min(), *np.quantile(bounded, [0.25, 0.5, 0.75]), bounded.max()]
        assert [got[g][c] for c in ("minimum", "q1", "median", "q3", "maximum")] == (
            pytest.approx(expected))


def test_period_distribution_and_volatility(values):
    named = values.withColumnsRenamed({"g": "time_period", "v": "energy_kwh"})
    got = {r["time_period"]: r for r in profile.period_distribution(named).collect()}
    vol = {r["time_period"]: r for r in profile.volatility(named).collect()}
    for g, v in by_group(values).items():
        bounded = np.clip(v, 0, np.quantile(v, 0.95))
        assert got[g]["mean"] == pytest.approx(bounded.mean())
        assert got[g]["median"] == pytest.approx(np.quantile(bounded, 0.5))
        if len(v) > 1:
            assert vol[g]["std"] == pytest.approx(np.std(v, ddof=1))
            assert vol[g]["cv"] == pytest.approx(np.std(v, ddof=1) / np.mean(v) * 100)
    assert vol["one"]["std"] is None


def test_correlation_is_pairwise_complete(spark):
    rng = random.Random(1)
    data = {c: [rng.random() if rng.random() > 0.2 else None for _ in range(200)] for c in "abc"}
    data["k"] = [15.0] * 200
    frame = pd.DataFrame(data)
    df = spark.createDataFrame(
        [tuple(None if x is None or x != x else float(x) for x in r)
         for r in frame.itertuples(index=False)],
        "a DOUBLE, b DOUBLE, c DOUBLE, k DOUBLE")
    expected = frame.astype(float).corr()
    got = {(r["a"], r["b"]): r["r"]
           for r in profile.correlation_matrix(df, ["a", "b", "c", "k", "absent"]).collect()}
    assert len(got) == 16
    for (x, y), r in got.items():
        want = expected.loc[x, y]
        assert r is None if math.isnan(want) else r == pytest.approx(want)


def test_quality_report(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', NULL), (1, NULL, NULL), (3, 'b', NULL)
                      AS t(n, s, empty)""").withColumn("empty", F.col("empty").cast("double"))
    for exact in (True, False):
        rows = {r["column"]: r for r in profile.quality_report(df, exact).collect()}
        assert (rows["n"]["dtype"], rows["n"]["unique"], rows["n"]["sample"]) == ("int", 2, "1")
        assert (rows["s"]["null_count"], rows["s"]["null_pct"]) == (1, 33.33)
        assert (rows["empty"]["non_null"], rows["empty"]["unique"]) == (0, 0)
    nothing = profile.quality_report(df.limit(0)).collect()
    assert all(r["non_null"] == 0 and r["null_pct"] is None for r in nothing)


def test_small_profiles(spark):
    df = spark.createDataFrame(
        [("A", dt.datetime(2024, 1, 31, 23), 2.0, 0.1), ("B", dt.datetime(2024, 2, 1, 0), 3.0, 0.9),
         ("B", dt.datetime(2024, 2, 1, 1), None, 0.3), ("B", dt.datetime(2024, 2, 1, 1), 1.0, 0.8)],
        "station_id STRING, timestamp TIMESTAMP_NTZ, energy_kwh DOUBLE, u DOUBLE")
    months = {r["month"].month: r["energy_kwh"] for r in profile.energy_by_time(df, "month").collect()}
    assert months == {1: 2.0, 2: 4.0}
    bands = profile.band_shares(df, "u").first()
    assert (bands["discount_pct"], bands["surge_pct"], bands["normal_pct"]) == (25.0, 25.0, 50.0)
    ranges = profile.range_profile(df).first()
    assert (ranges["rows"], ranges["stations"], ranges["missing_energy"]) == (4, 2, 1)
    summary = {r["column"]: r for r in profile.numeric_summary(df).collect()}
    assert (summary["energy_kwh"]["non_null"], summary["energy_kwh"]["mean"]) == (3, 2.0)
    assert {r["s"]: r["rows"] for r in profile.value_counts(df, F.col("station_id"), "s").collect()} == {"A": 1, "B": 3}
    assert profile.mean_by(df, "station_id", "energy_kwh", "m").count() == 2


def test_near_equal_values_are_not_ordered_in_one_task(spark, tmp_path):
    """100,000 values within a tenth of a percent: exact ranks, small windows."""
    df = spark.range(100_000).select((F.lit(1e6) + F.pmod(F.col("id") * 7919, F.lit(100_000)) / 100)
                                     .alias("v"))
    got = quantiles.values_at_ranks(
        df, "v", {"low": lambda n: F.lit(0), "mid": lambda n: F.floor(n / 2)}).first()
    assert (got["rows"], got["low"], got["mid"]) == (100_000, 1e6, 1e6 + 500.0)
    shares = quantiles.cumulative_share(df, "v").orderBy("v").collect()
    assert [r["cumulative_share"] for r in shares[:3]] == [1e-5, 2e-5, 3e-5]
    assert len(shares) == 100_000 and shares[-1]["cumulative_share"] == 1.0
    slots = df.select(quantiles.magnitude_slot(F.col("v")).alias("s")).distinct().count()
    assert slots == 1
