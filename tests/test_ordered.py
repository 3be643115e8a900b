"""Chunked computations against plain windows, with one station holding a third of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from chargelake.operators import features, ordered

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hours(spark):
    rng = random.Random(7)
    rows = []
    for station, share in [("HOT", 400), *[(f"S{i}", 40) for i in range(18)], ("LONE", 1)]:
        # long gaps, so that a look-back spans many chunks
        at = sorted(rng.sample(range(24 * 90), share))
        rows += [(station, START + dt.timedelta(hours=h),
                  None if rng.random() < 0.1 else round(rng.uniform(0, 50), 2),
                  rng.random()) for h in at]
    rows += [(None, START + dt.timedelta(hours=h), 1.0, 0.5) for h in range(30)]
    rows += [("S0", None, 3.0, 0.5)]
    return spark.createDataFrame(
        rows, "station_id STRING, timestamp TIMESTAMP_NTZ, energy_kwh DOUBLE, "
        "charger_utilization_rate DOUBLE").cache()


def rows_of(df):
    names = sorted(df.columns)
    out = []
    for r in df.select(*names).collect():
        out.append(tuple(round(v, 9) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk", ["hour", "day", "month"])
def test_lags_and_rolling(hours, chunk):
    w = Window.partitionBy("station_id").orderBy(F.col("timestamp").asc_nulls_last())
    known = F.col("station_id").isNotNull()
    expected = hours.withColumns(
        {f"demand_lag_{n}": F.when(known, F.lag("energy_kwh", n).over(w)) for n in (1, 2, 6, 24)}
        | {f"{s}_rolling_{n}h": F.when(known, F.avg(c).over(w.rowsBetween(1 - n, 0)))
           for s, c in (("energy", "energy_kwh"), ("charger", "charger_utilization_rate"))
           for n in (1, 6, 24)})
    got = features.add_lags_and_rolling(hours, chunk=chunk)
    assert rows_of(got) == rows_of(expected)
    assert got.columns == expected.columns


def test_lag_without_station(hours):
    rows = hours.filter("station_id IS NOT NULL AND timestamp IS NOT NULL")
    w = Window.orderBy("timestamp", "station_id")
    expected = rows.withColumn("demand_lag_2", F.lag("energy_kwh", 2).over(w))
    got = features.add_lags(rows, lags=[2], station=None, order=["timestamp", "station_id"],
                            chunk="day")
    assert rows_of(got) == rows_of(expected)


def test_rolling_of_one_row_is_the_value(hours):
    got = features.add_rolling(hours.filter("station_id IS NOT NULL"), sizes=[1], chunk="day")
    assert got.filter("NOT energy_rolling_1h <=> energy_kwh").isEmpty()


@pytest.mark.parametrize("chunk", ["hour", "day", "month"])
def test_rolling_over_true_hours(spark, hours, chunk):
    # a row a moment before and one of the same time: an open and a closed end
    odd = [("LONE", START + dt.timedelta(days=99, hours=h, microseconds=us), float(e), 0.5)
           for e, (h, us) in enumerate([(0, 0), (6, -1), (6, 0), (6, 0), (23, 999_999), (24, 0)])]
    table = hours.unionByName(spark.createDataFrame(odd, hours.schema))
    rows = table.collect()

    def mean(r, n):
        if r["station_id"] is None or r["timestamp"] is None:
            return None
        values = [x["energy_kwh"] for x in rows
                  if x["station_id"] == r["station_id"] and x["timestamp"] is not None
                  and x["energy_kwh"] is not None
                  and r["timestamp"] - dt.timedelta(hours=n) < x["timestamp"] <= r["timestamp"]]
        return round(sum(values) / len(values), 6) if values else None

    want = sorted((tuple(r) + tuple(mean(r, n) for n in (1, 6, 24)) for r in rows), key=repr)
    got = features.add_rolling(table, sizes=[1, 6, 24], chunk=chunk, mode="range")
    assert got.columns == [*table.columns, *[f"energy_rolling_{n}h" for n in (1, 6, 24)]]
    assert sorted((tuple(r)[:4] + tuple(None if v is None else round(v, 6) for v in tuple(r)[4:])
                   for r in got.collect()), key=repr) == want


def test_rolling_names_must_differ(hours):
    with pytest.raises(ValueError):
        features.add_rolling(hours.withColumn("energy_cost", F.lit(1.0)),
                             ["energy_kwh", "energy_cost"])


def test_carry_forward(hours):
    rows = hours.filter("timestamp IS NOT NULL AND station_id IS NOT NULL")
    w = Window.partitionBy("station_id").orderBy("timestamp").rowsBetween(
        Window.unboundedPreceding, 0)
    expected = rows.withColumn("energy_kwh", F.last("energy_kwh", True).over(w))
    got = ordered.carry_forward(rows, ["station_id"], "timestamp", ["energy_kwh"], "day")
    assert rows_of(got) == rows_of(expected)


def test_running_total(hours):
    rows = hours.filter("timestamp IS NOT NULL AND station_id IS NOT NULL").withColumn(
        "day", F.to_date("timestamp"))
    w = Window.partitionBy("station_id").orderBy("timestamp").rowsBetween(
        Window.unboundedPreceding, 0)
    expected = rows.withColumn("total", F.sum("charger_utilization_rate").over(w))
    got = ordered.running_total(rows, ["station_id"], "day", "timestamp",
                                {"total": "charger_utilization_rate"})
    assert rows_of(got) == rows_of(expected)


def test_position(hours):
    rows = hours.filter("station_id IS NOT NULL")
    got = ordered.with_position(rows, ["station_id", "timestamp"]).collect()
    far = dt.datetime.max
    expected = sorted(got, key=lambda r: (r["station_id"], r["timestamp"] or far))
    assert [r["position"] for r in expected] == list(range(len(got)))


def test_sequences(hours):
    rows = hours.filter("station_id IS NOT NULL AND timestamp IS NOT NULL").withColumn(
        "n", F.col("charger_utilization_rate") * 2)
    got = features.sequence_windows(
        rows, ["charger_utilization_rate", "n"], "charger_utilization_rate", rows=24,
        chunk="day").collect()
    by_station = {}
    for r in sorted(rows.collect(), key=lambda r: (r["station_id"], r["timestamp"])):
        by_station.setdefault(r["station_id"], []).append(r)
    assert len(got) == sum(max(0, len(v) - 24) for v in by_station.values())
    for r in got:
        history = by_station[r["station_id"]]
        i = next(i for i, h in enumerate(history) if h["timestamp"] == r["timestamp"])
        assert r["target"] == history[i]["charger_utilization_rate"]
        assert [x[0] for x in r["sequence"]] == [
            h["charger_utilization_rate"] for h in history[i - 24:i]]


@pytest.mark.parametrize("chunk", ["hour", "day"])
def test_session_overlap(spark, chunk):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        station = "HOT" if i % 3 == 0 else f"S{rng.randint(0, 9)}"
        start = START + dt.timedelta(minutes=rng.randint(0, 60 * 48))
        rows.append((i, station, start, start + dt.timedelta(minutes=rng.randint(1, 400))))
    rows.append((1000, "HOT", START, None))
    df = spark.createDataFrame(
        rows, "id INT, station_id STRING, session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ")
    got = {r["id"]: r["overlapping_sessions"]
           for r in features.add_session_overlap(df, chunk=chunk).collect()}
    whole = [r for r in rows if r[3]]
    for i, station, start, end in whole:
        assert got[i] == sum(
            1 for j, s, a, b in whole if j != i and s == station and a < end and b > start)
    assert got[1000] is None


def test_queue_and_occupancy(spark):
    df = spark.createDataFrame(
        [("A", START), ("A", START + dt.timedelta(minutes=59)), ("A", START + dt.timedelta(hours=1)),
         (None, START), ("A", None)] + [("B", START)] * 12,
        "station_id STRING, timestamp TIMESTAMP_NTZ")
    queue = features.add_queue_length(df).collect()
    at_a = [r["queue_length_proxy"] for r in queue if r["station_id"] == "A" and r["timestamp"]]
    assert sorted(at_a) == [0, 1, 1]
    assert {r["queue_length_proxy"] for r in queue if r["station_id"] == "B"} == {11}
    assert [r["queue_length_proxy"] for r in queue if not r["station_id"] or not r["timestamp"]] == [None, None]
    dense = features.add_occupancy_density(df).collect()
    assert {r["occupancy_density"] for r in dense if r["station_id"] == "B"} == {1.0}


def test_no_window_by_station_alone_over_rows(hours, plan):
    """Windows over the rows are cut by chunk; only chunk summaries are kept per station."""
    text = plan(features.add_lags_and_rolling(hours, chunk="day"))
    for line in text.splitlines():
        if "Window [lag(" in line:
            assert "[station_id#" in line and "_chunk#" in line.rsplit("], [", 2)[-2]
    assert "WindowGroupLimit" in text and "Python" not in text
