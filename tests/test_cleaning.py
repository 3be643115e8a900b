import datetime as dt

import pytest
from pyspark.sql import functions as F

from chargelake import schemas
from chargelake.operators import cleaning, reshape, rollup


@pytest.fixture
def raw(spark):
    t = "2024-01-01 {}:00"
    rows = [
        ("ok", "A", t.format("10:10"), t.format("11:10"), t.format("10:40"), 5.0),
        ("no done", "A", t.format("10:20"), t.format("10:50"), None, 7.0),
        ("no start", "A", None, t.format("10:50"), None, 1.0),
        ("no end", "A", t.format("10:30"), "garbage", None, 2.0),
        ("empty", "A", t.format("10:00"), t.format("10:00"), None, 2.0),
        ("backwards", "A", t.format("10:00"), t.format("09:00"), None, 2.0),
        ("null energy", "A", t.format("10:00"), t.format("11:00"), None, None),
        ("nan energy", "A", t.format("10:00"), t.format("11:00"), None, float("nan")),
        ("zero energy", "A", t.format("10:00"), t.format("11:00"), None, 0.0),
        ("negative energy", "A", t.format("10:00"), t.format("11:00"), None, -3.0),
        ("no station", None, t.format("10:00"), t.format("11:00"), None, 4.0),
    ]
    return spark.createDataFrame(
        rows, "sessionID STRING, stationID STRING, connectionTime STRING, "
        "disconnectTime STRING, doneChargingTime STRING, kWhDelivered DOUBLE")


def test_clean_sessions(raw):
    clean = {r["session_id"]: r for r in cleaning.clean_sessions(raw).collect()}
    assert set(clean) == {"ok", "no done", "no start", "no end", "no station"}
    assert clean["ok"]["session_duration_min"] == 60.0
    assert clean["ok"]["charging_duration_min"] == 30.0
    assert clean["no done"]["charging_duration_min"] == 30.0
    assert clean["no end"]["session_duration_min"] is None
    assert clean["ok"]["data_source"] == "ACN"


def test_clean_sessions_without_optional_columns(raw):
    few = raw.select("stationID", "connectionTime", "kWhDelivered")
    assert cleaning.clean_sessions(few).columns == [
        "station_id", "session_start", "energy_kwh", "data_source"]


def test_energy_filter_reaches_the_scan(raw, plan, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    stored = raw.sparkSession.read.parquet(str(tmp_path / "raw"))
    assert "GreaterThan(kWhDelivered,0.0)" in plan(cleaning.clean_sessions(stored))


def test_hourly_sessions(raw):
    hours = rollup.hourly_sessions(cleaning.clean_sessions(raw)).collect()
    assert len(hours) == 1  # rows without station or start belong to no hour
    hour = hours[0]
    assert hour["timestamp"] == dt.datetime(2024, 1, 1, 10)
    assert (hour["session_count"], hour["energy_kwh"]) == (3, 14.0)
    assert hour["avg_charging_min"] == 30.0
    assert hour["charger_utilization_rate"] == 1.0


def test_sum_without_values_is_zero(spark):
    df = spark.sql("SELECT 'A' AS station_id, TIMESTAMP_NTZ'2024-01-01 10:00:00' AS timestamp, "
                   "CAST(NULL AS DOUBLE) AS energy_kwh")
    row = rollup.hourly_rollup(df).first()
    assert (row["session_count"], row["total_energy_kwh"], row["avg_energy_kwh"]) == (0, 0.0, None)


def test_energy_is_preserved(raw):
    clean = cleaning.clean_sessions(raw).filter("station_id IS NOT NULL AND session_start IS NOT NULL")
    total = clean.agg(F.sum("energy_kwh")).first()[0]
    assert rollup.hourly_sessions(clean).agg(F.sum("energy_kwh")).first()[0] == total


def test_drop_null_columns_and_flatten(spark):
    df = spark.sql("""SELECT named_struct('$oid', 'x1') AS `_id`, 1 AS a,
                      CAST(NULL AS STRING) AS b""")
    out = cleaning.flatten_id(cleaning.drop_null_columns(df))
    assert out.columns == ["_id", "a"] and out.first()["_id"] == "x1"


@pytest.fixture
def grid_tables(spark):
    frame = spark.createDataFrame
    calendar = frame([(2024, 1, 1, 0, 5 * i, 0) for i in range(4)],
                     "year INT, month INT, day INT, hour INT, minute INT, second INT")
    volume = frame([(0, None, 1.0, None), (1, 2.0, None, None), (2, None, 3.0, None)],
                   "timestamp INT, `101` DOUBLE, `102` DOUBLE, `103` DOUBLE")
    occupancy = frame([(0, 1.0, 2.0, 0.0), (1, 9.0, None, 1.0), (3, 1.0, 1.0, 1.0)],
                      "timestamp INT, `101` DOUBLE, `102` DOUBLE, `103` DOUBLE")
    information = frame([(1, 101, 4, 0), (2, 102, 0, 1), (9, 101, 77, 1)],
                        "num INT, grid INT, count INT, CBD INT")
    return {"time": calendar, "volume": volume, "occupancy": occupancy,
            "information": information}


def test_grid_readings(grid_tables):
    readings = reshape.build_grid_readings(grid_tables)
    rows = {(r["grid_id"], r["timestamp"].minute): r for r in readings.collect()}
    assert len(rows) == 12  # the union of the instants of both measures, for three grids
    assert rows["101", 5]["volume_kwh"] == 2.0 and rows["101", 15]["volume_kwh"] is None
    assert rows["101", 0]["total_chargers"] == 4  # first of the duplicate attributes
    assert rows["103", 0]["total_chargers"] is None
    assert rows["102", 0]["station_id"] == "UV_102"


def test_clean_grid(grid_tables):
    clean = cleaning.clean_grid(reshape.build_grid_readings(grid_tables), chunk="hour")
    rows = {(r["grid_id"], r["timestamp"].minute): r for r in clean.collect()}
    assert [rows["101", m]["volume_kwh"] for m in (0, 5, 10, 15)] == [0.0, 2.0, 2.0, 2.0]
    assert [rows["103", m]["volume_kwh"] for m in (0, 5, 10, 15)] == [0.0] * 4
    assert rows["101", 5]["charger_utilization_rate"] == 1.0
    assert rows["102", 0]["charger_utilization_rate"] == 0.0  # no chargers
    assert rows["101", 5]["energy_kwh"] == 2.0
    hourly = rollup.hourly_grid(clean).collect()
    assert {r["station_id"]: r["energy_kwh"] for r in hourly} == {
        "UV_101": 6.0, "UV_102": 8.0, "UV_103": 0.0}


def test_matrix_with_its_own_index_origin(grid_tables):
    volume = grid_tables["volume"].withColumn("timestamp", F.col("timestamp") + 1)
    stamped = reshape.attach_calendar(volume, grid_tables["time"])
    assert sorted(r["timestamp"].minute for r in stamped.collect()) == [0, 5, 10]


def test_matrix_without_index_is_refused(grid_tables):
    with pytest.raises(ValueError):
        reshape.attach_calendar(grid_tables["volume"].drop("timestamp"), grid_tables["time"])


def test_unpivot_then_pivot_is_identity(grid_tables):
    wide = reshape.attach_calendar(grid_tables["volume"], grid_tables["time"])
    long = reshape.wide_to_long(wide, "v")
    assert long.count() == 9  # empty cells are kept
    back = long.groupBy("timestamp").pivot("grid_id", ["101", "102", "103"]).agg(F.max("v"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_merge_has_every_column(raw, grid_tables):
    left = rollup.hourly_sessions(cleaning.clean_sessions(raw))
    right = rollup.hourly_grid(cleaning.clean_grid(reshape.build_grid_readings(grid_tables)))
    merged = rollup.merge_sources(left, right)
    assert set(merged.columns) == set(left.columns) | set(right.columns)
    assert merged.count() == left.count() + right.count()
    assert merged.filter("data_source = 'UrbanEV' AND session_count IS NOT NULL").isEmpty()
    assert rollup.merge_sources(left.limit(0), right).count() == right.count()
    shared = rollup.common_columns(left, right)
    assert {"station_id", "timestamp", "energy_kwh", "data_source"} <= set(shared)
    ordered = [(r["station_id"], r["timestamp"]) for r in rollup.in_station_order(merged).collect()]
    assert ordered == sorted(ordered)


def test_source_split(raw):
    hours = rollup.hourly_sessions(cleaning.clean_sessions(raw))
    parts = cleaning.split_by_source(hours)
    assert parts["ACN"].count() == hours.count() and parts["UrbanEV"].isEmpty()


def test_pivot_mean(spark):
    df = spark.createDataFrame([(8, 0, 1.0), (8, 0, 3.0), (9, 6, 5.0)],
                               "hour_of_day INT, day_of_week INT, v DOUBLE")
    table = reshape.pivot_mean(df, "hour_of_day", "day_of_week", "v", reshape.WEEKDAYS)
    rows = {r["hour_of_day"]: r for r in table.collect()}
    assert rows[8]["Mon"] == 2.0 and rows[9]["Sun"] == 5.0 and rows[9]["Mon"] is None
    assert reshape.melt_pivot(table, "hour_of_day", "day", "mean").count() == 14


def test_grid_measures_are_named(grid_tables):
    assert set(schemas.GRID_MEASURES) <= set(schemas.GRID_TABLES)
