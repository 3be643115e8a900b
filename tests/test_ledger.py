"""The ledger of cleaning: right counts from the cleaning pass, rows as without it."""

import datetime as dt
import uuid

import pytest

from chargelake.operators import cleaning, ledger

RAW = ("sessionID string, stationID string, connectionTime string, disconnectTime string, "
       "doneChargingTime string, kWhDelivered double")
A, B, C = "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 10:30:00"
ROWS = [
    ("1", "S", A, B, C, 2.0), ("2", "S", A, B, None, 2.0), ("3", "S", A, B, "soon", 2.0),
    ("4", "S", A, B, C, None), ("5", "S", A, B, C, float("nan")), ("6", "S", A, B, C, 0.0),
    ("7", "S", A, B, C, -1.0), ("8", "S", B, A, C, 2.0), ("9", "S", A, A, C, 2.0),
    ("10", "S", B, A, C, None), ("11", "S", B, A, C, -1.0), ("12", "S", "never", B, C, 2.0),
    ("13", "S", None, " ", None, 2.0),
]
WANT = {
    ("sessions", "all", "in"): 13, ("sessions", "energy_missing", "dropped"): 3,
    ("sessions", "duration_not_positive", "dropped"): 3,
    ("sessions", "energy_not_positive", "dropped"): 2, ("sessions", "connectionTime", "unread"): 1,
    ("sessions", "disconnectTime", "unread"): 0, ("sessions", "doneChargingTime", "unread"): 1,
    ("sessions", "charging_duration", "filled"): 2, ("sessions", "all", "out"): 5,
}


def jobs(spark, run):
    group = f"ledger-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_sessions_are_counted_in_the_cleaning_pass(spark, tmp_path):
    raw = spark.createDataFrame(ROWS, RAW)
    kept = ledger.Ledger()
    clean = ledger.clean_sessions(raw, kept)
    plain = cleaning.clean_sessions(raw)
    assert clean.columns == plain.columns
    write = lambda df, name: df.write.parquet(str(tmp_path / name))
    counted = jobs(spark, lambda: (write(clean, "a"), kept.entries()))
    assert counted == jobs(spark, lambda: write(plain, "b"))
    assert {tuple(e[:3]): e[3] for e in kept.entries()} == WANT
    assert kept.reconciles() and kept.entries(recount=True) == kept.entries()
    assert spark.read.parquet(str(tmp_path / "a")).exceptAll(plain).count() == 0
    assert plain.exceptAll(spark.read.parquet(str(tmp_path / "a"))).count() == 0


def test_counts_that_do_not_reconcile_are_counted_anew(spark):
    kept = ledger.Ledger()
    ledger.clean_sessions(spark.createDataFrame(ROWS, RAW), kept).collect()
    right = kept.entries()
    doubled = lambda recount=False: right if recount else [(*right[0][:3], 26), *right[1:]]
    kept.entries = doubled
    assert not kept.reconciles()
    assert sorted(tuple(r) for r in kept.table(spark).collect()) == sorted(right)


def test_missing_columns_and_empty_tables(spark):
    for df in (spark.createDataFrame(ROWS, RAW).limit(0),
               spark.createDataFrame([("1", 2.0), ("2", None)], "sessionID string, kWhDelivered double"),
               spark.createDataFrame([("1",)], "sessionID string")):
        kept = ledger.Ledger()
        clean = ledger.clean_sessions(df, kept)
        assert sorted(clean.collect()) == sorted(cleaning.clean_sessions(df).collect())
        assert kept.reconciles()


@pytest.mark.parametrize("chunk", ["hour", "month"])
def test_grid_cells_are_counted(spark, chunk):
    day = dt.datetime(2024, 1, 1)
    cells = [("A", 0, None, 1.0), ("A", 1, 2.0, None), ("A", 2, None, float("nan")), ("A", 3, 4.0, 9.0),
             ("B", 0, None, None), ("B", 1, None, 2.0)]
    df = spark.createDataFrame(
        [(s, day + dt.timedelta(hours=h), v, a, 4 if s == "A" else 0) for s, h, v, a in cells],
        "station_id string, timestamp timestamp_ntz, volume_kwh double, active_chargers double, "
        "total_chargers int")
    kept = ledger.Ledger()
    out = sorted(ledger.clean_grid(df, kept, chunk=chunk).collect())
    assert out == sorted(cleaning.clean_grid(df, chunk=chunk).collect())
    got = {(rule, effect): n for _, rule, effect, n in kept.entries()}
    assert got == {("all", "in"): 6, ("all", "out"): 6, ("volume_kwh", "filled"): 1,
                   ("volume_kwh", "zeroed"): 3, ("active_chargers", "filled"): 2,
                   ("active_chargers", "zeroed"): 1, ("charger_utilization_rate", "zeroed"): 2}
    assert kept.reconciles()
