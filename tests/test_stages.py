"""Bucketed and incremental stages: the same rows as plain ones, with less work."""

import os
import random
import re
import subprocess
import sys
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chargelake.operators.cleaning import clean_sessions
from chargelake.operators.features import build_features
from chargelake.operators.ordered import CHUNK
from chargelake.operators.rollup import hourly_sessions
from chargelake.plans import incremental
from chargelake.plans.incremental import SessionStages, Update
from chargelake.session import stored
from chargelake.sources.bucketed import co_partitioned, write_bucketed
from chargelake.sources.readers import read_sessions_csv


def same(left, right):
    right = right.select(left.columns)
    return left.exceptAll(right).count() == right.exceptAll(left).count() == 0


# bucketed tables

@pytest.fixture(scope="module")
def merged(spark):
    rng = random.Random(8)
    rows = [(None if i % 211 == 0 else "HOT" if rng.random() < 0.4 else f"S{rng.randrange(9)}", i)
            for i in range(4000)]
    at = F.timestamp_add("HOUR", "i", F.lit("2024-01-01").cast("timestamp_ntz"))
    df = spark.createDataFrame(rows, "station_id string, i int").withColumn("timestamp", at)
    df = df.withColumns({
        "energy_kwh": F.when(F.col("i") % 17 > 0, F.col("i") * 0.5),
        "charger_utilization_rate": (F.col("i") % 10) / 10, "queue_length_proxy": F.col("i") % 3,
        "data_source": F.lit("ACN")}).drop("i")
    return stored(df, "merged")


def exchanges_above(text, scan):
    """Names of the nodes between the root and a scan, from the plan's indentation."""
    lines = text.splitlines()
    depth = lambda line: len(re.match(r"[\s:|+-]*", line).group())
    at = next(i for i, line in enumerate(lines) if scan(line))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    return [line for line in above if "Exchange" in line]


def test_features_of_a_bucketed_stage_move_no_rows(spark, merged, plan, tmp_path):
    name = f"b{uuid.uuid4().hex}"
    stage = write_bucketed(merged, name, str(tmp_path / "b"), 8)
    built = build_features(stage.read(spark), "month")
    text = plan(built)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert all("Bucketed: true" in line for line in scans)
    # the fact side is the scan that reads every column
    assert not exchanges_above(text, lambda line: "FileScan" in line and "data_source" in line)
    assert same(build_features(merged, "month"), built.drop(CHUNK))
    assert sum(1 for n in os.listdir(tmp_path / "b") if n.endswith(".parquet")) <= 8


def test_predictions_join_a_bucketed_stage(spark, merged, plan, tmp_path):
    name = f"b{uuid.uuid4().hex}"
    stage = write_bucketed(merged, name, str(tmp_path / "b"), 8)
    predictions = merged.filter("station_id <> 'S3'").select(
        "station_id", "timestamp", F.lit(0.5).alias("predicted"))
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with co_partitioned(spark):
            joined = stage.join(spark, predictions)
            text = plan(joined)
            got = stored(joined, "joined")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    assert not exchanges_above(text, lambda line: "Bucketed: true" in line)
    assert same(merged.join(predictions, ["station_id", "timestamp"], "left"), got.drop(CHUNK))


# incremental stages

HEADER = "sessionID,stationID,connectionTime,disconnectTime,doneChargingTime,kWhDelivered"


def sessions_file(folder, name, month, stations=("A", "B"), days=range(1, 28, 2), seed=1, year=2024):
    rng = random.Random(f"{name}{seed}")
    lines = [HEADER]
    for station in stations:
        for day in days:
            hour = rng.randrange(20)
            at = f"{year}-{month:02d}-{day:02d} {hour:02d}:{rng.randrange(60):02d}:00"
            end = f"{year}-{month:02d}-{day:02d} {hour + 2:02d}:00:00"
            lines.append(f"{name}-{station}-{day},{station},{at},{end},,{rng.randrange(1, 90)}.5")
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def full(spark, source):
    raw = read_sessions_csv(spark, [str(p) for p in sorted(source.iterdir())])
    clean = stored(clean_sessions(raw), "full")
    hours = stored(hourly_sessions(clean), "full-hours")
    return clean, hours, build_features(hours, "month")


def check(spark, source, stages):
    for kept, whole in zip((stages.sessions(), stages.hours(), stages.features()),
                           full(spark, source)):
        assert same(whole, kept)


def written(folder):
    return {name: max(f.stat().st_mtime_ns for f in (folder / "features" / name).iterdir())
            for name in os.listdir(folder / "features") if "=" in name}


@pytest.fixture
def source(tmp_path):
    source = tmp_path / "in put"
    for m in range(1, 8):
        sessions_file(source, f"m{m}.csv", m)
    # a station with few rows a month, so that features look back over many months
    for m in range(1, 8):
        sessions_file(source, f"c{m}.csv", m, ["C"], [3, 9] if m != 4 else [3])
    return source


def test_stages_follow_their_source_files(spark, source, tmp_path):
    folder = tmp_path / "stages"
    stages = SessionStages(spark, str(source), str(folder))
    first = stages.update()
    assert len(first.read) == 14 and len(first.months) == 7 and not first.skipped
    check(spark, source, stages)

    before = written(folder)
    assert stages.update() == Update() and stages.update().skipped
    assert written(folder) == before

    # a late file: its month and those whose features look back into it
    sessions_file(source, "late.csv", 2, ["A", "C"], [5])
    late = stages.update()
    assert [os.path.basename(f) for f in late.read] == ["late.csv"]
    assert late.months == ["2024-02"]
    assert late.feature_months == [f"2024-{m:02d}" for m in range(2, 8)]
    after = written(folder)
    assert after["ym=2024-01"] == before["ym=2024-01"]
    check(spark, source, stages)

    # without the station that looks back far, later months stay
    for m in range(1, 8):
        (source / f"c{m}.csv").unlink()
    (source / "late.csv").unlink()
    gone = stages.update()
    assert len(gone.gone) == 8 and not gone.read
    check(spark, source, stages)
    before = written(folder)
    sessions_file(source, "late.csv", 3, ["A"], [5])
    assert stages.update().feature_months == ["2024-03", "2024-04", "2024-05"]
    after = written(folder)
    assert {m for m in after if after[m] != before[m]} == {"ym=2024-03", "ym=2024-04", "ym=2024-05"}
    check(spark, source, stages)


def test_changed_and_emptied_months(spark, source, tmp_path):
    stages = SessionStages(spark, str(source), str(tmp_path / "stages"))
    stages.update()
    time.sleep(0.01)
    sessions_file(source, "m6.csv", 9, seed=2)      # its rows move from June to September
    (source / "c6.csv").unlink()
    changed = stages.update()
    assert changed.months == ["2024-06", "2024-09"]
    assert not (tmp_path / "stages" / "hours" / "ym=2024-06").exists()
    check(spark, source, stages)
    # a file of no rows left
    (source / "m6.csv").write_text(HEADER + "\n")
    assert stages.update().months == ["2024-09"]
    check(spark, source, stages)
    assert stages.update().skipped


@pytest.mark.parametrize("breaks_at", ["hours", "manifest"])
def test_an_update_that_broke_off_is_made_good(spark, source, tmp_path, monkeypatch, breaks_at):
    stages = SessionStages(spark, str(source), str(tmp_path / "stages"))
    stages.update()
    sessions_file(source, "late.csv", 2, ["A"], [5])
    with monkeypatch.context() as patch:
        rewrite, write = SessionStages._rewrite, SessionStages._write_version

        def failing(self, name, *rest):
            if name == breaks_at:
                raise RuntimeError("lost")
            return (write if name in ("pending", "manifest") else rewrite)(self, name, *rest)

        patch.setattr(SessionStages, "_rewrite", failing)
        patch.setattr(SessionStages, "_write_version", failing)
        with pytest.raises(RuntimeError):
            stages.update()
    # meanwhile the late file moves to another month
    time.sleep(0.01)
    sessions_file(source, "late.csv", 5, ["A"], [5])
    again = stages.update()
    assert again.months == ["2024-02", "2024-05"]
    check(spark, source, stages)
    assert stages.update().skipped


def test_intermediates_go_at_the_end_of_the_application(tmp_path):
    code = (
        "from chargelake.session import build_session, stored\n"
        f"spark = build_session(master='local[1]', **{{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "print(*stored(spark.range(3), 'short').inputFiles())\n"
    )
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=Path(__file__).resolve().parents[1])
    assert str(tmp_path) in run.stdout
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_months_of_missing_times(spark):
    df = spark.createDataFrame([(None,)], "t timestamp")
    assert df.select(incremental.month("t")).first()[0] == "none"
