import json

import pytest
from pyspark.sql import functions as F

from chargelake.operators import cleaning, tariff
from chargelake.sources import readers, writers

RECORDS = [
    {"_id": {"$oid": "a1"}, "sessionID": "1", "stationID": "S", "kWhDelivered": 2.5,
     "connectionTime": "Wed, 25 Apr 2018 11:08:04 GMT",
     "disconnectTime": "Wed, 25 Apr 2018 12:08:04 GMT", "doneChargingTime": None},
    {"_id": {"$oid": "a2"}, "sessionID": "2", "stationID": "S", "kWhDelivered": 3.5,
     "connectionTime": "2018-04-25 11:30:00", "disconnectTime": "2018-04-25 11:45:00"},
]


@pytest.mark.parametrize("document", [
    RECORDS, {"data": RECORDS}, {r["sessionID"]: r for r in RECORDS},
])
def test_json_documents(spark, tmp_path, document):
    path = tmp_path / "sessions.json"
    path.write_text(json.dumps(document))
    raw = readers.read_sessions(spark, str(tmp_path / "absent.csv"), str(path))
    rows = sorted(cleaning.clean_sessions(cleaning.flatten_id(raw)).collect(),
                  key=lambda r: r["session_id"])
    assert [r["_id"] for r in rows] == ["a1", "a2"]
    assert [r["session_duration_min"] for r in rows] == [60.0, 15.0]
    assert [r["energy_kwh"] for r in rows] == [2.5, 3.5]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "sessions.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    raw = readers.read_sessions(spark, json_path=str(path), lines=True)
    assert cleaning.clean_sessions(raw).count() == 2


def test_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "sessions.csv"
    path.write_text("kWhDelivered,extra,stationID,connectionTime,disconnectTime\n"
                    "2.5,x,S,2018-04-25 11:00:00,2018-04-25 11:30:00\n"
                    "bad,x,S,2018-04-25 11:00:00,2018-04-25 11:30:00\n")
    clean = cleaning.clean_sessions(readers.read_sessions(spark, str(path))).collect()
    assert [(r["station_id"], r["energy_kwh"], r["extra"]) for r in clean] == [("S", 2.5, "x")]


def test_missing_files_give_no_rows(spark, tmp_path):
    raw = readers.read_sessions(spark, str(tmp_path / "a.csv"), str(tmp_path / "a.json"))
    assert raw.isEmpty() and "kWhDelivered" in raw.columns
    assert readers.read_grid_tables(spark, str(tmp_path)) == {}


def test_csv_with_dates(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("timestamp,v\n2024-01-01 10:00:00,1.5\nnever,2\n")
    df = readers.read_csv(spark, str(path), {"v": "double"}, ["timestamp"])
    assert dict(df.dtypes) == {"timestamp": "timestamp_ntz", "v": "double"}
    assert df.filter("timestamp IS NULL").count() == 1


def test_convert_raw_sessions(spark, tmp_path):
    df = spark.sql("""SELECT named_struct('$oid', 'x') AS `_id`, 'S' AS stationID,
                      CAST(NULL AS STRING) AS userInputs""")
    writers.convert_raw_sessions(df, str(tmp_path / "json"), str(tmp_path / "csv"))
    back = readers.read_csv(spark, str(tmp_path / "csv")).first()
    assert back.asDict() == {"_id": "x", "stationID": "S"}
    assert spark.read.json(str(tmp_path / "json")).first()["_id"] == "x"


def test_stage_is_pruned_by_source(spark, tmp_path, plan):
    df = spark.range(10).withColumn(
        "data_source", F.when(F.col("id") < 7, "ACN").otherwise("UrbanEV"))
    writers.write_stage(df, str(tmp_path / "s"), ["data_source"])
    part = readers.read_stage(spark, str(tmp_path / "s")).filter("data_source = 'ACN'")
    assert part.count() == 7
    text = plan(part)
    assert "PartitionFilters: [isnotnull(data_source" in text


def test_lookup_round_trip(spark, tmp_path):
    lookup = tariff.tariff_lookup(spark)
    writers.save_lookup(lookup, str(tmp_path / "lookup"))
    back = writers.load_lookup(spark, str(tmp_path / "lookup"))
    assert back.exceptAll(lookup).isEmpty() and back.count() == tariff.LOOKUP_CELLS


@pytest.mark.parametrize("text", ['[{"stationID": "S"}, {"stationID"', '{"a": {"stationID": "S"}, "meta": 3}'])
def test_broken_json_document_raises(spark, tmp_path, text):
    path = tmp_path / "sessions.json"
    path.write_text(text)
    with pytest.raises(Exception, match="session records"):
        readers.read_sessions_json(spark, str(path)).collect()


def test_json_document_after_white_space(spark, tmp_path):
    path = tmp_path / "sessions.json"
    path.write_text("\n\t " + json.dumps(RECORDS) + "\n")
    assert readers.read_sessions_json(spark, str(path)).count() == 2
    path.write_text("\n")
    assert readers.read_sessions_json(spark, str(path)).count() == 0


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "sessions.csv"
    path.write_text('a,b,stationID,kWhDelivered\n1,"[{""x"": 1, ""y"": ""u, v""}]",S1,2.5\n'
                    '2,"two\nlines",S2,3.5\n')
    rows = readers.read_sessions_csv(spark, str(path), multiline=True).collect()
    assert [(r["b"], r["stationID"], r["kWhDelivered"]) for r in rows] == [
        ('[{"x": 1, "y": "u, v"}]', "S1", 2.5), ("two\nlines", "S2", 3.5)]
    frame = spark.createDataFrame([('say "hi", you', 1)], "t string, n int")
    writers.write_csv(frame, str(tmp_path / "out"))
    assert readers.read_csv(spark, str(tmp_path / "out"), {"n": "int"}).collect() == frame.collect()
