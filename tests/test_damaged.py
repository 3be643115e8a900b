"""Damaged input: good rows stay, everything else comes out once, with its place."""

import json

import pytest
from pyspark.sql import functions as F

from chargelake.sources import damaged, numbering, readers


def line(i, **more):
    return json.dumps({"sessionID": str(i), "stationID": "S", "kWhDelivered": 1.5,
                       "connectionTime": "2024-01-01 10:00:00"} | more)


def rejects(checked, *columns):
    return sorted((tuple(r) for r in checked.rejects.select(
        *(columns or ("place", "kind", "field", "text"))).collect()), key=repr)


def ids(df):
    return sorted(r["sessionID"] for r in df.select("sessionID").collect())


LINES = [
    line(1), line(2)[:20], line(3) + " " + line(30), line(4) + "," + line(40), "", "  ",
    line(5, kWhDelivered="2.5"), line(6, kWhDelivered="much"), f"[{line(7)}, 3, null, {line(8)}]",
    "null", "12", '"text"', line(9) + "]", line(10, connectionTime="never", kWhDelivered="x"),
    "[]", "{}", line(11, _id={"$oid": "a\"{}["}), f"[{line(12)}] [{line(13)}]", line(14, kWhDelivered=None),
]


@pytest.fixture
def lines_file(tmp_path):
    path = tmp_path / "s.jsonl"
    path.write_text("﻿" + "\n".join(LINES) + "\n")
    return str(path)


def test_json_lines_account_for_every_line(spark, lines_file):
    checked = damaged.check_json_lines(spark, lines_file)
    rows = {r["sessionID"]: r for r in checked.rows.collect()}
    assert set(rows) == {"1", "5", "6", "7", "8", "10", None, "11", "14"}
    assert rows["5"]["kWhDelivered"] == 2.5 and rows["6"]["kWhDelivered"] is None
    assert json.loads(rows["11"]["_id"]) == {"$oid": "a\"{}["}
    want = [(n + 1, kind, None, LINES[n]) for n, kind in (
        (1, "line"), (2, "surplus"), (3, "surplus"), (9, "line"), (10, "line"), (11, "line"),
        (12, "surplus"), (17, "surplus"))]
    want += [(8, "field", "kWhDelivered", "much"), (9, "record", None, "3"),
             (9, "record", None, "null"), (14, "field", "connectionTime", "never"),
             (14, "field", "kWhDelivered", "x")]
    assert rejects(checked) == sorted(want, key=repr)
    assert {r["file"].rsplit("/", 1)[1] for r in checked.rejects.collect()} == {"s.jsonl"}


def test_places_do_not_depend_on_splits(spark, tmp_path):
    for name in ("b", "a", "c d"):
        with open(tmp_path / f"{name}.jsonl", "w") as file:
            file.writelines((line(i) if i % 50 else f"bad {name} {i}") + "\n" for i in range(1000))
    for size in ("4k", "1m", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            checked = damaged.check_json_lines(spark, str(tmp_path))
            got = rejects(checked, "place", "text")
            numbers = numbering.in_file_order(spark.read.text(str(tmp_path)), "n")
            order = [r["value"] for r in numbers.orderBy("n").collect()]
            largest = max(r["n"] for r in numbers.collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == sorted((i + 1, f"bad {n} {i}") for n in ("a", "b", "c d")
                             for i in range(0, 1000, 50)) or got == sorted(
            ((i + 1, f"bad {n} {i}") for n in ("a", "b", "c d") for i in range(0, 1000, 50)), key=repr)
        assert largest == 2999 and len(order) == 3000
        assert [x for x in order if x.startswith("bad")] == [
            f"bad {n} {i}" for n in ("a", "b", "c d") for i in range(0, 1000, 50)]


@pytest.mark.parametrize("document,good,found", [
    (f"[{line(1)}, {line(2)}]", ["1", "2"], []),
    ('{"data": [%s, 5]}' % line(1), ["1"], [(2, "record", None, "5")]),
    ('{"a": %s, "b": [1], "a": %s}' % (line(1), line(2)), ["1", "2"], [(2, "record", None, "[1]")]),
    (f"[{line(1)}] [{line(2)}]", [], "surplus"),
    ('{"data": [%s]}\n{"data": []}' % line(1), [], "surplus"),
    (f"[{line(1)}, {line(2)[:-3]}", [], "document"),
    ("12", [], "document"),
    (f"[{line(1, kWhDelivered='a lot')}]", ["1"], [(1, "field", "kWhDelivered", "a lot")]),
    ("[]", [], []), (" \n", [], []), ("", [], []),
])
def test_json_documents(spark, tmp_path, document, good, found):
    path = tmp_path / "s.json"
    path.write_text(document)
    checked = damaged.check_json_documents(spark, str(path))
    assert ids(checked.rows) == good
    if isinstance(found, str):
        found = [(0, found, None, document)]
    assert rejects(checked) == found
    fatal = [f for f in found if f[1] != "field"]
    if fatal:
        with pytest.raises(Exception, match="not a document of session records"):
            readers.read_sessions_json(spark, str(path)).collect()
    else:
        assert ids(readers.read_sessions_json(spark, str(path))) == good


def test_strict_lines_fail_on_damage(spark, lines_file, tmp_path):
    with pytest.raises(Exception, match="not a line of session records"):
        readers.read_sessions_json(spark, lines_file, lines=True).collect()
    good = tmp_path / "good.jsonl"
    good.write_text("\n".join([line(1), line(2, kWhDelivered="2.5")]))
    assert [r["kWhDelivered"] for r in readers.read_sessions_json(
        spark, str(good), lines=True).orderBy("sessionID").collect()] == [1.5, 2.5]


CSV = '''sessionID,stationID,kWhDelivered,connectionTime
1,"a, ""b""",2.5,2024-01-01 10:00:00
2,S,3
3,S,3,2024-01-01,4
4,"S,3,2024-01-01
5,S,3,"2024-01-01

6,S,many,2024-01-01 10:00:00
7,S,,never
'''


def test_csv_accounts_for_every_line(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(CSV)
    checked = damaged.check_sessions_csv(spark, str(path))
    rows = sorted(map(tuple, checked.rows.collect()))
    assert rows == [("1", 'a, "b"', 2.5, "2024-01-01 10:00:00"),
                    ("6", "S", None, "2024-01-01 10:00:00"), ("7", "S", None, "never")]
    lines = CSV.split("\n")
    assert rejects(checked) == sorted(
        [(n, "line", None, lines[n - 1]) for n in (3, 4, 5, 6)]
        + [(8, "field", "kWhDelivered", "many"), (9, "field", "connectionTime", "never")], key=repr)


def test_csv_records_over_several_lines(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text('a,b\n1,"x\ny"\n2\n3,z\n')
    checked = damaged.check_csv(spark, str(path), {"a": "int"}, multiline=True)
    assert sorted(map(tuple, checked.rows.collect())) == [(1, "x\ny"), (3, "z")]
    assert rejects(checked) == [(2, "line", None, "2")]
    assert rejects(damaged.check_csv(spark, str(path), multiline=True)) == [(2, "line", None, "2")]


def test_csv_files_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n")
    (tmp_path / "b.csv").write_text("a,b,c\n4,5,6\n")
    assert damaged.check_csv(spark, str(tmp_path)).rows.count() == 2
    (tmp_path / "c.csv").write_text("b,a,c\n4,5,6\n")
    with pytest.raises(Exception, match="another header"):
        damaged.check_csv(spark, str(tmp_path)).rows.collect()


def test_dead_letters_replace_those_of_the_same_source(spark, tmp_path, lines_file):
    letters = str(tmp_path / "letters")
    for _ in range(2):
        rows = readers.read_sessions_checked(spark, letters, json_path=lines_file, lines=True)
    assert rows.count() == 9
    stored = spark.read.parquet(letters)
    assert stored.count() == 13 and {r[0] for r in stored.select("source").collect()} == {"sessions"}
    with pytest.raises(damaged.DamagedInput, match="damaged"):
        damaged.raise_on(stored)
    damaged.raise_on(stored.filter("kind = 'field'"))
    assert readers.read_sessions_checked(spark, letters, str(tmp_path / "no.csv")).isEmpty()


def test_matrices_without_index_meet_the_calendar_by_position(spark, tmp_path):
    hours = range(48)
    calendar = ["year,month,day,hour"] + [f"2024,1,{1 + h // 24},{h % 24}" for h in hours]
    (tmp_path / "time.csv").write_text("\n".join(calendar))
    (tmp_path / "volume.csv").mkdir()
    for part in range(4):
        (tmp_path / "volume.csv" / f"part-{part}.csv").write_text("\n".join(
            ["102,104"] + [f"{h},{100 + h}" for h in hours[12 * part:12 * part + 12]]))
    from chargelake.operators.reshape import build_grid_readings
    for size in ("64", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            readings = build_grid_readings(readers.read_grid_tables(spark, str(tmp_path)))
            got = {(r["grid_id"], r["timestamp"].day, r["timestamp"].hour): r["volume_kwh"]
                   for r in readings.collect()}
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert got == {(g, 1 + h // 24, h % 24): float(h + add)
                       for h in hours for g, add in (("102", 0), ("104", 100))}


def test_numbering_has_no_window(spark, tmp_path, plan):
    (tmp_path / "a.txt").write_text("x\ny\n")
    numbers = numbering.in_file_order(spark.read.text(str(tmp_path)), "n")
    assert "Window" not in plan(numbers) and numbers.filter(F.col("n") == 1).count() == 1
