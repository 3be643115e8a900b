import datetime as dt

import pytest
from pyspark.sql import functions as F

from chargelake.functions import scalar as s


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("value, expected", [(None, None), (-0.1, 0.0), (0.4, 0.4), (7.0, 1.0)])
def test_clip_keeps_null(spark, value, expected):
    assert one(spark, s.clip(F.lit(value).cast("double"), 0.0, 1.0)) == expected


@pytest.mark.parametrize("value, digits, expected", [
    (2.5, 0, 2.0), (3.5, 0, 4.0), (0.125, 2, 0.12), (6424.33499999999999, 2, 6424.34),
    (0.52343749999999999, 6, 0.523438), (-1.005, 1, -1.0),
])
def test_half_even(spark, value, digits, expected):
    assert one(spark, s.half_even(F.lit(value), digits)) == expected


@pytest.mark.parametrize("value, expected", [
    (None, None), (-0.3, 0), (0.05, 0), (0.15, 2), (0.25, 2), (0.35, 4), (0.3, 3), (1.7, 10),
])
def test_tenth_index_rounds_half_to_even(spark, value, expected):
    assert one(spark, s.tenth_index(F.lit(value).cast("double"))) == expected


def test_ratio_by_zero_is_null(spark):
    assert one(spark, s.ratio(F.lit(1.0), F.lit(0.0))) is None


@pytest.mark.parametrize("text, expected", [
    ("2018-04-25 11:08:04", dt.datetime(2018, 4, 25, 11, 8, 4)),
    ("2018-04-25T11:08:04.5", dt.datetime(2018, 4, 25, 11, 8, 4, 500000)),
    ("2018-04-25 11:08:04+00:00", dt.datetime(2018, 4, 25, 11, 8, 4)),
    ("Wed, 25 Apr 2018 11:08:04 GMT", dt.datetime(2018, 4, 25, 11, 8, 4)),
    ("not a time", None), ("", None), (None, None),
])
def test_parse_time(spark, text, expected):
    assert one(spark, s.parse_time(F.lit(text).cast("string"))) == expected


def test_floor_time_and_minutes(spark):
    ts = F.lit("2024-03-10 02:37:41.25").cast("timestamp_ntz")
    floors = [one(spark, s.floor_time(ts, u)) for u in ("year", "month", "day", "hour")]
    assert floors == [dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1),
                      dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 10, 2)]
    assert one(spark, s.floor_minutes(ts, 5)) == dt.datetime(2024, 3, 10, 2, 35)
    earlier = F.lit("2024-03-09 23:07:11.25").cast("timestamp_ntz")
    assert one(spark, s.minutes_between(earlier, ts)) == pytest.approx(210.5)
    assert one(spark, s.minutes_between(ts, earlier)) == pytest.approx(-210.5)


def test_time_does_not_depend_on_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        # half past two does not exist in that zone on this day
        ts = F.lit("2024-03-10 02:37:41").cast("timestamp_ntz")
        later = F.lit("2024-03-10 03:37:41").cast("timestamp_ntz")
        text = one(spark, s.floor_time(ts, "hour").cast("string"))
        assert text == "2024-03-10 02:00:00"
        assert one(spark, s.minutes_between(ts, later)) == 60.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_time_features(spark):
    days = spark.sql("""SELECT * FROM VALUES
        (TIMESTAMP_NTZ'2024-01-01 08:00:00'), (TIMESTAMP_NTZ'2024-01-06 12:00:00'),
        (TIMESTAMP_NTZ'2024-01-07 23:00:00') AS t(ts)""")
    rows = days.select(*[c.alias(n) for n, c in s.time_feature_columns("ts").items()]).collect()
    assert [r["day_of_week"] for r in rows] == [0, 5, 6]
    assert [r["is_weekend"] for r in rows] == [0, 1, 1]
    assert [r["is_peak_hour"] for r in rows] == [1, 0, 0]
    assert [r["time_period"] for r in rows] == ["peak", "shoulder", "off_peak"]


def test_periods_cover_the_day(spark):
    rows = spark.range(24).select(s.time_period(F.col("id")).alias("p"))
    counts = {r["p"]: r["n"] for r in rows.groupBy("p").agg(F.count("*").alias("n")).collect()}
    assert counts == {"peak": 8, "shoulder": 9, "off_peak": 7}


def test_gain_from_zero_is_infinite(spark):
    assert one(spark, s.gain_percent(F.lit(0.0), F.lit(3.0))) == float("inf")
    assert one(spark, s.gain_percent(F.lit(2.0), F.lit(3.0))) == 50.0


def test_oid(spark):
    assert one(spark, s.oid_text(F.lit('{"$oid":"5a"}'))) == "5a"
    assert one(spark, s.oid_text(F.lit("5a"))) == "5a"


@pytest.mark.parametrize("text,hour", [
    ("2018-04-25T11:08:04+08:00", 3), ("2018-04-25T11:08:04-07:00", 18),
    ("2018-04-25 11:08:04Z", 11), ("2018-04-25T11:08:04", 11),
    ("Wed, 25 Apr 2018 11:08:04 GMT", 11), ("Wed, 25 Apr 2018 11:08:04 +0200", 9),
    ("Wed, 25 Apr 2018 11:08:04", 11), ("junk", None), ("", None),
])
def test_parse_time_keeps_the_zone(spark, text, hour):
    found = one(spark, s.parse_time(F.lit(text)))
    assert (found.hour if found else None) == hour
