"""Scalar column expressions with the null, rounding and time rules used throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chargelake import config


def as_column(value: Column | str | float | int) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def clip(value: Column | str, low: float | None, high: float | None) -> Column:
    """Bound a value; null stays null (greatest and least alone would skip it)."""
    column = as_column(value)
    bounded = column
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(column.isNotNull(), bounded)


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Division whose result is null for a zero divisor."""
    return F.try_divide(as_column(top), as_column(bottom))


def without_nan(value: Column | str) -> Column:
    column = as_column(value)
    return F.when(~F.isnan(column), column)


def half_even(value: Column, digits: int) -> Column:
    """Round half to even by scaling, the way array libraries round doubles.

    The last bits of a distributed sum depend on the order of its parts. Four more places
    are rounded first, so that a value half way between two results is always seen as such.
    """
    snapped = F.rint(value * F.lit(10.0 ** (digits + 4))) / F.lit(1e4)
    return F.rint(snapped) / F.lit(10.0 ** digits)


def tenth_index(value: Column | str) -> Column:
    """Nearest tenth of a share as an index 0..10."""
    return clip(F.rint(as_column(value) * 10), 0.0, 10.0).cast("int")


def floor_time(ts: Column | str, unit: str) -> Column:
    """Start of the hour, day, month or year as TIMESTAMP_NTZ, whatever the session zone."""
    ts = as_column(ts).cast("timestamp_ntz")
    one, zero = F.lit(1), F.lit(0)
    parts = [
        F.year(ts),
        F.month(ts) if unit != "year" else one,
        F.dayofmonth(ts) if unit in ("day", "hour") else one,
        F.hour(ts) if unit == "hour" else zero,
    ]
    if unit not in ("year", "month", "day", "hour"):
        raise ValueError(f"unknown time unit {unit!r}")
    return F.make_timestamp_ntz(*parts, zero, zero)


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    ts = as_column(ts).cast("timestamp_ntz")
    slot = (F.floor(F.minute(ts) / minutes) * minutes).cast("int")
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), slot, F.lit(0)
    )


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Signed minutes from start to end as a double."""
    gap = as_column(end) - as_column(start)
    seconds = F.extract(F.lit("SECOND"), gap).cast("double")
    whole = (
        F.extract(F.lit("DAY"), gap) * 1440
        + F.extract(F.lit("HOUR"), gap) * 60
        + F.extract(F.lit("MINUTE"), gap)
    )
    return whole.cast("double") + seconds / 60.0


def parse_time(text: Column | str) -> Column:
    """ISO or RFC-1123 text to TIMESTAMP_NTZ; anything else becomes null.

    Text with a zone or offset gives the time in UTC, text without one the time it names.
    The usual text, ISO without a zone, is told by its shape and cast at once.
    """
    text = F.trim(as_column(text))
    usual = (F.substring(text, 5, 1) == "-") & (
        F.translate(F.substring(text, 11, 64), "T0123456789:. ", "") == "")

    def utc(moment: Column) -> Column:
        return F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))

    # "Wed, 25 Apr 2018 11:08:04 GMT" without its weekday
    rfc = F.regexp_replace(text, r"^[A-Za-z]{3}, ", "")
    zoned = F.coalesce(
        F.when(text.rlike(r"\d:\d.*(Z|[+-]\d\d?(:?\d\d)?| ?[A-Za-z]+(/[A-Za-z_]+)?)$"),
               text.try_cast("timestamp")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss xx")),
        F.try_to_timestamp(rfc, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]xx")),
    )
    plain = F.coalesce(
        text.try_cast("timestamp_ntz"),
        F.try_to_timestamp(rfc, F.lit("d MMM yyyy HH:mm:ss")).cast("timestamp_ntz"))
    return F.when(usual, text.try_cast("timestamp_ntz")).otherwise(F.coalesce(utc(zoned), plain))


def time_period(hour: Column | str) -> Column:
    hour = as_column(hour)
    return (
        F.when(hour.isin(config.PEAK_HOURS), "peak")
        .when(hour.isin(config.SHOULDER_HOURS), "shoulder")
        .otherwise("off_peak")
    )


def time_of_use_factor(hour: Column | str) -> Column:
    period = time_period(hour)
    return (
        F.when(period == "peak", config.PEAK_FACTOR)
        .when(period == "off_peak", config.OFF_PEAK_FACTOR)
        .otherwise(1.0)
    )


def time_feature_columns(ts: Column | str) -> dict[str, Column]:
    """hour_of_day, day_of_week (Monday 0), weekend and peak flags, month, day, period."""
    ts = as_column(ts)
    hour, weekday = F.hour(ts), F.weekday(ts)
    return {
        "hour_of_day": hour,
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
        "is_peak_hour": hour.isin(config.PEAK_HOURS).cast("int"),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
        "time_period": time_period(hour),
    }


def gain_percent(old: Column, new: Column) -> Column:
    """Relative change in percent; plus infinity when the old value is zero."""
    return F.when(old == 0, F.lit(float("inf"))).otherwise(ratio(new - old, old) * 100)


def oid_text(value: Column | str) -> Column:
    """The id inside text of the form {"$oid": ...}; any other text is passed through."""
    text = as_column(value)
    return F.coalesce(F.get_json_object(text, "$['$oid']"), text)
