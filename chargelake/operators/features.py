"""Features of station-hours and sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from chargelake import config
from chargelake.functions.scalar import clip, floor_time, ratio, time_feature_columns
from chargelake.operators.ordered import (
    CHUNK, HISTORY, over_history, over_recent, running_total, time_chunk,
)


_UTILISATION = "charger_utilization_rate"
#: features of a row by itself: its revenue, cost, queue and occupancy
_OF_ROWS = ("revenue_per_session", "energy_cost_per_kwh", "queue_length_proxy",
            "occupancy_density")
#: columns that rolling means are taken of
_ROLLED = ("energy_kwh", _UTILISATION)


def _no_value() -> Column:
    return F.lit(None).cast("double")


def add_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(time_feature_columns(ts))


def charger_utilization(df: DataFrame, charging: str = "charging_duration_min",
                        total: str = "session_duration_min") -> Column:
    if not {charging, total} <= set(df.columns):
        return _no_value()
    return clip(ratio(charging, total), 0.0, 1.0)


def revenue(df: DataFrame, energy: str = "energy_kwh",
            tariff: float = config.BASELINE_TARIFF) -> Column:
    return F.col(energy) * tariff if energy in df.columns else _no_value()


def energy_cost(df: DataFrame, cost: str = "session_cost", energy: str = "energy_kwh") -> Column:
    return ratio(cost, energy) if cost in df.columns else F.lit(config.BASELINE_TARIFF)


def occupancy_from_chargers() -> Column:
    share = clip(ratio("active_chargers", "total_chargers"), 0.0, 1.0)
    return F.coalesce(share, F.lit(0.0))


def _with_rows_per_hour(df: DataFrame, station: str, ts: str) -> DataFrame:
    """Number of rows per station and hour, on every row; null where a key is null.

    Counts are made before the shuffle and joined back, so a crowded station-hour is
    never gathered for a window, and the join may split it.
    """
    keyed = df.withColumn("_hour", floor_time(ts, "hour"))
    counts = keyed.groupBy(station, "_hour").agg(F.count(ts).alias("_rows"))
    return keyed.join(counts, [station, "_hour"], "left").drop("_hour")


def queue_of_rows() -> Column:
    return clip(F.col("_rows") - 1, 0, None)


def occupancy_of_rows(chargers: int = 10) -> Column:
    return clip(F.col("_rows") / F.lit(float(chargers)), 0.0, 1.0)


def add_queue_length(df: DataFrame, station: str = "station_id", ts: str = "timestamp",
                     name: str = "queue_length_proxy") -> DataFrame:
    """Other rows at the same station in the same hour."""
    if not {station, ts} <= set(df.columns):
        return df.withColumn(name, F.lit(0).cast("bigint"))
    return (
        _with_rows_per_hour(df, station, ts)
        .select(*[c for c in df.columns if c != name], queue_of_rows().alias(name))
    )


def add_occupancy_density(df: DataFrame, station: str = "station_id", ts: str = "timestamp",
                          chargers: int = 10, name: str = "occupancy_density") -> DataFrame:
    """Rows at the same station in the same hour, as a share of its chargers."""
    if station not in df.columns:
        return df.withColumn(name, _no_value())
    density = occupancy_of_rows(chargers)
    return (
        _with_rows_per_hour(df, station, ts)
        .select(*[c for c in df.columns if c != name], density.alias(name))
    )


def _lags(target: str, lags: Sequence[int], window: WindowSpec) -> dict[str, Column]:
    return {f"demand_lag_{n}": F.lag(target, n).over(window) for n in lags}


def _rolling(targets: Sequence[str], sizes: Sequence[int], window: WindowSpec,
             mode: str = "rows") -> dict[str, Column]:
    def last(n: int) -> WindowSpec:
        if mode == "range":
            return window.rangeBetween(1 - n * 3_600_000_000, 0)
        return window.rowsBetween(1 - n, 0)

    return {f"{c.split('_')[0]}_rolling_{n}h": F.avg(c).over(last(n))
            for c in targets for n in sizes}


def _check_rolling_names(targets: Sequence[str]) -> None:
    stems = [c.split("_")[0] for c in targets]
    if len(set(stems)) < len(stems):
        raise ValueError(f"rolling targets {list(targets)} share the first word of their names")


def _keys(df: DataFrame, station: str | None) -> list[str]:
    return [station] if station and station in df.columns else []


def _usual_chunk(keys: Sequence[str]) -> str:
    """A year of hourly rows of one station, or an hour of all stations together."""
    return "year" if keys else "hour"


def add_lags(df: DataFrame, target: str = "energy_kwh", lags: Sequence[int] = config.LAGS,
             station: str | None = "station_id", order: Sequence[str] = ("timestamp",),
             chunk: str | None = None) -> DataFrame:
    """Value n rows earlier, per station or over the whole table."""
    keys = _keys(df, station)
    return over_history(
        df, keys, order, max(lags), [target],
        lambda window: _lags(target, lags, window), chunk or _usual_chunk(keys),
    )


def add_rolling(df: DataFrame, targets: Sequence[str] = ("energy_kwh",),
                sizes: Sequence[int] = config.ROLLING_ROWS,
                station: str | None = "station_id", order: Sequence[str] = ("timestamp",),
                chunk: str | None = None, mode: str = "rows") -> DataFrame:
    """Mean over the last n rows, the current one included; shorter at the start.

    With mode="range", over the rows of the last n hours instead: later than n hours before
    the row's time, up to that time, other rows of the same time included.
    """
    if mode not in ("rows", "range"):
        raise ValueError(f"unknown mode {mode!r}")
    present = [c for c in targets if c in df.columns]
    if not present:
        return df
    _check_rolling_names(present)
    keys = _keys(df, station)
    if mode == "range":
        return over_recent(
            df, keys, order[0], max(sizes), present,
            lambda window: _rolling(present, sizes, window, mode), chunk or _usual_chunk(keys),
        )
    return over_history(
        df, keys, order, max(max(sizes) - 1, 1), present,
        lambda window: _rolling(present, sizes, window), chunk or _usual_chunk(keys),
    )


def add_lags_and_rolling(df: DataFrame, target: str = "energy_kwh",
                         targets: Sequence[str] = _ROLLED,
                         station: str | None = "station_id",
                         order: Sequence[str] = ("timestamp",), chunk: str | None = None,
                         rows_per_hour: str | None = None) -> DataFrame:
    """Lags and rolling means from one window over one shuffle.

    `rows_per_hour` names a column for the number of rows of the station in the hour. For
    hourly tables, whose rows per station and hour are few, it needs no shuffle of its own.
    """
    present = [c for c in targets if c in df.columns]
    _check_rolling_names(present)
    keys = _keys(df, station)

    def build(window: WindowSpec) -> dict[str, Column]:
        columns = _lags(target, config.LAGS, window) | _rolling(
            present, config.ROLLING_ROWS, window)
        if rows_per_hour:
            hour = Window.partitionBy(*keys, CHUNK, floor_time(order[0], "hour"))
            own = F.when(~F.col(HISTORY), F.col(order[0]))
            columns[rows_per_hour] = F.when(
                F.col(order[0]).isNotNull(), F.count(own).over(hour))
        return columns

    return over_history(
        df, keys, order, max(config.LAGS), [target, *present], build,
        chunk or _usual_chunk(keys))


def sequence_windows(df: DataFrame, features: Sequence[str], target: str,
                     rows: int = config.SEQUENCE_ROWS, station: str | None = "station_id",
                     order: Sequence[str] = ("timestamp",), chunk: str | None = None) -> DataFrame:
    """The feature vectors of the `rows` rows before each row, with its target.

    Only rows with a full window are kept.
    """
    vector = F.array(*[F.col(c).cast("double") for c in features])
    keys = _keys(df, station)
    base = df.select(*keys, *order, F.col(target).alias("target"), vector.alias("_vector"))
    out = over_history(
        base, keys, order, rows, ["_vector"],
        lambda window: {"sequence": F.collect_list("_vector").over(window.rowsBetween(-rows, -1))},
        chunk or _usual_chunk(keys),
    )
    return out.filter(F.size("sequence") == rows).drop("_vector")


def add_session_overlap(df: DataFrame, station: str = "station_id",
                        start: str = "session_start", end: str = "session_end",
                        name: str = "overlapping_sessions", chunk: str = "day") -> DataFrame:
    """Number of other sessions at the station that share time with each session.

    Another session overlaps unless it ends by the start or starts at or after the end,
    so the number is (starts before the end) - (ends by the start) - 1. Both are running
    totals over the distinct instants of a station: no pairs are formed.
    """
    edges = F.explode(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("starts"), F.lit(0).alias("ends"),
                 F.lit(0).alias("points")),
        F.struct(F.col(end).alias("at"), F.lit(0).alias("starts"), F.lit(1).alias("ends"),
                 (F.col(start) >= F.col(end)).cast("int").alias("points")),
    ))
    both = F.col(start).isNotNull() & F.col(end).isNotNull()
    moments = (
        df.filter(both).select(station, edges.alias("e")).select(station, "e.*")
        .withColumn(CHUNK, time_chunk("at", chunk))
    )
    instants = moments.groupBy(station, CHUNK, "at").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"),
        F.sum("points").alias("points"))
    totals = running_total(
        instants, [station], CHUNK, "at", {"all_starts": "starts", "all_ends": "ends"}, moments
    )
    before_end = totals.filter("ends > 0").select(
        station, F.col("at").alias(end), (F.col("all_starts") - F.col("starts")).alias("_started")
    )
    by_start = totals.filter("starts > 0").select(
        station, F.col("at").alias(start), F.col("all_ends").alias("_ended"),
        F.col("points").alias("_points"))
    # a session of no length is among the ends, not the starts, and so are others like it
    itself = F.when(F.col(start) < F.col(end), F.lit(1)).otherwise(-F.col("_points"))
    overlap = F.when(both, F.greatest(F.col("_started") - F.col("_ended") - itself, F.lit(0)))
    return (
        df.join(before_end, [station, end], "left")
        .join(by_start, [station, start], "left")
        .select(*df.columns, overlap.alias(name))
    )


def engineered_columns() -> list[str]:
    """Names of the numeric features that build_features gives an hourly table."""
    window = Window.partitionBy("station_id").orderBy("timestamp")
    by_time = [c for c in time_feature_columns("timestamp") if c != "time_period"]
    return [*by_time, _UTILISATION, *_OF_ROWS, *_lags("energy_kwh", config.LAGS, window),
            *_rolling(_ROLLED, config.ROLLING_ROWS, window)]


def energy_columns() -> set[str]:
    """Those of the features that hold the energy of the same row."""
    window = Window.partitionBy("station_id").orderBy("timestamp")
    return {_OF_ROWS[0], *_rolling(["energy_kwh"], config.ROLLING_ROWS, window)}


def _lag_target(df: DataFrame) -> str:
    """The column that lags are taken of: energy, else the first numeric one."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if "energy_kwh" in numbers or not numbers:
        return "energy_kwh"
    return numbers[0]


def _with_utilisation(df: DataFrame) -> DataFrame:
    """The utilisation, worked out from the durations if there is none in the whole table."""
    computed = charger_utilization(df)
    if _UTILISATION not in df.columns:
        return df.withColumn(_UTILISATION, computed)
    if not {"charging_duration_min", "session_duration_min"} <= set(df.columns):
        return df
    # one number, which the plan works out first
    known = df.agg(F.count(_UTILISATION)).scalar()
    return df.withColumn(_UTILISATION, F.when(known == 0, computed).otherwise(F.col(_UTILISATION)))


def build_features(df: DataFrame, chunk: str = "year") -> DataFrame:
    """All features of the hourly table, which is read three times: pass a stored one.

    A queue counted on the sessions is kept, zero where a source has none. Without one, the
    rows per station and hour are counted here. A utilisation that is null throughout is
    worked out anew, and without energy lags are taken of the first numeric column.
    """
    target = _lag_target(df)
    df = _with_utilisation(df)
    ts = "timestamp" if "timestamp" in df.columns else "session_start"
    counted = "queue_length_proxy" in df.columns
    out = add_lags_and_rolling(
        df, target, _ROLLED, order=[ts], chunk=chunk, rows_per_hour=None if counted else "_rows")
    out = add_time_features(out, ts)
    queue = F.coalesce("queue_length_proxy", F.lit(0)) if counted else queue_of_rows()
    if {"active_chargers", "total_chargers"} <= set(out.columns):
        density = occupancy_from_chargers()
    elif counted:
        density = clip((queue + 1) / F.lit(10.0), 0.0, 1.0)
    else:
        density = occupancy_of_rows()
    values = (revenue(out), energy_cost(out), queue, density)
    return out.withColumns(dict(zip(_OF_ROWS, values))).drop("_rows")
