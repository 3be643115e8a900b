"""The registered queries: every operator over whole given tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


from chargelake.functions.scalar import half_even, parse_time
from chargelake.operators import (
    cleaning, demand, features as feat, metrics, monitor, profile, quantiles, reshape, rollup,
    scenarios, sketches, tariff,
)
from chargelake.operators.ledger import Ledger, clean_grid, clean_sessions
from chargelake.plans import analytics, incremental
from chargelake.session import scratch_path, stored
from chargelake.sources import bucketed, damaged, numbering, readers, writers
from chargelake.testbed import mapping as m

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a number of places, so that the order of a sum does not show."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: half_even(F.col(f"`{c}`"), digits) + 0.0 for c in doubles})


# sessions

@query
def session_clean(spark, sf_dir):
    return rounded(cleaning.clean_sessions(m.raw_sessions(spark, sf_dir)).drop("_id"))


@query
def drop_null_columns(spark, sf_dir):
    raw = m.raw_sessions(spark, sf_dir).withColumns({
        "userInputs": F.lit(None).cast("string"), "siteID": F.lit(None).cast("string"),
    })
    return cleaning.flatten_id(cleaning.drop_null_columns(raw))


@query
def json_sessions(spark, sf_dir):
    path = scratch_path(spark, "json_sessions")
    writers.write_json(m.raw_sessions(spark, sf_dir), path)
    raw = readers.read_sessions(spark, json_path=path, lines=True)
    return rounded(cleaning.flatten_id(cleaning.clean_sessions(raw)).select(
        "_id", "session_id", "station_id", "session_start", "session_end", "energy_kwh",
        "session_duration_min", "charging_duration_min"))


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv_roundtrip")
    writers.write_csv(m.raw_sessions(spark, sf_dir), path)
    raw = readers.read_csv(spark, path, {"kWhDelivered": "double"}, ["connectionTime"])
    return raw.select("sessionID", "stationID", "connectionTime", "kWhDelivered")


def _record_texts(spark, sf_dir):
    """Events as JSON session records, with their number in `id`."""
    energy = F.col("value").cast("decimal(18,4)").cast("string")
    return m.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.concat(
            F.lit('{"sessionID":"'), F.col("event_id").cast("string"), F.lit('","kWhDelivered":'),
            F.when(F.col("event_id") % 97 == 3, F.lit('"n/a"'))
            .when(F.col("event_id") % 97 == 4, F.concat(F.lit('"'), energy, F.lit('"')))
            .otherwise(energy), F.lit("}")).alias("text"))


def _accounted(checked):
    """Good rows and rejects in one table; the file and place of a reject change with the run."""
    good = checked.rows.select(
        F.lit("row").alias("kind"), "sessionID", F.col("kWhDelivered").alias("energy_kwh"),
        F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("text"))
    return good.unionByName(checked.rejects.select(
        "kind", "field", "text"), allowMissingColumns=True)


@query
def json_damaged(spark, sf_dir):
    """Lines that are cut, doubled, lists, or hold damaged and quoted numbers."""
    text, case = F.col("text"), F.col("id") % 97
    line = (
        F.when(case == 0, F.substring(text, 1, 12))
        .when(case == 1, F.concat(text, F.lit(" "), text))
        .when(case == 2, F.concat(F.lit("["), text, F.lit(",7]"))).otherwise(text)
    )
    path = scratch_path(spark, "json_damaged")
    _record_texts(spark, sf_dir).select(line.alias("value")).write.text(path)
    return _accounted(damaged.check_json_lines(spark, path))


@query
def json_documents(spark, sf_dir):
    """Documents of about 500 records, one to a file: lists, maps and {"data": [...]}.

    Each ends with an element that is no record; of ten, one is cut and one is followed by
    a second list.
    """
    records = _record_texts(spark, sf_dir)
    documents = F.lit(records.count() // 500 + 10)
    number = F.pmod(F.col("id"), documents)
    form, state = F.col("document") % 3, F.col("document") % 10
    entry = F.when(form == 1, F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('":'), "text"))
    body = records.withColumn("document", number).select(
        "document", F.lit(1).alias("part"), "id",
        F.concat(F.coalesce(entry, F.col("text")), F.lit(",")).alias("value"))
    ends = spark.range(records.count() // 500 + 10).select(F.col("id").alias("document"))
    first = ends.select("document", F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("id"),
                        F.when(form == 0, "[").when(form == 1, "{").otherwise('{"data":[')
                        .alias("value"))
    close = F.when(form == 0, "5]").when(form == 1, '"end":5}').otherwise("5]}")
    last = ends.select(
        "document", F.lit(2).alias("part"), F.lit(0).cast("bigint").alias("id"),
        F.when(state == 8, "").when(state == 9, F.concat(close, F.lit(" []"))).otherwise(close)
        .alias("value"))
    path = scratch_path(spark, "json_documents")
    (first.unionByName(body).unionByName(last).repartition("document")
     .sortWithinPartitions("document", "part", "id").select("document", "value")
     .write.partitionBy("document").text(path))
    checked = damaged.check_json_documents(spark, f"{path}/*")
    whole = F.col("kind").isin("document", "surplus")
    rejects = checked.rejects.withColumn("text", F.when(whole, F.regexp_count(
        "text", F.lit("sessionID")).cast("string")).otherwise(F.col("text")))
    return _accounted(damaged.Checked(checked.rows, rejects))


@query
def csv_quoted(spark, sf_dir):
    """Sessions by way of CSV with quotes, separators and line breaks in their text."""
    raw = m.raw_sessions(spark, sf_dir)
    odd = F.concat(F.col("stationID"), F.lit(', "'), F.col("sessionID"), F.lit('"\nend'))
    path = scratch_path(spark, "csv_quoted")
    writers.write_csv(raw.withColumn("stationID", odd).drop("_id"), path)
    read = readers.read_sessions_csv(spark, path, multiline=True)
    return rounded(cleaning.clean_sessions(read).select(
        "session_id", "station_id", "session_start", "energy_kwh"))


@query
def csv_damaged(spark, sf_dir):
    """CSV lines with a field too few or too many, an open quote, or a damaged number or time."""
    case = F.col("event_id") % 89
    energy = F.col("value").cast("decimal(18,4)").cast("string")
    fields = F.concat_ws(
        ",", F.col("event_id").cast("string"), F.when(case == 3, "n/a").otherwise(energy))
    when = F.when(case == 4, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    line = (
        F.when(case == 0, fields).when(case == 1, F.concat_ws(",", fields, when, F.lit("more")))
        .when(case == 2, F.concat_ws(",", fields, F.concat(F.lit('"'), when)))
        .otherwise(F.concat_ws(",", fields, when))
    )
    path = scratch_path(spark, "csv_damaged")
    m.table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return _accounted(damaged.check_sessions_csv(
        spark, path, columns=["sessionID", "kWhDelivered", "connectionTime"]))


@query
def grid_files(spark, sf_dir):
    """grid_outer_join by way of files: matrices and calendar in time order, several files each,
    without an interval index, so that they meet by position."""
    folder = scratch_path(spark, "grid_files")
    tables = m.grid_tables(spark, sf_dir)
    for name, rows in tables.items():
        if name == "information":
            writers.write_csv(rows, f"{folder}/{name}.csv")
        else:
            in_order = rows.repartitionByRange(3, "timestamp").sortWithinPartitions("timestamp")
            writers.write_csv(in_order.drop("timestamp"), f"{folder}/{name}.csv")
    return rounded(reshape.build_grid_readings(readers.read_grid_tables(spark, folder)))


@query
def raw_convert(spark, sf_dir):
    """Sessions converted to JSON records and CSV, read back from both."""
    folder = scratch_path(spark, "raw_convert")
    raw = m.raw_sessions(spark, sf_dir).withColumn("userInputs", F.lit(None).cast("string"))
    writers.convert_raw_sessions(raw, f"{folder}/json", f"{folder}/csv")
    names = ["_id", "sessionID", "stationID", "connectionTime", "kWhDelivered"]
    as_json = readers.read_sessions_json(spark, f"{folder}/json", lines=True)
    as_csv = readers.read_sessions_csv(spark, f"{folder}/csv")
    return as_json.select(F.lit("json").alias("form"), *names).unionByName(
        as_csv.select(F.lit("csv").alias("form"), *names))


@query
def station_order(spark, sf_dir):
    """Station-hours stored in order: each row's number in the files."""
    path = scratch_path(spark, "station_order")
    hours = m.sessions_by_hour(spark, sf_dir).select("station_id", "timestamp")
    rollup.in_station_order(hours).write.parquet(path)
    return numbering.in_file_order(spark.read.parquet(path), "place")


@query
def split_by_source(spark, sf_dir):
    parts = cleaning.split_by_source(m.merged(spark, sf_dir))
    counts = [rows.groupBy("station_id").agg(F.count(F.lit(1)).alias("hours")).withColumn(
        "part", F.lit(name)) for name, rows in parts.items()]
    return counts[0].unionByName(counts[1])


@query
def monitoring_export(spark, sf_dir):
    """Feedback per day, exported with its metrics as CSV and read back."""
    folder = scratch_path(spark, "monitoring_export")
    periods = _periods(spark, sf_dir)
    writers.export_monitoring(monitor.add_feedback(periods), folder)
    feedback = readers.read_csv(spark, f"{folder}/feedback_signals", timestamps=["period"])
    values = {c: "double" for c in periods.columns if c != "period"}
    metric_rows = readers.read_csv(spark, f"{folder}/monitoring_metrics", values, ["period"])
    return monitor.rounded_periods(metric_rows).join(feedback, "period")


@query
def models_saved(spark, sf_dir):
    """Predictions of a saved and loaded forest, against those before."""
    folder = scratch_path(spark, "models")
    rows = stored(m.features(spark, sf_dir), "features")
    names = demand.model_features(rows, "energy_kwh")
    prepared = stored(demand.prepare(rows, "energy_kwh", names), "prepared")
    model = demand.train(prepared, names, demand.random_forest(5, 4))
    writers.save_models({"forest": model}, folder)
    before = demand.predict(model, prepared).select("station_id", "timestamp", "split", F.col(
        "prediction").alias("before"))
    after = demand.predict(writers.load_model(folder, "forest"), prepared).select(
        "station_id", "timestamp", "prediction")
    return before.join(after, ["station_id", "timestamp"]).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("different"))


@query
def parse_times(spark, sf_dir):
    """One time in the forms that sessions come with, each read back."""
    moment = F.date_trunc("second", "ts").cast("timestamp_ntz")
    shown = lambda pattern: F.date_format(F.col("at"), pattern)
    events = m.table(spark, sf_dir, "events").select("event_id", moment.alias("at"))
    forms = {
        "iso": shown("yyyy-MM-dd HH:mm:ss"), "iso_t": shown("yyyy-MM-dd'T'HH:mm:ss"),
        "zulu": F.concat(shown("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")),
        "offset": F.concat(shown("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")),
        "rfc": F.concat(shown("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        "rfc_offset": F.concat(shown("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0130")),
        "day": shown("yyyy-MM-dd"), "none": F.lit("soon"),
    }
    return events.select("event_id", "at", *[parse_time(t).alias(c) for c, t in forms.items()])


def _ledger_of(spark, sf_dir, clean):
    """The ledger after the one pass that stores the cleaned rows."""
    kept = Ledger()
    stored(clean(kept), "cleaned")
    return kept.table(spark)


@query
def cleaning_ledger(spark, sf_dir):
    raw = m.raw_sessions(spark, sf_dir)
    odd = F.when(F.col("sessionID").cast("bigint") % 7 == 0, F.lit("soon")).otherwise(
        F.col("doneChargingTime"))
    low = F.when(F.col("sessionID").cast("bigint") % 11 == 0, F.lit(None)).when(
        F.col("sessionID").cast("bigint") % 13 == 0, F.lit(0.0)).otherwise(F.col("kWhDelivered"))
    damaged_rows = raw.withColumns({"doneChargingTime": odd, "kWhDelivered": low})
    return _ledger_of(spark, sf_dir, lambda kept: clean_sessions(damaged_rows, kept))


@query
def grid_ledger(spark, sf_dir):
    readings = stored(m.readings(spark, sf_dir), "readings")
    return _ledger_of(spark, sf_dir, lambda kept: clean_grid(readings, kept, chunk=m.CHUNK))


@query
def stage_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "stage_roundtrip")
    hourly = m.sessions_by_hour(spark, sf_dir)
    writers.write_stage(
        hourly.withColumn("ym", F.date_format("timestamp", "yyyy-MM")), path,
        ["data_source", "ym"])
    return rounded(readers.read_stage(spark, path).select(
        "data_source", "station_id", "timestamp", "session_count", "energy_kwh"))


@query
def hourly_sessions(spark, sf_dir):
    return rounded(m.sessions_by_hour(spark, sf_dir))


@query
def hourly_deliveries(spark, sf_dir):
    return rounded(rollup.hourly_rollup(m.deliveries(spark, sf_dir)))


# grid readings

@query
def assemble_timestamp(spark, sf_dir):
    tables = m.grid_tables(spark, sf_dir)
    return rounded(reshape.attach_calendar(tables["volume"], tables["time"]))


@query
def wide_to_long(spark, sf_dir):
    tables = m.grid_tables(spark, sf_dir)
    wide = reshape.attach_calendar(tables["volume"], tables["time"])
    return rounded(reshape.wide_to_long(wide, "volume_kwh"))


@query
def grid_outer_join(spark, sf_dir):
    return rounded(m.readings(spark, sf_dir))


@query
def forward_fill(spark, sf_dir):
    return rounded(m.readings_clean(spark, sf_dir).select(
        "station_id", "timestamp", "volume_kwh", "active_chargers", "price_per_kwh",
        "avg_duration_min", "charger_utilization_rate", "energy_kwh"))


@query
def hourly_grid(spark, sf_dir):
    return rounded(rollup.hourly_grid(m.readings_clean(spark, sf_dir)))


@query
def merge_sources(spark, sf_dir):
    return rounded(m.merged(spark, sf_dir))


@query
def grid_profile(spark, sf_dir):
    readings = m.readings(spark, sf_dir)
    return profile.grid_profile(reshape.grid_attributes(
        m.grid_tables(spark, sf_dir)["information"])).withColumn(
            "readings", readings.agg(F.count(F.lit(1))).scalar())


# features

@query
def time_features(spark, sf_dir):
    return feat.add_time_features(
        m.sessions(spark, sf_dir).select("session_id", "session_start"), "session_start")


@query
def utilization_revenue_cost(spark, sf_dir):
    s = m.sessions(spark, sf_dir).withColumn(
        "session_cost", F.col("energy_kwh") * F.col("charging_duration_min") / 10)
    return rounded(s.select(
        "session_id",
        feat.charger_utilization(s).alias("charger_utilization_rate"),
        feat.charger_utilization(s, "charging_duration_min", "absent").alias("no_utilization"),
        feat.revenue(s).alias("revenue_per_session"),
        feat.energy_cost(s).alias("energy_cost_per_kwh"),
        feat.energy_cost(s, "absent").alias("baseline_cost_per_kwh"),
    ))


@query
def occupancy_from_chargers(spark, sf_dir):
    hourly = rollup.hourly_grid(m.readings_clean(spark, sf_dir))
    return rounded(hourly.select(
        "station_id", "timestamp", feat.occupancy_from_chargers().alias("occupancy_density")))


@query
def lag_features(spark, sf_dir):
    hourly = stored(m.sessions_by_hour(spark, sf_dir), "hours").select(
        "station_id", "timestamp", "energy_kwh")
    return rounded(feat.add_lags(hourly, chunk=m.CHUNK))


@query
def lag_global(spark, sf_dir):
    hourly = stored(m.sessions_by_hour(spark, sf_dir), "hours").select(
        "station_id", "timestamp", "energy_kwh")
    return rounded(feat.add_lags(
        hourly, station=None, order=["timestamp", "station_id"], chunk=m.CHUNK))


@query
def rolling_features(spark, sf_dir):
    hourly = stored(m.sessions_by_hour(spark, sf_dir), "hours").select(
        "station_id", "timestamp", "energy_kwh", "charger_utilization_rate")
    return rounded(feat.add_rolling(
        hourly, ["energy_kwh", "charger_utilization_rate"], chunk=m.CHUNK))


@query
def lag_rolling_deliveries(spark, sf_dir):
    daily = stored(rollup.hourly_rollup(m.deliveries(spark, sf_dir)), "daily").select(
        "station_id", F.col("hour_bucket").alias("timestamp"),
        F.col("total_energy_kwh").alias("energy_kwh"))
    return rounded(feat.add_lags_and_rolling(daily, targets=["energy_kwh"], chunk="year"))


@query
def queue_proxy(spark, sf_dir):
    s = m.sessions(spark, sf_dir).select("session_id", "station_id", "session_start")
    return feat.add_queue_length(s, ts="session_start")


@query
def occupancy_density(spark, sf_dir):
    s = m.sessions(spark, sf_dir).select("session_id", "station_id", "session_start")
    return rounded(feat.add_occupancy_density(s, ts="session_start"))


@query
def session_overlap(spark, sf_dir):
    s = m.sessions(spark, sf_dir).select(
        "session_id", "station_id", "session_start", "session_end")
    return feat.add_session_overlap(s)


@query
def sequence_windows(spark, sf_dir):
    s = stored(m.sessions_by_hour(spark, sf_dir), "hours")
    windows = feat.sequence_windows(
        s, ["energy_kwh", "session_count"], "energy_kwh", chunk=m.CHUNK)
    return rounded(windows.select(
        "station_id", "timestamp", "target",
        F.size("sequence").alias("length"),
        F.col("sequence")[0][0].alias("first_energy"),
        F.col("sequence")[23][0].alias("last_energy"),
        F.aggregate("sequence", F.lit(0.0), lambda a, x: a + x[1]).alias("sessions"),
    ))


# tariffs

def _observed_cells(spark, sf_dir):
    rows = m.forecast(m.features(spark, sf_dir))
    cells = rows.select(*[c.alias(n) for n, c in tariff.price_cell(rows).items()])
    return cells.groupBy("hour", "u_idx", "c_idx").agg(F.count(F.lit(1)).alias("slots"))


@query
def tariff_grid(spark, sf_dir):
    cells = tariff.tariff_lookup(spark).join(
        _observed_cells(spark, sf_dir), ["hour", "u_idx", "c_idx"], "left")
    return cells.withColumn("slots", F.coalesce("slots", F.lit(0)))


def _observed_schedule(spark, sf_dir):
    slots = _observed_cells(spark, sf_dir).groupBy(
        "hour", (F.col("u_idx") / 10.0).alias("utilization")).agg(F.sum("slots").alias("slots"))
    schedule = tariff.pricing_schedule(tariff.tariff_lookup(spark)).join(
        slots, ["hour", "utilization"], "left")
    return schedule.withColumn("slots", F.coalesce("slots", F.lit(0)))


@query
def pricing_schedule(spark, sf_dir):
    return _observed_schedule(spark, sf_dir)


@query
def schedule_pivot(spark, sf_dir):
    return rounded(reshape.pivot_mean(
        _observed_schedule(spark, sf_dir), "utilization", "hour", "tariff_inr",
        {h: f"h{h:02d}" for h in range(24)}))


@query
def tariff_batch(spark, sf_dir):
    return rounded(m.priced(spark, sf_dir).select(
        "station_id", "timestamp", "hour_of_day", "predicted_utilization",
        "congestion_probability", "dynamic_tariff"))


@query
def single_tariff(spark, sf_dir):
    inputs = m.table(spark, sf_dir, "events").select(
        "event_id",
        (m.minutes() / F.lit(60.0)).alias("predicted_utilization"),
        F.when(F.col("event_type") != "error", F.hour("ts")).alias("hour_of_day"),
        (F.col("value") / 100).alias("congestion_probability"),
    )
    return tariff.price_table(inputs).select("event_id", "dynamic_tariff")


@query
def predictions_join(spark, sf_dir):
    rows = stored(m.features(spark, sf_dir), "features")
    predictions = rows.filter(F.col("is_peak_hour") == 1).select(
        "station_id", "timestamp", F.col("charger_rolling_6h").alias("predicted_utilization"))
    joined = tariff.with_predictions(
        rows.select("station_id", "timestamp", "energy_kwh"), predictions)
    return rounded(joined.withColumn(
        "congestion", tariff.congestion_flag("predicted_utilization")))


def _metric(make):
    def run(spark, sf_dir):
        rows = m.priced(spark, sf_dir)
        return metrics.report(rows, make(rows))
    return run


QUERIES["revenue_simulation"] = _metric(metrics.revenue_metric)
QUERIES["utilization_change"] = _metric(metrics.utilization_metric)
QUERIES["off_peak_uplift"] = _metric(metrics.off_peak_metric)
QUERIES["tariff_evaluation"] = _metric(metrics.tariff_metric)
QUERIES["customer_response"] = _metric(metrics.response_metric)
QUERIES["pricing_efficiency"] = _metric(metrics.efficiency_metric)


@query
def wait_time(spark, sf_dir):
    """Both branches: queues of sessions, utilisation of station-hours."""
    queues = feat.add_queue_length(
        feat.add_time_features(m.sessions(spark, sf_dir), "session_start"), ts="session_start")
    rows = m.priced(spark, sf_dir).drop("queue_length_proxy")
    one = metrics.report(queues, metrics.waiting_metric(queues))
    two = metrics.report(rows, metrics.waiting_metric(rows))
    return one.withColumn("branch", F.lit("queue")).unionByName(
        two.withColumn("branch", F.lit("utilization")))


# monitoring

def _periods(spark, sf_dir, by=()):
    return monitor.period_metrics(m.priced(spark, sf_dir), "day", by=by)


@query
def monitoring_rollup(spark, sf_dir):
    return monitor.rounded_periods(_periods(spark, sf_dir))


@query
def monitoring_by_station(spark, sf_dir):
    return monitor.rounded_periods(_periods(spark, sf_dir, ["station_id"]))


@query
def monitoring_summary(spark, sf_dir):
    return rounded(monitor.summarise_periods(
        monitor.rounded_periods(_periods(spark, sf_dir))))


@query
def scenario_metrics(spark, sf_dir):
    """Four price scenarios per day from one pass: fixed tariff, best tariffs, the tiers, and
    the tiers after the feedback of all days."""
    rows = stored(m.priced(spark, sf_dir), "priced")
    path = monitor.multiplier_path(monitor.add_feedback(monitor.period_metrics(rows, "day")))
    cases = {
        "baseline": scenarios.baseline_price(), "best": F.col("dynamic_tariff"),
        **scenarios.path_prices(path, half_even(F.col("predicted_utilization"), 6)),
    }
    return monitor.rounded_periods(scenarios.scenario_metrics(rows, cases, unit="day"))


_FEEDBACK_GROUPS = ["station_id", "time_period"]


def _with_naive_forecast(rows):
    """The mean of the last six hours as the forecast of the utilisation."""
    return rows.withColumns({
        "actual": half_even(F.col("charger_utilization_rate"), 6),
        "prediction": half_even(F.col("charger_rolling_6h"), 6)})


def _signals(spark, sf_dir):
    """Feedback per station, time of day and day: every action occurs in the given data."""
    return monitor.add_feedback(monitor.period_metrics(
        _with_naive_forecast(m.priced(spark, sf_dir)), "day", by=_FEEDBACK_GROUPS,
        forecast=("actual", "prediction")))


@query
def feedback_signals(spark, sf_dir):
    return writers.flatten_structs(_signals(spark, sf_dir).select(
        *_FEEDBACK_GROUPS, "period", "demand_feedback", "tariff_feedback"))


@query
def multiplier_path(spark, sf_dir):
    return rounded(monitor.multiplier_path(_signals(spark, sf_dir), by=_FEEDBACK_GROUPS))


# profiles

@query
def quality_report(spark, sf_dir):
    return profile.quality_report(m.sessions(spark, sf_dir).drop("data_source"))


@query
def numeric_summary(spark, sf_dir):
    return rounded(profile.numeric_summary(m.merged(spark, sf_dir)))


@query
def numeric_summary_deliveries(spark, sf_dir):
    return rounded(profile.numeric_summary(m.table(spark, sf_dir, "lineitem")))


_SHARES = {"p05": 0.05, "median": 0.5, "p95": 0.95}


@query
def sketched_quantiles(spark, sf_dir):
    """Quantiles of a month's deliveries from sketches per day: the exact value, and whether
    the sketch's is within the bound on ranks. (Sketches are random, so they aren't shown.)"""
    rows = m.deliveries(spark, sf_dir).withColumn("month", F.trunc("timestamp", "month"))
    daily = stored(sketches.daily_sketches(rows, ["energy_kwh", "duration_min"]), "daily")
    found = stored(sketches.merged(daily, unit="month").select("month", *[
        sketches.quantile(c, s).alias(f"{c}_{n}")
        for c in ("energy_kwh", "duration_min") for n, s in _SHARES.items()]), "found")
    parts = []
    for column in ("energy_kwh", "duration_min"):
        names = {n: f"{column}_{n}" for n in _SHARES}
        exact = quantiles.quantiles(rows, column, _SHARES, ["month"])
        bounds = sketches.rank_bounds(rows, column, found, list(names.values()), ["month"])
        within = lambda n, share: (
            (F.col(f"{names[n]}_below") - sketches.RANK_ERROR <= share)
            & (F.col(f"{names[n]}_upto") + sketches.RANK_ERROR >= share))
        parts.append(exact.join(bounds, "month").select(
            F.lit(column).alias("measure"), "month", F.explode(F.array(*[
                F.struct(F.lit(n).alias("quantile"), F.col(n).alias("exact"),
                         within(n, s).alias("within")) for n, s in _SHARES.items()])).alias("q")
        ).select("measure", "month", "q.*"))
    return rounded(parts[0].unionByName(parts[1]))


@query
def sketched_distinct(spark, sf_dir):
    """Stations per year from sketches per day, against the exact number."""
    rows = m.deliveries(spark, sf_dir).withColumn("year", F.trunc("timestamp", "year"))
    daily = sketches.daily_sketches(rows, keys=["station_id"])
    found = sketches.merged(daily, unit="year").select(
        "year", "rows", sketches.distinct("station_id").alias("estimate"))
    exact = rows.groupBy("year").agg(F.count_distinct("station_id").alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= sketches.DISTINCT_ERROR * F.col("exact")
    return found.join(exact, "year").select("year", "rows", "exact", near.alias("within"))


@query
def value_counts(spark, sf_dir):
    rows = stored(m.merged(spark, sf_dir), "merged")
    by_source = profile.value_counts(rows, F.col("data_source"), "value")
    by_hour = profile.value_counts(
        rows.filter(F.col("data_source") == "ACN"), F.hour("timestamp").cast("string"), "value")
    return by_source.withColumn("kind", F.lit("data_source")).unionByName(
        by_hour.withColumn("kind", F.lit("hour")))


@query
def range_profile(spark, sf_dir):
    return rounded(profile.range_profile(m.merged(spark, sf_dir), by=["data_source"]))


@query
def monthly_energy(spark, sf_dir):
    return rounded(profile.energy_by_time(m.deliveries(spark, sf_dir), "month"), 4)


@query
def daily_energy(spark, sf_dir):
    return rounded(profile.energy_by_time(m.merged(spark, sf_dir), "day", by=["data_source"]), 4)


@query
def hour_weekday_heatmap(spark, sf_dir):
    rows = feat.add_time_features(m.merged(spark, sf_dir))
    return rounded(reshape.pivot_mean(
        rows, "hour_of_day", "day_of_week", "energy_kwh", reshape.WEEKDAYS))


@query
def winsorised_energy(spark, sf_dir):
    rows = m.sessions(spark, sf_dir).select("session_id", "station_id", "energy_kwh")
    return rounded(quantiles.winsorise(rows, "energy_kwh", 0.99, ["station_id"]))


@query
def weekday_weekend_box(spark, sf_dir):
    rows = feat.add_time_features(stored(m.merged(spark, sf_dir), "merged"))
    return rounded(profile.box_statistics(rows, ["data_source", "is_weekend"]))


@query
def period_distribution(spark, sf_dir):
    rows = feat.add_time_features(stored(m.merged(spark, sf_dir), "hours"))
    return rounded(profile.period_distribution(rows))


@query
def demand_volatility(spark, sf_dir):
    return rounded(profile.volatility(feat.add_time_features(m.merged(spark, sf_dir))))


@query
def util_histogram(spark, sf_dir):
    return rounded(quantiles.histogram(
        stored(m.merged(spark, sf_dir), "merged"), "charger_utilization_rate"))


@query
def energy_histogram(spark, sf_dir):
    """Energy bounded at its 99 % quantile, in 50 bins."""
    rows = quantiles.winsorise(
        m.sessions(spark, sf_dir).select("energy_kwh"), "energy_kwh", 0.99)
    return rounded(quantiles.histogram(rows, "energy_kwh"))


@query
def tariff_histogram(spark, sf_dir):
    return rounded(quantiles.histogram(
        stored(m.priced(spark, sf_dir).select("dynamic_tariff"), "priced"), "dynamic_tariff"))


@query
def util_cdf(spark, sf_dir):
    hourly = m.merged(spark, sf_dir).select(
        half_even(F.col("charger_utilization_rate"), 6).alias("charger_utilization_rate"))
    return rounded(quantiles.cumulative_share(hourly, "charger_utilization_rate"))


@query
def band_shares(spark, sf_dir):
    return rounded(profile.band_shares(m.merged(spark, sf_dir)))


@query
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(m.features(spark, sf_dir), [
        "energy_kwh", "charger_utilization_rate", "hour_of_day", "day_of_week", "is_weekend",
        "is_peak_hour", "revenue_per_session", "occupancy_density", "demand_lag_1",
        "energy_rolling_6h", "energy_rolling_24h"]))


@query
def tariff_by_hour(spark, sf_dir):
    return rounded(profile.mean_by(
        m.priced(spark, sf_dir), "hour_of_day", "dynamic_tariff", "avg_tariff"))


@query
def group_metric_table(spark, sf_dir):
    """One row per source with the numeric columns both sources share."""
    left, right = m.sessions_by_hour(spark, sf_dir), rollup.hourly_grid(
        m.readings_clean(spark, sf_dir))
    shared = [c for c in rollup.common_columns(left, right)
              if c in cleaning.numeric_columns(left)]
    rows = rollup.merge_sources(left, right)
    return rounded(rows.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(c).alias(f"mean_{c}") for c in shared],
        *[F.stddev_samp(c).alias(f"std_{c}") for c in shared]))


@query
def top_station_hours(spark, sf_dir):
    return rounded(m.sessions_by_hour(spark, sf_dir).select(
        "station_id", "timestamp", "session_count", "energy_kwh").orderBy(
            half_even(F.col("energy_kwh"), 6).desc_nulls_last(),
            F.col("station_id").asc_nulls_last(), F.col("timestamp").asc_nulls_last()
        ).limit(20))


# demand models

@query
def chrono_split(spark, sf_dir):
    rows = demand.complete_rows(
        stored(m.features(spark, sf_dir), "features"), ["demand_lag_24", "energy_kwh"])
    return rounded(demand.split_by_time(rows).select(
        "station_id", "timestamp", "energy_kwh", "demand_lag_24", "split"))


@query
def position_split(spark, sf_dir):
    rows = demand.complete_rows(
        stored(m.features(spark, sf_dir), "features"), ["demand_lag_24", "energy_kwh"])
    return rounded(demand.split_by_position(rows).select(
        "station_id", "timestamp", "energy_kwh", "demand_lag_24", "split"))


def _naive_forecasts(spark, sf_dir):
    """The value n hours before as a forecast, for every lag n."""
    rows = m.features(spark, sf_dir)
    return rows.select("station_id", F.col("energy_kwh").alias("actual"), F.explode(F.array(*[
        F.struct(F.lit(f"lag_{n}").alias("model"), F.col(f"demand_lag_{n}").alias("prediction"))
        for n in (1, 2, 6, 24)])).alias("f")).select("station_id", "actual", "f.*")


@query
def regression_metrics(spark, sf_dir):
    return rounded(demand.evaluate(_naive_forecasts(spark, sf_dir)))


@query
def best_model(spark, sf_dir):
    return rounded(demand.best_model(demand.evaluate(_naive_forecasts(spark, sf_dir))))


def _checked_model(spark, sf_dir, name, regressor):
    """What can be known of a trained model without training it again.

    One row per split: its rows, the scaler's features, the rows that got a prediction, and
    whether the model beats the mean of the training rows there.
    """
    rows = stored(m.features(spark, sf_dir), "features")
    names = demand.model_features(rows, "energy_kwh")
    models, _, prepared = analytics.predict_demand(rows, regressors={name: regressor})
    mean = prepared.filter(F.col("split") == "train").agg(F.avg("actual")).scalar()
    error = lambda value: F.sqrt(F.avg(F.pow(F.col("actual") - value, 2)))
    return demand.predict(models[name], prepared).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("prediction").alias("predictions"),
        (error(F.col("prediction")) < error(mean)).alias("beats_mean"),
        half_even(F.avg("actual"), 6).alias("mean_actual"),
    ).withColumn("features", F.lit(",".join(names))).withColumn("model", F.lit(name))


@query
def demand_forest(spark, sf_dir):
    return _checked_model(spark, sf_dir, "random_forest", demand.random_forest())


@query
def demand_gbt(spark, sf_dir):
    return _checked_model(spark, sf_dir, "gradient_boosting", demand.gradient_boosting())


@query
def feature_importance(spark, sf_dir):
    """Every feature with whether its importance is a share, all shares sum to one, and the
    five most important come first, in order."""
    rows = stored(m.features(spark, sf_dir), "features")
    names = demand.model_features(rows, "energy_kwh")
    prepared = stored(demand.prepare(rows, "energy_kwh", names), "prepared")
    model = demand.train(prepared, names, demand.random_forest())
    table = demand.feature_importance(spark, model, names)
    total = table.agg(F.sum("importance")).scalar()
    top = [r["importance"] for r in demand.feature_importance(spark, model, names, top=5).collect()]
    largest = sorted(model.stages[-1].featureImportances.toArray().tolist(), reverse=True)[:5]
    return table.select(
        F.lit(top == largest).alias("top_in_order"),
        "feature", F.col("importance").between(0, 1).alias("is_share"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


# stages

@query
def bucketed_features(spark, sf_dir):
    """pipeline_features over a stage dealt into buckets by station and day."""
    stage = _bucketed(spark, m.merged(spark, sf_dir), "merged")
    return rounded(feat.build_features(stage.read(spark), m.CHUNK).drop("_chunk"))


@query
def bucketed_predictions(spark, sf_dir):
    """predictions_join over a bucketed stage: only the predictions are shuffled."""
    stage = _bucketed(spark, m.features(spark, sf_dir), "features")
    rows = stage.read(spark)
    predictions = rows.filter(F.col("is_peak_hour") == 1).select(
        "station_id", "timestamp", F.col("charger_rolling_6h").alias("predicted_utilization"))
    with bucketed.co_partitioned(spark):
        joined = stored(stage.join(spark, predictions).select(
            "station_id", "timestamp", "energy_kwh", "predicted_utilization"), "joined")
    return rounded(joined.withColumn(
        "congestion", tariff.congestion_flag("predicted_utilization")))


def _bucketed(spark, rows, name):
    path = scratch_path(spark, name)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return bucketed.write_bucketed(
        rows, os.path.basename(path).replace("-", "_"), path, parts, m.CHUNK)


@query
def incremental_features(spark, sf_dir):
    """Features kept up to date as session files come in: first all but one day in seven,
    then the files of those days, then one of them anew."""
    source, folder = scratch_path(spark, "incoming"), scratch_path(spark, "stages")
    raw = m.raw_sessions(spark, sf_dir).drop("_id")
    late = F.dayofmonth(F.col("connectionTime").cast("timestamp_ntz")) % 7 == 3
    again = F.dayofmonth(F.col("connectionTime").cast("timestamp_ntz")) == 10
    stages = incremental.SessionStages(spark, source, folder, chunk=m.CHUNK)
    writers.write_csv(raw.filter(~late), f"{source}/first")
    stages.update()
    writers.write_csv(raw.filter(late & ~again), f"{source}/late")
    writers.write_csv(raw.filter(again).withColumn("kWhDelivered", F.lit(1.0)), f"{source}/tenth")
    stages.update()
    writers.write_csv(raw.filter(again), f"{source}/tenth")
    stages.update()
    if not stages.update().skipped:
        raise RuntimeError("an update without a change did something")
    return rounded(stages.features())


# composed plans

@query
def pipeline_preprocess(spark, sf_dir):
    from chargelake.plans.preprocess import preprocess
    merged = preprocess(
        m.raw_sessions(spark, sf_dir), m.grid_tables(spark, sf_dir),
        lambda df: stored(df, "readings"), m.CHUNK)
    return rounded(merged.groupBy("data_source", "station_id").agg(
        F.count(F.lit(1)).alias("hours"),
        F.sum("energy_kwh").alias("energy_kwh"),
        F.avg("charger_utilization_rate").alias("mean_utilization"),
        F.avg("price_per_kwh").alias("mean_price")), 4)


@query
def pipeline_features(spark, sf_dir):
    return rounded(m.features(spark, sf_dir))


@query
def pipeline_tariff(spark, sf_dir):
    _, evaluation = analytics.optimise_tariffs(m.features(spark, sf_dir))
    return evaluation


@query
def pipeline_monitor(spark, sf_dir):
    rows = m.features(spark, sf_dir)
    fit = demand.evaluate(
        _with_naive_forecast(rows).withColumn("period", F.date_trunc("day", "timestamp")
                                              .cast("timestamp_ntz")), ["period"])
    signals, _ = analytics.monitor(rows, by=["data_source"], demand_metrics=fit)
    return writers.flatten_structs(monitor.rounded_periods(
        signals.drop("demand_rmse", "demand_r2")))
