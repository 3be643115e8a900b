"""DuckDB SQL for the registered queries, written independently of the Spark plans.

Common table expressions are listed once and pulled in by name; every query states which
columns it rounds. Cumulative and ordered steps use plain window functions here, overlap
counting a range join, and the best tariff a brute-force search over all whole cents.
"""

from __future__ import annotations

import re

_CTE: dict[str, str] = {}

_CTE["raw"] = """
SELECT event_id, ts, event_type, user_id, value,
       CAST(regexp_extract(props, '[0-9]+') AS INT) AS k,
       'ST_' || CAST(user_id % 10 AS VARCHAR) AS station_id
FROM events"""

_CTE["sessions"] = """
SELECT CAST(event_id AS VARCHAR) AS session_id, station_id,
       CAST(user_id AS VARCHAR) AS user_id,
       ts AS session_start, ts + to_minutes(k) AS session_end,
       CASE WHEN event_type <> 'error' THEN ts + to_seconds(45 * k) END AS charging_end,
       value AS energy_kwh, k::DOUBLE AS session_duration_min,
       (CASE WHEN event_type <> 'error' THEN 0.75::DOUBLE * k ELSE k END)::DOUBLE
         AS charging_duration_min,
       'ACN' AS data_source
FROM raw WHERE value > 0 AND NOT coalesce(k <= 0, false)"""

_CTE["hours"] = """
SELECT station_id, date_trunc('hour', session_start)::TIMESTAMP AS timestamp,
       count(energy_kwh) AS session_count, sum(energy_kwh) AS total_energy_kwh,
       avg(energy_kwh) AS avg_energy_kwh, avg(session_duration_min) AS avg_duration_min,
       avg(charging_duration_min) AS avg_charging_min,
       greatest(least(avg(charging_duration_min) * count(energy_kwh) / 60, 1::DOUBLE), 0::DOUBLE)
         AS charger_utilization_rate,
       sum(energy_kwh) AS energy_kwh, 'ACN' AS data_source,
       greatest(count(session_start) - 1, 0) AS queue_length_proxy
FROM sessions GROUP BY 1, 2"""

_CTE["slots"] = """
SELECT date_trunc('hour', ts) + to_minutes(5 * (extract('minute' FROM ts) // 5)) AS timestamp,
       event_type AS grid_id, sum(value) AS volume_kwh, count(value)::DOUBLE AS active_chargers,
       avg(value) AS price_per_kwh, avg(k) AS avg_duration_min
FROM raw GROUP BY 1, 2"""

_CTE["grids"] = """
SELECT list_value('click', 'error', 'purchase', 'signup', 'view')[r_regionkey + 1] AS grid_id,
       (r_regionkey + 1)::INT AS total_chargers, (r_regionkey = 0)::INT AS is_cbd
FROM region"""

_CTE["readings"] = """
SELECT g.grid_id, b.timestamp, s.volume_kwh, s.active_chargers, s.price_per_kwh,
       s.avg_duration_min, g.total_chargers, g.is_cbd, 'UrbanEV' AS data_source,
       'UV_' || g.grid_id AS station_id
FROM (SELECT DISTINCT timestamp FROM slots) b CROSS JOIN grids g
LEFT JOIN slots s ON s.timestamp = b.timestamp AND s.grid_id = g.grid_id"""

_FILL = ", ".join(
    f"coalesce(last_value({c} IGNORE NULLS) OVER w, 0) AS {c}"
    for c in ("volume_kwh", "active_chargers", "price_per_kwh", "avg_duration_min"))
_CTE["filled"] = f"""
SELECT grid_id, station_id, timestamp, {_FILL}, total_chargers, is_cbd, data_source
FROM readings WINDOW w AS (PARTITION BY station_id ORDER BY timestamp
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

_CTE["clean"] = """
SELECT *, coalesce(CASE WHEN active_chargers / nullif(total_chargers, 0) IS NOT NULL THEN
         greatest(least(active_chargers / nullif(total_chargers, 0), 1::DOUBLE), 0::DOUBLE) END,
         0) AS charger_utilization_rate,
       volume_kwh AS energy_kwh
FROM filled"""

_CTE["grid_hours"] = """
SELECT station_id, date_trunc('hour', timestamp)::TIMESTAMP AS timestamp,
       sum(energy_kwh) AS energy_kwh, sum(volume_kwh) AS volume_kwh,
       avg(active_chargers) AS active_chargers, avg(price_per_kwh) AS price_per_kwh,
       avg(avg_duration_min) AS avg_duration_min,
       avg(charger_utilization_rate) AS charger_utilization_rate,
       max(total_chargers) AS total_chargers, max(is_cbd) AS is_cbd,
       max(data_source) AS data_source
FROM clean GROUP BY 1, 2"""

_CTE["merged"] = "SELECT * FROM hours UNION ALL BY NAME SELECT * FROM grid_hours"

_PERIOD = """CASE WHEN {h} IN (8, 9, 10, 11, 17, 18, 19, 20) THEN 'peak'
     WHEN {h} IN (6, 7, 12, 13, 14, 15, 16, 21, 22) THEN 'shoulder' ELSE 'off_peak' END"""


def _time(ts: str) -> str:
    hour = f"extract('hour' FROM {ts})"
    return f"""{hour}::INT AS hour_of_day, (extract('isodow' FROM {ts}) - 1)::INT AS day_of_week,
       (extract('isodow' FROM {ts}) >= 6)::INT AS is_weekend,
       ({hour} IN (8, 9, 10, 11, 17, 18, 19, 20))::INT AS is_peak_hour,
       extract('month' FROM {ts})::INT AS month, extract('day' FROM {ts})::INT AS day_of_month,
       {_PERIOD.format(h=hour)} AS time_period"""


_LAGS = ", ".join(f"lag(energy_kwh, {n}) OVER w AS demand_lag_{n}" for n in (1, 2, 6, 24))


def _rolling(column: str) -> str:
    stem = column.split("_")[0]
    return ", ".join(
        f"avg({column}) OVER (PARTITION BY station_id ORDER BY timestamp "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {stem}_rolling_{n}h"
        for n in (1, 6, 24))


def _features(source: str, density: str) -> str:
    return f"""
SELECT * REPLACE (coalesce(queue_length_proxy, 0) AS queue_length_proxy), {_time('timestamp')},
       energy_kwh * 15 AS revenue_per_session, 15::DOUBLE AS energy_cost_per_kwh,
       {density} AS occupancy_density,
       {_LAGS}, {_rolling('energy_kwh')}, {_rolling('charger_utilization_rate')}
FROM {source} WINDOW w AS (PARTITION BY station_id ORDER BY timestamp)"""


_SHARE = "active_chargers / nullif(total_chargers, 0)"
_OCCUPANCY = f"""coalesce(CASE WHEN {_SHARE} IS NOT NULL THEN
         greatest(least({_SHARE}, 1::DOUBLE), 0::DOUBLE) END, 0)"""
_CTE["features"] = _features("merged", _OCCUPANCY)
_CTE["hour_features"] = _features("hours", "0::DOUBLE")


def _index(value: str, default: str) -> str:
    return f"greatest(least(round_even(coalesce({value}, {default}) * 10, 0), 10), 0)::INT"


_CTE["forecast"] = f"""
SELECT *, charger_rolling_24h AS predicted_utilization,
       charger_rolling_6h AS congestion_probability,
       hour_of_day AS hour, {_index('charger_rolling_24h', '0.5::DOUBLE')} AS u_idx,
       {_index('charger_rolling_6h', '0::DOUBLE')} AS c_idx
FROM features"""

_CTE["scores"] = """
SELECT hour, u_idx, c_idx, cents, round_even(1e6::DOUBLE * (
         u * 50::DOUBLE * d * p
         - CASE WHEN u < 0.3::DOUBLE THEN 10::DOUBLE * greatest(p - r * 0.7::DOUBLE, 0) ** 2
                WHEN u > 0.8::DOUBLE THEN 10::DOUBLE * greatest(r * 1.5::DOUBLE - p, 0) ** 2
                ELSE 2::DOUBLE * (p - r) ** 2 END
         - 1000::DOUBLE * (1 + 2 * c) * greatest(u * d - 0.8::DOUBLE, 0) ** 2), 0) AS score
FROM (SELECT *, greatest(least(1 - 0.3::DOUBLE * (p / r - 1), 1.8::DOUBLE), 0.2::DOUBLE) AS d
      FROM (SELECT h.hour::INT AS hour, a.u_idx::INT AS u_idx, b.c_idx::INT AS c_idx, q.cents,
                   q.cents / 100::DOUBLE AS p, a.u_idx / 10::DOUBLE AS u,
                   b.c_idx / 10::DOUBLE AS c,
                   15::DOUBLE * CASE WHEN h.hour IN (8, 9, 10, 11, 17, 18, 19, 20)
                                     THEN 1.1::DOUBLE
                                     WHEN h.hour <= 5 OR h.hour = 23 THEN 0.9::DOUBLE
                                     ELSE 1::DOUBLE END AS r
            FROM range(24) h(hour), range(11) a(u_idx), range(11) b(c_idx),
                 range(900, 3001) q(cents)))"""

_CTE["lookup"] = """
SELECT s.hour, s.u_idx, s.c_idx,
       CASE WHEN count(*) = 2 THEN max(s.cents) ELSE min(s.cents) END / 100::DOUBLE
         AS tariff_inr
FROM scores s JOIN (SELECT hour, u_idx, c_idx, max(score) AS best FROM scores GROUP BY ALL) m
  ON s.hour = m.hour AND s.u_idx = m.u_idx AND s.c_idx = m.c_idx AND s.score = m.best
GROUP BY 1, 2, 3"""

_CTE["priced"] = """
SELECT f.*, coalesce(l.tariff_inr, 15::DOUBLE) AS dynamic_tariff
FROM forecast f LEFT JOIN lookup l USING (hour, u_idx, c_idx)"""

_CTE["all_priced"] = f"""
SELECT f.*, coalesce(l.tariff_inr, 15::DOUBLE) AS dynamic_tariff
FROM (SELECT *, hour_of_day AS hour,
             {_index('charger_utilization_rate', '0.5::DOUBLE')} AS u_idx, 0 AS c_idx
      FROM features) f LEFT JOIN lookup l USING (hour, u_idx, c_idx)"""

_CTE["deliveries"] = """
SELECT 'SUP_' || CAST(l_suppkey AS VARCHAR) AS station_id, l_shipdate AS timestamp,
       l_quantity AS energy_kwh, l_extendedprice / 1000 AS duration_min
FROM lineitem"""

_CTE["daily"] = """
SELECT station_id, date_trunc('hour', timestamp)::TIMESTAMP AS hour_bucket,
       count(energy_kwh) AS session_count, sum(energy_kwh) AS total_energy_kwh,
       avg(energy_kwh) AS avg_energy_kwh, avg(duration_min) AS avg_duration_min
FROM deliveries GROUP BY 1, 2"""

_CTE["cells"] = """
SELECT hour, u_idx, c_idx, count(*) AS slots FROM forecast GROUP BY 1, 2, 3"""

_CTE["schedule"] = """
SELECT l.hour, l.u_idx / 10::DOUBLE AS utilization, coalesce(sum(c.slots), 0)::BIGINT AS slots,
       any_value(l.tariff_inr) AS tariff_inr
FROM lookup l LEFT JOIN cells c ON l.hour = c.hour AND l.u_idx = c.u_idx WHERE l.c_idx = 0
GROUP BY l.hour, l.u_idx"""


def _even(value: str, digits: int) -> str:
    """Round half to even by scaling, four more places first."""
    snapped = f"round_even(({value}) * 1e{digits + 4}::DOUBLE, 0) / 1e4::DOUBLE"
    return f"(round_even({snapped}, 0) / 1e{digits}::DOUBLE)"


_GAIN = "CASE WHEN {o} = 0 THEN 'inf'::DOUBLE ELSE ({n} - {o}) / {o} * 100 END"
_REVENUE = {
    "baseline_revenue_INR": _even("o", 2), "dynamic_revenue_INR": _even("n", 2),
    "revenue_gain_pct": _even(_GAIN.format(o="o", n="n"), 2),
    "baseline_tariff": "15::DOUBLE", "avg_dynamic_tariff": _even("t", 2),
}
_UTILIZATION = {
    "avg_util_before": _even("b", 4), "avg_util_after": _even("a", 4),
    "util_change_pct":
        f"CASE WHEN b > 0 THEN {_even('(a - b) / b * 100', 2)} ELSE 0 END::DOUBLE",
}
_OFF_PEAK = {
    "off_peak_slots": "idle", "off_peak_pct": _even("idle / cnt * 100::DOUBLE", 2),
    "avg_discount_pct": _even("coalesce((1 - ip) * 100, 0)", 2),
    "estimated_session_uplift_pct":
        _even("coalesce((1 - ip) * 100, 0) * 0.3::DOUBLE", 2),
}


def _aggregates(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    columns = f"{by}, " if by else ""
    return f"""(SELECT {columns}count(*) AS cnt, coalesce(sum(energy_kwh * 15), 0) AS o,
   coalesce(sum(energy_kwh * dynamic_tariff), 0) AS n, avg(dynamic_tariff) AS t,
   avg(charger_utilization_rate) AS b,
   avg(greatest(least(charger_utilization_rate * greatest(least(
       1 - 0.3::DOUBLE * (dynamic_tariff / 15 - 1), 1.5::DOUBLE), 0.3::DOUBLE), 1::DOUBLE),
       0::DOUBLE)) AS a,
   count(*) FILTER (charger_utilization_rate < 0.3::DOUBLE) AS idle,
   avg(dynamic_tariff / 15) FILTER (charger_utilization_rate < 0.3::DOUBLE) AS ip,
   sum(energy_kwh) AS e, avg((dynamic_tariff / 15 - 1) * 100) AS pc,
   avg((dynamic_tariff > 15)::INT) AS up, avg((dynamic_tariff < 15)::INT) AS down,
   avg(queue_length_proxy) FILTER (is_peak_hour = 1) * 5 AS wait,
   avg(predicted_utilization) AS use
 FROM {source} {group})"""


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in columns.items())


_OBSERVED = _even("charger_utilization_rate", 6)
_NAIVE = _even("charger_rolling_6h", 6)
_FIT = f"""sqrt(avg(({_OBSERVED} - {_NAIVE}) ** 2)) AS demand_rmse,
  coalesce(1 - sum(({_OBSERVED} - {_NAIVE}) ** 2) / nullif(var_pop({_OBSERVED}) * count(*), 0),
           (sum(({_OBSERVED} - {_NAIVE}) ** 2) = 0)::INT) AS demand_r2"""


def _periods(source: str, by: str = "", order: str = "date_trunc('day', timestamp)") -> str:
    keys = f"{by}, period" if by else "period"
    inner = _aggregates(f"(SELECT *, {order}::TIMESTAMP AS period FROM {source})", keys)
    return f"""
SELECT {keys}, n AS revenue_INR,
       {_GAIN.format(o='o', n='n')} AS revenue_gain_pct,
       use AS avg_utilization, {_even('wait * 0.7::DOUBLE', 2)} AS avg_wait_time_min,
       CASE WHEN e > 0 THEN {_even('n / e', 2)} ELSE 0 END::DOUBLE AS pricing_efficiency,
       {_even('abs(-0.3::DOUBLE * pc)', 4)} AS customer_response_rate
FROM {inner}"""


_CTE["periods"] = _periods("priced")
_CTE["station_periods"] = _periods("priced", "station_id")
_CTE["source_periods"] = _periods(
    "(SELECT *, charger_utilization_rate AS predicted_utilization FROM all_priced)",
    "data_source")


_CTE["group_fit"] = f"""
SELECT station_id, time_period, date_trunc('day', timestamp)::TIMESTAMP AS period, {_FIT}
FROM priced GROUP BY 1, 2, 3"""
_CTE["group_periods"] = (
    "SELECT * FROM (" + _periods("priced", "station_id, time_period")
    + ") JOIN group_fit USING (station_id, time_period, period)")
_CTE["day_fit"] = f"""
SELECT date_trunc('day', timestamp)::TIMESTAMP AS period, {_FIT} FROM features GROUP BY 1"""


def _feedback() -> str:
    return f"""CASE WHEN coalesce(demand_r2, 0) < 0.6::DOUBLE THEN 'RETRAIN'
       WHEN coalesce(demand_rmse, 0) > 0.2::DOUBLE THEN 'FINE_TUNE' ELSE 'MAINTAIN' END
    AS demand_feedback_action,
  CASE WHEN coalesce(demand_r2, 0) < 0.6::DOUBLE THEN 'R² = '
            || printf('%.3f', {_even('coalesce(demand_r2, 0)', 3)}) || ' is below 0.6 threshold'
       WHEN coalesce(demand_rmse, 0) > 0.2::DOUBLE THEN 'RMSE = '
            || printf('%.4f', {_even('demand_rmse', 4)}) || ' is above 0.2 threshold'
       ELSE 'Model performance is acceptable' END AS demand_feedback_reason,
  CASE WHEN revenue_gain_pct < 0 THEN 'REDUCE_SURGE'
       WHEN avg_utilization < 0.3::DOUBLE THEN 'INCREASE_DISCOUNT'
       WHEN revenue_gain_pct > 20 THEN 'MODERATE' ELSE 'MAINTAIN' END AS tariff_feedback_action,
  CASE WHEN revenue_gain_pct < 0 THEN 'Revenue decreased by '
            || printf('%.1f', {_even('revenue_gain_pct', 1)}) || '% — pricing may be too aggressive'
       WHEN avg_utilization < 0.3::DOUBLE THEN 'Average utilization '
            || printf('%.2f', {_even('avg_utilization', 2)}) || ' is below 0.3 — increase discounts'
       WHEN revenue_gain_pct > 20 THEN 'Revenue gain ' || printf('%.1f', {_even('revenue_gain_pct', 1)})
            || '% is very high — may be overly aggressive'
       ELSE 'Pricing performance is balanced' END AS tariff_feedback_reason"""


_CTE["naive"] = " UNION ALL ".join(
    f"SELECT 'lag_{n}' AS model, energy_kwh AS y, demand_lag_{n} AS p FROM features "
    f"WHERE demand_lag_{n} IS NOT NULL" for n in (1, 2, 6, 24))
_CTE["scores_by_model"] = """
SELECT model, sqrt(avg((y - p) ** 2)) AS RMSE, avg(abs(y - p)) AS MAE,
       1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS R2
FROM naive GROUP BY model"""


def _with(sql: str) -> str:
    """Prepend the common table expressions a query uses, in their order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _CTE:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(_CTE[name])

    visit(sql)
    parts = [f"{name} AS ({_CTE[name]})" for name in _CTE if name in needed]
    return f"WITH {', '.join(parts)} {sql.strip()}" if parts else sql.strip()


def _r(*columns: str, digits: int = 6) -> str:
    """Rounded columns under their own names; adding zero turns -0.0 into 0.0."""
    return ", ".join(f"round({c}::DOUBLE, {digits}) + 0 AS {c}" for c in columns)


_HOUR_VALUES = ("total_energy_kwh", "avg_energy_kwh", "avg_duration_min", "avg_charging_min",
                "charger_utilization_rate", "energy_kwh")
_GRID_VALUES = ("energy_kwh", "volume_kwh", "active_chargers", "price_per_kwh",
                "avg_duration_min", "charger_utilization_rate")
_LAG_NAMES = tuple(f"demand_lag_{n}" for n in (1, 2, 6, 24))
_ROLLING_NAMES = tuple(f"{s}_rolling_{n}h" for s in ("energy", "charger") for n in (1, 6, 24))

_SQL: dict[str, str] = {}

_SQL["session_clean"] = f"""
SELECT session_id, station_id, user_id, session_start, session_end, charging_end,
       {_r('energy_kwh', 'session_duration_min', 'charging_duration_min')}, data_source
FROM sessions"""

_RAW_TEXT = """CAST(event_id AS VARCHAR) AS "_id", CAST(event_id AS VARCHAR) AS "sessionID",
       station_id AS "stationID", CAST(user_id AS VARCHAR) AS "userID" """

_SQL["json_sessions"] = f"""
SELECT session_id AS "_id", session_id, station_id, session_start, session_end,
       {_r('energy_kwh', 'session_duration_min', 'charging_duration_min')} FROM sessions"""

_SQL["csv_roundtrip"] = """
SELECT CAST(event_id AS VARCHAR) AS "sessionID", station_id AS "stationID",
       ts AS "connectionTime", value AS "kWhDelivered" FROM raw"""

_CTE["records"] = """
SELECT event_id AS id, value, value::DECIMAL(18,4)::DOUBLE AS energy,
       '{"sessionID":"' || event_id || '","kWhDelivered":' || CASE event_id % 97
         WHEN 3 THEN '"n/a"' WHEN 4 THEN '"' || value::DECIMAL(18,4) || '"'
         ELSE value::DECIMAL(18,4)::VARCHAR END || '}' AS text
FROM events"""

_GOOD = """'row' AS kind, id::VARCHAR AS "sessionID",
       CASE WHEN id % 97 <> 3 THEN energy END AS energy_kwh,
       NULL::VARCHAR AS field, NULL::VARCHAR AS text"""

_SQL["json_damaged"] = f"""
SELECT {_GOOD} FROM records WHERE id % 97 NOT IN (0, 1)
UNION ALL SELECT 'line', NULL, NULL, NULL, substr(text, 1, 12) FROM records WHERE id % 97 = 0
UNION ALL SELECT 'surplus', NULL, NULL, NULL, text || ' ' || text FROM records WHERE id % 97 = 1
UNION ALL SELECT 'record', NULL, NULL, NULL, '7' FROM records WHERE id % 97 = 2
UNION ALL SELECT 'field', NULL, NULL, 'kWhDelivered', 'n/a' FROM records WHERE id % 97 = 3"""

_CTE["documents_written"] = """
SELECT d FROM range((SELECT count(*) // 500 + 10 FROM events)) r(d)"""
_CTE["record_documents"] = """
SELECT *, id % (SELECT count(*) FROM documents_written) AS d FROM records"""

_SQL["json_documents"] = f"""
SELECT {_GOOD} FROM record_documents WHERE d % 10 < 8
UNION ALL SELECT 'field', NULL, NULL, 'kWhDelivered', 'n/a' FROM record_documents
  WHERE id % 97 = 3 AND d % 10 < 8
UNION ALL SELECT 'record', NULL, NULL, NULL, '5' FROM documents_written WHERE d % 10 < 8
UNION ALL SELECT CASE WHEN w.d % 10 = 8 THEN 'document' ELSE 'surplus' END, NULL, NULL, NULL,
       count(r.id)::VARCHAR FROM documents_written w LEFT JOIN record_documents r ON w.d = r.d
  WHERE w.d % 10 >= 8 GROUP BY w.d"""

_SQL["csv_quoted"] = f"""
SELECT session_id, station_id || ', "' || session_id || '"' || chr(10) || 'end' AS station_id,
       session_start, {_r('energy_kwh')} FROM sessions"""

_CTE["csv_lines"] = """
SELECT event_id, event_id % 89 AS c, value::DECIMAL(18,4)::DOUBLE AS energy,
       event_id || ',' || CASE event_id % 89 WHEN 3 THEN 'n/a'
         ELSE value::DECIMAL(18,4)::VARCHAR END AS fields,
       CASE event_id % 89 WHEN 4 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS moment
FROM events"""

_SQL["csv_damaged"] = """
SELECT 'row' AS kind, event_id::VARCHAR AS "sessionID", CASE WHEN c <> 3 THEN energy END
       AS energy_kwh, NULL::VARCHAR AS field, NULL::VARCHAR AS text FROM csv_lines WHERE c > 2
UNION ALL SELECT 'line', NULL, NULL, NULL, CASE c WHEN 0 THEN fields
       WHEN 1 THEN fields || ',' || moment || ',more' ELSE fields || ',"' || moment END
  FROM csv_lines WHERE c <= 2
UNION ALL SELECT 'field', NULL, NULL, 'kWhDelivered', 'n/a' FROM csv_lines WHERE c = 3
UNION ALL SELECT 'field', NULL, NULL, 'connectionTime', 'soon' FROM csv_lines WHERE c = 4"""

_SQL["parse_times"] = """
SELECT event_id, t AS at, t AS iso, t AS iso_t, t AS zulu, t - INTERVAL 2 HOUR AS "offset",
       t AS rfc, t + INTERVAL 90 MINUTE AS rfc_offset, date_trunc('day', t)::TIMESTAMP AS day,
       NULL::TIMESTAMP AS none
FROM (SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS t FROM events)"""

_CTE["odd_sessions"] = """
SELECT k, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 0
           ELSE value END AS energy, event_type <> 'error' AND event_id % 7 <> 0 AS done,
           event_id % 7 = 0 AS odd FROM raw"""
_CTE["ruled"] = """
SELECT *, CASE WHEN energy IS NULL THEN 'energy_missing'
      WHEN k <= 0 THEN 'duration_not_positive' WHEN energy <= 0 THEN 'energy_not_positive' END
      AS rule FROM odd_sessions"""

_SQL["cleaning_ledger"] = """
SELECT 'sessions' AS stage, 'all' AS rule, 'in' AS effect, count(*) AS rows FROM ruled
UNION ALL SELECT 'sessions', n, 'dropped', count(rule) FROM (VALUES ('energy_missing'),
    ('duration_not_positive'), ('energy_not_positive')) v(n) LEFT JOIN ruled ON rule = n GROUP BY n
UNION ALL SELECT 'sessions', 'connectionTime', 'unread', 0
UNION ALL SELECT 'sessions', 'disconnectTime', 'unread', 0
UNION ALL SELECT 'sessions', 'doneChargingTime', 'unread', count(*) FROM ruled WHERE odd
UNION ALL SELECT 'sessions', 'charging_duration', 'filled', count(*) FROM ruled
  WHERE rule IS NULL AND NOT done AND k IS NOT NULL
UNION ALL SELECT 'sessions', 'all', 'out', count(*) FROM ruled WHERE rule IS NULL"""

_CELLS = ("volume_kwh", "active_chargers", "price_per_kwh", "avg_duration_min")
_CTE["carried"] = "SELECT r.*, {} FROM readings r {}".format(
    ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS w_{c}" for c in _CELLS),
    "WINDOW w AS (PARTITION BY station_id ORDER BY timestamp)")

_SQL["grid_ledger"] = """
SELECT 'grid' AS stage, 'all' AS rule, e AS effect, count(*) AS rows
  FROM carried, (VALUES ('in'), ('out')) v(e) GROUP BY e
{cells}
UNION ALL SELECT 'grid', 'charger_utilization_rate', 'zeroed',
  count(*) FILTER (WHERE coalesce(total_chargers, 0) = 0) FROM carried""".format(
    cells="\n".join(
        f"UNION ALL SELECT 'grid', '{c}', 'filled', count(*) FILTER (WHERE {c} IS NULL AND "
        f"w_{c} IS NOT NULL) FROM carried UNION ALL SELECT 'grid', '{c}', 'zeroed', "
        f"count(*) FILTER (WHERE w_{c} IS NULL) FROM carried" for c in _CELLS))

_TEXT_TIME = "regexp_replace(regexp_replace(strftime({t}, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')"
_SQL["drop_null_columns"] = f"""
SELECT {_RAW_TEXT}, {_TEXT_TIME.format(t='ts')} AS "connectionTime",
       {_TEXT_TIME.format(t='ts + to_minutes(k)')} AS "disconnectTime",
       CASE WHEN event_type <> 'error' THEN {_TEXT_TIME.format(t='ts + to_seconds(45 * k)')} END
         AS "doneChargingTime", value AS "kWhDelivered" FROM raw"""

_SQL["stage_roundtrip"] = f"""
SELECT data_source, station_id, timestamp, session_count, {_r('energy_kwh')} FROM hours"""

_SQL["hourly_sessions"] = f"""
SELECT station_id, timestamp, session_count, data_source, queue_length_proxy,
       {_r(*_HOUR_VALUES)} FROM hours"""

_SQL["hourly_deliveries"] = f"""
SELECT station_id, hour_bucket, session_count,
       {_r('total_energy_kwh', 'avg_energy_kwh', 'avg_duration_min')} FROM daily"""

_GRIDS = ("click", "error", "purchase", "signup", "view")
_SQL["assemble_timestamp"] = "SELECT timestamp, " + ", ".join(
    f"round(sum(volume_kwh) FILTER (grid_id = '{g}'), 6) AS {g}" for g in _GRIDS
) + " FROM slots GROUP BY timestamp"

_SQL["wide_to_long"] = f"SELECT timestamp, grid_id, {_r('volume_kwh')} FROM readings"

_SQL["grid_outer_join"] = f"""
SELECT grid_id, timestamp, total_chargers, is_cbd, data_source, station_id,
       {_r('volume_kwh', 'active_chargers', 'price_per_kwh', 'avg_duration_min')}
FROM readings"""

_SQL["forward_fill"] = f"SELECT station_id, timestamp, {_r(*_GRID_VALUES)} FROM clean"

_SQL["hourly_grid"] = f"""
SELECT station_id, timestamp, total_chargers, is_cbd, data_source, {_r(*_GRID_VALUES)}
FROM grid_hours"""

_MERGED_VALUES = tuple(dict.fromkeys(_HOUR_VALUES + _GRID_VALUES))
_SQL["merge_sources"] = f"""
SELECT station_id, timestamp, session_count, total_chargers, is_cbd, data_source,
       queue_length_proxy, {_r(*_MERGED_VALUES)} FROM merged"""

_SQL["grid_profile"] = """
SELECT count(*) AS grids, sum(total_chargers)::BIGINT AS total_chargers,
       sum(is_cbd)::BIGINT AS cbd_grids, (SELECT count(*) FROM readings) AS readings
FROM grids"""

_SQL["time_features"] = f"""
SELECT session_id, session_start, {_time('session_start')} FROM sessions"""

_SQL["utilization_revenue_cost"] = """
SELECT session_id,
       round(least(charging_duration_min / session_duration_min, 1::DOUBLE), 6)
         AS charger_utilization_rate,
       NULL::DOUBLE AS no_utilization, round(energy_kwh * 15, 6) AS revenue_per_session,
       round(charging_duration_min / 10, 6) AS energy_cost_per_kwh,
       15::DOUBLE AS baseline_cost_per_kwh
FROM sessions"""

_SQL["occupancy_from_chargers"] = f"""
SELECT station_id, timestamp, round({_OCCUPANCY}, 6) AS occupancy_density FROM grid_hours"""

_SQL["lag_features"] = f"""
SELECT station_id, timestamp, {_r('energy_kwh', *_LAG_NAMES)} FROM hour_features"""

_SQL["lag_global"] = f"""
SELECT station_id, timestamp, {_r('energy_kwh', *_LAG_NAMES)}
FROM (SELECT *, {_LAGS} FROM hours WINDOW w AS (ORDER BY timestamp, station_id))"""

_SQL["rolling_features"] = f"""
SELECT station_id, timestamp, {_r('energy_kwh', 'charger_utilization_rate', *_ROLLING_NAMES)}
FROM hour_features"""

_SQL["lag_rolling_deliveries"] = f"""
SELECT station_id, timestamp, {_r('energy_kwh', *_LAG_NAMES, *_ROLLING_NAMES[:3])}
FROM (SELECT *, {_LAGS}, {_rolling('energy_kwh')}
      FROM (SELECT station_id, hour_bucket AS timestamp, total_energy_kwh AS energy_kwh
            FROM daily) WINDOW w AS (PARTITION BY station_id ORDER BY timestamp))"""

_ROWS_PER_HOUR = """count(session_start) OVER (
         PARTITION BY station_id, date_trunc('hour', session_start))"""
_SQL["queue_proxy"] = f"""
SELECT session_id, station_id, session_start,
       greatest({_ROWS_PER_HOUR} - 1, 0) AS queue_length_proxy FROM sessions"""

_SQL["occupancy_density"] = f"""
SELECT session_id, station_id, session_start,
       round(least({_ROWS_PER_HOUR} / 10::DOUBLE, 1::DOUBLE), 6) AS occupancy_density
FROM sessions"""

_SQL["session_overlap"] = """
SELECT a.session_id, a.station_id, a.session_start, a.session_end,
       count(*) - 1 AS overlapping_sessions
FROM sessions a JOIN sessions b
  ON a.station_id = b.station_id AND b.session_start < a.session_end
 AND b.session_end > a.session_start
GROUP BY ALL"""

_SQL["sequence_windows"] = """
SELECT station_id, timestamp, round(energy_kwh, 6) AS target, 24::INT AS length,
       round(lag(energy_kwh, 24) OVER w, 6) AS first_energy,
       round(lag(energy_kwh, 1) OVER w, 6) AS last_energy,
       sum(session_count) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)::DOUBLE AS sessions
FROM hours WINDOW w AS (PARTITION BY station_id ORDER BY timestamp)
QUALIFY row_number() OVER w > 24"""

_SQL["tariff_grid"] = """
SELECT hour, u_idx, c_idx, coalesce(slots, 0)::BIGINT AS slots, tariff_inr
FROM lookup LEFT JOIN cells USING (hour, u_idx, c_idx)"""

_SQL["pricing_schedule"] = "SELECT hour, utilization, slots, tariff_inr FROM schedule"

_SQL["schedule_pivot"] = "SELECT utilization, " + ", ".join(
    f"avg(tariff_inr) FILTER (hour = {h}) AS h{h:02d}" for h in range(24)
) + " FROM schedule GROUP BY utilization"

_SQL["tariff_batch"] = f"""
SELECT station_id, timestamp, hour_of_day,
       {_r('predicted_utilization', 'congestion_probability', 'dynamic_tariff')} FROM priced"""

_SQL["single_tariff"] = f"""
SELECT event_id, tariff_inr AS dynamic_tariff
FROM (SELECT event_id, {_index('k / 60::DOUBLE', '0.5')} AS u_idx,
             {_index('value / 100', '0')} AS c_idx,
             coalesce(CASE WHEN event_type <> 'error' THEN extract('hour' FROM ts) END, 12)::INT
               AS hour
      FROM raw) JOIN lookup USING (hour, u_idx, c_idx)"""

_SQL["predictions_join"] = """
SELECT a.station_id, a.timestamp, round(a.energy_kwh, 6) AS energy_kwh,
       round(b.charger_rolling_6h, 6) AS predicted_utilization,
       coalesce(b.charger_rolling_6h > 0.8::DOUBLE, false)::INT AS congestion
FROM features a LEFT JOIN (SELECT * FROM features WHERE is_peak_hour = 1) b
  USING (station_id, timestamp)"""

_ONE_ROW = _aggregates("priced")
_SQL["revenue_simulation"] = f"SELECT {_select(_REVENUE)} FROM {_ONE_ROW}"
_SQL["utilization_change"] = f"SELECT {_select(_UTILIZATION)} FROM {_ONE_ROW}"
_SQL["off_peak_uplift"] = f"SELECT {_select(_OFF_PEAK)} FROM {_ONE_ROW}"
_SQL["tariff_evaluation"] = (
    f"SELECT {_select(_REVENUE | _UTILIZATION | _OFF_PEAK)} FROM {_ONE_ROW}")
_SQL["customer_response"] = f"""
SELECT {_even('pc', 2)} AS avg_price_change_pct,
       {_even('up * 100', 2)} AS pct_slots_price_increased,
       {_even('down * 100', 2)} AS pct_slots_price_decreased,
       -0.3::DOUBLE AS estimated_demand_elasticity,
       {_even('abs(-0.3::DOUBLE * pc)', 4)} AS customer_response_rate FROM {_ONE_ROW}"""
_SQL["pricing_efficiency"] = f"""
SELECT 15::DOUBLE AS baseline_efficiency_per_kwh,
       {_even('n / e', 2)} AS dynamic_efficiency_per_kwh,
       {_even('(n / e - 15) / 15 * 100', 2)} AS efficiency_improvement_pct FROM {_ONE_ROW}"""

_WAIT = f"""{_even('b', 2)} AS baseline_avg_wait_min, {_even('a', 2)} AS dynamic_avg_wait_min,
       CASE WHEN b > 0 THEN {_even('(b - a) / b * 100', 2)} ELSE 0 END::DOUBLE
         AS wait_time_reduction_pct"""
_SQL["wait_time"] = f"""
SELECT {_WAIT}, 'queue' AS branch
FROM (SELECT b, b * 0.7::DOUBLE AS a FROM (SELECT avg(q) * 5 AS b FROM (
        SELECT session_start, greatest({_ROWS_PER_HOUR} - 1, 0) AS q FROM sessions)
      WHERE extract('hour' FROM session_start) IN (8, 9, 10, 11, 17, 18, 19, 20)))
UNION ALL
SELECT {_WAIT}, 'utilization' AS branch
FROM (SELECT b, b * greatest(0.3::DOUBLE, 1 - (t - 1) * 0.5::DOUBLE) AS a
      FROM (SELECT avg(charger_utilization_rate * 15) AS b, avg(dynamic_tariff) / 15 AS t
            FROM priced WHERE is_peak_hour = 1))"""

_SHOWN = f"""* REPLACE ({_even('revenue_INR', 2)} AS revenue_INR,
       {_even('revenue_gain_pct', 2)} AS revenue_gain_pct,
       {_even('avg_utilization', 4)} AS avg_utilization)"""
_SQL["monitoring_rollup"] = f"SELECT {_SHOWN} FROM periods"
_SQL["monitoring_by_station"] = f"SELECT {_SHOWN} FROM station_periods"
_SQL["monitoring_summary"] = """
SELECT count(*) AS periods, round(avg(revenue_gain_pct), 6) AS avg_revenue_gain_pct,
       round(avg(pricing_efficiency), 6) AS avg_pricing_efficiency,
       round(avg(customer_response_rate), 6) AS avg_customer_response
FROM (SELECT """ + _SHOWN + " FROM periods)"
_SQL["feedback_signals"] = (
    f"SELECT station_id, time_period, period, {_feedback()} FROM group_periods")

_SQL["multiplier_path"] = f"""
SELECT station_id, time_period, period, action, tier, round(m, 6) AS multiplier FROM (
  WITH RECURSIVE numbered AS (
    SELECT station_id, time_period, period, tariff_feedback_action AS action,
           row_number() OVER (PARTITION BY station_id, time_period ORDER BY period) AS i
    FROM (SELECT *, {_feedback()} FROM group_periods)),
  path AS (
    SELECT s.station_id, s.time_period, 0::BIGINT AS i, t.tier, t.m
    FROM (SELECT DISTINCT station_id, time_period FROM numbered) s,
         (VALUES ('off_peak', 0.7::DOUBLE), ('low', 0.9), ('normal', 1.0), ('high', 1.2),
                 ('surge', 1.5)) t(tier, m)
    UNION ALL
    SELECT p.station_id, p.time_period, n.i, p.tier,
           p.m * CASE WHEN n.action = 'REDUCE_SURGE' AND p.m > 1 THEN 0.95::DOUBLE
                      WHEN n.action = 'INCREASE_DISCOUNT' AND p.m < 1 THEN 0.95::DOUBLE
                      ELSE 1 END
    FROM path p JOIN numbered n ON n.station_id = p.station_id
      AND n.time_period = p.time_period AND n.i = p.i + 1)
  SELECT * FROM path JOIN numbered USING (station_id, time_period, i))"""

_CTE["final_multipliers"] = """
SELECT tier, m FROM (
  WITH RECURSIVE numbered AS (
    SELECT row_number() OVER (ORDER BY period) AS i, CASE WHEN revenue_gain_pct < 0
      THEN 'REDUCE_SURGE' WHEN avg_utilization < 0.3::DOUBLE THEN 'INCREASE_DISCOUNT' END AS action
    FROM periods),
  path AS (
    SELECT 0::BIGINT AS i, tier, m FROM (VALUES ('off_peak', 0.7::DOUBLE), ('low', 0.9),
      ('normal', 1.0), ('high', 1.2), ('surge', 1.5)) t(tier, m)
    UNION ALL
    SELECT n.i, p.tier, p.m * CASE WHEN n.action = 'REDUCE_SURGE' AND p.m > 1 THEN 0.95::DOUBLE
      WHEN n.action = 'INCREASE_DISCOUNT' AND p.m < 1 THEN 0.95::DOUBLE ELSE 1 END
    FROM path p JOIN numbered n ON n.i = p.i + 1)
  SELECT * FROM path WHERE i = (SELECT max(i) FROM numbered))"""
_TIER = """CASE WHEN coalesce(round(predicted_utilization, 6), 0) < 0.3::DOUBLE THEN 'off_peak'
  WHEN round(predicted_utilization, 6) < 0.5::DOUBLE THEN 'low'
  WHEN round(predicted_utilization, 6) < 0.7::DOUBLE THEN 'normal'
  WHEN round(predicted_utilization, 6) < 0.8::DOUBLE THEN 'high' ELSE 'surge' END"""
_START = f"""CASE {_TIER} WHEN 'off_peak' THEN 0.7::DOUBLE WHEN 'low' THEN 0.9::DOUBLE
  WHEN 'normal' THEN 1 WHEN 'high' THEN 1.2::DOUBLE ELSE 1.5::DOUBLE END"""
_SQL["scenario_metrics"] = " UNION ALL ".join(
    f"SELECT '{name}' AS scenario, {_SHOWN} FROM ("
    + _periods(f"(SELECT p.* REPLACE ({price} AS dynamic_tariff) FROM {source})") + ")"
    for name, price, source in (
        ("baseline", "15::DOUBLE", "priced p"), ("best", "dynamic_tariff", "priced p"),
        ("tiers", f"15 * {_START}", "priced p"),
        ("tiers_after_feedback", "15 * f.m",
         f"priced p JOIN final_multipliers f ON f.tier = {_TIER}")))

_SQL["sketched_quantiles"] = " UNION ALL ".join(f"""
SELECT '{c}' AS measure, date_trunc('month', timestamp)::DATE AS month, '{n}' AS quantile,
       round(quantile_cont({c}, {s}), 6) AS exact, true AS within
FROM deliveries GROUP BY 2""" for c in ("energy_kwh", "duration_min")
    for n, s in (("p05", 0.05), ("median", 0.5), ("p95", 0.95)))

_SQL["sketched_distinct"] = """
SELECT date_trunc('year', timestamp)::DATE AS year, count(*) AS rows,
       count(DISTINCT station_id) AS exact, true AS within
FROM deliveries GROUP BY 1"""

_SESSION_TYPES = {
    "session_id": "string", "station_id": "string", "user_id": "string",
    "session_start": "timestamp_ntz", "session_end": "timestamp_ntz",
    "charging_end": "timestamp_ntz", "energy_kwh": "double",
    "session_duration_min": "double", "charging_duration_min": "double",
}


def _sample(column: str, kind: str) -> str:
    if kind == "timestamp_ntz":
        return _TEXT_TIME.format(t=f"min({column})")
    return f"CAST(min({column}) AS VARCHAR)"


_SQL["quality_report"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
  count(*) - count({c}) AS null_count,
  {_even(f'(count(*) - count({c})) * 100::DOUBLE / count(*)', 2)} AS null_pct,
  count(DISTINCT {c}) AS "unique", {_sample(c, t)} AS sample FROM sessions"""
    for c, t in _SESSION_TYPES.items())


def _summary(source: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS non_null, round(avg({c}), 6) AS mean
FROM {source}""" for c in columns)


_SQL["numeric_summary"] = _summary("merged", (
    "session_count", "queue_length_proxy", "total_chargers", "is_cbd") + _MERGED_VALUES)
_SQL["numeric_summary_deliveries"] = _summary("lineitem", (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax"))

_SQL["value_counts"] = """
SELECT data_source AS value, count(*) AS rows, 'data_source' AS kind FROM merged GROUP BY 1
UNION ALL
SELECT CAST(extract('hour' FROM timestamp) AS VARCHAR), count(*), 'hour' FROM merged
WHERE data_source = 'ACN' GROUP BY 1"""

_SQL["range_profile"] = """
SELECT data_source, count(*) AS rows, min(timestamp) AS first_timestamp,
       max(timestamp) AS last_timestamp, count(DISTINCT station_id) AS stations,
       round(min(energy_kwh), 6) AS min_energy, round(max(energy_kwh), 6) AS max_energy,
       count(*) FILTER (energy_kwh IS NULL) AS missing_energy
FROM merged GROUP BY 1"""

_SQL["monthly_energy"] = """
SELECT date_trunc('month', timestamp)::DATE AS month, round(sum(energy_kwh), 4) AS energy_kwh
FROM deliveries GROUP BY 1"""
_SQL["daily_energy"] = """
SELECT data_source, date_trunc('day', timestamp)::DATE AS day,
       round(sum(energy_kwh), 4) AS energy_kwh
FROM merged GROUP BY 1, 2"""

_SQL["hour_weekday_heatmap"] = "SELECT extract('hour' FROM timestamp)::INT AS hour_of_day, " + (
    ", ".join(
        f"round(avg(energy_kwh) FILTER (extract('isodow' FROM timestamp) = {i + 1}), 6) AS {d}"
        for i, d in enumerate(("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")))
) + " FROM merged GROUP BY 1"

_SQL["winsorised_energy"] = """
SELECT session_id, station_id,
       round(greatest(least(energy_kwh, cap), 0::DOUBLE), 6) AS energy_kwh
FROM sessions JOIN (SELECT station_id, quantile_cont(energy_kwh, 0.99) AS cap FROM sessions
                    GROUP BY 1) USING (station_id)"""

_SQL["weekday_weekend_box"] = """
SELECT data_source, is_weekend, count(*) AS rows, round(min(v), 6) AS minimum,
       round(quantile_cont(v, 0.25), 6) AS q1, round(quantile_cont(v, 0.5), 6) AS median,
       round(quantile_cont(v, 0.75), 6) AS q3, round(max(v), 6) AS maximum
FROM (SELECT data_source, is_weekend, greatest(least(energy_kwh, cap), 0::DOUBLE) AS v
      FROM (SELECT *, (extract('isodow' FROM timestamp) >= 6)::INT AS is_weekend FROM merged)
      JOIN (SELECT data_source, (extract('isodow' FROM timestamp) >= 6)::INT AS is_weekend,
                   quantile_cont(energy_kwh, 0.95) AS cap FROM merged GROUP BY 1, 2)
      USING (data_source, is_weekend))
GROUP BY 1, 2"""

_SQL["period_distribution"] = """
SELECT time_period, count(*) AS rows, round(avg(v), 6) AS mean,
       round(quantile_cont(v, 0.5), 6) AS median, round(any_value(cap), 6) AS cap
FROM (SELECT time_period, cap, greatest(least(energy_kwh, cap), 0::DOUBLE) AS v
      FROM features JOIN (SELECT time_period, quantile_cont(energy_kwh, 0.95) AS cap
                          FROM features GROUP BY 1) USING (time_period))
GROUP BY 1"""

_SQL["demand_volatility"] = """
SELECT time_period, round(avg(energy_kwh), 6) AS mean, round(stddev_samp(energy_kwh), 6) AS std,
       round(stddev_samp(energy_kwh) / avg(energy_kwh) * 100, 6) AS cv
FROM features GROUP BY 1"""


def _histogram(source: str, column: str) -> str:
    return f"""
SELECT bin, round(lo + (hi - lo) / 50 * bin, 6) AS bin_start,
       round(lo + (hi - lo) / 50 * (bin + 1), 6) AS bin_end, rows
FROM (SELECT least(floor((v - lo) / (hi - lo) * 50), 49)::INT AS bin, lo, hi, count(*) AS rows
      FROM (SELECT {column} AS v, min({column}) OVER () AS lo, max({column}) OVER () AS hi
            FROM {source} WHERE {column} IS NOT NULL) GROUP BY 1, 2, 3)"""


_SQL["util_histogram"] = _histogram("merged", "charger_utilization_rate")
_SQL["tariff_histogram"] = _histogram("priced", "dynamic_tariff")
_SQL["energy_histogram"] = _histogram("""(SELECT greatest(least(energy_kwh,
   (SELECT quantile_cont(energy_kwh, 0.99) FROM sessions)), 0::DOUBLE) AS energy_kwh
   FROM sessions)""", "energy_kwh")

_SQL["util_cdf"] = """
SELECT charger_utilization_rate, rows,
       round(sum(rows) OVER (ORDER BY charger_utilization_rate) / sum(rows) OVER (), 6)
         AS cumulative_share
FROM (SELECT round(charger_utilization_rate, 6) AS charger_utilization_rate, count(*) AS rows
      FROM merged WHERE charger_utilization_rate IS NOT NULL GROUP BY 1)"""

_SQL["band_shares"] = """
SELECT round(d, 6) AS discount_pct, round(s, 6) AS surge_pct, round(100 - d - s, 6) AS normal_pct
FROM (SELECT avg((charger_utilization_rate < 0.3::DOUBLE)::INT) * 100 AS d,
             avg((charger_utilization_rate > 0.8::DOUBLE)::INT) * 100 AS s FROM merged)"""

_CORRELATED = (
    "energy_kwh", "charger_utilization_rate", "hour_of_day", "day_of_week", "is_weekend",
    "is_peak_hour", "revenue_per_session", "occupancy_density", "demand_lag_1",
    "energy_rolling_6h", "energy_rolling_24h")


def _r_of(a: str, b: str) -> str:
    if a == b:
        return f"CASE WHEN stddev_pop({a}) > 0 THEN 1::DOUBLE END"
    sd = lambda x, y: f"stddev_pop({x}) FILTER ({y} IS NOT NULL)"
    return f"covar_pop({a}, {b}) / nullif({sd(a, b)} * {sd(b, a)}, 0)"


_SQL["correlation_matrix"] = """
SELECT c.a, c.b, round(c.r, 6) + 0 AS r FROM (SELECT unnest([""" + ", ".join(
    f"{{'a': '{a}', 'b': '{b}', 'r': {_r_of(a, b)}}}" for a in _CORRELATED for b in _CORRELATED
) + "]) AS c FROM features)"

_SQL["tariff_by_hour"] = """
SELECT hour_of_day, round(avg(dynamic_tariff), 6) AS avg_tariff FROM priced GROUP BY 1"""

_SHARED = ("avg_duration_min", "charger_utilization_rate", "energy_kwh")
_SQL["group_metric_table"] = "SELECT data_source, count(*) AS rows, " + ", ".join(
    f"round({f}({c}), 6) AS {n}_{c}" for f, n in (("avg", "mean"), ("stddev_samp", "std"))
    for c in _SHARED) + " FROM merged GROUP BY 1"

_SQL["top_station_hours"] = """
SELECT station_id, timestamp, session_count, round(energy_kwh, 6) AS energy_kwh FROM hours
ORDER BY round(energy_kwh, 6) DESC NULLS LAST, station_id, timestamp LIMIT 20"""


def _split(order: str, place: str) -> str:
    return f"""
SELECT station_id, timestamp, round(energy_kwh, 6) AS energy_kwh,
       round(demand_lag_24, 6) AS demand_lag_24,
       CASE WHEN {place} < floor(n * 0.7::DOUBLE) THEN 'train'
            WHEN {place} < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'validation'
            ELSE 'test' END AS split
FROM (SELECT *, {order} AS pos, count(*) OVER () AS n FROM features
      WHERE demand_lag_24 IS NOT NULL AND energy_kwh IS NOT NULL)"""


# rows of one instant share the place of the first of them that passes a cut
_SQL["chrono_split"] = """
SELECT station_id, timestamp, round(energy_kwh, 6) AS energy_kwh,
       round(demand_lag_24, 6) AS demand_lag_24,
       CASE WHEN timestamp < max(c1) OVER () THEN 'train'
            WHEN timestamp < max(c2) OVER () THEN 'validation' ELSE 'test' END AS split
FROM (SELECT *, CASE WHEN pos = floor(n * 0.7::DOUBLE) THEN timestamp END AS c1,
             CASE WHEN pos = floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE)
                  THEN timestamp END AS c2
      FROM (SELECT *, row_number() OVER (ORDER BY timestamp) - 1 AS pos, count(*) OVER () AS n
            FROM features WHERE demand_lag_24 IS NOT NULL AND energy_kwh IS NOT NULL))"""
_SQL["position_split"] = _split("row_number() OVER (ORDER BY station_id, timestamp) - 1", "pos")

_SQL["regression_metrics"] = (
    "SELECT model, round(RMSE, 6) AS \"RMSE\", round(MAE, 6) AS \"MAE\", round(R2, 6) AS \"R2\" "
    "FROM scores_by_model")
_SQL["best_model"] = _SQL["regression_metrics"] + " ORDER BY RMSE, model LIMIT 1"

_SQL["pipeline_preprocess"] = """
SELECT data_source, station_id, count(*) AS hours, round(sum(energy_kwh), 4) AS energy_kwh,
       round(avg(charger_utilization_rate), 4) AS mean_utilization,
       round(avg(price_per_kwh), 4) AS mean_price
FROM merged GROUP BY 1, 2"""

_SQL["pipeline_features"] = f"""
SELECT station_id, timestamp, session_count, total_chargers, is_cbd, data_source, hour_of_day,
       day_of_week, is_weekend, is_peak_hour, month, day_of_month, time_period,
       queue_length_proxy,
       {_r(*_MERGED_VALUES, 'revenue_per_session', 'energy_cost_per_kwh', 'occupancy_density',
           *_LAG_NAMES, *_ROLLING_NAMES)}
FROM features"""

_SQL["pipeline_tariff"] = f"""
SELECT {_select(_REVENUE | _UTILIZATION | _OFF_PEAK)}
FROM {_aggregates('(SELECT *, charger_utilization_rate AS predicted_utilization FROM all_priced)')}"""

_SQL["pipeline_monitor"] = f"""
SELECT * EXCLUDE (demand_rmse, demand_r2) REPLACE ({_SHOWN.split('REPLACE (', 1)[1]},
       {_feedback()}
FROM (SELECT * FROM source_periods JOIN day_fit USING (period))"""

# the features a model of the energy gets: those not computed from the energy of the row
_MODEL_FEATURES = (
    "hour_of_day", "day_of_week", "is_weekend", "is_peak_hour", "month", "day_of_month",
    "charger_utilization_rate", "energy_cost_per_kwh", "queue_length_proxy",
    "occupancy_density", *_LAG_NAMES,
    *(f"charger_rolling_{n}h" for n in (1, 6, 24)))


def _model(name: str) -> str:
    complete = " AND ".join(f"{c} IS NOT NULL" for c in (*_MODEL_FEATURES, "energy_kwh"))
    split = _SQL["chrono_split"].replace(
        "demand_lag_24 IS NOT NULL AND energy_kwh IS NOT NULL", complete)
    return f"""
SELECT split, count(*) AS rows, count(*) AS predictions, true AS beats_mean,
       round(avg(energy_kwh), 6) AS mean_actual, '{','.join(_MODEL_FEATURES)}' AS features,
       '{name}' AS model
FROM ({split.replace('round(energy_kwh, 6) AS energy_kwh', 'energy_kwh')}) GROUP BY split"""


_SQL["demand_forest"] = _model("random_forest")
_SQL["demand_gbt"] = _model("gradient_boosting")
_SQL["feature_importance"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, true AS is_share, true AS sums_to_one, true AS top_in_order" for c in _MODEL_FEATURES)


_CTE["session_features"] = _features(
    "hours", "least(greatest((queue_length_proxy + 1) / 10::DOUBLE, 0), 1)::DOUBLE")
_SQL["incremental_features"] = f"""
SELECT station_id, timestamp, session_count, data_source, hour_of_day, day_of_week, is_weekend,
       is_peak_hour, month, day_of_month, time_period, queue_length_proxy,
       {_r('total_energy_kwh', 'avg_energy_kwh', 'avg_duration_min', 'avg_charging_min',
           'charger_utilization_rate', 'energy_kwh', 'revenue_per_session',
           'energy_cost_per_kwh', 'occupancy_density', *_LAG_NAMES, *_ROLLING_NAMES)}
FROM session_features"""

_SQL["grid_files"] = _SQL["grid_outer_join"]
_SQL["raw_convert"] = f"""
SELECT form, CAST(event_id AS VARCHAR) AS "_id", CAST(event_id AS VARCHAR) AS "sessionID",
       station_id AS "stationID", {_TEXT_TIME.format(t='ts')} AS "connectionTime",
       value AS "kWhDelivered"
FROM raw, (VALUES ('json'), ('csv')) v(form)"""
_SQL["station_order"] = """
SELECT station_id, timestamp, row_number() OVER (ORDER BY station_id, timestamp) - 1 AS place
FROM hours"""
_SQL["split_by_source"] = """
SELECT data_source AS part, station_id, count(*) AS hours FROM merged GROUP BY 1, 2"""
_SQL["monitoring_export"] = f"""
SELECT {_SHOWN} FROM periods JOIN (
  SELECT period, {_feedback()} FROM (SELECT *, 0::DOUBLE AS demand_r2, 0::DOUBLE AS demand_rmse
                                     FROM periods)) USING (period)"""
_SQL["models_saved"] = f"""
SELECT split, count(*) AS rows, 0::BIGINT AS different FROM ({_SQL["demand_forest"].split("FROM (", 1)[1].rsplit(")", 1)[0]})
GROUP BY split"""

_SQL["bucketed_features"] = _SQL["pipeline_features"]
_SQL["bucketed_predictions"] = _SQL["predictions_join"]


def _stable_rounding(sql: str) -> str:
    """Every round(x, n) as the scaled form, which both engines compute alike."""
    while found := re.search(r"\bround\(", sql):
        depth, end = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[found.end():end - 1].rsplit(",", 1)
        sql = sql[:found.start()] + _even(value, int(digits)) + sql[end:]
    return sql


ORACLES: dict[str, str] = {name: _stable_rounding(_with(sql)) for name, sql in _SQL.items()}
