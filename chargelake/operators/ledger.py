"""What cleaning dropped, filled and could not read, counted in the pass that cleans.

The counts are observed metrics of the cleaning plan itself: they come with the first
action on the cleaned frame, and no job is run for them. Rules are counted before the rows
go, so with a ledger the filters no longer reach the file scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from chargelake import config, schemas
from chargelake.functions.scalar import clip, ratio
from chargelake.operators.cleaning import add_durations, nan_to_null, parse_session_times
from chargelake.operators.ordered import carry_forward

TABLE = "stage string, rule string, effect string, rows bigint"
_RULE = "_rule"


@dataclass
class Ledger:
    """Counts by stage and rule; `entries` waits for the first action on the cleaned frames."""

    _parts: list[tuple[str, DataFrame, dict[tuple[str, str], Column], Observation]] = field(
        default_factory=list)

    def watch(self, stage: str, df: DataFrame, counts: dict[tuple[str, str], Column]) -> DataFrame:
        """`df`, observed: counts maps (rule, effect) to a condition on its rows."""
        observation = Observation(f"ledger_{stage}_{len(self._parts)}")
        self._parts.append((stage, df, counts, observation))
        return df.observe(observation, *_named(counts))

    def entries(self, recount: bool = False) -> list[tuple[str, str, str, int]]:
        """(stage, rule, effect, rows); with `recount`, from an aggregation of their own.

        A stage that is run again after an executor was lost may be observed twice. Then
        the counts don't reconcile, and counting anew gives the right ones.
        """
        found = []
        for stage, df, counts, observation in self._parts:
            values = (df.agg(*_named(counts)).first().asDict() if recount else observation.get)
            found += [(stage, rule, effect, int(values[f"c{i}"] or 0))
                      for i, (rule, effect) in enumerate(counts)]
        return found

    def reconciles(self, entries: list[tuple[str, str, str, int]] | None = None) -> bool:
        """Whether in each stage the rows that came in were dropped or went out."""
        sums: dict[str, int] = {}
        for stage, _, effect, rows in self.entries() if entries is None else entries:
            sums[stage] = sums.get(stage, 0) + {"in": rows, "dropped": -rows, "out": -rows}.get(
                effect, 0)
        return not any(sums.values())

    def table(self, spark: SparkSession) -> DataFrame:
        """The entries as a table, counted anew if they don't reconcile."""
        entries = self.entries()
        if not self.reconciles(entries):
            entries = self.entries(recount=True)
        return spark.createDataFrame(entries, TABLE)


def _named(counts: dict[tuple[str, str], Column]) -> list[Column]:
    return [F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(counts.values())]


def clean_sessions(df: DataFrame, ledger: Ledger, stage: str = "sessions") -> DataFrame:
    """cleaning.clean_sessions, with the ledger kept.

    A row is counted under the first rule that drops it: no energy, an end by the start,
    energy not above zero. Times that are there but can't be read are counted per column.
    """
    times = [c for c in ("connectionTime", "disconnectTime", "doneChargingTime") if c in df.columns]
    texts = [c for c in times if isinstance(df.schema[c].dataType, T.StringType)]
    parsed = parse_session_times(nan_to_null(df.withColumns({f"_text_{c}": F.col(c) for c in texts})))
    rules = []
    if "kWhDelivered" in df.columns:
        rules.append(("energy_missing", F.col("kWhDelivered").isNull()))
    if {"connectionTime", "disconnectTime"} <= set(times):
        rules.append(("duration_not_positive", F.col("disconnectTime") <= F.col("connectionTime")))
    if "kWhDelivered" in df.columns:
        rules.append(("energy_not_positive", F.col("kWhDelivered") <= 0))
    rule = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        rule = F.when(condition, name).otherwise(rule)
    parsed = add_durations(parsed.withColumn(_RULE, rule))
    counts = {("all", "in"): F.lit(True)}
    counts |= {(name, "dropped"): F.col(_RULE) == name for name, _ in rules}
    counts |= {(c, "unread"): (F.trim(f"_text_{c}") != "") & F.col(c).isNull() for c in texts}
    if "charging_duration_min" in parsed.columns:
        counts[("charging_duration", "filled")] = (
            F.col(_RULE).isNull() & F.col("doneChargingTime").isNull()
            & F.col("charging_duration_min").isNotNull())
    kept = ledger.watch(stage, parsed, counts).filter(F.col(_RULE).isNull())
    kept = kept.drop(_RULE, *[f"_text_{c}" for c in texts])
    kept = kept.withColumnsRenamed(schemas.SESSION_NAMES).withColumn(
        "data_source", F.lit(config.SESSION_SOURCE))
    return ledger.watch(stage, kept, {("all", "out"): F.lit(True)})


def clean_grid(df: DataFrame, ledger: Ledger,
               fill: Iterable[str] = tuple(schemas.GRID_MEASURES.values()),
               chunk: str = "month", stage: str = "grid") -> DataFrame:
    """cleaning.clean_grid, with the ledger kept.

    Per measure: cells filled with the last earlier value, and cells before any value that
    were set to zero. Rows whose utilisation can't be computed and counts as zero.
    """
    measures = [c for c in fill if c in df.columns]
    carry = bool(measures) and "station_id" in df.columns
    out = nan_to_null(df)
    counts = {("all", "in"): F.lit(True), ("all", "out"): F.lit(True)}
    if carry:
        out = out.withColumns({f"_null_{c}": F.col(c).isNull() for c in measures})
        out = carry_forward(out, ["station_id"], "timestamp", measures, chunk)
        for c in measures:
            counts[(c, "filled")] = F.col(f"_null_{c}") & F.col(c).isNotNull()
            counts[(c, "zeroed")] = F.col(c).isNull()
    share = None
    if {"active_chargers", "total_chargers"} <= set(df.columns):
        active = F.coalesce("active_chargers", F.lit(0.0)) if carry else F.col("active_chargers")
        share = clip(ratio(active, "total_chargers"), 0.0, 1.0)
        counts[("charger_utilization_rate", "zeroed")] = share.isNull()
    out = ledger.watch(stage, out, counts)
    if carry:
        out = out.drop(*[f"_null_{c}" for c in measures])
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in measures})
    if share is not None:
        share = clip(ratio("active_chargers", "total_chargers"), 0.0, 1.0)
        out = out.withColumn("charger_utilization_rate", F.coalesce(share, F.lit(0.0)))
    if "volume_kwh" in df.columns and "energy_kwh" not in df.columns:
        out = out.withColumn("energy_kwh", F.col("volume_kwh"))
    return out
