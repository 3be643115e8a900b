"""Metrics of several price scenarios from one pass over the rows.

Each row gets the price of every scenario side by side; all their sums are made in the same
aggregate, and only its few result rows are turned into one row per scenario.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from chargelake import config
from chargelake.functions.scalar import as_column, floor_time
from chargelake.operators.metrics import Metric
from chargelake.operators.monitor import episode_metric


def baseline_price() -> Column:
    return F.lit(config.BASELINE_TARIFF)


def tier(utilization: Column | str) -> Column:
    """Name of the pricing tier of a utilisation; a missing one counts as idle."""
    use = F.coalesce(as_column(utilization), F.lit(0.0))
    *lower, last = config.TIER_BOUNDS.items()
    named = F.lit(last[0])
    for name, upper in reversed(lower):
        named = F.when(use < upper, name).otherwise(named)
    return named


def tier_price(utilization: Column | str, multipliers: dict[str, float]) -> Column:
    """The baseline tariff times the multiplier of the row's tier."""
    of = F.create_map(*[F.lit(x) for pair in multipliers.items() for x in pair])
    return F.element_at(of, tier(utilization)) * config.BASELINE_TARIFF


def path_prices(path: DataFrame, utilization: Column | str, order: str = "period"
                ) -> dict[str, Column]:
    """Prices with the multipliers at the start and at the end of a path of feedback.

    `path` is one group's from `monitor.multiplier_path`: five rows per period, of which
    the last period's come to the driver.
    """
    last = path.groupBy("tier").agg(F.max_by("multiplier", order).alias("m")).collect()
    return {
        "tiers": tier_price(utilization, config.TIER_MULTIPLIERS),
        "tiers_after_feedback": tier_price(
            utilization, config.TIER_MULTIPLIERS | {r["tier"]: r["m"] for r in last}),
    }


def scenario_metrics(df: DataFrame, scenarios: dict[str, Column], energy: str = "energy_kwh",
                     unit: str | None = None, ts: str = "timestamp", by: Sequence[str] = (),
                     utilization: str = "predicted_utilization") -> DataFrame:
    """The metrics of `monitor.period_metrics` per scenario, and per period and group.

    `scenarios` maps names to the price of a row. Metrics are not rounded further than there.
    """
    groups = list(by)
    if unit:
        df = df.withColumn("period", floor_time(ts, unit))
        groups.append("period")
    prices = {f"_price_{i}": price for i, price in enumerate(scenarios.values())}
    rows = df.withColumns(prices)
    metrics = [episode_metric(rows, energy, utilization, name) for name in prices]
    sums, states = [], []
    for i, (name, metric) in enumerate(zip(scenarios, metrics)):
        needed = {**metric.aggregates, "_rows": F.count(F.lit(1))}
        sums += [column.alias(f"{c}_{i}") for c, column in needed.items()]
        states.append(F.struct(F.lit(name).alias("scenario"),
                               *[F.col(f"{c}_{i}").alias(c) for c in needed]))
    results: Metric = metrics[0]
    return (
        rows.groupBy(*groups).agg(*sums)
        .select(*groups, F.explode(F.array(*states)).alias("_s")).select(*groups, "_s.*")
        .select("scenario", *groups, *[c.alias(n) for n, c in results.results.items()])
    )
