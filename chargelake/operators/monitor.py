"""Metrics per reporting period, feedback on them and the path of the tier multipliers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake import config
from chargelake.functions.scalar import floor_time, gain_percent, half_even
from chargelake.operators.metrics import (
    efficiency_metric, regression_metric, report, response_metric, revenue_metric,
    waiting_metric, Metric,
)


def episode_metric(df: DataFrame, energy: str = "energy_kwh",
                   utilization: str = "predicted_utilization",
                   tariff: str = "dynamic_tariff") -> Metric:
    """Revenue, utilisation, waiting, efficiency and response at the prices in `tariff`.

    Revenue, gain and utilisation are not rounded; feedback works on the exact values.
    """
    if utilization not in df.columns:
        utilization = "charger_utilization_rate"
    parts = (
        revenue_metric(df, energy, tariff) | waiting_metric(df, tariff=tariff)
        | response_metric(df, tariff)
        | efficiency_metric(df, revenue=f"{tariff.removesuffix('_tariff')}_revenue", energy=energy,
                            tariff=tariff)
    )
    return Metric(parts.aggregates | {"_mean_use": F.avg(utilization)}, {
        "revenue_INR": F.col("_new_revenue"),
        "revenue_gain_pct": gain_percent(F.col("_old_revenue"), F.col("_new_revenue")),
        "avg_utilization": F.col("_mean_use"),
        "avg_wait_time_min": parts.results["dynamic_avg_wait_min"],
        "pricing_efficiency": parts.results["dynamic_efficiency_per_kwh"],
        "customer_response_rate": parts.results["customer_response_rate"],
    })


def period_metrics(df: DataFrame, unit: str | None = "day", ts: str = "timestamp",
                   energy: str = "energy_kwh", by: Sequence[str] = (),
                   utilization: str = "predicted_utilization",
                   forecast: tuple[str, str] | None = None) -> DataFrame:
    """Revenue, utilisation, waiting, efficiency and response per period and group.

    All metrics of a period come from the same aggregate. The table must be priced.
    `forecast` names an observed column and its forecast, whose error and fit are added as
    `demand_rmse` and `demand_r2`.
    """
    groups = list(by)
    if unit:
        df = df.withColumn("period", floor_time(ts, unit))
        groups.append("period")
    metric = episode_metric(df, energy, utilization)
    if forecast:
        fit = regression_metric(*forecast)
        metric = Metric(fit.aggregates | metric.aggregates, {
            "demand_rmse": fit.results["RMSE"], "demand_r2": fit.results["R2"],
        } | metric.results)
    return report(df, metric, groups)


def rounded_periods(df: DataFrame) -> DataFrame:
    """The metrics of a period with the places they are shown with."""
    places = {"revenue_INR": 2, "revenue_gain_pct": 2, "avg_utilization": 4}
    return df.withColumns({c: half_even(F.col(c), n) for c, n in places.items()})


def _signal(action: str, *reason: Column | str | int) -> Column:
    text = F.lit(reason[0])
    if len(reason) == 3:
        template, value, digits = reason
        text = F.format_string(template, half_even(value, digits))
    return F.struct(F.lit(action).alias("action"), text.alias("reason"))


def add_feedback(df: DataFrame) -> DataFrame:
    """Feedback to the demand models and to the tariff, as action and reason.

    Periods without model metrics (`demand_r2`, `demand_rmse`) count as not predicted.
    """
    model = lambda name: (
        F.coalesce(F.col(name), F.lit(0.0)) if name in df.columns else F.lit(0.0)
    )
    r2, rmse = model("demand_r2"), model("demand_rmse")
    gain, use = F.col("revenue_gain_pct"), F.col("avg_utilization")
    # fixed values: actions, reasons and thresholds of the feedback
    demand = (
        F.when(r2 < 0.6, _signal("RETRAIN", "R² = %.3f is below 0.6 threshold", r2, 3))
        .when(rmse > 0.2, _signal("FINE_TUNE", "RMSE = %.4f is above 0.2 threshold", rmse, 4))
        .otherwise(_signal("MAINTAIN", "Model performance is acceptable"))
    )
    tariff = (
        F.when(gain < 0, _signal(
            "REDUCE_SURGE", "Revenue decreased by %.1f%% — pricing may be too aggressive", gain, 1))
        .when(use < config.DISCOUNT_UTILISATION, _signal(
            "INCREASE_DISCOUNT",
            "Average utilization %.2f is below 0.3 — increase discounts", use, 2))
        .when(gain > 20, _signal(
            "MODERATE", "Revenue gain %.1f%% is very high — may be overly aggressive", gain, 1))
        .otherwise(_signal("MAINTAIN", "Pricing performance is balanced"))
    )
    return df.withColumns({"demand_feedback": demand, "tariff_feedback": tariff})


def _reductions_to_leave(multiplier: float) -> int:
    """How many reductions bring a surge multiplier to one or below."""
    return max(0, math.ceil(math.log(1 / multiplier) / math.log(config.TIER_STEP)))


def multiplier_path(feedback: DataFrame, order: str = "period",
                    by: Sequence[str] = ()) -> DataFrame:
    """Multiplier of every pricing tier after each period's feedback.

    REDUCE_SURGE shrinks tiers above one, INCREASE_DISCOUNT those below. A surge tier that
    has been reduced past one turns into a discount tier, so its value follows from the
    reductions so far and the discounts given after that turn. `feedback` has one row per
    period, so the window over it is small.
    """
    action = F.col("tariff_feedback.action")
    upto = (
        Window.partitionBy(*by).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = feedback.withColumns({
        "_reduced": F.count_if(action == "REDUCE_SURGE").over(upto),
        "_discounted": F.count_if(action == "INCREASE_DISCOUNT").over(upto),
    })
    step = F.lit(config.TIER_STEP)
    paths = []
    extra = {}
    for i, (tier, start) in enumerate(config.TIER_MULTIPLIERS.items()):
        if start < 1:
            value = start * F.pow(step, F.col("_discounted"))
        elif start > 1:
            turn = _reductions_to_leave(start)
            # discounts given before the turn do not touch the tier
            extra[f"_turn_{i}"] = F.min(
                F.when(F.col("_reduced") >= turn, F.col("_discounted"))
            ).over(upto)
            later = F.coalesce(F.col("_discounted") - F.col(f"_turn_{i}"), F.lit(0))
            value = start * F.pow(step, F.least(F.col("_reduced"), F.lit(turn)) + later)
        else:
            value = F.lit(start)
        paths.append(F.struct(F.lit(tier).alias("tier"), value.alias("multiplier")))
    return (
        counted.withColumns(extra)
        .select(*by, order, action.alias("action"), F.explode(F.array(*paths)).alias("t"))
        .select(*by, order, "action", "t.tier", "t.multiplier")
    )


def summarise_periods(periods: DataFrame) -> DataFrame:
    """Means over the reporting periods."""
    return periods.agg(
        F.count(F.lit(1)).alias("periods"),
        F.avg("revenue_gain_pct").alias("avg_revenue_gain_pct"),
        F.avg("pricing_efficiency").alias("avg_pricing_efficiency"),
        F.avg("customer_response_rate").alias("avg_customer_response"),
    )
