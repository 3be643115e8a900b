"""One-row (or row-per-group) metrics of pricing and prediction.

Every metric is a `Metric`: the aggregates it needs and the results computed from them.
Metrics that are reported together are merged, so that any number of them costs one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from chargelake import config
from chargelake.functions.scalar import clip, gain_percent, half_even, ratio


@dataclass
class Metric:
    aggregates: dict[str, Column] = field(default_factory=dict)
    results: dict[str, Column] = field(default_factory=dict)

    def __or__(self, other: Metric) -> Metric:
        return Metric(self.aggregates | other.aggregates, self.results | other.results)


def report(df: DataFrame, metric: Metric, by: Sequence[str] = ()) -> DataFrame:
    """Evaluate metrics in one aggregate, over the table or per group."""
    needed = {**metric.aggregates, "_rows": F.count(F.lit(1))}
    return (
        df.groupBy(*by).agg(*[c.alias(n) for n, c in needed.items()])
        .select(*by, *[c.alias(n) for n, c in metric.results.items()])
    )


def _sum0(column: Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def revenue_metric(df: DataFrame, energy: str = "energy_kwh",
                   tariff: str = "dynamic_tariff") -> Metric:
    """Revenue at the fixed and at the dynamic tariff."""
    if energy not in df.columns:
        return Metric()
    if tariff not in df.columns:
        raise ValueError(f"price the table first: it has no column {tariff!r}")
    old, new = F.col("_old_revenue"), F.col("_new_revenue")
    return Metric(
        {
            "_old_revenue": _sum0(F.col(energy) * config.BASELINE_TARIFF),
            "_new_revenue": _sum0(F.col(energy) * F.col(tariff)),
            "_mean_tariff": F.avg(tariff),
        },
        {
            "baseline_revenue_INR": half_even(old, 2),
            "dynamic_revenue_INR": half_even(new, 2),
            "revenue_gain_pct": half_even(gain_percent(old, new), 2),
            "baseline_tariff": F.lit(config.BASELINE_TARIFF),
            "avg_dynamic_tariff": half_even(F.col("_mean_tariff"), 2),
        },
    )


def utilization_metric(df: DataFrame, utilization: str = "charger_utilization_rate",
                       tariff: str = "dynamic_tariff") -> Metric:
    """Mean utilisation before and after the response to the tariff."""
    if not {utilization, tariff} <= set(df.columns):
        return Metric()
    demand = clip(
        1 + config.ELASTICITY * (F.col(tariff) / config.BASELINE_TARIFF - 1),
        *config.EVALUATION_DEMAND_BOUNDS,
    )
    before, after = F.col("_util_before"), F.col("_util_after")
    change = half_even(ratio(after - before, before) * 100, 2)
    return Metric(
        {
            "_util_before": F.avg(utilization),
            "_util_after": F.avg(clip(F.col(utilization) * demand, 0.0, 1.0)),
        },
        {
            "avg_util_before": half_even(before, 4),
            "avg_util_after": half_even(after, 4),
            "util_change_pct": F.when(before > 0, change).otherwise(0.0),
        },
    )


def off_peak_metric(df: DataFrame, utilization: str = "charger_utilization_rate",
                    tariff: str = "dynamic_tariff") -> Metric:
    """Low-utilisation slots, their discount and the sessions it may add."""
    if utilization not in df.columns:
        return Metric()
    idle = F.col(utilization) < config.DISCOUNT_UTILISATION
    aggregates = {"_idle": F.count_if(idle)}
    drop = F.lit(0.0)
    if tariff in df.columns:
        aggregates["_idle_price"] = F.avg(
            F.when(idle, F.col(tariff) / config.BASELINE_TARIFF)
        )
        drop = F.coalesce((1 - F.col("_idle_price")) * 100, F.lit(0.0))
    share = ratio(F.col("_idle"), F.col("_rows")) * 100
    return Metric(aggregates, {
        "off_peak_slots": F.col("_idle"),
        "off_peak_pct": F.coalesce(half_even(share, 2), F.lit(0.0)),
        "avg_discount_pct": half_even(drop, 2),
        "estimated_session_uplift_pct": half_even(drop * abs(config.ELASTICITY), 2),
    })


def tariff_metric(df: DataFrame, energy: str = "energy_kwh") -> Metric:
    return revenue_metric(df, energy) | utilization_metric(df) | off_peak_metric(df)


def _peak(df: DataFrame, default: bool) -> Column:
    if "is_peak_hour" not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col("is_peak_hour") == 1, F.lit(False))


def waiting_metric(df: DataFrame, queue: str = "queue_length_proxy",
                   tariff: str = "dynamic_tariff",
                   utilization: str = "charger_utilization_rate") -> Metric:
    """Peak waiting time before and after pricing, from queues or else from utilisation."""
    before = F.col("_wait_before")
    if queue in df.columns:
        aggregates = {"_wait_before": F.avg(F.when(_peak(df, True), F.col(queue))) * 5}
        after = before * 0.7
    elif utilization in df.columns:
        # without any peak row all rows count, but there is no peak price then
        peak = _peak(df, False)
        wait = F.col(utilization) * 15
        aggregates = {
            "_wait_before": F.when(F.count_if(peak) > 0, F.avg(F.when(peak, wait)))
            .otherwise(F.avg(wait))
        }
        after = before
        if tariff in df.columns:
            aggregates["_peak_price"] = (
                F.avg(F.when(peak, F.col(tariff))) / config.BASELINE_TARIFF
            )
            # greatest skips a missing peak price
            after = before * F.greatest(F.lit(0.3), 1 - (F.col("_peak_price") - 1) * 0.5)
    else:
        aggregates = {"_wait_before": F.max(F.lit(0.0))}
        after = before
    reduction = half_even(ratio(before - after, before) * 100, 2)
    return Metric(aggregates, {
        "baseline_avg_wait_min": half_even(before, 2),
        "dynamic_avg_wait_min": half_even(after, 2),
        "wait_time_reduction_pct": F.when(before > 0, reduction).otherwise(0.0),
    })


def response_metric(df: DataFrame, tariff: str = "dynamic_tariff") -> Metric:
    """Price change, how many slots got dearer or cheaper, and the expected response."""
    if tariff not in df.columns:
        return Metric({}, {"customer_response_rate": F.lit(0.0)})
    change = (F.col(tariff) / config.BASELINE_TARIFF - 1) * 100
    share = lambda condition: F.avg(F.coalesce(condition, F.lit(False)).cast("int"))
    mean = F.col("_price_change")
    return Metric(
        {
            "_price_change": F.avg(change),
            "_dearer": share(change > 0),
            "_cheaper": share(change < 0),
        },
        {
            "avg_price_change_pct": half_even(mean, 2),
            "pct_slots_price_increased": half_even(F.col("_dearer") * 100, 2),
            "pct_slots_price_decreased": half_even(F.col("_cheaper") * 100, 2),
            "estimated_demand_elasticity": F.lit(config.ELASTICITY),
            "customer_response_rate": half_even(F.abs(config.ELASTICITY * mean), 4),
        },
    )


def efficiency_metric(df: DataFrame, revenue: str = "dynamic_revenue",
                      energy: str = "energy_kwh", tariff: str = "dynamic_tariff") -> Metric:
    """Revenue per kWh, compared with the fixed tariff."""
    if energy not in df.columns:
        return Metric({}, {"pricing_efficiency": F.lit(0.0)})
    if revenue in df.columns:
        earned = F.col(revenue)
    elif tariff in df.columns:
        earned = F.col(energy) * F.col(tariff)
    else:
        earned = F.col(energy) * config.BASELINE_TARIFF
    total = F.col("_total_energy")
    per_kwh = F.when(total > 0, ratio(F.col("_earned"), total)).otherwise(0.0)
    better = (per_kwh - config.BASELINE_TARIFF) / config.BASELINE_TARIFF * 100
    return Metric(
        {"_total_energy": _sum0(F.col(energy)), "_earned": _sum0(earned)},
        {
            "baseline_efficiency_per_kwh": F.lit(config.BASELINE_TARIFF),
            "dynamic_efficiency_per_kwh": half_even(per_kwh, 2),
            "efficiency_improvement_pct": half_even(better, 2),
        },
    )


def regression_metric(actual: str = "actual", predicted: str = "prediction") -> Metric:
    """RMSE, MAE and R2 over the rows that have both values."""
    both = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    y = F.when(both, F.col(actual).cast("double"))
    error = y - F.col(predicted)
    squares = F.col("_mse") * F.col("_n")
    spread = F.col("_variance") * F.col("_n")
    perfect = F.when(squares == 0, 1.0).otherwise(0.0)
    return Metric(
        {
            "_n": F.count(y), "_mse": F.avg(error * error),
            "_mae": F.avg(F.abs(error)), "_variance": F.var_pop(y),
        },
        {
            "RMSE": F.sqrt("_mse"),
            "MAE": F.col("_mae"),
            "R2": F.when(F.col("_n") > 0, F.coalesce(1 - ratio(squares, spread), perfect)),
        },
    )
