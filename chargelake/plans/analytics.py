"""Features, demand models, pricing and monitoring as plans over the hourly table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from chargelake.operators.demand import (
    evaluate_all, gradient_boosting, model_features, prepare, random_forest, train,
)
from chargelake.operators.features import build_features
from chargelake.operators.metrics import report, tariff_metric
from chargelake.operators.monitor import add_feedback, multiplier_path, period_metrics
from chargelake.operators.tariff import price_table, with_predictions
from chargelake.session import stored

REGRESSORS = {"gradient_boosting": gradient_boosting, "random_forest": random_forest}


def engineer_features(merged: DataFrame, chunk: str = "year") -> DataFrame:
    return build_features(merged, chunk)


def predict_demand(
    features: DataFrame, target: str = "energy_kwh",
    regressors: dict | None = None, mode: str = "time",
) -> tuple[dict[str, PipelineModel], DataFrame, DataFrame]:
    """Trained models, their metrics and the prepared rows.

    Training makes many passes, so the prepared rows are stored first.
    """
    names = model_features(features, target)
    prepared = stored(prepare(features, target, names, mode), "prepared")
    regressors = regressors or {n: make() for n, make in REGRESSORS.items()}
    models = {n: train(prepared, names, r) for n, r in regressors.items()}
    return models, evaluate_all(models, prepared), prepared


def optimise_tariffs(features: DataFrame, lookup: DataFrame | None = None,
                     predictions: DataFrame | None = None,
                     energy: str = "energy_kwh") -> tuple[DataFrame, DataFrame]:
    """The priced table and its evaluation in one row."""
    rows = features if predictions is None else with_predictions(features, predictions)
    priced = price_table(rows, lookup)
    return priced, report(priced, tariff_metric(priced, energy))


def monitor(features: DataFrame, unit: str = "day", lookup: DataFrame | None = None,
            demand_metrics: DataFrame | None = None, by: Sequence[str] = (),
            energy: str = "energy_kwh") -> tuple[DataFrame, DataFrame]:
    """Metrics with feedback per period, and the multiplier path they lead to.

    `demand_metrics` is a one-row table with RMSE and R2, or one per period.
    """
    priced = price_table(features, lookup)
    periods = period_metrics(priced, unit, energy=energy, by=by)
    if demand_metrics is not None:
        named = demand_metrics.withColumnsRenamed({"RMSE": "demand_rmse", "R2": "demand_r2"})
        if "period" in named.columns:
            periods = periods.join(
                named.select("period", "demand_rmse", "demand_r2"), "period", "left")
        else:
            periods = periods.withColumns({
                c: named.select(c).scalar() for c in ("demand_rmse", "demand_r2")})
    signals = add_feedback(periods)
    return signals, multiplier_path(signals, by=by)
