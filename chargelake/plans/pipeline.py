"""The whole chain, with a stored table between stages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake.operators.demand import best_model
from chargelake.operators.tariff import pricing_schedule, tariff_lookup
from chargelake.plans.analytics import (
    engineer_features, monitor, optimise_tariffs, predict_demand,
)
from chargelake.plans.preprocess import read_merged, run_preprocessing
from chargelake.sources.readers import read_stage
from chargelake.sources.writers import (
    export_monitoring, save_lookup, save_models, write_csv, write_stage,
)


@dataclass
class PipelineResult:
    features: DataFrame
    models: dict[str, PipelineModel]
    demand_metrics: DataFrame
    tariff_metrics: DataFrame
    schedule: DataFrame
    periods: DataFrame
    multipliers: DataFrame


def run_pipeline(
    spark: SparkSession, folder: str, sessions_csv: str | None = None,
    grid_folder: str | None = None, sessions_json: str | None = None,
    skip_preprocessing: bool = False, skip_features: bool = False,
    regressors: dict | None = None, energy: str = "energy_kwh", unit: str = "day",
    keep_damaged: bool = False,
) -> PipelineResult:
    """Preprocess, engineer features, train, price and monitor.

    Every stage is stored below `folder`; a skipped stage is read from there. Each stage is
    skipped by its own flag only. The ledger of preprocessing is stored as `ledger`. With
    `keep_damaged`, damaged session input goes to `damaged` instead of failing the run.
    """
    if not skip_preprocessing:
        run_preprocessing(spark, sessions_csv, grid_folder, f"{folder}/merged", sessions_json,
                          f"{folder}/ledger", f"{folder}/damaged" if keep_damaged else None)
    if not skip_features:
        engineered = engineer_features(read_merged(spark, f"{folder}/merged"))
        engineered = engineered.withColumn("ym", F.date_format("timestamp", "yyyy-MM"))
        write_stage(engineered, f"{folder}/features", ["data_source", "ym"])
    features = read_stage(spark, f"{folder}/features").drop("ym")

    models, demand_metrics, _ = predict_demand(features, energy, regressors)
    save_models(models, f"{folder}/models")
    write_csv(demand_metrics, f"{folder}/demand_metrics")
    demand_metrics = spark.read.csv(
        f"{folder}/demand_metrics", header=True,
        schema="model STRING, RMSE DOUBLE, MAE DOUBLE, R2 DOUBLE")

    save_lookup(tariff_lookup(spark), f"{folder}/tariff_lookup")
    lookup = read_stage(spark, f"{folder}/tariff_lookup")
    _, tariff_metrics = optimise_tariffs(features, lookup, energy=energy)
    write_csv(tariff_metrics, f"{folder}/tariff_metrics")
    schedule = pricing_schedule(lookup)
    write_csv(schedule, f"{folder}/pricing_schedule")

    periods, multipliers = monitor(
        features, unit, lookup, best_model(demand_metrics), energy=energy)
    export_monitoring(periods, folder)
    return PipelineResult(
        features, models, demand_metrics, tariff_metrics, schedule, periods, multipliers)
