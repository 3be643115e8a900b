"""Writers of stage tables, reports and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chargelake.operators.cleaning import drop_null_columns, flatten_id
from chargelake.sources.readers import read_stage


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, in folders per partition value so that later filters read less.

    Rebalancing splits a partition value with many rows over several tasks and joins
    small ones, so neither one task nor many tiny files result.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def convert_raw_sessions(df: DataFrame, json_path: str, csv_path: str) -> DataFrame:
    """Drop empty columns, flatten the id and store as JSON records and CSV."""
    clean = flatten_id(drop_null_columns(df))
    write_json(clean, json_path)
    write_csv(clean, csv_path)
    return clean


def flatten_structs(df: DataFrame) -> DataFrame:
    """Struct columns as one column per field, for formats without nesting."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            columns += [F.col(f"`{f.name}`.`{s}`").alias(f"{f.name}_{s}")
                        for s in f.dataType.names]
        else:
            columns.append(F.col(f"`{f.name}`"))
    return df.select(columns)


def export_monitoring(periods: DataFrame, folder: str) -> None:
    """Metrics and feedback per period, each as CSV."""
    feedback = ["demand_feedback", "tariff_feedback"]
    metrics = periods.drop(*feedback)
    write_csv(metrics, f"{folder}/monitoring_metrics")
    if set(feedback) <= set(periods.columns):
        keys = [c for c in periods.columns if c in ("data_source", "station_id", "period")]
        write_csv(flatten_structs(periods.select(*keys, *feedback)), f"{folder}/feedback_signals")


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    for name, model in models.items():
        model.write().overwrite().save(f"{folder}/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}")


def save_lookup(lookup: DataFrame, path: str) -> None:
    lookup.coalesce(1).write.mode("overwrite").parquet(path)


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_stage(spark, path)
