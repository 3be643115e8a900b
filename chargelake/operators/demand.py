"""Demand models with Spark ML: preparation, training, evaluation, importance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake import config
from chargelake.operators.cleaning import complete_rows, numeric_columns
from chargelake.operators.features import energy_columns, engineered_columns
from chargelake.operators.metrics import regression_metric, report
from chargelake.operators.quantiles import day_slot, values_at_ranks
from chargelake.operators.selection import cuts_at
from chargelake.session import ensure_checkpoint_dir

SPLIT = "split"
_HELD_OUT = "_held_out"


def model_features(df: DataFrame, target: str, leak_free: bool = True) -> list[str]:
    """The engineered features the table has, else all numeric columns but the target.

    Features computed from the energy of the same row are left out when energy is
    predicted, unless leak_free is off.
    """
    names = [c for c in engineered_columns() if c in df.columns]
    if not names:
        names = [c for c in numeric_columns(df) if c != target]
    if leak_free and target in ("energy_kwh", "total_energy_kwh"):
        own_energy = energy_columns()
        names = [c for c in names if c not in own_energy]
    return names


def _train_rows(n):
    return F.floor(n * F.lit(config.TRAIN_SHARE))


def _train_and_validation_rows(n):
    return _train_rows(n) + F.floor(n * F.lit(config.VALIDATION_SHARE))


def _label(place, train_end, validation_end):
    return (
        F.when(place < train_end, "train").when(place < validation_end, "validation")
        .otherwise("test")
    )


def split_by_time(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """70 / 15 / 15 by exact cut-off times; rows of one instant stay together."""
    cuts = values_at_ranks(
        df, ts, {"train_end": _train_rows, "validation_end": _train_and_validation_rows},
        slot=day_slot, narrow=0,
    ).select(F.struct("train_end", "validation_end")).scalar()
    return df.withColumn(SPLIT, _label(F.col(ts), cuts["train_end"], cuts["validation_end"]))


def split_by_position(df: DataFrame,
                      order: Sequence[str] = ("station_id", "timestamp")) -> DataFrame:
    """70 / 15 / 15 by place in the order of station and time: whole stations are held out.

    The rows at the two borders are selected, the table is not sorted. Rows of one station
    and time stay together.
    """
    station, ts = order
    rows = df.count()
    train = math.floor(rows * config.TRAIN_SHARE)
    validation = train + math.floor(rows * config.VALIDATION_SHARE)
    cuts = cuts_at(df, {"train": train, "validation": validation}, station, ts)
    return df.withColumn(SPLIT, F.when(cuts["train"].after(station, ts), "train").when(
        cuts["validation"].after(station, ts), "validation").otherwise("test"))


def prepare(df: DataFrame, target: str = "energy_kwh", features: Sequence[str] | None = None,
            mode: str = "time") -> DataFrame:
    """Complete rows with their split label and the target as `actual`."""
    features = list(features or model_features(df, target))
    rows = complete_rows(df, [*features, target])
    split = split_by_time(rows) if mode == "time" else split_by_position(rows)
    keys = [c for c in ("station_id", "timestamp") if c in df.columns and c not in features]
    return split.select(
        *keys, SPLIT, F.col(target).cast("double").alias("actual"),
        *[F.col(c).cast("double").alias(c) for c in features],
    )


def random_forest(trees: int = 300, depth: int = 10) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol="actual", numTrees=trees, maxDepth=depth,
        seed=config.SEED,
    )


def gradient_boosting(rounds: int = 500, depth: int = 6, step: float = 0.05,
                      sample: float = 0.8, use_validation: bool = True) -> GBTRegressor:
    """One booster stands for both vendor libraries, which share these parameters.

    It stops when the error on the validation rows no longer falls, unless that is off.
    """
    booster = GBTRegressor(
        featuresCol="features", labelCol="actual", maxIter=rounds, maxDepth=depth,
        stepSize=step, subsamplingRate=sample, seed=config.SEED,
    )
    return booster.setValidationIndicatorCol(_HELD_OUT) if use_validation else booster


def train(prepared: DataFrame, features: Sequence[str], regressor: Estimator) -> PipelineModel:
    """Scaler and regressor fitted on the training rows.

    Rows of the validation part only stop a booster that asks for them; the scaler never
    sees them. The scaler divides by the sample standard deviation.
    """
    rows = prepared.filter(F.col(SPLIT) == "train")
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features")
    scaler = StandardScaler(
        inputCol="raw_features", outputCol="features", withMean=True, withStd=True
    )
    scaling = Pipeline(stages=[assembler, scaler]).fit(rows)
    if regressor.hasParam("validationIndicatorCol") and regressor.isSet("validationIndicatorCol"):
        rows = prepared.filter(F.col(SPLIT) != "test").withColumn(
            _HELD_OUT, F.col(SPLIT) == "validation")
    # boosting cuts its lineage every few rounds, if there is a folder for it
    ensure_checkpoint_dir(prepared.sparkSession)
    model = regressor.fit(scaling.transform(rows))
    return PipelineModel([*scaling.stages, model])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("raw_features", "features")


def evaluate(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return report(predictions, regression_metric(), by)


def evaluate_all(models: dict[str, PipelineModel], prepared: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 of every model on the test rows, from one aggregate."""
    test = prepared.filter(F.col(SPLIT) == "test")
    parts = [
        predict(model, test).select("actual", "prediction", F.lit(name).alias("model"))
        for name, model in models.items()
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return evaluate(together)


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("RMSE").asc_nulls_last(), "model").limit(1)


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str],
                       top: int | None = None) -> DataFrame:
    """Importance per feature, largest first: one row per feature."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(
        list(zip(features, weights)), "feature STRING, importance DOUBLE"
    ).orderBy(F.col("importance").desc(), "feature")
    return table.limit(top) if top else table
