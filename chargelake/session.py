"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from chargelake.sources import storage


def build_session(app_name: str = "chargelake", master: str | None = None,
                  **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # recording a call site for every column expression doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; else one in the warehouse,
    which executors reach as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_intermediate")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has used.

    It lies in a folder of this application, which goes when the application ends.
    """
    own = os.path.join(shared_folder(spark), f"chargelake-{spark.sparkContext.applicationId}")
    storage.drop_at_exit(spark, own)
    return os.path.join(own, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back.

    For inputs that an operator reads more than once: the work behind them is done once,
    later reads take only the columns they need, and lost executors cost no recomputation.
    The table goes when the application ends.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
