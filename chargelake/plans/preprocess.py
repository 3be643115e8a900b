"""Raw sessions and grid tables to one table of station-hours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chargelake.operators import ledger as counted
from chargelake.operators.cleaning import clean_grid, clean_sessions
from chargelake.operators.ledger import Ledger
from chargelake.operators.reshape import build_grid_readings
from chargelake.operators.rollup import hourly_grid, hourly_sessions, merge_sources
from chargelake.session import stored
from chargelake.sources.readers import read_grid_tables, read_sessions, read_sessions_checked
from chargelake.sources.writers import write_csv, write_stage


def preprocess(sessions: DataFrame | None, grid_tables: dict[str, DataFrame] | None,
               store: Callable[[DataFrame], DataFrame] = lambda df: df,
               chunk: str = "month", ledger: Ledger | None = None) -> DataFrame:
    """Either source may be missing. `store` may keep the long readings, read twice.

    With a `ledger`, cleaning is counted there.
    """
    parts = []
    if sessions is not None:
        clean = clean_sessions(sessions) if ledger is None else counted.clean_sessions(
            sessions, ledger)
        parts.append(hourly_sessions(clean))
    if grid_tables:
        readings = store(build_grid_readings(grid_tables))
        clean = clean_grid(readings, chunk=chunk) if ledger is None else counted.clean_grid(
            readings, ledger, chunk=chunk)
        parts.append(hourly_grid(clean))
    if not parts:
        raise ValueError("neither sessions nor grid tables given")
    return merge_sources(*parts) if len(parts) == 2 else parts[0]


def run_preprocessing(spark: SparkSession, sessions_csv: str | None, grid_folder: str | None,
                      output: str, sessions_json: str | None = None,
                      ledger_path: str | None = None, damaged_path: str | None = None) -> DataFrame:
    """Read, preprocess and store by source and month.

    The counts of cleaning come from the pass that stores the rows and go to `ledger_path`;
    damaged session input goes to `damaged_path`, without one it fails the run or is null.
    """
    sessions = None
    if sessions_csv or sessions_json:
        sessions = (read_sessions(spark, sessions_csv, sessions_json) if damaged_path is None
                    else read_sessions_checked(spark, damaged_path, sessions_csv, sessions_json))
    grid = read_grid_tables(spark, grid_folder) if grid_folder else None
    keep = lambda df: stored(df, "readings")
    ledger = Ledger() if ledger_path else None
    merged = preprocess(sessions, grid, keep, ledger=ledger)
    write_stage(merged.withColumn("ym", F.date_format("timestamp", "yyyy-MM")), output,
                ["data_source", "ym"])
    if ledger is not None:
        write_csv(ledger.table(spark), ledger_path)
    return read_merged(spark, output)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("ym")
