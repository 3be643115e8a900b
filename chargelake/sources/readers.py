"""Readers of session files, grid matrices and stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chargelake import schemas
from chargelake.sources.damaged import (
    check_json_documents, check_json_lines, check_sessions_csv, sessions_or_error,
    write_dead_letters,
)
from chargelake.sources.numbering import in_file_order


def _or_none(read, *args) -> DataFrame | None:
    """The frame, or None when its path does not exist."""
    try:
        return read(*args)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_csv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
             timestamps: Sequence[str] = (), multiline: bool = False) -> DataFrame:
    """CSV with header. Columns are matched by name and cast as asked; others are text.

    Quotes within quoted text are doubled (RFC 4180). With `multiline`, quoted text may
    hold line breaks; a file is then read by one task. Text that cannot be cast becomes
    null. No pass over the data infers types.
    """
    raw = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=multiline)
    wanted = dict(types or {}) | {c: "timestamp_ntz" for c in timestamps}
    return raw.withColumns(
        {c: F.col(f"`{c}`").try_cast(t) for c, t in wanted.items() if c in raw.columns}
    )


def _raw_session_schema() -> T.StructType:
    return T._parse_datatype_string(schemas.RAW_SESSION_DDL)


def read_sessions_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return read_csv(spark, path, {"kWhDelivered": "double"}, multiline=multiline)


def read_sessions_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Session records from JSON.

    With `lines`, one record per line: the form to use for large data, as files are split.
    Otherwise each file holds one document, an array of records, {"data": [records]} or
    an object whose values are records; files are read in parallel, a file by one task.
    A line or document that is none of these, broken off or followed by something else, and
    an element that is no record, raise an error; `damaged.check_json_lines` and
    `check_json_documents` set them apart instead. Numbers may be written as text; one that
    can't be read is null. Empty files have no rows.
    """
    return sessions_or_error(spark, path, lines)


def read_sessions(spark: SparkSession, csv_path: str | None = None,
                  json_path: str | None = None, lines: bool = False) -> DataFrame:
    """CSV if it is there, else JSON, else no rows."""
    found = _or_none(read_sessions_csv, spark, csv_path) if csv_path else None
    if found is None and json_path:
        found = _or_none(read_sessions_json, spark, json_path, lines)
    return found if found is not None else spark.createDataFrame([], _raw_session_schema())


def read_sessions_checked(spark: SparkSession, dead_letters: str, csv_path: str | None = None,
                          json_path: str | None = None, lines: bool = False) -> DataFrame:
    """As read_sessions, with everything damaged stored in the table `dead_letters`."""
    check = check_json_lines if lines else check_json_documents
    found = _or_none(check_sessions_csv, spark, csv_path) if csv_path else None
    if found is None and json_path:
        found = _or_none(check, spark, json_path)
    if found is None:
        return spark.createDataFrame([], _raw_session_schema())
    write_dead_letters(found.rejects, dead_letters, "sessions")
    return found.rows


def read_grid_tables(spark: SparkSession, folder: str, suffix: str = ".csv",
                     index: str = "timestamp") -> dict[str, DataFrame]:
    """The tables of the grid data set that exist in a folder, by name.

    A matrix or calendar without the interval index gets it from the order of its rows in
    the files: matrix and calendar then meet by position, from the first interval on.
    """
    tables = {}
    for name in schemas.GRID_TABLES:
        table = _or_none(read_csv, spark, f"{folder.rstrip('/')}/{name}{suffix}")
        if table is not None:
            by_interval = name == "time" or name in schemas.GRID_MEASURES
            tables[name] = (in_file_order(table, index)
                            if by_interval and index not in table.columns else table)
    return tables


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A table written by `write_stage`."""
    return spark.read.parquet(path)
