"""Rows numbered in the order of their files, without a sort and without a window.

A scan reads each split of a file (a stretch that begins at `file_block_start`) in one task
and in order, so a row's place in its split is known there. The rows before a split follow
from the rows of each split: one row per split comes to the driver, which holds the list of
splits anyway to plan the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_ID, _FILE, _BLOCK = "_scan_id", "_scan_file", "_scan_block"
SCAN = (_FILE, _BLOCK, _ID)


def with_scan_place(scan: DataFrame) -> DataFrame:
    """Adds the columns SCAN to a frame that comes straight from a file reader."""
    return scan.select(
        *[F.col(f"`{c}`") for c in scan.columns], F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_ID))


def numbered(rows: DataFrame, scan: DataFrame, name: str = "number", per_file: bool = False,
             file: str | None = None) -> DataFrame:
    """Zero-based number of each of `rows` among all rows of `scan`.

    `rows` is with_scan_place(scan) or made from it row by row; its columns SCAN go, `file`
    names a column for the path to stay. Files follow each other by path, or are counted
    from zero each with `per_file`.
    """
    splits = sorted(
        with_scan_place(scan).groupBy(_FILE, _BLOCK)
        .agg(F.min(_ID).alias("first"), F.count(F.lit(1)).alias("rows")).collect())
    before, ahead, current = [], 0, None
    for path, block, first, size in splits:
        if per_file and path != current:
            ahead, current = 0, path
        before.append((path, block, ahead - first))
        ahead += size
    offsets = scan.sparkSession.createDataFrame(
        before, f"{_FILE} string, {_BLOCK} bigint, _offset bigint")
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in SCAN]
    if file:
        kept.append(F.col(_FILE).alias(file))
    return rows.join(offsets, [_FILE, _BLOCK]).select(
        *kept, (F.col(_ID) + F.col("_offset")).alias(name))


def in_file_order(scan: DataFrame, name: str) -> DataFrame:
    """A frame that comes straight from a file reader, with its rows numbered from zero."""
    return numbered(with_scan_place(scan), scan, name)
