"""Comparing the rows of a bucket without gathering the bucket.

A bucket of any size is dealt into chunks of about LIMIT rows; every two chunks meet in a
unit of their own. A unit is one vectorised piece of work of bounded memory, so a hot
bucket spreads over as many tasks as it has units, and no pair is missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.common import stored

LIMIT = 512
#: buckets above the limit that are broadcast; with more of them rows are salted
LISTED = 20_000
#: pairs that a step of a task compares
PAIRS = 500_000


def deal(rows: DataFrame, keys: list[str], member: str, limit: int = LIMIT) -> DataFrame:
    """Rows of all buckets, dealt into units and sorted by unit within partitions.

    Adds _lo, _hi (the two chunks of the unit) and _second (the row is of the higher one).
    A bucket of up to `limit` rows is one unit. The larger ones, whose rows are many but
    which are few themselves, are listed; rows meet that list by broadcast, or where it is
    long by key and salt, so the rows of a bucket never come together for it.
    """
    spark = rows.sparkSession
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    large = stored(sizes.select(*keys, F.ceil(F.col("_n") / limit).alias("_parts")), "large-buckets")
    if large.count() <= LISTED:
        found = rows.join(F.broadcast(large), keys, "left")
    else:
        salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        salted = large.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        salt = F.pmod(F.xxhash64(member, F.lit(7)), F.lit(salts)).cast("int")
        found = rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], "left").drop("_salt")
    parts = F.coalesce(F.col("_parts"), F.lit(1).cast("bigint"))
    return (
        found.withColumn("_parts", parts)
        .withColumn("_chunk", F.pmod(F.xxhash64(member), F.col("_parts")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)))
        .withColumn("_lo", F.least("_chunk", "_other"))
        .withColumn("_hi", F.greatest("_chunk", "_other"))
        .withColumn("_second", F.col("_chunk") > F.col("_lo"))
        .select(*rows.columns, "_lo", "_hi", "_second")
        .repartition(*keys, "_lo", "_hi")
        .sortWithinPartitions(*keys, "_lo", "_hi", "_second")
    )


def compare(keys: list[str], work: Callable[[dict, np.ndarray, np.ndarray], pa.RecordBatch | None]
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that calls `work` with the rows and the pairs of whole units."""
    marks = [*keys, "_lo", "_hi"]

    def whole(columns: dict) -> Iterator[pa.RecordBatch]:
        n = len(columns["_lo"])
        if n < 2:
            return
        new = np.ones(n, bool)
        new[1:] = np.logical_or.reduce([columns[c][1:] != columns[c][:-1] for c in marks])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, n))
        stop = np.repeat(begins + sizes, sizes)
        second = columns["_second"]
        mixed_unit = columns["_lo"] != columns["_hi"]
        firsts = np.add.reduceat((~second).astype(np.int64), begins)
        middle = np.repeat(begins + firsts, sizes)
        at = np.arange(n)
        partner = np.where(mixed_unit, middle, at + 1)
        count = np.where(mixed_unit & second, 0, stop - partner)
        ahead = np.cumsum(count)
        row = 0
        while row < n:
            done = ahead[row - 1] if row else 0
            to = max(int(np.searchsorted(ahead, done + PAIRS, side="right")), row + 1)
            c = count[row:to]
            if c.sum():
                i = np.repeat(at[row:to], c)
                j = np.repeat(partner[row:to] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                out = work(columns, i, j)
                if out is not None and out.num_rows:
                    yield out
            row = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {name: np.asarray(batch.column(name)) if name != "_second"
                       else np.asarray(batch.column(name).cast(pa.int8())).astype(bool)
                       for name in batch.schema.names}
            if rest is not None:
                columns = {c: np.concatenate([rest[c], columns[c]]) for c in columns}
            n = len(columns["_lo"])
            same = np.logical_and.reduce([columns[c] == columns[c][-1] for c in marks])
            cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from whole({c: v[:cut] for c, v in columns.items()})
            rest = {c: v[cut:] for c, v in columns.items()}
        if rest is not None:
            yield from whole(rest)

    return run


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among n rows to as few that connect the same rows: (row, its smallest row)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rows = np.flatnonzero(label != np.arange(n))
    return rows, label[rows]
