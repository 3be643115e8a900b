"""Stage tables dealt into buckets by station and time chunk.

Ordered features work per station and chunk, so over such a table they need no shuffle of
its rows, and a join by station and time moves the other side only. The chunk is part of the
bucket's key: a station with a third of all rows is spread over as many buckets as it has
chunks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from chargelake.operators.ordered import CHUNK, time_chunk

_SUBSET = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table: its name in the catalog and how it is dealt."""

    table: str
    buckets: int
    chunk: str
    keys: tuple[str, ...] = ("station_id",)
    ts: str = "timestamp"

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows, with the chunk in CHUNK: operators that find it there keep it."""
        return spark.table(self.table)

    def chunked(self, other: DataFrame) -> DataFrame:
        """Another table with the chunk that each of its rows has here."""
        return other.withColumn(CHUNK, time_chunk(self.ts, self.chunk))

    def join(self, spark: SparkSession, other: DataFrame, how: str = "left") -> DataFrame:
        """The rows with those of `other` of the same keys and time.

        Only `other` is shuffled, if the plan is made within `co_partitioned`.
        """
        return self.read(spark).join(self.chunked(other), [*self.keys, CHUNK, self.ts], how)


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Lets a join use buckets by some of its keys; holds for plans made inside."""
    before = spark.conf.get(_SUBSET)
    spark.conf.set(_SUBSET, "false")
    try:
        yield
    finally:
        spark.conf.set(_SUBSET, before)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, chunk: str = "month",
                   keys: Sequence[str] = ("station_id",), ts: str = "timestamp") -> Bucketed:
    """Store a table in one sorted file per bucket, below `path`, as `table` in the catalog."""
    order = [*keys, CHUNK, ts]
    (
        df.withColumn(CHUNK, time_chunk(ts, chunk))
        .repartition(buckets, *keys, CHUNK).sortWithinPartitions(*order)
        .write.mode("overwrite").bucketBy(buckets, *keys, CHUNK).sortBy(*order)
        .option("path", path).saveAsTable(table)
    )
    return Bucketed(table, buckets, chunk, tuple(keys), ts)
