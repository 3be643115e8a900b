"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chargelake.session import scratch_path

#: a word is a run of bytes other than space and the controls 0x09 to 0x0D
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: text bytes one vectorised step looks at; a longer document is a step of its own
STEP_BYTES = 4 << 20
_M = 0x9E3779B97F4A7C15


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the folder in spark.checkpoint.dir and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: stands for a null doc_id in keys and sorts after all others
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Columns id and key, which tell documents apart, with `columns` beside them.

    key is 32 bits of the text, or 64 where doc_id is null. Repeated rows (same doc_id,
    same text) share it; operators treat them as copies of each other. `columns` may hold
    "row", all columns of a row as one struct, so that no name can clash.
    """
    picked = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
              if name == "row" else F.col(name) for name in columns]
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"),
        F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
        .otherwise(F.hash("text").cast("bigint")).alias("key"),
        *picked)


def doc_id(column: str = "id") -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column)).alias("doc_id")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and where each begins; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def squeezed(column: pa.Array) -> pa.Array:
    """Each text as a Zstandard frame, null stays null: texts shuffle at half the bytes."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    data, offsets = utf8(column)
    data, at = memoryview(data), offsets.tolist()
    known = column.is_valid().to_pylist()
    return pa.array([squeeze(data[a:b]) if ok else None
                     for a, b, ok in zip(at, at[1:], known)], pa.binary())


def restored(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([None if x is None else expand(x) for x in column.to_pylist()],
                    pa.binary()).cast(pa.string())


def steps(batch: pa.RecordBatch, column: str = "text",
          limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text, whole documents each."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, kept for a whole task."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, STEP_BYTES + (1 << 16))
            for name, factor in (("up", _M), ("down", pow(_M, -1, 1 << 64))):
                powers = np.full(size, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers))
        return self.up, self.down


class Words:
    """The words of some documents as positions in one buffer.

    `data` has the words of each document joined by one space; word i is
    data[start[i]:end[i]], document d has the words first[d] to first[d + 1].
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        data, offsets = utf8(column)
        lo, hi = int(offsets[0]), int(offsets[-1])
        data, offsets = data[lo:hi], offsets - lo
        space = SPACE[data]
        word = ~space
        begins = word.copy()
        begins[1:] &= space[:-1]
        inner = offsets[1:-1]
        inner = inner[inner < len(data)]
        begins[inner] = word[inner]
        ends = word.copy()
        ends[:-1] &= space[1:]
        last = inner[inner > 0] - 1
        ends[last] = word[last]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(start, offsets)
        n = len(start)
        # one space after each word, also after the last of a document
        size = end - start
        new_end = np.cumsum(size + 1) - 1
        new_start = new_end - size
        out = np.full(int(new_end[-1]) + 1 if n else 0, 0x20, np.uint8)
        keep = np.ones(len(out), bool)
        keep[new_end] = False
        source = data[word]
        if lower:
            upper = (source >= 0x41) & (source <= 0x5A)
            source = source + (upper.astype(np.uint8) << np.uint8(5))
        out[keep] = source
        self.data, self.start, self.end = out, new_start, new_end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self, d: int) -> np.ndarray:
        """Bytes of a document's words joined by one space."""
        a, b = self.first[d], self.first[d + 1]
        return self.data[self.start[a]:self.end[b - 1]] if b > a else self.data[:0]

    def hashes(self, powers: Powers) -> np.ndarray:
        """A 64-bit hash of every word."""
        n = len(self.data)
        if not n:
            return np.zeros(0, np.uint64)
        up, down = powers.of(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        value = (sums[self.end] - sums[self.start]) * down[self.start]
        return mixed(value + (self.end - self.start).astype(np.uint64) * np.uint64(_M))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; different values stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Polynomial hash of every run of `width` values, by doubling."""
    if len(values) < width:
        return values[:0]
    mask = (1 << 64) - 1
    total, done, part, size = None, 0, values, 1
    while True:
        if width & size:
            if total is None:
                total, done = part, size
            else:
                n = len(values) - done - size + 1
                total = total[:n] * np.uint64(pow(factor, size, 1 << 64) & mask) + part[done:done + n]
                done += size
        if done == width:
            return mixed(total)
        n = len(part) - size
        part = part[:n] * np.uint64(pow(factor, size, 1 << 64) & mask) + part[size:size + n]
        size *= 2


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of every `width` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    part, size = values, 1
    while size * 2 <= width:
        part = pick(part[:-size], part[size:])
        size *= 2
    rest = width - size
    return pick(part[:len(part) - rest], part[rest:]) if rest else part
