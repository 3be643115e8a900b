"""Importance resampling towards a target distribution, on hashed n-gram features.

A document's n-grams fall into buckets by the CRC-32 of their bytes. A bucket's gain is the
logarithm of its share among the target's n-grams over its share among all documents'; a
document's weight is the mean gain of its n-grams. Gumbel noise from a hash of the id is
added, and the greatest sums are drawn: a sample without replacement in proportion to the
weights, the same on every run.

Per step of text, n-grams are interned in an open-addressed table of NumPy arrays: XXH64
keys choose the slot, bytes are compared on every hit, and a slot holds bucket and count.
Counting adds the slots' counts to their buckets; scoring gathers gains by the slot of each
occurrence. Only sums per bucket are shuffled, and the ids with their scores are written
once; texts never move.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import SPACE, Words, steps, stored, utf8
from chargelake.llm.longtext import LIMIT, binary, parts

BUCKETS = 10_000
LEAST_WORDS = 20
SEED = "2024"
#: drawn documents, as a fraction
SHARE = (10, 100)

# letters and digits as lower case, everything else below 0x80 as a space
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[:0x30] = _LOWER[0x3A:0x41] = _LOWER[0x5B:0x61] = _LOWER[0x7B:0x80] = 0x20

# fixed values: the primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161,
    9650029242287828579, 2870177450012600261))
_SHORT = 32


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Grams:
    """Byte strings data[start:end], and their bytes as numbers of eight at any place."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.eights = np.ndarray(len(data) + 1, "<u8", self.data.data, strides=(1,))
        self.start, self.size = start, end - start

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i]:self.start[i] + self.size[i]].tobytes()

    def keys(self) -> np.ndarray:
        """XXH64 of every string; those of 32 bytes and more one by one."""
        start, size = self.start, self.size
        h = size.astype(np.uint64) + _P5
        at = start.copy()
        for done in range(8, _SHORT, 8):
            rows = np.flatnonzero((size >= done) & (size < _SHORT))
            if not len(rows):
                break
            lane = _rotated(self.eights[at[rows]] * _P2, 31) * _P1
            h[rows] = _rotated(h[rows] ^ lane, 27) * _P1 + _P4
            at[rows] += 8
        rows = np.flatnonzero((size & 4 > 0) & (size < _SHORT))
        lane = (self.eights[at[rows]] & np.uint64(0xFFFFFFFF)) * _P1
        h[rows] = _rotated(h[rows] ^ lane, 23) * _P2 + _P3
        at[rows] += 4
        for odd in range(1, 4):
            rows = np.flatnonzero((size & 3 >= odd) & (size < _SHORT))
            h[rows] = _rotated(h[rows] ^ self.data[at[rows]].astype(np.uint64) * _P5, 11) * _P1
            at[rows] += 1
        h = (h ^ h >> np.uint64(33)) * _P2
        h = (h ^ h >> np.uint64(29)) * _P3
        h ^= h >> np.uint64(32)
        for i in np.flatnonzero(size >= _SHORT).tolist():
            h[i] = xxhash.xxh64_intdigest(self.bytes(i))
        return h

    def equal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether strings i and j have the same bytes."""
        same = self.size[i] == self.size[j]
        rows = np.flatnonzero(same & (i != j))
        done = 0
        while len(rows):
            left = self.size[i[rows]] - done
            a, b = self.eights[self.start[i[rows]] + done], self.eights[self.start[j[rows]] + done]
            beyond = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)
            differ = (a ^ b) << beyond != 0
            same[rows[differ]] = False
            rows = rows[~differ & (left > 8)]
            done += 8
        return same


class Table:
    """An open-addressed table over the strings of one step.

    `slot` is the place of every occurrence, `owner` the string in each place (-1: none),
    `count` how often it occurs, `bucket` the remainder of its CRC-32.
    """

    def __init__(self, grams: Grams, buckets: int):
        n = len(grams.start)
        places = 1 << max(1, 2 * n - 1).bit_length()
        keys = grams.keys()
        self.owner = np.full(places, -1, np.int64)
        self.slot = (keys & np.uint64(places - 1)).astype(np.int64)
        open_ = np.arange(n)
        while len(open_):
            place = self.slot[open_]
            free = self.owner[place] < 0
            # of several that want a free place the last to write has it
            self.owner[place[free]] = open_[free]
            owner = self.owner[place]
            same = keys[owner] == keys[open_]
            same[same] = grams.equal(owner[same], open_[same])
            open_ = open_[~same]
            self.slot[open_] = (self.slot[open_] + 1) & (places - 1)
        self.used = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slot, minlength=places)
        self.bucket = np.zeros(places, np.int64)
        start, size = grams.start.tolist(), grams.size.tolist()
        raw = grams.data.tobytes()
        self.bucket[self.used] = [crc32(raw[start[i]:start[i] + size[i]]) % buckets
                                  for i in self.owner[self.used].tolist()]


def _between_words(data: np.ndarray) -> np.ndarray:
    return SPACE[_LOWER[data]]


class Runs:
    """The n-grams of a column of texts: their table and the document of each occurrence."""

    def __init__(self, column: pa.Array, order: int, buckets: int, carried: bytes = b""):
        data, offsets = utf8(column)
        data = _LOWER[data[offsets[0]:offsets[-1]]]
        offsets = offsets - offsets[0]
        if carried:
            data = np.concatenate([np.frombuffer(carried + b" ", np.uint8), data])
            offsets = np.array([0, len(data)])
        words = Words(binary(data, offsets))
        before = carried.count(b" ") + 1 if carried else 0
        self.n_words = words.counts - before
        of = np.repeat(np.arange(len(words.counts)), words.counts)
        first = words.first[:-1][of] if len(of) else of
        starts, ends, docs = [], [], []
        at = np.arange(len(of))
        for size in range(1, order + 1):
            last = at[(at - first >= size - 1) & (at >= before)]
            starts.append(words.start[last - size + 1])
            ends.append(words.end[last])
            docs.append(of[last])
        self.document = np.concatenate(docs)
        self.table = Table(Grams(words.data, np.concatenate(starts), np.concatenate(ends)), buckets)
        tail = words.data[words.start[max(len(words.start) - order + 1, 0)]:words.end[-1]] if (
            order > 1 and len(words.start)) else words.data[:0]
        self.tail = tail.tobytes()


def _runs(column: pa.Array, order: int, buckets: int) -> Iterator[Runs]:
    """Of whole texts, or of the parts of one long text with the last words before each."""
    carried = b""
    for part in parts(column, LIMIT, _between_words):
        runs = Runs(part, order, buckets, carried)
        carried = runs.tail
        yield runs


def bucket_counts(docs: DataFrame, order: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n: how many n-grams of all texts fall into each bucket (others: no row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in steps(batch, limit=LIMIT):
                for runs in _runs(some.column("text"), order, buckets):
                    table = runs.table
                    np.add.at(total, table.bucket[table.used], table.count[table.used])
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(total[found])], ["bucket", "n"])

    return docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, order: int = 1,
          buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths; `buckets` rows a side come to the driver."""
    def counted(texts: DataFrame) -> list[int]:
        counts = [0] * buckets
        for bucket, n in bucket_counts(texts, order, buckets).collect():
            counts[bucket] = n
        return counts

    own, wanted = counted(docs), counted(target)
    all_own, all_wanted = float(sum(own) + buckets), float(sum(wanted) + buckets)
    return np.array([floor(1000 * log((t + 1) * all_own / ((s + 1) * all_wanted)))
                     for s, t in zip(own, wanted)], np.int64)


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths from the SHA-256 of seed and id; a null id counts as ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    return F.floor(-1000 * F.log(-F.log(share)))


def weighed(docs: DataFrame, gain: np.ndarray, order: int = 1, whole_rows: bool = False,
            seed: str = SEED) -> DataFrame:
    """doc_id, tie (a hash of the whole row), n_words, n_features, weight and score.

    With `whole_rows`, also all columns of `docs` in a struct `row`. A text without a word
    (null, empty) weighs 0.
    """
    values = np.asarray(gain, np.int64)
    buckets = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in steps(batch, limit=LIMIT):
                n = some.num_rows
                words, features, total = (np.zeros(n, np.int64) for _ in range(3))
                for runs in _runs(some.column("text"), order, buckets):
                    words += runs.n_words
                    features += np.bincount(runs.document, minlength=n)
                    own = values[runs.table.bucket][runs.table.slot]
                    np.add.at(total, runs.document, own)
                weight = total // np.maximum(features, 1)
                kept = [c for c in some.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in kept], pa.array(words), pa.array(features),
                     pa.array(weight)], [*kept, "n_words", "n_features", "weight"])

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie"),
                       *([row] if whole_rows else []))
    schema = rows.drop("text").schema
    for name in ("n_words", "n_features", "weight"):
        schema = schema.add(name, "long")
    return rows.mapInArrow(run, schema).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed))


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]


def ranked(scores: DataFrame, share: tuple[int, int] = SHARE,
           least_words: int = LEAST_WORDS) -> DataFrame:
    """`scores` (a stored table) with rank: 1, 2, ... for the drawn, null for others.

    Scores are whole numbers: their counts, a row per distinct score, give the score of the
    last one drawn. Only rows from that score on are sorted, over range partitions; a row's
    rank is its place there plus the rows of the partitions before.
    """
    fit = scores.filter(F.col("n_words") >= least_words)
    counts = sorted(fit.groupBy("score").count().collect(), reverse=True)
    draws = share[0] * sum(n for _, n in counts) // share[1]
    if draws == 0:
        return scores.withColumn("rank", F.lit(None).cast("bigint"))
    taken, edge = 0, 0
    for edge, n in counts:
        taken += n
        if taken >= draws:
            break
    high = (F.col("n_words") >= least_words) & (F.col("score") >= edge)
    row = F.monotonically_increasing_id()
    spread = stored(
        scores.filter(high).repartitionByRange(*_order()).sortWithinPartitions(*_order())
        .withColumn("part", F.shiftright(row, 33).cast("int"))
        .withColumn("nth", row.bitwiseAND((1 << 33) - 1)), "drawn")
    # a row per task of that sort
    sizes = sorted(spread.groupBy("part").count().collect())
    before, ahead = [], 0
    for part, n in sizes:
        before.append((part, ahead))
        ahead += n
    ahead_of = scores.sparkSession.createDataFrame(before, "part int, ahead bigint")
    rank = F.col("ahead") + F.col("nth") + 1
    placed = spread.join(F.broadcast(ahead_of), "part").withColumn(
        "rank", F.when(rank <= draws, rank))
    rest = scores.filter(~high).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.select(rest.columns).unionByName(rest)


def importance(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE,
               order: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
               seed: str = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank (null: not drawn).

    Of the documents with `least_words` words or more, share[0] of share[1] (rounded down)
    with the highest scores are drawn; ties go to the smaller doc_id, a null one last, then
    to a hash of the row. Null texts have no words. Repeated rows are scored and drawn each.
    Without documents there are no rows; without a target text all buckets count as empty
    there. Other columns of either table are not looked at. A text of any length is taken
    in parts, which share the last order - 1 words.
    """
    scores = stored(weighed(docs, gains(docs, target, order, buckets), order, seed=seed), "scores")
    return ranked(scores, share, least_words).drop("tie")


def resampled(docs: DataFrame, target: DataFrame, share: tuple[int, int] = SHARE,
              order: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
              seed: str = SEED) -> DataFrame:
    """The documents that importance() draws, with all their columns unchanged.

    The place of the last one drawn tells which rows are; texts are read once more, not joined.
    """
    gain = gains(docs, target, order, buckets)
    places = ranked(stored(weighed(docs, gain, order, seed=seed), "scores"), share, least_words)
    last = places.filter("rank is not null").orderBy(F.col("rank").desc()).first()
    if last is None:
        return docs.limit(0)
    rows = weighed(docs, gain, order, whole_rows=True, seed=seed).filter(
        F.col("n_words") >= least_words)
    same_id = F.col("doc_id").eqNullSafe(F.lit(last["doc_id"]))
    smaller = (F.lit(last["doc_id"] is None) & F.col("doc_id").isNotNull()) | F.coalesce(
        F.col("doc_id") < F.lit(last["doc_id"]), F.lit(False))
    tied = (F.col("score") == last["score"]) & same_id
    inside = (F.col("score") > last["score"]) | (
        (F.col("score") == last["score"]) & smaller) | (tied & (F.col("tie") < last["tie"]))
    # copies of the last one are equal rows: as many as were drawn, whichever
    copies = places.filter("rank is not null").filter(tied & (F.col("tie") == last["tie"])).count()
    return rows.filter(inside).unionByName(
        rows.filter(tied & (F.col("tie") == last["tie"])).limit(copies)).select("row.*")
