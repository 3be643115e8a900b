"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text gives a vector of transformed statistics. Per class, mean and covariance come
from summed moments; a covariance is shrunk towards the pooled one and that towards its
diagonal, so that it always has a Cholesky factor. The factor is kept: a document's squared
Mahalanobis distance is the length of a triangular solve, and its score the logistic of the
difference of the two log densities and priors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.common import (
    Powers, Words, doc_id, keyed, rolling, steps, stored, utf8)
from chargelake.llm.ppm import held_out

FEATURES = (
    "words", "characters_per_word", "spread_of_word_length", "longest_word", "upper", "digits",
    "sentence_marks", "other_marks", "exclamations", "non_ascii", "lines", "repeated_words",
    "repeated_runs", "ending_in_mark", "without_letter", "capitalised", "bytes_entropy",
    "short_words",
)
SHRINK_TO_POOLED = 0.2
SHRINK_TO_DIAGONAL = 0.1
LEAST_SCORE = 0.3
RUN = 5

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_HIGH = np.arange(256) >= 0x80
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK &= ~(_UPPER | _LOWER | _DIGIT | _STOP)
_LETTER = _UPPER | _LOWER | _HIGH


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _distinct(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Distinct values per group."""
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, of))
    new = np.ones(len(values), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (of[order][1:] != of[order][:-1])
    return np.bincount(of[order][new], minlength=len(first) - 1).astype(float)


def statistics(column: pa.Array, powers: Powers) -> np.ndarray:
    """One row of FEATURES per text, over all of it; a null or empty text is all zero."""
    words = Words(column)
    n = words.counts.astype(float)
    some = np.maximum(n, 1)
    docs = len(n)
    data, start, end, first = words.data, words.start, words.end, words.first
    size = (end - start).astype(float)
    bounds = np.append(start, len(data))[first]  # bytes of each document, spaces with them
    letters = np.maximum(_sums(size, first), 1)

    def share(table: np.ndarray) -> np.ndarray:
        return _sums(table[data], bounds) / letters

    mean = _sums(size, first) / some
    spread = np.sqrt(np.maximum(_sums(size ** 2, first) / some - mean ** 2, 0))
    longest = np.zeros(docs)
    filled = np.flatnonzero(words.counts)
    if len(filled):
        longest[filled] = np.maximum.reduceat(size, first[filled])
    hashes = words.hashes(powers)
    unique = _distinct(hashes, first)
    runs = rolling(hashes, RUN, 0x9FB21C651E98DF25)
    of = np.repeat(np.arange(docs), words.counts)[:len(runs)]
    inside = np.arange(len(runs)) + RUN <= first[1:][of]
    kept = np.flatnonzero(inside)
    run_first = np.searchsorted(of[kept], np.arange(docs + 1))
    run_count = np.diff(run_first)
    run_unique = _distinct(runs[kept], run_first) if len(kept) else np.zeros(docs)
    has_letter = np.zeros(len(start), bool)
    if len(start):
        has_letter = np.add.reduceat(_LETTER[data].astype(np.int64), start) > 0
    short = _sums((size <= 4) & has_letter, first) / some if len(start) else np.zeros(docs)
    entropy = np.zeros(docs)
    for d in filled:
        counts = np.bincount(data[bounds[d]:bounds[d + 1]], minlength=256)
        p = counts[counts > 0] / counts.sum()
        entropy[d] = -(p * np.log2(p)).sum()
    raw = _lines(column)
    return np.stack([
        np.log1p(n), np.log1p(mean), np.log1p(spread), np.log1p(longest),
        np.sqrt(share(_UPPER)), np.sqrt(share(_DIGIT)), np.sqrt(share(_STOP)),
        np.sqrt(share(_MARK)), np.sqrt(_sums(data == 0x21, bounds) / some),
        np.sqrt(share(_HIGH)), np.sqrt(raw / some), np.sqrt(1 - unique / some) * (n > 0),
        np.sqrt(1 - run_unique / np.maximum(run_count, 1)) * (run_count > 0),
        np.sqrt(_sums((_STOP | _MARK)[data[end - 1]], first) / some) if len(end) else np.zeros(docs),
        np.sqrt(_sums(~has_letter, first) / some),
        np.sqrt(_sums(_UPPER[data[start]], first) / some) if len(start) else np.zeros(docs),
        entropy, np.sqrt(short),
    ], axis=1)


def _lines(column: pa.Array) -> np.ndarray:
    data, offsets = utf8(column)
    lo, hi = int(offsets[0]), int(offsets[-1])
    total = np.concatenate([[0], np.cumsum(data[lo:hi] == 0x0A)])
    return np.diff(total[offsets - lo]).astype(float)


def with_statistics(docs: DataFrame) -> DataFrame:
    """id, key and the statistics (array of doubles) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for part in steps(batch):
                x = statistics(part.column("text"), powers)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), lists], ["id", "key", "x"])

    return keyed(docs, "text").mapInArrow(run, "id bigint, key bigint, x array<double>")


@dataclass
class Discriminant:
    """Scale of the statistics, and per class its prior, mean, Cholesky factor, log volume."""

    centre: np.ndarray
    scale: np.ndarray
    classes: list[tuple[float, np.ndarray, np.ndarray, float]]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1; 0 where nothing is known, a constant for one class alone."""
        if len(self.classes) < 2:
            return np.full(len(x), self.classes[0][0] if self.classes else 0.0)
        z = (x - self.centre) / self.scale
        density = []
        for prior, mean, factor, volume in self.classes:
            solved = np.linalg.solve(factor, (z - mean).T)  # lower triangular
            density.append(np.log(prior) - volume - 0.5 * (solved ** 2).sum(axis=0))
        return density[1] - density[0]


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per label (0 or 1): rows, sum and sum of outer products of x, summed over tasks."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            label = np.asarray(batch.column("label"))
            x = np.asarray(batch.column("x").flatten()).reshape(len(label), d)
            for y in np.unique(label):
                own = x[label == y]
                sums = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                total[int(y)] = total.get(int(y), 0) + sums
        places = 1 + d + d * d
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(list(total), places), pa.int32()),
             pa.array(np.tile(np.arange(places), len(total)), pa.int32()),
             pa.array(np.concatenate(list(total.values())) if total else [], pa.float64())],
            ["label", "place", "value"])

    rows = (labelled.select("label", "x").mapInArrow(run, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")).collect())
    result = {}
    for y in {r["label"] for r in rows}:
        values = np.zeros(1 + d + d * d)
        for r in rows:
            if r["label"] == y:
                values[r["place"]] = r["value"]
        result[y] = (values[0], values[1:1 + d], values[1 + d:].reshape(d, d))
    return result


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]],
        to_pooled: float = SHRINK_TO_POOLED,
        to_diagonal: float = SHRINK_TO_DIAGONAL) -> Discriminant:
    """The discriminant of summed moments; classes without rows are left out."""
    d = len(FEATURES)
    if not sums:
        return Discriminant(np.zeros(d), np.ones(d), [])
    n = sum(s[0] for s in sums.values())
    centre = sum(s[1] for s in sums.values()) / n
    variance = np.diag(sum(s[2] for s in sums.values())) / n - centre ** 2
    scale = np.sqrt(np.maximum(variance, 1e-6))
    if len(sums) < 2:
        return Discriminant(centre, scale, [(4.0 if 1 in sums else -4.0,) + (centre, np.eye(d), 0.0)])
    own = {}
    for y, (count, total, outer) in sorted(sums.items()):
        mean = total / count
        spread = outer / count - np.outer(mean, mean)
        own[y] = (count, (mean - centre) / scale, spread / np.outer(scale, scale))
    pooled = sum(c * s for c, _, s in own.values()) / n
    classes = []
    for count, mean, spread in own.values():
        mixed_spread = (1 - to_pooled) * spread + to_pooled * pooled
        shrunk = ((1 - to_diagonal) * mixed_spread
                  + to_diagonal * np.diag(np.diag(mixed_spread)) + 1e-3 * np.eye(d))
        factor = np.linalg.cholesky(shrunk)
        classes.append((count / n, mean, factor, float(np.log(np.diag(factor)).sum())))
    return Discriminant(centre, scale, classes)


def score(rows: DataFrame, model: Discriminant) -> DataFrame:
    """id, key and score (0 to 1, the probability of class 1) of rows with statistics x."""
    d = len(FEATURES)
    known = (model.centre, model.scale, model.classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Discriminant(*known)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.asarray(batch.column("x").flatten()).reshape(batch.num_rows, d)
            odds = np.clip(model.log_odds(x), -700, 700)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(1 / (1 + np.exp(-odds)))],
                ["id", "key", "score"])

    return rows.select("id", "key", "x").mapInArrow(run, "id bigint, key bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Learns from the labels (doc_id, quality 0 or 1; others are ignored) of the documents
    that are not held out, all of them; a repeated label counts each time. Only statistics
    of the text enter a score. Null and empty texts have the score of all-zero statistics.
    Without any label scores are 0.5. Repeated rows are scored each. No rows for no rows.
    """
    rows = stored(with_statistics(docs), "statistics")
    named = labels.filter("quality in (0, 1)").select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("quality").cast("int").alias("label"))
    labelled = (rows.join(named, "id").withColumn("doc_id", doc_id())
                .filter(~held_out()))
    scored = score(rows, fit(moments(labelled)))
    return scored.select(doc_id(), "score").select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= least_score).cast("int").alias("predicted"))
