"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints at distance d <= 4 differ in at most d of their eight bytes, so
they share at least 8 - d positional bytes: the guaranteed minimum of matches. Posting
lists of single (position, byte) pairs hold n / 256 fingerprints each, too many to tally
over, so the index posts every set of one position less than the guarantee names (56 sets
of three for distance 4; a list holds about n / 2**24): whoever reaches the minimum meets in
four lists at least, and a pair that meets in one may still lack the minimum. The shared
positional bytes of each pair that meets are tallied, pairs below the minimum are dropped
by that count alone, and the bit distance is worked out for the rest only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.common import Words, doc_id, keyed, steps, stored
from chargelake.llm.graph import components
from chargelake.llm.units import compare, deal, forest

SHINGLE = 4
DISTANCE = 4
SEED = 42

# how often each of eight bits is set in a byte, one count to a byte of the sum
_SPREAD = np.array(
    [sum(1 << (8 * bit) for bit in range(8) if byte >> bit & 1) for byte in range(256)],
    dtype=np.uint64)


def bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit value per group first[d]:first[d + 1]: the bits set in over half its hashes."""
    groups = len(first) - 1
    sizes = np.diff(first)
    result = np.zeros(groups, np.uint64)
    if not len(hashes):
        return result
    # runs of at most 255 hashes, whose counts fit a byte
    runs = np.concatenate([np.arange(a, b, 255) for a, b in zip(first[:-1], first[1:])])
    lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    counts = np.add.reduceat(lanes, runs, axis=0).view(np.uint8).reshape(len(runs), 64)
    filled = np.flatnonzero(sizes)
    begins = np.searchsorted(runs, first[filled])
    totals = np.add.reduceat(counts.astype(np.int64), begins, axis=0)
    bits = totals * 2 > sizes[filled, None]
    result[filled] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return result


def fingerprints(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text of a column, all of it, repeats included."""
    words = Words(column, lower=True)
    data, counts = words.data.tobytes(), words.counts
    start, end = words.start.tolist(), words.end.tolist()
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    sizes = []
    for d, n in enumerate(counts.tolist()):
        a = int(words.first[d])
        if n == 0:
            sizes.append(0)
            continue
        k = min(n, shingle)
        hashes += [digest(data[x:y], SEED)
                   for x, y in zip(start[a:a + n - k + 1], end[a + k - 1:a + n])]
        sizes.append(n - k + 1)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return bit_majority(np.array(hashes, np.uint64), first)


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """id, key and fp (signed 64 bits) of every row; null and wordless texts have zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                fp = fingerprints(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), pa.array(fp)], ["id", "key", "fp"])

    return keyed(docs, "text").mapInArrow(run, "id bigint, key bigint, fp bigint")


def reaching(fp: np.ndarray, i: np.ndarray, j: np.ndarray, least: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of fingerprints i and j, those that share `least` positional bytes."""
    tally = np.zeros(len(i), np.int8)
    for position in range(0, 64, 8):
        byte = (fp >> np.uint64(position)).astype(np.uint8)
        tally += byte[i] == byte[j]
    enough = tally >= least
    return i[enough], j[enough]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Distinct fingerprints (fp) to links (src, dst) that connect all within `distance` bits.

    Links are thinned to a forest within each piece of work, never across: what is
    connected stays so, and a tight group of very many fingerprints does not emit its pairs.
    """
    least = max(8 - distance, 1)
    masks = []
    for kept in combinations(range(8), max(least - 1, 1)):
        mask = sum(0xFF << (8 * b) for b in kept)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    # by number: small as the table is, its many postings are work for all tasks
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    posted = (
        prints.repartition(tasks, F.xxhash64("fp")).select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks]))
                      .alias("positions"))
        .withColumn("bytes", F.col("fp").bitwiseAND(F.col("positions")))
    )

    def verify(rows: dict, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
        fp = rows["fp"].view(np.uint64)
        i, j = reaching(fp, i, j, least)
        near = np.bitwise_count(fp[i] ^ fp[j]) <= distance
        if not near.any():
            return None
        i, j = i[near], j[near]
        low = min(i.min(), j.min())
        a, b = forest(i - low, j - low, int(max(i.max(), j.max()) - low) + 1)
        signed = rows["fp"]
        return pa.RecordBatch.from_arrays(
            [pa.array(signed[a + low]), pa.array(signed[b + low])], ["src", "dst"])

    keys = ["positions", "bytes"]
    return deal(posted, keys, "fp").mapInArrow(compare(keys, verify), "src bigint, dst bigint")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE,
                   distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id linked, directly or not) per document.

    Equal fingerprints are one node of the graph, so exact copies cost nothing there.
    Null and empty texts have fingerprint zero and link like any other. Repeated rows are
    returned each. A null doc_id is never a component_id unless the component has no other;
    then that is null. An empty table gives an empty one. Other columns are left out.
    """
    return _grouped(docs, shingle, distance).select(
        doc_id(), "fp", doc_id("least").alias("component_id"))


def _grouped(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """id, key, fp, and of the component: least (id), least_key (of that row)."""
    prints = stored(with_fingerprint(docs, shingle), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min(F.struct("id", "key")).alias("first"))
    roots = components(links(classes.select("fp"), distance))
    labelled = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("least"))
    members = labelled.join(smallest, "root").select(
        "fp", F.col("least.id").alias("least"), F.col("least.key").alias("least_key"))
    return prints.join(members, "fp").select("id", "key", "fp", "least", "least_key")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """The documents left when one of each group stays: that of the smallest doc_id.

    Columns and texts are unchanged. A null doc_id counts as the largest. Of repeated rows
    of the smallest doc_id one stays.
    """
    kept = (_grouped(docs, shingle, distance)
            .filter("id = least and key = least_key").select("id", "key").distinct())
    return (keyed(docs, "row").join(kept, ["id", "key"])
            .dropDuplicates(["id", "key"]).select("row.*"))
