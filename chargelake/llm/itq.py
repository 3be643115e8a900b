"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Unit vectors are centred and projected on principal directions; a rotation is learned that
brings them close to the corners of a cube, so that the signs are balanced binary codes in
which near vectors differ in few bits. A code is cut into substrings, one Hamming table
each. Every vector enters a table under its substring and under all strings one bit away,
so two vectors meet in a table exactly if their substrings differ in at most two bits. A
pair is taken up in the first such table only, thinned by the distance of the whole codes,
and reranked with the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import stored
from chargelake.llm.graph import components
from chargelake.llm.units import compare, deal

THRESHOLD = 0.95
#: rows the rotation is fitted on, in expectation
SAMPLE = 20_000
#: tables at least; longer substrings take more, so that a pair is missed this rarely
TABLES = 6
MISS = 0.01
ROUNDS = 30
_NO_ID = (1 << 63) - 1


def fit(sample: np.ndarray, bits: int, rounds: int = ROUNDS,
        seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dimensions by bits) of codes of any length.

    Each set of as many bits as there are dimensions is a quantisation of its own from
    another random start: rotate, take signs, and turn the rotation to fit them best.
    """
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, directions = np.linalg.svd(centred, full_matrices=False)
    basis = directions.T
    projected = centred @ basis
    random = np.random.default_rng(seed)
    parts = []
    while sum(p.shape[1] for p in parts) < bits:
        rotation, _ = np.linalg.qr(random.standard_normal((basis.shape[1],) * 2))
        for _ in range(rounds):
            corners = np.where(projected @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(corners.T @ projected)
            rotation = (u @ v).T
        parts.append(basis @ rotation)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.list_(pa.float64()))
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _usable(vector: str) -> Column:
    """Not null, not zero, finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def tables_needed(each: int, threshold: float, least: int = TABLES) -> int:
    """Tables of `each` bits by which a pair at `threshold` is missed in less than MISS.

    It is missed in a table if more than two bits differ, each with the chance angle / pi,
    taken as independent.
    """
    chance = np.arccos(threshold) / np.pi
    beyond = 1 - sum(comb(each, k) * chance**k * (1 - chance)**(each - k) for k in range(3))
    if beyond <= 0 or beyond**least < MISS:
        return least
    return int(log(MISS) / log(beyond)) + 1


def links(classes: DataFrame, threshold: float, tables: int, sample: int,
          bits: int | None = None) -> DataFrame:
    """a, b (a < b) of all pairs of classes (rep, vector) found at or above the threshold."""
    spark = classes.sparkSession
    n = classes.count()
    if n < 2:
        return spark.createDataFrame([], "a bigint, b bigint")
    # substrings grow with the number of vectors: buckets stay of the same size
    each = bits or min(max(ceil(log2(n)) + 2, 8), 31)
    tables = tables_needed(each, threshold, tables)
    share = F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < F.lit(ceil((1 << 20) * min(1, sample / n)))
    drawn = np.array([r[0] for r in classes.filter(share).select("vector").collect()], float)
    if not len(drawn):
        drawn = np.array([r[0] for r in classes.select("vector").limit(sample).collect()], float)
    drawn /= np.linalg.norm(drawn, axis=1, keepdims=True)
    mean, projection = fit(drawn, each * tables)
    # a pair at the threshold differs in about bits * angle / pi; beyond 5 deviations: apart
    chance = np.arccos(threshold) / np.pi
    total = each * tables
    most = ceil(total * chance + 5 * np.sqrt(total * chance * (1 - chance)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            signs = ((x - mean) @ projection >= 0).reshape(len(x), tables, each)
            codes = (signs * (1 << np.arange(each))).sum(axis=2).astype(np.int32)
            lists = pa.FixedSizeListArray.from_arrays(
                pa.array(codes.ravel()), tables).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), lists], ["rep", "codes"])

    coded = classes.select("rep", "vector").mapInArrow(encode, "rep bigint, codes array<int>")
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(each)])
    posted = (
        coded.select("rep", "codes", F.posexplode("codes").alias("table", "own"))
        .withColumn("flip", F.explode(flips))
        .select("rep", *[F.col("codes")[t].alias(f"c{t}") for t in range(tables)], "table",
                F.col("own").bitwiseXOR(F.col("flip")).alias("entry"))
    )

    def first_met(rows: dict, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch | None:
        codes = np.stack([rows[f"c{t}"] for t in range(tables)], axis=1)
        a, b = codes[i], codes[j]
        apart = np.bitwise_count(a ^ b)
        table = rows["table"][i]
        near = np.argmax(apart <= 2, axis=1) == table
        near &= apart.sum(axis=1) <= most
        if not near.any():
            return None
        i, j, table, a, b, apart = i[near], j[near], table[near], a[near], b[near], apart[near]
        # of the entries a pair shares in its table, one counts
        at = np.arange(len(i))
        a, b, apart = a[at, table], b[at, table], apart[at, table]
        low = (a ^ b) & -(a ^ b)
        shared = np.where(apart == 0, a, np.where(
            apart == 1, np.minimum(a, b), np.minimum(a ^ low, b ^ low)))
        ok = shared == rows["entry"][i]
        i, j = rows["rep"][i[ok]], rows["rep"][j[ok]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], ["a", "b"])

    candidates = deal(posted, ["table", "entry"], "rep").mapInArrow(
        compare(["table", "entry"], first_met), "a bigint, b bigint")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column("x")), _matrix(batch.column("y"))
            x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
            cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
            yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    left = classes.select(F.col("rep").alias("a"), F.col("vector").alias("x"))
    right = classes.select(F.col("rep").alias("b"), F.col("vector").alias("y"))
    return (candidates.join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .mapInArrow(rerank, "a bigint, b bigint"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES,
                 sample: int = SAMPLE, vec_id: str = "vec_id",
                 vector: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept per row.

    Links are pairs at or above the threshold in cosine, found through the tables; equal
    vectors link always and are one node. Substrings grow with the number of vectors; there
    are `tables` of them, or as many more as keep the chance that a pair at the threshold is
    missed below one in a hundred, if bits are independent; nearer pairs are missed less.
    Low thresholds take many tables. The tests compute this up to a billion vectors and
    measure recall against brute force at 1,005.
    Vectors that are null, zero or hold null or non-finite components link with nothing and
    are their own component. The rotation is fitted on about `sample` rows; every row is
    indexed. Repeated rows are nodes of their own that link with each other; a null vec_id
    counts as the largest. Vectors whose length is not the most frequent one (of several, the
    smallest) link with nothing either. An empty table gives no rows.
    """
    rows = vectors.select(
        F.coalesce(F.col(vec_id).cast("bigint"), F.lit(_NO_ID)).alias("id"),
        F.col(vector).cast("array<double>").alias("vector")).withColumn("good", _usable("vector"))
    # a row per length
    lengths = rows.filter("good").groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.col("count").desc(), "length").first()
    rows = rows.withColumn("good", F.col("good") & (
        F.size("vector") == (usual["length"] if usual else 0)))
    # a class of equal vectors is one row, summed up before the shuffle, named by its hash
    rep = F.xxhash64("vector", F.lit(1)).alias("rep")
    classes = stored(
        rows.filter("good").groupBy("vector").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")).select("*", rep),
        "vector-classes")
    found = stored(links(classes, threshold, tables, sample), "vector-links")
    copies = classes.select("rep", "copies")
    degree = (
        found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .join(copies.withColumnRenamed("rep", "b"), "b")
        .groupBy("a").agg(F.sum("copies").alias("linked"))
    )
    roots = components(found.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    labelled = classes.join(roots, classes.rep == roots.node, "left").withColumn(
        "root", F.coalesce("root", "rep"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component"))
    nodes = (labelled.join(smallest, "root").join(degree, F.col("rep") == F.col("a"), "left")
             .select("rep", "component",
                     (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")))
    named = rows.filter("good").select("id", rep).join(nodes, "rep").select(
        "id", "n_links", "component")
    alone = rows.filter("not good").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    return named.unionByName(alone).select(
        F.when(F.col("id") != _NO_ID, F.col("id")).alias("vec_id"), "n_links",
        F.when(F.col("component") != _NO_ID, F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))
