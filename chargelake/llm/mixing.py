"""Mixing sources to target weights on a low-discrepancy schedule.

Each source's documents are put in a seeded random order and cut into blocks of equal
words; a source whose target exceeds its size is read round and round. A schedule of slots
takes one block each: van der Corput points (bit-reversed slot times) go through the
cumulative numbers of slots per source, so every stretch of the schedule holds each source
in about its share. The rank of a slot among its source's slots says which block it takes.
That rank is counted in closed form from the bits of the time, so no source is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.llm.common import WORD, doc_id, keyed, stored

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 8192
_CHUNK = 1 << 16


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            repeats: int = REPEATS) -> DataFrame:
    """source, total and target per source; `sizes` has source and size.

    Sources by code point (null last) take `weights` in turn and share the sum of all
    sizes. A target stops at `repeats` times its source; the excess is shared again by
    weight. That ends at a level at which every source takes weight times level or its
    stop, found in one pass over the sources ordered by stop over weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (place % len(weights) + 1).cast("int")).cast("bigint")
    # one row per source
    per_source = (
        sizes.groupBy("source").agg(F.sum("size").alias("total"))
        .withColumn("place", place).withColumn("weight", weight)
        .withColumn("stop", F.col("total") * repeats)
    )
    by_ratio = Window.orderBy(F.col("stop") / F.col("weight"), "place")
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.sum("total").over(Window.partitionBy()) - F.coalesce(F.sum("stop").over(below), F.lit(0)))
             / F.sum("weight").over(rest))
    tried = per_source.withColumn("level", level).withColumn(
        "open", F.col("stop") / F.col("weight") > F.col("level"))
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return tried.select(
        "source", "place", "total",
        F.least(F.col("stop").cast("double"),
                F.coalesce(final * F.col("weight"), F.col("stop").cast("double"))).alias("target"))


def _reversed(value: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(value), bits, "0")), 2, 10).cast("bigint")


def _earlier(time: Column, point: Column, bound: Column, bits: int) -> Column:
    """How many times before `time` have a point below `bound`; `point` is that of `time`.

    For each set bit j of the time, the times that agree above j and have 0 there have
    2**j points, spaced 2**(bits - j) apart from the point's last bits - j - 1 bits on.
    """
    total = F.lit(0).cast("bigint")
    for j in range(bits):
        spacing = 1 << (bits - j)
        offset = point.bitwiseAND(F.lit((1 << (bits - j - 1)) - 1).cast("bigint"))
        under = F.floor((bound - offset + (spacing - 1)) / F.lit(float(spacing))).cast("bigint")
        under = F.least(F.greatest(under, F.lit(0)), F.lit(1 << j))
        total = total + F.when(
            F.shiftright(time, j).bitwiseAND(F.lit(1).cast("bigint")) == 1, under).otherwise(0)
    return total


def schedule(shares: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot (its time), place (of the source) and block, for sources with place and quota.

    A source has one slot per `block_words` of its quota, the last one perhaps shorter.
    """
    need = F.ceil(F.col("quota") / block_words)
    lanes = shares.select("place", need.alias("slots")).withColumn(
        "upper", F.sum("slots").over(Window.orderBy("place"))).withColumn(
        "lower", F.col("upper") - F.col("slots")).filter("slots > 0")
    slots = lanes.agg(F.max("upper")).first()[0] or 0
    bits = max(int(slots - 1).bit_length(), 1) if slots else 1
    # a source's slots are a range of points, made chunk by chunk in many tasks
    chunks = lanes.withColumn("chunk", F.explode(F.sequence(
        "lower", F.col("upper") - 1, F.lit(_CHUNK).cast("bigint")))).repartition("chunk")
    ranges = chunks.withColumn("point", F.explode(F.sequence(
        "chunk", F.least(F.col("chunk") + _CHUNK, F.col("upper")) - 1)))
    timed = ranges.withColumn("slot", _reversed(F.col("point"), bits))
    rank = (_earlier(F.col("slot"), F.col("point"), F.col("upper"), bits)
            - _earlier(F.col("slot"), F.col("point"), F.col("lower"), bits))
    return timed.select("slot", "place", rank.alias("block"))


def sized(docs: DataFrame) -> DataFrame:
    """id, key, copy, source and size (words) per row, written to the shared folder."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    copy = F.row_number().over(Window.partitionBy("id", "key").orderBy("source"))
    return stored(keyed(docs, "source", "text").withColumn("size", size).drop("text")
                  .withColumn("copy", copy), "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS,
        block_words: int = BLOCK_WORDS, seed: str = "mix",
        sizes: DataFrame | None = None) -> DataFrame:
    """The mix, a row per slot, document and epoch: slot, source, block, epoch, id, key,
    copy, start and stop (words of the document taken).

    Rows in order of slot are the schedule. Documents without words (null and empty texts)
    take part in no slot. Repeated rows are documents of their own, told apart by copy. A
    null source is a source. Ties of the random order fall by id, key and copy. An empty
    table gives no rows.
    """
    sizes = sized(docs) if sizes is None else sizes
    shares = targets(sizes, weights, repeats).withColumn(
        "quota", F.floor(F.col("target") + 0.5))
    # place in the random order of the source: by hash buckets, so no source is one task
    shuffled = sizes.filter("size > 0").withColumn(
        "order", F.md5(F.concat_ws(":", doc_id().cast("string"), F.lit(seed)))).withColumn(
        "bucket", F.substring("order", 1, 3))
    sums = shuffled.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", F.coalesce(
        F.sum("words").over(before), F.lit(0)).alias("before"))
    offsets = (sums.join(shares, sums.source.eqNullSafe(shares.source))
               .select(sums.source, "bucket", "before", "place", "total", "quota"))
    inside = Window.partitionBy("source", "bucket").orderBy("order", "id", "key", "copy").rowsBetween(
        Window.unboundedPreceding, -1)
    lying = shuffled.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = (
        lying.join(offsets, lying.source.eqNullSafe(offsets.source)
                   & (lying.bucket == offsets.bucket))
        .select(lying.source, "id", "key", "copy", "size", "place", "total", "quota",
                (F.col("before") + F.col("inside")).alias("at"))
        # the stream is read from its start again for every epoch, up to the quota
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("begin", F.col("at") + F.col("epoch") * F.col("total"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
        .filter("begin < end")
        .withColumn("block", F.explode(F.sequence(
            F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))))
    )
    start = F.greatest("begin", F.col("block") * block_words) - F.col("begin")
    stop = F.least("end", (F.col("block") + 1) * block_words) - F.col("begin")
    return (
        placed.join(schedule(shares, block_words), ["place", "block"])
        .select("slot", "source", "block", "epoch", "id", "key", "copy",
                start.alias("start"), stop.alias("stop"))
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                    repeats: int = REPEATS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix with their own columns, in the order of the schedule.

    A document comes once for each epoch that takes it, whole and at the slot of its first
    word; only where a source's quota ends within a document, its text is cut after the
    last word taken, and n_chars (if there is one) follows.
    """
    parts = mix(docs, weights, repeats, block_words).groupBy("id", "key", "copy", "epoch").agg(
        F.min_by("slot", "start").alias("slot"), F.sum(F.col("stop") - F.col("start")).alias("taken"))
    copy = F.row_number().over(Window.partitionBy("id", "key").orderBy("row.source"))
    rows = keyed(docs, "row").withColumn("copy", copy).join(parts, ["id", "key", "copy"])
    words = F.regexp_count(F.col("row.text"), F.lit(WORD))
    head = F.array_join(F.slice(F.regexp_extract_all(
        "row.text", F.lit(f"({WORD})"), F.lit(1)), 1, F.col("taken").cast("int")), " ")
    text = F.when(F.col("taken") < words, head).otherwise(F.col("row.text"))
    ordered = (rows.withColumn("text", text).repartitionByRange("slot", "id")
               .sortWithinPartitions("slot", "id"))
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("text"))
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            columns.append(F.length("text").cast(kind).alias("n_chars"))
        else:
            columns.append(F.col("row").getField(name).alias(name))
    return ordered.select(*columns)
