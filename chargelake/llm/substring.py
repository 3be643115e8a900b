"""Substring deduplication by seed and extend on winnowed anchors.

Seeds: of every window of `threshold` words, the least hash of its 8-word grams is an
anchor (winnowing), so equal windows have equal anchors at equal places. Anchors that occur
once in the corpus cannot lie in a repeat and are dropped after counting.

Extension: around each remaining anchor, the match is extended both ways as far as the
anchor is the least one: a block of consecutive windows that share it. Blocks met again as
a whole are repeats at once (the inside of long matches); only blocks met once, at the ends
of matches, are compared window by window with one example of every other block of their
anchor. So a passage in very many documents costs one row per anchor, and no pairs are made.
Overlapping repeated windows join to the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from chargelake.llm.common import (
    STEP_BYTES, Powers, Words, keyed, mixed, restored, rolling, sliding, squeezed, steps, stored)

THRESHOLD = 35
GRAM = 8
#: blocks of an anchor that are compared in one task, and their windows: text without a period
#: has THRESHOLD - GRAM + 1 in a block at most, a line repeated as many as the document
KINDS = 2048
WINDOWS = KINDS * (THRESHOLD - GRAM + 1)
_GRAM_FACTOR = 0xD6E8FEB86659FD93
_WINDOW_FACTOR = 0xA0761D6478BD642F
_BLOCK_FACTOR = 0xE7037ED1A0B428DB


def _windows(words: Words, powers: Powers, threshold: int, gram: int):
    """Word hashes, gram hashes, the least gram of each window, and whether it is whole."""
    h = words.hashes(powers)
    grams = rolling(h, gram, _GRAM_FACTOR)
    least = sliding(grams, threshold - gram + 1, np.minimum)
    counts = words.counts
    stop = np.repeat(words.first[1:], counts)
    at = np.arange(len(least))
    whole = at + threshold <= stop[:len(least)]
    return h, grams, least, whole


def anchors(docs: DataFrame, threshold: int, gram: int) -> DataFrame:
    """id, key, anchor, places: every anchor of every document and how often it is there."""
    width = threshold - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for part in steps(batch):
                words = Words(part.column("text"))
                _, grams, least, whole = _windows(words, powers, threshold, gram)
                if not whole.any():
                    continue
                # a gram is an anchor if it is the least of a window that covers it
                bound = np.zeros(len(least) + 2 * (width - 1), np.uint64)
                bound[width - 1:width - 1 + len(least)] = np.where(whole, least, 0)
                chosen = np.flatnonzero(sliding(bound, width, np.maximum) == grams)
                of = np.searchsorted(words.first, chosen, side="right") - 1
                gram_of = grams[chosen]
                order = np.lexsort((gram_of, of))
                of, gram_of = of[order], gram_of[order]
                new = np.ones(len(of), bool)
                new[1:] = (of[1:] != of[:-1]) | (gram_of[1:] != gram_of[:-1])
                at = np.flatnonzero(new)
                places = np.diff(np.append(at, len(of)))
                of = pa.array(of[at])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(of), part.column("key").take(of),
                     pa.array(gram_of[at].view(np.int64)), pa.array(places.astype(np.int32))],
                    ["id", "key", "anchor", "places"])

    return keyed(docs, "text").mapInArrow(
        run, "id bigint, key bigint, anchor bigint, places int")


def blocks(seeded: DataFrame, threshold: int, gram: int) -> DataFrame:
    """id, key, anchor, block, start, windows: runs of windows whose least gram is a seed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for part in steps(batch, "squeezed", STEP_BYTES // 2):
                words = Words(restored(part.column("squeezed")))
                h, _, least, whole = _windows(words, powers, threshold, gram)
                seeds = np.unique(np.asarray(part.column("seeds").flatten()).view(np.uint64))
                if not whole.any():
                    continue
                # runs of whole windows with the same least gram, within a document
                new = np.ones(len(least), bool)
                new[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
                begins = words.first[:-1]
                new[begins[begins < len(least)]] = True
                run_at = np.flatnonzero(new)
                value = least[run_at]
                place = np.minimum(np.searchsorted(seeds, value), len(seeds) - 1)
                wanted = whole[run_at] & (seeds[place] == value)
                if not wanted.any():
                    continue
                size = np.diff(np.append(run_at, len(least)))
                window = rolling(h, threshold, _WINDOW_FACTOR)
                # a hash of the run: place-dependent sum of its windows and its length
                inside = np.arange(len(least)) - np.repeat(run_at, size)
                term = mixed(window + (inside + 1).astype(np.uint64) * np.uint64(_BLOCK_FACTOR))
                block = mixed(np.add.reduceat(term, run_at) + size.astype(np.uint64))
                picked = np.flatnonzero(wanted)
                of = np.searchsorted(words.first, run_at[picked], side="right") - 1
                rows = np.repeat(run_at[picked] - (np.cumsum(size[picked]) - size[picked]),
                                 size[picked]) + np.arange(size[picked].sum())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(size[picked])), pa.int32()),
                    pa.array(window[rows].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(of)), part.column("key").take(pa.array(of)),
                     pa.array(value[picked].view(np.int64)),
                     pa.array(block[picked].view(np.int64)),
                     pa.array(run_at[picked] - words.first[of], pa.int64()), lists],
                    ["id", "key", "anchor", "block", "start", "windows"])

    return seeded.mapInArrow(
        run, "id bigint, key bigint, anchor bigint, block bigint, start bigint, "
             "windows array<bigint>")


def light(docs: DataFrame) -> DataFrame:
    """id, key, the text squeezed, and the other columns as a struct: what is shuffled."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    df = keyed(docs.withColumn("rest", F.struct(*others)) if others else docs,
               "text", *(["rest"] if others else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [squeezed(c) if name == "text" else c
                       for name, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays(
                columns, ["squeezed" if n == "text" else n for n in batch.schema.names])

    out = T.StructType([T.StructField("squeezed", T.BinaryType()) if f.name == "text" else f
                        for f in df.schema])
    return df.mapInArrow(run, out)


def _sized(kinds: DataFrame) -> DataFrame:
    """`kinds` and whether their anchor is crowded: too many blocks or windows for one task."""
    sizes = kinds.groupBy("anchor").agg(
        ((F.count(F.lit(1)) > KINDS) | (F.sum(F.size("windows").cast("bigint")) > WINDOWS))
        .alias("crowded"))
    return kinds.join(sizes, "anchor")


def _same_anchor(kinds: DataFrame, threshold: int) -> DataFrame:
    """id, key, start, stop of the repeated windows of blocks met once, by anchor.

    An anchor's blocks are compared in one task each while they are at most KINDS with at
    most WINDOWS windows; the windows of more are counted by partial sums, so that no
    anchor is gathered.
    """
    sized = _sized(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            anchor = rest.column("anchor").to_numpy()
            new = np.flatnonzero(anchor[1:] != anchor[:-1])
            if len(new):
                cut = int(new[-1]) + 1
                yield from repeated(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and len(rest):
            yield from repeated(rest)

    def repeated(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        anchor, n = rows.column("anchor").to_numpy(), rows.column("n").to_numpy()
        lists = rows.column("windows").combine_chunks()
        offsets = np.asarray(lists.offsets)
        window = np.asarray(lists.flatten())
        offsets = offsets - offsets[0]
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((window, anchor[row]))
        same = ((window[order][1:] == window[order][:-1])
                & (anchor[row[order]][1:] == anchor[row[order]][:-1]))
        twice = np.zeros(len(window) + 1, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        found = np.flatnonzero(twice[:-1] & (n[row] == 1))
        of = row[found]
        at = rows.column("start").to_numpy()[of] + found - offsets[of]
        yield pa.RecordBatch.from_arrays(
            [rows.column("id").combine_chunks().take(pa.array(of)),
             rows.column("key").combine_chunks().take(pa.array(of)),
             pa.array(at, pa.int64()), pa.array(at + threshold, pa.int64())],
            ["id", "key", "start", "stop"])

    columns = ["anchor", "n", "windows", "id", "key", "start"]
    few = sized.filter("not crowded").select(*columns).repartition("anchor")
    found = few.sortWithinPartitions("anchor").mapInArrow(
        run, "id bigint, key bigint, start bigint, stop bigint")

    many = sized.filter("crowded").select(
        *columns, F.posexplode("windows").alias("at", "window")).drop("windows")
    twice = (many.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("_n"))
             .filter("_n > 1").select("anchor", "window"))
    place = F.col("start") + F.col("at")
    counted = many.filter("n = 1").join(twice, ["anchor", "window"], "left_semi").select(
        "id", "key", place.alias("start"), (place + threshold).alias("stop"))
    return found.unionByName(counted)


def repeats(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """id, key, spans: the maximal repeats [from, to) in words, of documents that have any."""
    found = anchors(docs, threshold, gram)
    seeds = found.groupBy("anchor").agg(F.sum("places").alias("_n")).filter("_n > 1")
    seeded = (found.select("id", "key", "anchor").join(seeds.select("anchor"), "anchor")
              .groupBy("id", "key").agg(F.collect_set("anchor").alias("seeds")))
    # equal blocks and windows count within equal anchors, so 128 bits tell them apart
    texts = light(docs.select("doc_id", "text")).select("id", "key", "squeezed")
    block = stored(blocks(texts.join(seeded.hint("shuffle_hash"), ["id", "key"]),
                          threshold, gram), "blocks")
    kinds = block.groupBy("anchor", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("windows").alias("windows"),
        F.min(F.struct("id", "key", "start")).alias("place"))
    again = kinds.filter("n > 1").select("anchor", "block")
    entire = block.select("id", "key", "anchor", "block", "start", F.size("windows").alias("size")).join(
        again, ["anchor", "block"], "left_semi").select(
        "id", "key", "start", (F.col("start") + F.col("size") + threshold - 1).alias("stop"))
    ends = _same_anchor(kinds.select("anchor", "n", "windows", "place.*"), threshold)
    return (entire.unionByName(ends).groupBy("id", "key")
            .agg(F.collect_set(F.struct("start", "stop")).alias("spans")))


def _cover(words: Words, d: int, spans: list[dict] | None) -> np.ndarray:
    """Which words of document d lie in a span."""
    n = int(words.first[d + 1] - words.first[d])
    edge = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(edge, [s["start"] for s in spans], 1)
        np.add.at(edge, [s["stop"] for s in spans], -1)
    return np.cumsum(edge[:n]) > 0


def remove_repeats(docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """Columns row, kept, n_words, n_removed, spans per document, every document once.

    `row` has the columns of `docs`. `kept` is the words outside of repeats joined by one
    space; the text itself where nothing is removed is in `row`. Texts are whole; null and
    wordless ones keep nothing and lose nothing. A document with fewer words than the
    threshold has no window. Repeated rows repeat each other's windows. `spans` has the
    maximal repeats, [start, stop) in words, in order. An empty table gives an empty one.
    """
    spans = repeats(docs, threshold, gram)
    texts = light(docs)
    joined = texts.join(spans.hint("shuffle_hash"), ["id", "key"], "left")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "squeezed", STEP_BYTES // 2):
                text = restored(part.column("squeezed"))
                words = Words(text)
                kept, lost, merged = [], [], []
                for d, own in enumerate(part.column("spans").to_pylist()):
                    gone = _cover(words, d, own)
                    lost.append(int(gone.sum()))
                    if not lost[-1]:
                        kept.append(words.document(d).tobytes())
                        merged.append([])
                        continue
                    a, b = words.first[d], words.first[d + 1]
                    start, end = words.start[a:b], words.end[a:b]
                    data = words.data[int(start[0]):int(end[-1]) + 1]
                    # each word with the space behind it
                    mask = np.repeat(~gone, end - start + 1)
                    kept.append(data[mask].tobytes()[:-1])
                    flips = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                    merged.append([{"start": int(x), "stop": int(y)}
                                   for x, y in zip(flips[::2], flips[1::2])])
                others = iter(part.column("rest").flatten() if len(names) > 1 else ())
                row = pa.StructArray.from_arrays(
                    [text if name == "text" else next(others) for name in names], names=names)
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(kept).cast(pa.string()),
                     pa.array(words.counts.astype(np.int64)), pa.array(lost, pa.int64()),
                     pa.array(merged, pa.list_(pa.struct(
                         [("start", pa.int64()), ("stop", pa.int64())])))],
                    ["row", "kept", "n_words", "n_removed", "spans"])

    span = T.StructType().add("start", "long").add("stop", "long")
    out = (T.StructType().add("row", docs.schema)
           .add("kept", "string").add("n_words", "long").add("n_removed", "long")
           .add("spans", T.ArrayType(span)))
    return joined.mapInArrow(run, out)
