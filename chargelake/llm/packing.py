"""Hierarchical packing of documents into sequences of several context sizes.

A document is cut into full windows of the largest tier and a tail; each piece goes to the
smallest tier (2048, 1024, 512, 256 tokens) that holds it. Pieces are ordered by tier, the
longest first. From the front of that order, each piece opens a window of its own tier;
pieces from its back, the shorter tiers, are cut to fill the gaps of those windows, in
order. The border is where the gaps opened so far are as large as what is left to fill them
with, found from sums per task and tier. So every sequence is full at its tier's size
except one, and documents stay whole as far as possible. Sequences are numbered in that
order; dealing the numbers round to `steps` groups balances the tiers and tokens of each.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from chargelake.llm.common import doc_id, keyed, steps, stored, utf8
from chargelake.llm.longtext import binary

TIERS = (2048, 1024, 512, 256)
END = 1
#: sequences' tokens to a step group
STEP_TOKENS = 1 << 20
#: tokens of the gap coordinate that one task's unit covers
BLOCK = 1 << 18
#: offsets are broadcast up to this many rows (tasks times tiers), joined plainly beyond
BROADCAST_ROWS = 50_000
#: words a task keeps the ids of, before it begins anew
_KNOWN_WORDS = 500_000
_LETTER, _DIGIT, _SIGN, _QUOTE, _LEAD, _TRAIL = range(1, 7)
#: kinds of bytes that tell where the tokenizer cuts: ASCII letters, digits, signs and the
#: apostrophe, and the two bytes of Latin-1's letters beyond ASCII
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _QUOTE
_KIND[0xC3] = _LEAD
_KIND[0x80:0xC0] = _TRAIL
_KIND[[0x97, 0xB7]] = 0
#: by the kinds of two neighbours: surely a cut, or one if a letter of two bytes ends or
#: begins there; an apostrophe may belong to the letters behind it
_CUT, _IF_ENDS, _IF_BEGINS = 1, 2, 3
_BETWEEN = np.zeros((32, 8), np.uint8)
_BETWEEN[_LETTER, [_DIGIT, _SIGN, _QUOTE]] = _CUT
_BETWEEN[_DIGIT, [_LETTER, _SIGN, _QUOTE]] = _CUT
_BETWEEN[_SIGN, [_LETTER, _DIGIT]] = _CUT
_BETWEEN[_QUOTE, _DIGIT] = _CUT
_BETWEEN[_TRAIL, [_DIGIT, _SIGN, _QUOTE]] = _IF_ENDS
_BETWEEN[[_DIGIT, _SIGN], _LEAD] = _IF_BEGINS
_BETWEEN = _BETWEEN.ravel()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: second bytes of Latin-1's capitals
_CAPITAL = np.zeros(256, bool)
_CAPITAL[0x80:0x9F] = True
_CAPITAL[0x97] = False
#: words that are one run of letters to the tokenizer and that its normalizer leaves alone:
#: a to z and the small letters of Latin-1
_PLAIN = "^[a-zß-öø-ÿ]+$"
#: byte-level form: bytes that are no visible characters of Latin-1 are numbered from U+0100;
#: line breaks stay, they part the words
_FORM = np.arange(256, dtype="<u2")
_FORM[[*range(0x21), *range(0x7F, 0xA1), 0xAD]] = 256 + np.arange(68)
_FORM[0x0A] = 0x0A


def folds_case(tokenizer: str) -> bool:
    """Whether the tokenizer lower-cases and cuts letters and digits from punctuation."""
    with open(tokenizer, encoding="utf-8") as file:
        settings = json.load(file)
    steps_ = (settings.get("normalizer") or {}).get("normalizers", [])
    cuts = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    pattern = cuts[0].get("pattern", {}).get("Regex", "") if cuts else ""
    return (any(s["type"] == "Lowercase" for s in steps_)
            and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))


def _mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] for bytes, without widening them to places of eight bytes."""
    return np.frombuffer(bytearray(data).translate(table.tobytes()), np.uint8)


class WordIds:
    """Token ids of texts, word by word; a word's ids are worked out once in a task.

    `known` has a word's place: its run of ids in `flat`; the place 0 is that of `end`. Where
    the tokenizer does the same itself, capitals of Latin-1 are lowered and words are cut
    between letters, digits and signs, so that fewer different words are left. Texts that
    might hold a special token's string are left as they are.
    """

    def __init__(self, encoder, fold: bool, end: int):
        self.encoder, self.fold, self.end = encoder, fold, end
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.begins, self.sizes = array("I", [self.end]), array("q", [0]), array("q", [1])

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Add words to those known; their places."""
        model, first = self.encoder.model.tokenize, len(self.flat)
        ids, sizes = [], array("q")
        # a lone run of letters: only the byte-level form is left to make of it
        plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False) \
            if self.fold else np.zeros(len(words), bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        words = words.to_numpy(zero_copy_only=False)[order].tolist()
        letters, rest = words[:plain.sum()], words[plain.sum():]
        if letters:
            data = np.frombuffer("\n".join(letters).encode(), np.uint8)
            shown = _FORM[data].tobytes().decode("utf-16-le").split("\n")
            for form in shown:
                own = [token.id for token in model(form)]
                sizes.append(len(own))
                ids += own
            self.flat.extend(ids)
        for at in range(0, len(rest), 20_000):
            for encoding in self.encoder.encode_batch_fast(
                    rest[at:at + 20_000], add_special_tokens=False):
                own = encoding.ids
                sizes.append(len(own))
                self.flat.extend(own)
        size = np.array(sizes)
        self.begins.frombytes((np.cumsum(size) - size + first).tobytes())
        self.sizes.extend(sizes)
        begin = len(self.known) + 1
        self.known.update(zip(words, range(begin, begin + len(words))))
        places = np.empty(len(words), np.int64)
        places[order] = np.arange(begin, begin + len(words))
        return places

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of different words, learned where they are not known."""
        places = np.fromiter(map(self.known.get, words.to_numpy(zero_copy_only=False), repeat(0)),
                             np.int64, len(words))
        new = np.flatnonzero(places == 0)
        if len(new):
            places[new] = self._learn(words.take(pa.array(new)))
        return places

    def _folded(self, column: pa.Array) -> pa.Array:
        """Texts in lower case, with a space where the tokenizer cuts a word."""
        data, offsets = utf8(column)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        text = binary(data, offsets).cast(pa.large_string())
        if not self.fold or not len(data):
            return text
        kind = _mapped(data, _KIND)
        found = _mapped((kind[:-1] << np.uint8(3)) | kind[1:], _BETWEEN)
        at = np.flatnonzero(found) + 1
        sort = found[at - 1]
        behind = np.append(data, np.zeros(2, np.uint8))
        # a letter of two bytes lies before or behind
        at = at[(sort == _CUT) | ((sort == _IF_ENDS) & (data[at - 2] == 0xC3))
                | ((sort == _IF_BEGINS) & (_KIND[behind[at + 1]] == _TRAIL))]
        # the tokenizer composes before it lowers: what marks may follow stays as it is
        lower = _mapped(data, _LOWER)
        marked = np.flatnonzero(data[1:] >= 0xC4)
        lower[marked] = data[marked]
        capital = np.flatnonzero(data == 0xC3)
        capital = capital[_CAPITAL[behind[capital + 1]] & (behind[capital + 2] < 0xC4)] + 1
        lower[capital] += np.uint8(0x20)
        cut = binary(np.insert(lower, at, np.uint8(0x20)), offsets + np.searchsorted(at, offsets))
        special = pc.match_substring(text, "<|")
        return pc.if_else(special, text, cut.cast(pa.large_string()))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with `end` behind, and where each begins."""
        if len(self.known) > _KNOWN_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(self._folded(column))
        words, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(words), 0)
        words, parent = pc.filter(words, real), pc.filter(parent, real).to_numpy()
        coded = pc.dictionary_encode(words)
        place_of = self._places(coded.dictionary)
        after = np.searchsorted(parent, np.arange(len(column)), side="right")
        places = np.insert(place_of[coded.indices.to_numpy()], after, 0)
        sizes = np.array(self.sizes)[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.array(self.flat, "<u4")[
            np.repeat(np.array(self.begins)[places] - ends + sizes, sizes) + np.arange(total)]
        return ids, np.concatenate([[0], ends[after + np.arange(len(column))]])


def pieces(docs: DataFrame, tokenizer: str, end: int = END,
           tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Token ids of every document plus `end`, cut into windows of the largest tier and a tail.

    id, key, start, length, doc_tokens, ids (little-endian unsigned 32-bit), tier (place in
    `tiers`), and the place within the task's pieces of that tier: part, nth, gaps and
    tokens of those before it. White space separates tokens for these tokenizers, so each
    distinct word is encoded once in a task.
    """
    largest = tiers[0]
    fold = folds_case(tokenizer)
    descending = np.array(tiers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one thread a task: Spark deals out the cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        known = WordIds(Tokenizer.from_file(tokenizer), fold, end)
        part = TaskContext.get().partitionId()
        nth = np.zeros(len(tiers), np.int64)
        gaps = np.zeros(len(tiers), np.int64)
        tokens = np.zeros(len(tiers), np.int64)
        for batch in batches:
            for some in steps(batch):
                ids, bounds = known.encode(some.column("text"))
                ids, bounds = ids.tobytes(), bounds.tolist()
                rows = []
                for d, (begin, stop) in enumerate(zip(bounds, bounds[1:])):
                    total = stop - begin
                    for start in range(0, total, largest):
                        length = min(largest, total - start)
                        own = ids[4 * (begin + start):4 * (begin + start + length)]
                        tier = int((descending >= length).sum()) - 1
                        rows.append((d, start, length, total, own, tier,
                                     nth[tier], gaps[tier], tokens[tier]))
                        nth[tier] += 1
                        gaps[tier] += tiers[tier] - length
                        tokens[tier] += length
                of, start, length, total, ids, tier, n, g, t = zip(*rows)
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id").take(of), some.column("key").take(of),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(total, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(tier, pa.int32()), pa.array([part] * len(rows), pa.int32()),
                     pa.array(n, pa.int64()), pa.array(g, pa.int64()), pa.array(t, pa.int64())],
                    ["id", "key", "start", "length", "doc_tokens", "ids", "tier", "part",
                     "nth", "gaps", "tokens"])
            # the worker lives on: give back what this batch needed
            pa.default_memory_pool().release_unused()

    return keyed(docs, "text").mapInArrow(
        run, "id bigint, key bigint, start bigint, length bigint, doc_tokens bigint, "
             "ids binary, tier int, part int, nth bigint, gaps bigint, tokens bigint")


def _offsets(items: DataFrame, tiers: tuple[int, ...]) -> tuple[DataFrame, int]:
    """Per tier and part: pieces, gaps and tokens before it in the order (tier, part)."""
    size = F.element_at(F.array(*[F.lit(t) for t in tiers]), F.col("tier") + 1)
    sums = items.groupBy("tier", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size - F.col("length")).alias("gap"),
        F.sum("length").alias("filled"))
    sums = stored(sums, "packing-sums")
    # in two levels, so that no task orders the parts of all tasks
    group = F.shiftright("part", 12)
    inner = Window.partitionBy("tier", "group").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.orderBy("tier", "group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("group", group)
    names = {"n": "n_before", "gap": "gap_before", "filled": "filled_before"}
    groups = sums.groupBy("tier", "group").agg(*[F.sum(c).alias(c) for c in names])
    groups = groups.select("tier", "group", *[
        F.coalesce(F.sum(c).over(outer), F.lit(0)).alias(f"outer_{c}") for c in names])
    inside = sums.select("tier", "part", "group", *[
        F.coalesce(F.sum(c).over(inner), F.lit(0)).alias(f"inner_{c}") for c in names])
    offsets = inside.join(groups, ["tier", "group"]).select("tier", "part", *[
        (F.col(f"outer_{c}") + F.col(f"inner_{c}")).alias(n) for c, n in names.items()])
    total = sums.agg(F.sum("filled"), F.count(F.lit(1))).first()
    if total[1] <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return offsets, int(total[0] or 0)


def _fill(largest: int):
    """Cuts fillers at the borders of gaps, within a block of the gap coordinate."""
    def run(key: tuple, gaps: pd.DataFrame, fillers: pd.DataFrame) -> pd.DataFrame:
        lower, upper = int(key[0]) * BLOCK, (int(key[0]) + 1) * BLOCK
        gaps, fillers = gaps.sort_values("at"), fillers.sort_values("at")
        out: dict[str, list] = {c: [] for c in (
            "id", "key", "start", "length", "doc_tokens", "ids", "sequence_id", "offset")}
        if len(fillers) and len(gaps):
            g_at, g_end = gaps["at"].to_numpy(), (gaps["at"] + gaps["room"]).to_numpy()
            f_at, f_end = fillers["at"].to_numpy(), (fillers["at"] + fillers["length"]).to_numpy()
            edges = np.unique(np.concatenate([g_at, g_end, f_at, f_end]))
            a, b = edges[:-1], edges[1:]
            g = np.searchsorted(g_at, a, side="right") - 1
            f = np.searchsorted(f_at, a, side="right") - 1
            ok = (g >= 0) & (f >= 0)
            ok &= (a < g_end[g]) & (a < f_end[f])
            a, b, g, f = a[ok], b[ok], g[ok], f[ok]
            # a stretch that a block border cuts belongs to the block of its begin
            ok = (a >= lower) & (a < upper)
            a, b, g, f = a[ok], b[ok], g[ok], f[ok]
            ids = fillers["ids"].to_list()
            into = a - f_at[f]
            out["id"] = fillers["id"].to_numpy()[f]
            out["key"] = fillers["key"].to_numpy()[f]
            out["start"] = fillers["start"].to_numpy()[f] + into
            out["length"] = b - a
            out["doc_tokens"] = fillers["doc_tokens"].to_numpy()[f]
            out["ids"] = [ids[x][4 * i:4 * (i + n)] for x, i, n in zip(f, into, b - a)]
            out["sequence_id"] = gaps["sequence_id"].to_numpy()[g]
            out["offset"] = gaps["offset"].to_numpy()[g] + a - g_at[g]
        return pd.DataFrame(out)

    return run


def pack(docs: DataFrame, tokenizer: str, end: int = END, tiers: tuple[int, ...] = TIERS,
         step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of all documents in sequences: doc_id, start, length, ids, doc_tokens,
    sequence_id, offset, context (tier's tokens) and step (the step group).

    `tokenizer` is a path all executors have, of one whose tokens do not span white space.
    Null texts count as empty: their only id is `end`. Repeated rows are packed each, under
    the same doc_id. Pieces of a sequence lie without gaps from offset 0. Only the last
    sequence may be shorter than its context. An empty table gives no rows. `tiers` are
    powers of two, descending.
    """
    items = stored(pieces(docs, tokenizer, end, tiers), "pieces")
    offsets, tokens = _offsets(items, tiers)
    size = F.element_at(F.array(*[F.lit(t).cast("bigint") for t in tiers]), F.col("tier") + 1)
    placed = (
        items.join(offsets, ["tier", "part"])
        .withColumn("place", F.col("n_before") + F.col("nth"))
        .withColumn("room", size - F.col("length"))
        .withColumn("gap_at", F.col("gap_before") + F.col("gaps"))
        .withColumn("token_at", F.col("filled_before") + F.col("tokens"))
        # gaps up to this piece against the tokens behind it
        .withColumn("opens", F.col("gap_at") + F.col("room")
                    <= F.lit(tokens) - F.col("token_at") - F.col("length"))
        .withColumn("context", size)
    )
    border = placed.filter("opens").agg(
        F.count(F.lit(1)), F.max(F.struct("place", F.col("gap_at") + F.col("room"),
                                          F.col("token_at") + F.col("length")))).first()
    opened, edge = border[0], border[1]
    # filled by the windows opened, and where the fillers' tokens begin
    room, first = (edge[1], edge[2]) if edge else (0, 0)
    rest = tokens - first - room
    hosts = placed.filter("opens").select(
        "id", "key", "start", "length", "doc_tokens", "ids",
        F.col("place").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"), "context")
    spark = docs.sparkSession
    gaps = placed.filter("opens and room > 0").select(
        F.col("gap_at").alias("at"), "room", F.col("place").alias("sequence_id"),
        F.col("length").alias("offset"))
    if rest:  # what no gap takes is a last, short sequence
        gaps = gaps.unionByName(spark.range(1).select(
            F.lit(room).cast("bigint").alias("at"), F.lit(rest).cast("bigint").alias("room"),
            F.lit(opened).cast("bigint").alias("sequence_id"),
            F.lit(0).cast("bigint").alias("offset")))
    fillers = placed.filter("not opens").select(
        (F.col("token_at") - first).alias("at"), "id", "key", "start", "length", "doc_tokens", "ids")

    def by_block(df: DataFrame, width: str) -> DataFrame:
        last = F.floor((F.col("at") + F.col(width) - 1) / BLOCK)
        return df.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / BLOCK), last)))

    filled = by_block(gaps, "room").groupBy("block").cogroup(
        by_block(fillers, "length").groupBy("block")).applyInPandas(
        _fill(tiers[0]), "id bigint, key bigint, start bigint, length bigint, "
                         "doc_tokens bigint, ids binary, sequence_id bigint, offset bigint")
    sequences = opened + (1 if rest else 0)
    groups = max(-(-tokens // step_tokens), 1)
    contexts = _context(items, offsets, tiers, opened)
    filled = filled.withColumn("context", contexts)
    return hosts.unionByName(filled).select(
        doc_id(), "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context",
        F.pmod(F.col("sequence_id"), F.lit(min(groups, max(sequences, 1)))).alias("step"))


def _context(items: DataFrame, offsets: DataFrame, tiers: tuple[int, ...],
             opened: int) -> Column:
    """Context size of a sequence from its number: tiers follow each other in that order."""
    firsts = {r["tier"]: r["first"] for r in offsets.groupBy("tier").agg(
        F.min("n_before").alias("first")).collect()}  # a row per tier
    size = F.lit(tiers[0])
    for tier, first in sorted(firsts.items()):
        size = F.when(F.col("sequence_id") >= first, F.lit(tiers[tier])).otherwise(size)
    return F.when(F.col("sequence_id") >= opened, F.lit(tiers[0])).otherwise(size).cast("bigint")
