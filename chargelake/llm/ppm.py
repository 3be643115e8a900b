"""Language identification by prediction by partial matching.

Per language, a variable-order byte context tree: how often each byte followed each context
of 0 to ORDER bytes. A byte's code length is read at the longest context; a byte not seen
there costs the escape (method C: distinct followers over total plus distinct) and is tried
one byte shorter, down to 8 bits for a byte never seen. Statistics are frozen, so a text's
code length is the sum over its bytes. Contexts begin at the space before a word and the
space behind it is coded with it; hence words cost the same wherever they stand and each
is worked out once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import steps

ORDER = 4
#: text a language's tree is learned from
SAMPLE_BYTES = 1 << 20
#: rows that share it at least, if the language has as many
LEAST_ROWS = 64
UNDETERMINED = "und"
_KNOWN_WORDS = 250_000
_BLANKS = " \t\n\x0b\x0c\r"
#: longest run of bytes a text taken in part counts as one word
_PIECE = 1024
_LETTER = r"\p{L}"
_GOLDEN = 0.6180339887498949


def held_out(doc_id: str = "doc_id") -> Column:
    """One document in five, by the CRC-32 of its id as text; a null id counts as ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


class Trees:
    """Context trees of all languages: code lengths of byte strings in bits."""

    def __init__(self, counts: dict[str, Counter], order: int = ORDER):
        self.languages = sorted(counts)
        self.order = order
        per_language = []
        for language in self.languages:
            grams: Counter = Counter()
            for word, n in counts[language].items():
                text = b" " + word + b" "
                for end in range(2, len(text) + 1):
                    for size in range(1, min(order + 1, end) + 1):
                        grams[text[end - size:end]] += n
            # a string as context: how often and by how many different bytes it was followed
            total, kinds = Counter(), Counter()
            for gram, n in grams.items():
                total[gram[:-1]] += n
                kinds[gram[:-1]] += 1
            per_language.append((grams, total, kinds))
        union = sorted(set().union(*[g for g, _, _ in per_language],
                                   *[t for _, t, _ in per_language]) if per_language else [],
                       key=len)
        self.index = {gram: i for i, gram in enumerate(union)}
        self.cost = np.zeros((len(union), len(self.languages)))
        self.escape = np.zeros_like(self.cost)
        for j, (grams, total, kinds) in enumerate(per_language):
            for i, gram in enumerate(union):
                if gram in total:
                    self.escape[i, j] = -log2(kinds[gram] / (total[gram] + kinds[gram]))
                if gram in grams:
                    context = gram[:-1]
                    self.cost[i, j] = -log2(grams[gram] / (total[context] + kinds[context]))
                elif gram:
                    shorter = self.cost[self.index[gram[1:]], j] if len(gram) > 1 else 8.0
                    self.cost[i, j] = self.escape[self.index[gram[:-1]], j] + shorter

        # the same strings by size, as sorted numbers
        self.tables = []
        for size in range(order + 2):
            rows = [(int.from_bytes(gram, "big"), i) for gram, i in self.index.items()
                    if len(gram) == size]
            rows.sort()
            self.tables.append((np.array([k for k, _ in rows], np.int64),
                                np.array([i for _, i in rows], np.int64)))
        del self.index

    def _find(self, size: int, keys: np.ndarray) -> np.ndarray:
        """Row of each string of that size, -1 for one that no language has."""
        table, rows = self.tables[size]
        if not len(table):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, rows[at], -1)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Code length in bits of each word, with the space behind it, per language."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8).astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        place = np.arange(len(data)) - np.repeat(begins, sizes)
        bits = np.zeros((len(data), len(self.languages)))
        # the string that ends at each byte, of the greatest size first
        longest = np.minimum(place + 1, self.order + 1)
        open_ = np.flatnonzero(place > 0)
        for size in range(self.order + 1, 0, -1):
            now = open_[longest[open_] >= size]
            key = np.zeros(len(now), np.int64)
            for back in range(size):
                key += data[now - back] << (8 * back)
            row = self._find(size, key)
            seen = row >= 0
            bits[now[seen]] += self.cost[row[seen]]
            unseen = now[~seen]
            context = self._find(size - 1, key[~seen] >> 8)
            known = context >= 0
            bits[unseen[known]] += self.escape[context[known]]
            open_ = np.concatenate([unseen, open_[longest[open_] < size]])
        bits[open_] += 8.0
        return np.add.reduceat(bits, begins, axis=0)


def _word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs per lang, in the `share` of each text that is taken.

    A text taken in part gives words from all over it, at steps of the golden ratio, which
    keep time with no pattern in it, and always its first. Its very long words are pieces.
    """
    def taken(text: bytes, share: float) -> Iterator[bytes]:
        pieces = (text[at:min(at + _PIECE, word.end())] for word in re.finditer(rb"\S+", text)
                  for at in range(word.start(), word.end(), _PIECE))
        return (piece for i, piece in enumerate(pieces) if i * _GOLDEN % 1 < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for language, text, share in zip(*[batch.column(c).to_pylist()
                                               for c in ("lang", "text", "share")]):
                text = text.encode()
                seen.update((language, w)
                            for w in (text.split() if share >= 1 else taken(text, share)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in seen], pa.string()),
                 pa.array([x[1] for x in seen], pa.binary()),
                 pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    return (docs.mapInArrow(run, "lang string, word binary, n bigint")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> Trees:
    """Trees of every non-null lang of `docs` that has a text with a word, from a hash sample.

    Rows are drawn in the order of a hash of id and text, until a language has
    `sample_bytes` or all its rows. A text counts with a LEAST_ROWS-th of that at most, so
    as many rows are drawn at least; what is still missing when all rows are drawn comes
    from the longer texts in proportion. Texts that count in part give words from all over
    them. So about `sample_bytes` per language come to the driver, and no language with a
    word is without a tree. Sizes per language are counted over all rows. Repeated rows
    count each.
    """
    labelled = docs.filter("lang is not null").filter(
        F.octet_length(F.ltrim("text", F.lit(_BLANKS))) > 0)
    size = F.octet_length("text").cast("bigint")
    part = F.least(size, F.lit(max(1, sample_bytes // LEAST_ROWS)).cast("bigint"))
    # 64 buckets for each power of two: one has about a hundredth of the rows before it
    bucket = F.floor(64 * F.log2(F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1) + 1.0))
    sizes: dict[str, list] = {}
    for row in labelled.groupBy("lang", bucket.alias("bucket")).agg(
            F.sum(part).alias("part"), F.sum(size).alias("size")).collect():
        sizes.setdefault(row["lang"], []).append((row["bucket"], row["part"], row["size"]))
    if not sizes:
        return Trees({}, order)
    last, rest = [], []
    for language, buckets in sizes.items():
        parts = wholes = 0
        for at, own, whole in sorted(buckets):
            parts, wholes = parts + own, wholes + whole
            if parts >= sample_bytes:
                break
        missing = max(0, sample_bytes - parts)
        last += [F.lit(language), F.lit(at)]
        rest += [F.lit(language), F.lit(min(1.0, missing / (wholes - parts)) if wholes > parts
                                        else 1.0)]
    of = lambda values: F.element_at(F.create_map(*values), F.col("lang"))
    sample = labelled.filter(bucket <= of(last)).select(
        "lang", "text", ((part + (size - part) * of(rest)) / size).alias("share"))
    counts: dict[str, Counter] = {language: Counter() for language in sizes}
    for row in _word_counts(sample).collect():
        counts[row["lang"]][bytes(row["word"])] = row["n"]
    without = sorted(language for language, words in counts.items() if not words)
    if without:
        raise ValueError(f"no words were drawn of the languages {without}")
    return Trees(counts, order)


def identify(docs: DataFrame, trees: Trees) -> DataFrame:
    """All columns of `docs` in a struct `row`, with lang_pred and score.

    lang_pred is the language of the shortest code for the whole text (ties: the smaller
    name); score is its share of the languages' probabilities of the text, 0 to 1. Null
    texts, texts without a letter, and all texts if nothing was learned are "und" with
    score 0. Repeated rows are scored each.
    """
    # plain tables: workers need not be able to import this package
    model = docs.sparkSession.sparkContext.broadcast(vars(trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees({})
        vars(trees).update(model.value)
        width = len(trees.languages)
        has_letter = regex.compile(_LETTER).search

        known: dict[bytes, int] = {}
        table = np.zeros((0, width))
        for batch in batches:
            for part in steps(batch):
                split = [text.encode().split() if text is not None and width and has_letter(text)
                         else None for text in part.column("text").to_pylist()]
                new = list({w for words in split if words for w in words if w not in known})
                if len(known) + len(new) > _KNOWN_WORDS:
                    known, table = {}, np.zeros((0, width))
                    new = list({w for words in split if words for w in words})
                if new:
                    known.update(zip(new, range(len(table), len(table) + len(new))))
                    table = np.concatenate([table, trees.words(new)])
                named, scores = [], []
                for words in split:
                    if words is None:
                        named.append(UNDETERMINED)
                        scores.append(0.0)
                        continue
                    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                    bits = table[at].sum(axis=0)
                    best = int(bits.argmin())
                    named.append(trees.languages[best])
                    scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(named, pa.string()),
                     pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, schema)


def language_of(docs: DataFrame, order: int = ORDER,
                sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """identify() by trees learned from the rows of `docs` that are not held out."""
    return identify(docs, train(docs.filter(~held_out()), order, sample_bytes))


def _with_letter(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds a letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has_letter = regex.compile(_LETTER).search
        for batch in batches:
            yield batch.filter(pa.array([text is not None and has_letter(text) is not None
                                         for text in batch.column("text").to_pylist()],
                                        pa.bool_()))

    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.mapInArrow(run, rows.schema).select("row.*")


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The documents, unchanged, whose language is determined with at least that score.

    If nothing can be learned, as no labelled row that is not held out has a word, there is
    no score to go by: then only null texts and texts without a letter are dropped.
    """
    trees = train(docs.filter(~held_out()))
    if not trees.languages:
        return _with_letter(docs)
    return (identify(docs, trees).filter(F.col("lang_pred") != UNDETERMINED)
            .filter(F.col("score") >= least_score).select("row.*"))
