"""Byte-level BPE encoding with content-defined chunks, and decoding.

A rolling hash over the last WINDOW bytes cuts texts into chunks, so equal passages give
equal chunks wherever they stand, and a chunk that several documents share is encoded once
in a task. A chunk's own encoding is that of the text only between borders at which the
tokenizer cuts whatever stands around them ("sure" borders, as where a visible character
meets a space). The join of two chunks is therefore encoded again, over a window that grows
from the join until it ends, on both sides, at a border where the chunks' encodings and the
text's agree; across chunks without such a border it runs on to the next. So ids are those
of the whole text.

What a chunk holds between its sure borders is put together from pieces, each distinct one
encoded once by the tokenizer; the windows are such pieces as well.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chargelake.llm.common import rolling, steps, utf8
from chargelake.llm.longtext import LIMIT, parts

WINDOW = 32
#: a chunk has 1 << CUT_BITS bytes on average
CUT_BITS = 8
#: and no more than this, where the rolling hash finds no cut (as in periodic text)
LONGEST = 1 << 13
#: texts of chunks and pieces a task remembers the ids of, and ids, before it starts anew
REMEMBERED_BYTES = 16 << 20
REMEMBERED_IDS = 8 << 20
_FACTOR = 0x9E3779B97F4A7C15

_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[0x30:0x3A] = False


#: a piece that the pattern takes whole: letters of ASCII and Latin-1, a blank before them
_ONE_RUN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: byte-level form: bytes that are no visible characters of Latin-1 are numbered from U+0100
_FORM = {byte: 256 + i for i, byte in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}


def _before_blank(data: np.ndarray) -> np.ndarray:
    """Places where a blank follows a character that is none.

    The character is a visible one of ASCII, or of two bytes from U+00C0 on, or of three
    bytes from U+4000 on: none of those is a white space.
    """
    solid = _VISIBLE[data]
    tail = data & 0xC0 == 0x80
    solid[1:] |= tail[1:] & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    solid[2:] |= tail[2:] & tail[1:-1] & (data[:-2] >= 0xE4) & (data[:-2] <= 0xEF)
    sure = _BLANK[data]
    sure[1:] &= solid[:-1]
    sure[:1] = False
    return sure


def sure_borders(data: np.ndarray) -> np.ndarray:
    """Mask of the bytes before which the pattern of byte-level BPE always cuts.

    No alternative of the pattern goes on with a blank behind another character, nor with a
    mark behind a letter; and none looks back, so what follows a cut does not depend on what
    is before it.
    """
    sure = _before_blank(data)
    sure[1:] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    return sure


class Vocabulary:
    """What a tokenizer file says: the bytes of each id, and the special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        cut = settings.get("pre_tokenizer") or {}
        special = settings.get("added_tokens") or []
        if not (settings["model"]["type"] == "BPE" and cut.get("type") == "ByteLevel"
                and cut.get("use_regex") and not cut.get("add_prefix_space")
                and not settings.get("normalizer") and not settings.get("post_processor")):
            raise ValueError(f"{path} is not plain byte-level BPE with its usual pattern")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
               for t in special):
            raise ValueError(f"{path} has special tokens that take in what is around them")
        # a byte is written as the character of its number, or from U+0100 on if that is
        # not a visible one of Latin-1
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
        moved = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}
        names = {i: token for token, i in settings["model"]["vocab"].items()}
        names |= {t["id"]: t["content"] for t in special}
        self.token_bytes = [b""] * (max(names) + 1)
        for i, name in names.items():
            known = all(c in byte_of for c in name)
            self.token_bytes[i] = bytes(byte_of[c] for c in name) if known else name.encode()
        names_ = sorted((t["content"].encode() for t in special), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, names_))) if names_ else None


class Encoder:
    """Ids of texts, with a memory of chunks and pieces that lasts for a task."""

    def __init__(self, tokenizer, special: re.Pattern | None, bits: int = CUT_BITS,
                 window: int = WINDOW, longest: int = LONGEST):
        self.tokenizer, self.special = tokenizer, special
        self.bits, self.window, self.longest = bits, window, longest
        self._forget()
        self.reused = 0

    def _forget(self) -> None:
        self.places: dict[bytes, int] = {}
        self.chunks: dict[bytes, int] = {}
        self.start, self.stop = array("q"), array("q")
        self.ids = array("I")
        self.size = 0

    def _place(self) -> int:
        self.start.append(0)
        self.stop.append(0)
        return len(self.start) - 1

    def _cuts(self, data: np.ndarray, inside: np.ndarray) -> list[int]:
        """Borders of the chunks of one text, 0 and its length included."""
        size = len(data)
        if size <= 1 << self.bits:
            return [0, size]
        hashes = rolling(data.astype(np.uint64) + np.uint64(1), self.window, _FACTOR)
        found = np.flatnonzero(hashes & np.uint64((1 << self.bits) - 1) == 0) + self.window
        borders, last, least = [0], 0, self.window
        for at in [*found.tolist(), size]:
            if at - last < least and at < size:
                continue
            while at - last > self.longest:
                last = self._allowed(data, inside, last + self.longest)
                borders.append(last)
            if at < size:
                at = self._allowed(data, inside, at)
            if last < at < size:
                borders.append(at)
                last = at
        if borders[-1] < size:
            borders.append(size)
        return borders

    @staticmethod
    def _allowed(data: np.ndarray, inside: np.ndarray, at: int) -> int:
        """The first place from `at` on between characters and not inside a special token."""
        while at < len(data) and (data[at] & 0xC0 == 0x80 or inside[at]):
            at += 1
        return at

    def _text(self, raw: bytes, data: np.ndarray, sure: np.ndarray, fresh: list) -> list[int]:
        """The places whose ids, in order, are those of one text."""
        size = len(raw)
        inside = np.zeros(size, bool)
        if self.special is not None:
            for match in self.special.finditer(raw):
                a, b = match.span()
                inside[a + 1:b] = True
                sure[a:b] = False
                sure[a] = True
                if b < size:
                    sure[b] = True
        borders = np.flatnonzero(sure)
        cuts = self._cuts(data, inside)
        # of each chunk, the sure borders inside: the first, and the last
        low = np.searchsorted(borders, cuts[:-1], side="right").tolist()
        high = (np.searchsorted(borders, cuts[1:], side="left") - 1).tolist()
        borders = borders.tolist()
        out: list[int] = []
        window = 0  # where the window that is open at the last join begins
        places, pieces, chunks = self.places, self._pieces, self.chunks
        for a, b, i, j in zip(cuts, cuts[1:], low, high):
            if i >= j:  # no two agreeing borders: the window goes on
                continue
            # the window across the join in front, with sure borders inside it as they are
            first = borders[i]
            out += pieces(raw, window, first, borders)
            chunk = raw[a:b]
            place = chunks.get(chunk)
            if place is None:
                chunks[chunk] = place = self._place()
                self.size += len(chunk)
                cut = borders[i:j + 1]
                own = []
                for x, y in zip(cut, cut[1:]):
                    piece = raw[x:y]
                    at = places.get(piece)
                    own.append(self._new(piece) if at is None else at)
                fresh.append((place, own))
            else:
                self.reused += 1
            out.append(place)
            window = borders[j]
        out += pieces(raw, window, size, borders)
        return out

    def _new(self, piece: bytes) -> int:
        at = self.places[piece] = self._place()
        self.unknown.append((at, piece))
        self.size += len(piece)
        return at

    def _pieces(self, raw: bytes, begin: int, end: int, borders: list[int]) -> list[int]:
        """Places of the pieces between the sure borders from begin to end."""
        cut = [begin, *borders[bisect_right(borders, begin):bisect_left(borders, end)], end]
        out = []
        for x, y in zip(cut, cut[1:]):
            if x < y:
                at = self.places.get(raw[x:y])
                out.append(self._new(raw[x:y]) if at is None else at)
        return out

    def _gathered(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids behind `places` in a row, and where the ids of each run of `counts` end."""
        start, stop = np.array(self.start), np.array(self.stop)
        sizes = (stop - start)[places]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.array(self.ids, np.uint32)[
            np.repeat(start[places] - ends + sizes, sizes) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.cumsum(counts)]
        return ids, bounds

    def _append(self, ids, place: int) -> None:
        self.start[place] = len(self.ids)
        self.ids.extend(ids)
        self.stop[place] = len(self.ids)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column in a row, and where those of each text end."""
        if self.size > REMEMBERED_BYTES or len(self.ids) > REMEMBERED_IDS:
            self._forget()
        data, offsets = utf8(column)
        sequences, fresh = [], []
        self.unknown: list[tuple[int, bytes]] = []
        for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
            text = data[a:b]
            sequences.append(self._text(text.tobytes(), text, sure_borders(text), fresh))
        model, others = self.tokenizer.model.tokenize, []
        for place, piece in self.unknown:
            if _ONE_RUN.fullmatch(piece):
                # letters behind a blank at most: nothing is left to cut
                form = piece.decode("latin-1").translate(_FORM)
                self._append([t.id for t in model(form)], place)
            else:
                others.append((place, piece.decode()))
        for at in range(0, len(others), 20_000):
            some = others[at:at + 20_000]
            for (place, _), e in zip(some, self.tokenizer.encode_batch_fast(
                    [piece for _, piece in some], add_special_tokens=False)):
                self._append(e.ids, place)
        if fresh:
            counts = np.array([len(own) for _, own in fresh])
            ids, bounds = self._gathered(
                np.array([at for _, own in fresh for at in own], np.int64), counts)
            begin = len(self.ids)
            self.ids.frombytes(ids.astype(np.uint32).tobytes())
            for (place, _), a, b in zip(fresh, [0, *bounds.tolist()], bounds.tolist()):
                self.start[place], self.stop[place] = begin + a, begin + b
        counts = np.array([len(s) for s in sequences], np.int64)
        return self._gathered(np.array([at for s in sequences for at in s], np.int64), counts)


def _loaded(path: str):
    # one thread a task: Spark deals out the cores
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """row (all columns of `docs` but text, in a struct), n_tokens and ids of every document.

    ids are little-endian unsigned 32-bit numbers, without special tokens added, padding or
    truncation; a special token's string in a text is that token. `tokenizer` is the path,
    on all executors, of a byte-level BPE file (else ValueError). Null texts count as empty
    and have no ids. Repeated rows are returned each; a text of any length is worked through
    in parts. An empty table gives no rows.
    """
    vocabulary = Vocabulary(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_loaded(tokenizer), vocabulary.special)
        for batch in batches:
            for some in steps(batch, limit=LIMIT):
                found = [encoder.encode(p) for p in parts(some.column("text"), LIMIT, _before_blank)]
                if len(found) == 1:
                    ids, ends = found[0]
                else:  # one long text
                    ids = np.concatenate([x for x, _ in found])
                    ends = np.array([len(ids)])
                offsets = np.concatenate([[0], ends]) * 4
                column = pa.Array.from_buffers(pa.large_binary(), some.num_rows, [
                    None, pa.py_buffer(offsets.astype(np.int64)),
                    pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [some.column("row"), pa.array(np.diff(offsets) // 4),
                     column.cast(pa.binary())], ["row", "n_tokens", "ids"])

    rows = docs.select(
        "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    schema = rows.select("row").schema.add("n_tokens", "long").add("ids", "binary")
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The columns of `encoded` but ids, with text (the ids' bytes as UTF-8, broken
    characters replaced) and ids_sha256, the digest of the ids as decimals joined by commas.

    Null ids give an empty text; an id the tokenizer has not raises IndexError.
    """
    vocabulary = Vocabulary(tokenizer)
    kept = [c for c in encoded.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = vocabulary.token_bytes
        decimal = [b"%d" % i for i in range(len(token_bytes))]
        for batch in batches:
            for some in steps(batch, "ids", LIMIT):
                texts, digests = [], []
                for own in some.column("ids").to_pylist():
                    ids = np.frombuffer(own or b"", "<u4")
                    digest, text = sha256(), []
                    for at in range(0, len(ids), 1 << 16):
                        some_ids = ids[at:at + (1 << 16)].tolist()
                        if at:
                            digest.update(b",")
                        digest.update(b",".join([decimal[i] for i in some_ids]))
                        text.append(b"".join([token_bytes[i] for i in some_ids]))
                    texts.append(b"".join(text).decode(errors="replace"))
                    digests.append(digest.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in kept], pa.array(texts, pa.string()),
                     pa.array(digests, pa.string())], [*kept, "text", "ids_sha256"])

    schema = encoded.select(*kept).schema.add("text", "string").add("ids_sha256", "string")
    return encoded.mapInArrow(run, schema)
