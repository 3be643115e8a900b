"""Fill-in-middle transformation as a pyarrow.compute pipeline.

A text is split into units, runs of letters A-Z or single other characters. Two cuts between
units, drawn from a hash of doc_id, part it into prefix, middle and suffix, which are put in
a new order behind sentinels. Per step of text: the units of all documents become a list
array, are flattened with the index of their document, get their ordinal there and by that
a role; each role's units are filtered, rebuilt into lists and joined to one piece per
document, and the pieces are joined with the sentinels. A long text goes through in parts,
whose pieces are joined at its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from chargelake.llm.common import steps, utf8
from chargelake.llm.longtext import LIMIT, binary, parts

# by bytes: a character is one byte below 0x80, or a leading byte and what continues it
_UNIT = r"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]*"
#: a byte that no text holds, behind every unit
_MARK = b"\xff"
_NOTHING = pa.scalar(b"", pa.large_binary())


@dataclass(frozen=True)
class Layout:
    """Sentinels, percentages and seed of the transformation."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    #: of a hundred documents, how many are transformed, and of a hundred of those, how many
    #: have the suffix first
    transformed: int = 90
    suffix_first: int = 20
    seed: str = "1"

    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _between_units(data: np.ndarray) -> np.ndarray:
    lower = data | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A)
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    return ~inside & (data & 0xC0 != 0x80)


def _units(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """All units in a row, the row of the column each is from, and its ordinal there; and
    the number of units of each row."""
    marked = pc.replace_substring_regex(column, pattern=f"({_UNIT})", replacement=b"\\1" + _MARK)
    lists = pc.split_pattern(marked, pattern=_MARK)
    # nothing follows the last mark of a text
    count = pc.list_value_length(lists).to_numpy().astype(np.int64) - 1
    parent = pc.list_parent_indices(lists).to_numpy()
    begins = np.cumsum(count + 1) - count - 1
    ordinal = np.arange(len(parent)) - begins[parent]
    real = pa.array(ordinal < count[parent])
    return (pc.filter(pc.list_flatten(lists), real), pc.filter(pa.array(parent), real).to_numpy(),
            pc.filter(pa.array(ordinal), real).to_numpy(), count)


def _joined(units: pa.Array, parent: np.ndarray, rows: int) -> pa.Array:
    """The units of each of `rows` rows, joined."""
    offsets = np.zeros(rows + 1, np.int64)
    np.cumsum(np.bincount(parent, minlength=rows), out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), units),
                          _NOTHING)


def _pieces(column: pa.Array, first: np.ndarray, second: np.ndarray, before: int = 0,
            split=None) -> list[pa.Array]:
    """Prefix, middle and suffix of each row, cut after `first` and `second` units."""
    units, parent, ordinal, _ = split or _units(column)
    ordinal = ordinal + before
    a, b = first[parent], second[parent]
    return [_joined(pc.filter(units, pa.array(role)), parent[role], len(column))
            for role in (ordinal < a, (ordinal >= a) & (ordinal < b), ordinal >= b)]


def _cut_points(h1: np.ndarray, h2: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, two = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(one, two), np.maximum(one, two)


def _split(column: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The number of units of each text, and its three pieces."""
    some = list(parts(column, LIMIT, _between_units))
    if len(some) == 1:
        split = _units(some[0])
        return split[3], _pieces(some[0], *_cut_points(h1, h2, split[3]), split=split)
    counts = [pc.count_substring_regex(part, pattern=_UNIT)[0].as_py() for part in some]
    n = np.array([sum(counts)], np.int64)
    cut = _cut_points(h1, h2, n)
    before = np.cumsum([0, *counts])
    found = [_pieces(part, *cut, before=int(at)) for part, at in zip(some, before)]
    together = np.zeros(len(some), np.int64)
    return n, [_joined(pa.concat_arrays(role), together, 1) for role in zip(*found)]


def _arranged(text: pa.Array, n: np.ndarray, h3: np.ndarray, h4: np.ndarray,
              pieces: list[pa.Array], layout: Layout) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Form and output of each text, and whether it is plain."""
    p, s, m = (pa.scalar(x.encode(), pa.large_binary()) for x in layout.sentinels())
    prefix, middle, suffix = pieces
    plain = pa.array((n == 0) | (h3 % 100 >= layout.transformed))
    for sentinel in layout.sentinels():
        plain = pc.or_(plain, pc.match_substring(text, pattern=sentinel))
    turned = pa.array(h4 % 100 < layout.suffix_first)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, _NOTHING)
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, _NOTHING)
    output = pc.if_else(plain, text, pc.if_else(turned, spm, psm))
    return pc.if_else(plain, "plain", pc.if_else(turned, "spm", "psm")), output, plain


def fill_in_middle(docs: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """row (all columns of `docs` but text, in a struct), n, form, prefix_chars, middle_chars
    and output of every document.

    n is the number of units, form "psm", "spm" or "plain" (the text as it is: empty, or
    with a sentinel in it, or left out by the hash); lengths are in characters, null if
    plain. Null texts count as empty, a null doc_id as ''. Repeated rows are transformed
    each, alike; texts of any length are worked through in parts, and an empty table gives
    no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in steps(batch, limit=LIMIT):
                data, offsets = utf8(some.column("text"))
                text = binary(data[offsets[0]:offsets[-1]], offsets - offsets[0])
                h1, h2, h3, h4 = (some.column(f"h{i}").to_numpy() for i in range(1, 5))
                n, pieces = _split(text, h1, h2)
                form, output, plain = _arranged(text, n, h3, h4, pieces, layout)
                chars = [pc.if_else(plain, None, pc.utf8_length(x.cast(pa.large_string()))
                                    .cast(pa.int64())) for x in pieces[:2]]
                yield pa.RecordBatch.from_arrays(
                    [some.column("row"), pa.array(n), form.cast(pa.string()), *chars,
                     output.cast(pa.large_string()).cast(pa.string())],
                    ["row", "n", "form", "prefix_chars", "middle_chars", "output"])

    digest = F.sha2(F.concat(F.lit(f"{layout.seed}:"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(
        "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
        *[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}")
          for i in range(4)])
    schema = rows.select("row").schema.add("n", "long").add("form", "string").add(
        "prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The text that a form and output were made of.

    Only sentinels end where the output parts: a transformed text holds none, and none can
    arise between a piece and a sentinel, as no sentinel's end begins another.
    """
    def halves(text: Column, sentinel: str) -> tuple[Column, Column]:
        head = F.substring_index(text, sentinel, 1)
        return head, F.substr(text, F.length(head) + len(sentinel) + 1)

    def ordered(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        one, rest = halves(body, second)
        return one, *halves(rest, layout.middle)

    prefix, suffix, middle = ordered(layout.prefix, layout.suffix)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = ordered(layout.suffix, layout.prefix)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
