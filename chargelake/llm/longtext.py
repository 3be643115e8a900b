"""Texts in parts of bounded size, so that one very long document is many small steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from chargelake.llm.common import utf8

#: bytes of text that one vectorised step looks at
LIMIT = 2 << 20
#: bytes looked through at a time for a place to cut
_LOOK = 1 << 16
#: bytes before a place that tell whether it may be cut
BEFORE = 3


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow column of byte strings on a buffer; offsets are 64-bit and begin at 0."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))])


def cuts(data: np.ndarray, limit: int, may_cut: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Borders of the parts of one text, 0 and its length included.

    `may_cut` says for each byte of a stretch whether the text may be cut before it, from
    that byte and up to BEFORE bytes in front. A part is at least `limit` long and ends at
    the first such place; without one it runs to the end.
    """
    borders, size = [0], len(data)
    while size - borders[-1] > limit:
        at = borders[-1] + limit
        while at < size:
            begin = max(at - BEFORE, 0)
            found = np.flatnonzero(may_cut(data[begin:at + _LOOK])[at - begin:])
            if len(found):
                at += int(found[0])
                break
            at += _LOOK
        borders.append(min(at, size))
    if borders[-1] < size or size == 0:
        borders.append(size)
    return borders


def parts(column: pa.Array, limit: int, may_cut: Callable[[np.ndarray], np.ndarray]
          ) -> Iterator[pa.Array]:
    """A column of texts as it is, or its only text, if that is long, in parts of one row each."""
    data, offsets = utf8(column)
    if len(column) != 1 or offsets[1] - offsets[0] <= 2 * limit:
        yield binary(data[offsets[0]:offsets[-1]], offsets - offsets[0])
        return
    text = data[offsets[0]:offsets[1]]
    borders = cuts(text, limit, may_cut)
    for a, b in zip(borders, borders[1:]):
        yield binary(text[a:b], np.array([0, b - a]))
