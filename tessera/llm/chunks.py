"""Texts cut into chunks that tokenize on their own, each distinct chunk worked on once per block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tessera.llm import words as W

#: Bytes that end a character which may be white space beyond ASCII (after a lead byte other than C3 to DF).
_MAYBE_BLANK_ENDS = np.zeros(256, bool)
_MAYBE_BLANK_ENDS[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True


def after_blanks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row starts and the places where a space or line feed follows a character that is surely no white space."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        before = data[:-1]
        sure = (before > 0x20) & (before < 0x7F)
        far = before >= 0x80
        lead = np.zeros(n - 1, np.uint8)
        lead[1:] = data[:-2]
        sure |= far & (~_MAYBE_BLANK_ENDS[before] | ((lead >= 0xC3) & (lead <= 0xDF)))
        cut[1:n] = _BLANK[data[1:]] & sure
    cut[offsets] = True
    return np.flatnonzero(cut)


def distinct(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(number of its distinct chunk, for every chunk; the distinct chunks) of data cut at ``places``."""
    if len(places) < 2:
        return np.zeros(0, np.int64), []
    chunks = pa.Array.from_buffers(pa.large_binary(), len(places) - 1,
                                   [None, pa.py_buffer(np.ascontiguousarray(places, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = chunks.dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary.to_pylist()


def rejoined(values: list[bytes], numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all chunks in a row, and where each row's begin; row i has the chunks first[i] to first[i + 1]."""
    if not len(numbers):
        return np.zeros(0, np.uint8), np.zeros(len(first), np.int64)
    taken = pa.array(values, pa.large_binary()).take(pa.array(numbers))
    _, offsets, out = taken.buffers()
    offsets = np.frombuffer(offsets, np.int64)[taken.offset : taken.offset + len(taken) + 1]
    out = np.frombuffer(out, np.uint8) if out is not None and out.size else np.zeros(0, np.uint8)
    return out, offsets[first]


def binary_column(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of bytes as a column of ``kind`` (large_binary or large_string), cast to its ordinary form."""
    column = pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return column.cast(pa.binary() if kind == pa.large_binary() else pa.string())


class Remembered:
    """A bounded memory of results by chunk: two generations, the older one goes when the newer is full."""

    def __init__(self, most: int = 150_000):
        self.most, self.new, self.old = most, {}, {}

    def all(self, chunks: list[bytes], make) -> list[bytes]:
        """The result of each chunk; ``make`` gives those of a list of chunks that aren't known."""
        found = list(map(self.new.get, chunks))
        missing = [i for i, x in enumerate(found) if x is None]
        if not missing:
            return found
        old = self.old
        for i in missing:
            found[i] = old.get(chunks[i])
        unknown = [i for i in missing if found[i] is None]
        for i, x in zip(unknown, make([chunks[i] for i in unknown]) if unknown else [], strict=True):
            found[i] = x
        if len(self.new) >= self.most:
            self.new, self.old = {}, self.new
        self.new.update((chunks[i], found[i]) for i in missing)
        return found


def text_ranges(column, most: int = 4 * W.BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    data, offsets = W.utf8(column)
    return data, offsets, list(W.ranges(offsets, most))
