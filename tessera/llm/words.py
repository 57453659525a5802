"""Words of whole texts as arrays: one pass over the UTF-8 bytes of an Arrow column, no Python per word.

A word is a run of bytes outside a separator class. Every word gets a 64-bit
hash (a random value per byte times a power of an odd base, summed and mixed),
so equal words have equal hashes wherever they stand; runs of words are hashed
from the word hashes. Nulls and empty texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are worked on in blocks of so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8
_WORD_BASE = 0xD1B54A32D192ED0B  # odd, 3 modulo 8


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (in a new array)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class _Powers:
    """base**0, base**1, ... modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.table = base, np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            out = np.full(max(n, 2 * len(self.table)), U64(self.base))
            out[0] = 1
            np.multiply.accumulate(out, out=out)
            self.table = out
        return self.table[:n]


_CHARS = _Powers(_BASE)
_WORDS = _Powers(_WORD_BASE)
_WORDS_BACK = _Powers(pow(_WORD_BASE, -1, 1 << 64))


class WordClass:
    """Which bytes belong to words, and the value of each byte (A-Z as a-z if ``lower``)."""

    def __init__(self, inside, lower: bool):
        self.inside = np.zeros(256, bool)
        self.inside[list(inside)] = True
        values = mix(np.arange(256, dtype=U64) * U64(0x2545F4914F6CDD1D)) | U64(1)
        if lower:
            values[65:91] = values[97:123]
        self.values = np.where(self.inside, values, U64(0))


_BLANKS = {0x20, *range(0x09, 0x0E)}
#: Runs of anything but blanks, upper and lower case alike.
LOWER_WORDS = WordClass(set(range(256)) - _BLANKS, lower=True)
#: Runs of anything but blanks, unchanged.
EXACT_WORDS = WordClass(set(range(256)) - _BLANKS, lower=False)
#: Runs of ASCII letters and digits and of all other characters beyond ASCII.
PLAIN_WORDS = WordClass({*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}, lower=True)


@dataclass
class Block:
    """Rows ``lo`` to ``hi`` of a column: bytes, words (first and past-last byte, hash) and each row's words."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # row i has the words first[i] to first[i + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("") if len(column) else pa.array([], pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last byte of each word; words end where rows end."""
    n = len(data)
    within = inside[data]
    begin, end = within.copy(), within.copy()
    begin[1:] &= ~within[:-1]
    end[:-1] &= ~within[1:]
    edges = offsets[:-1][offsets[:-1] < n]
    begin[edges] = within[edges]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] = within[last]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def split_block(lo: int, hi: int, data: np.ndarray, offsets: np.ndarray, words: WordClass) -> Block:
    starts, ends = word_spans(data, offsets, words.inside)
    if len(starts):
        at, n = int(starts[0]), len(data)
        place = np.arange(at, n, dtype=np.int64)
        place -= np.repeat(starts, np.diff(np.append(starts, n)))
        longest = int((ends - starts).max())
        np.minimum(place, longest - 1, out=place)
        values = words.values[data[at:]]
        values *= _CHARS.upto(longest)[place]
        hashes = mix(np.add.reduceat(values, starts - at))
    else:
        hashes = np.zeros(0, U64)
    return Block(lo, hi, data, offsets, starts, ends, hashes, np.searchsorted(starts, offsets))


def blocks(column, words: WordClass, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """All rows of a text column, in blocks."""
    data, offsets = utf8(column)
    for lo, hi in ranges(offsets, most):
        part = offsets[lo : hi + 1]
        yield split_block(lo, hi, data[part[0] : part[-1]], part - part[0], words)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, for every first word (rows aside)."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U64)
    total = np.zeros(n + 1, U64)
    np.cumsum(hashes * _WORDS.upto(n), out=total[1:])
    out = total[k:] - total[:-k]
    out *= _WORDS_BACK.upto(n)[: len(out)]
    return mix(out)


def spans(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the words from ``begin`` to before ``end``, for arrays of both."""
    total = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * _WORDS.upto(len(hashes)), out=total[1:])
    return mix((total[end] - total[begin]) * _WORDS_BACK.upto(len(hashes) + 1)[begin])


def run_rows(block: Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, rows) of the runs of ``k`` words that lie within one row."""
    n = np.maximum(block.counts - k + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return block.first[:-1][row] + within, row


def shingle_sets(block: Block, k: int) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct hashes of its ``k``-word shingles; all its words as one if it has fewer."""
    all_runs = runs(block.hashes, k)
    for i in range(len(block.first) - 1):
        a, b = int(block.first[i]), int(block.first[i + 1])
        if b - a >= k:
            yield np.unique(all_runs[a : b - k + 1])
        elif b > a:
            yield runs(block.hashes[a:b], b - a) ^ U64(b - a)
        else:
            yield np.zeros(0, U64)
