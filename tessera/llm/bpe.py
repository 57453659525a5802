"""BPE encoding and decoding with forced boundaries.

A token can't span two neighbouring bytes that no vocabulary token has side by
side, so a word is cut there: the fragments are encoded on their own, by the
merge ranks, and their ids concatenated. The fragments of many words are merged
side by side as arrays, one merge of each a round. White space and the
pre-tokenizer's word ends are boundaries anyway; distinct chunks, and distinct
words in them, are encoded once while they are remembered. Decoding is a lookup
in the token table.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import chunks as C
from tessera.llm import words as W
from tessera.llm.rows import KEY, keyed
from tessera.llm.stage import prepare, tidied


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


#: The word pattern of the pre-tokenizer for ASCII text in lower case.
_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


#: Texts are encoded in blocks of so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 4 * W.BLOCK_BYTES
#: Fragments up to so many symbols are merged side by side; longer ones keep their pairs in a heap.
_SHORT = 48
#: Chunks that are cut into words at a time, and symbols that are merged side by side (a longer word on its own).
_CHUNKS, _SYMBOLS = 8192, 1 << 16
#: Words of more symbols aren't remembered.
_KEPT_SYMBOLS = 64


def _merged_in_heap(parts: list[int], ranks: dict[int, int], results: list[int], size: int) -> list[int]:
    """The merged symbols of a long fragment in O(n log n): neighbours as a linked list, pairs in a heap by (rank, place)."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get(parts[i] * size + parts[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        # an entry is out of date if its left symbol is gone or the pair there is another by now
        if parts[i] < 0 or j >= n or ranks.get(parts[i] * size + parts[j]) != rank:
            continue
        parts[i] = results[rank]
        parts[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (found := ranks.get(parts[i] * size + parts[k])) is not None:
                heappush(heap, (found, i))
        if (h := before[i]) >= 0 and (found := ranks.get(parts[h] * size + parts[i])) is not None:
            heappush(heap, (found, h))
    return [p for p in parts if p >= 0]


class ForcedBoundaryBPE:
    """A byte-level BPE vocabulary file (word ends marked by a suffix) as an encoder and decoder."""

    def __init__(self, text: str):
        config = json.loads(text)
        model, pre = config["model"], config["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["byte_fallback"] or model["dropout"] or model["ignore_merges"] \
                or config["decoder"] or config["post_processor"] or pre[0]["pattern"] != {"Regex": _SPLIT}:
            raise ValueError("the vocabulary needs steps that this encoder doesn't have")
        # only the library's normalizer and pre-tokenizer are asked here: it needs no vocabulary for that
        self.library = Tokenizer.from_str(json.dumps(config | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []}))
        self.suffix = model["end_of_word_suffix"] or ""
        self.symbols = byte_symbols()
        self.byte_of = {c: b for b, c in enumerate(self.symbols)}
        vocabulary = model["vocab"]
        self.ids = vocabulary
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        #: The rank of a pair of ids a, b under a * size + b, and the id that the pair of a rank becomes.
        self.ranks = {vocabulary[a] * self.size + vocabulary[b]: i for i, (a, b) in enumerate(pairs)}
        self.results = [vocabulary[a + b] for a, b in pairs]
        # the same as arrays, by key and by rank
        self.pairs = np.sort(np.fromiter(self.ranks, np.int64, len(self.ranks)))
        self.pair_ranks = np.array([self.ranks[x] for x in self.pairs.tolist()], np.int64)
        self.result_ids = np.array(self.results, np.int64)
        #: Ids of single bytes, inside a word and as its end (-1: none).
        self.inner_ids, self.end_ids = (np.array([vocabulary.get(c + end, -1) for c in self.symbols], np.int64) for end in ("", self.suffix))
        self.byte_at = np.zeros(max(map(ord, self.symbols)) + 1, np.uint8)
        self.byte_at[list(map(ord, self.symbols))] = np.arange(256)
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.special_parts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        inside = np.zeros((256, 256), bool)
        for token in vocabulary:
            own = token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            raw = [self.byte_of[c] for c in own if c in self.byte_of]
            inside[raw[:-1], raw[1:]] = True
        #: Pairs of byte symbols that some token has side by side; between all others a cut is certain.
        self.together = inside
        self.inside = {self.symbols[a] + self.symbols[b] for a, b in np.argwhere(inside)}
        table = dict(self.special)
        table.update(vocabulary)
        strings = [b""] * (max(table.values()) + 1)
        for token, i in table.items():
            strings[i] = token.encode() + b" "
        #: Token strings by id, each with the blank that decoding puts between tokens.
        self.strings = pa.array(strings, pa.large_binary())
        self.known = C.Remembered(60_000)
        self.known_words = C.Remembered(60_000)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids; the number of ranks for pairs that don't merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], len(self.results))

    def merged(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Merge the fragments of ``ids`` that begin at ``places`` (and end at the next) in place, by rank: the lowest
        first, the leftmost of equals. Returns which places hold an id then."""
        stay = np.ones(len(ids), bool)
        size = np.diff(places)
        for f in np.flatnonzero(size > _SHORT).tolist():
            a, b = int(places[f]), int(places[f + 1])
            out = _merged_in_heap(ids[a:b].tolist(), self.ranks, self.results, self.size)
            ids[a : a + len(out)] = out
            stay[a + len(out) : b] = False
        short = (size > 1) & (size <= _SHORT)
        at = np.flatnonzero(np.repeat(short, size))
        if not len(at) or not self.results:
            return stay
        # what is left of the fragments that still merge: sizes, places, ids, ends, rank of each pair with the next
        size, value = size[short], ids[at]
        ends = np.zeros(len(at), bool)
        ends[np.cumsum(size) - 1] = True
        rank = np.full(len(at), len(self.results))
        inner = np.flatnonzero(~ends)
        rank[inner] = self._ranks_of(value[inner], value[inner + 1])
        while len(at):
            best = np.minimum.reduceat(rank << 32 | np.arange(len(at)), np.cumsum(size) - size)
            merging = best >> 32 < len(self.results)
            best = best[merging]
            i = best & 0xFFFFFFFF
            value[i] = self.result_ids[best >> 32]
            ends[i] = ends[i + 1]
            keep = np.repeat(merging, size)
            done = np.flatnonzero(~keep)
            ids[at[done]] = value[done]
            keep[i + 1] = False
            stay[at[i + 1]] = False
            size = size[merging] - 1
            i = (np.cumsum(keep) - 1)[i]
            at, value, ends, rank = at[keep], value[keep], ends[keep], rank[keep]
            rank[i] = len(self.results)
            again = i[~ends[i]]
            before = i[i > 0] - 1
            again = np.concatenate([again, before[~ends[before]]])
            rank[again] = self._ranks_of(value[again], value[again + 1])
        return stay

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Before which bytes a cut is certain."""
        cut = np.zeros(len(data), bool)
        cut[1:] = ~self.together[data[:-1], data[1:]]
        return cut

    def _bytes_of(self, words: list[str]) -> np.ndarray:
        return self.byte_at[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]

    def fragments_of(self, word: str) -> list[str]:
        """The word (byte symbols) cut at every certain boundary."""
        places = [0, *np.flatnonzero(self._cuts(self._bytes_of([word]))).tolist(), len(word)]
        return [word[a:b] for a, b in zip(places, places[1:])]

    def words_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word (byte symbols), as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        ends = np.cumsum([0, *map(len, words)])
        for lo, hi in W.ranges(ends, _SYMBOLS):
            data, end = self._bytes_of(words[lo:hi]), ends[lo + 1 : hi + 1] - ends[lo]
            ids, cut = self.inner_ids[data], self._cuts(data)
            ids[end - 1] = self.end_ids[data[end - 1]]
            if ids.min() < 0:
                raise KeyError("a byte that the vocabulary doesn't have")
            cut[0] = cut[end[:-1]] = True
            stay = self.merged(ids, np.append(np.flatnonzero(cut), len(data)))
            raw = ids[stay].astype("<u4").tobytes()
            at = [0, *(np.cumsum(stay)[end - 1] * 4).tolist()]
            out += [raw[a:b] for a, b in zip(at, at[1:])]
        return out

    def words_of(self, text: str) -> list[str]:
        if text.isascii():
            found = _ASCII_WORDS.findall(text.lower())
            return found if text.isprintable() else ["".join(self.symbols[b] for b in w.encode()) for w in found]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def words_in(self, chunk: bytes) -> list[str | int]:
        """The words of a run of characters without blanks inside; special tokens in it as their ids."""
        text = chunk.decode()
        if "<" not in text:
            return self.words_of(text.strip("\t\n\v\f\r "))
        found, at = [], 0
        for m in self.special_parts.finditer(text):
            found += [*self.words_of(text[at : m.start()].strip("\t\n\v\f\r ")), self.special[m[0]]]
            at = m.end()
        return found + self.words_of(text[at:].strip("\t\n\v\f\r "))

    def chunks_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk, as little-endian unsigned 32-bit numbers."""
        out: list[bytes] = []
        special = {i: struct.pack("<I", i) for i in self.special.values()}
        for lo in range(0, len(chunks), _CHUNKS):
            cut = [self.words_in(c) for c in chunks[lo : lo + _CHUNKS]]
            own = [w for w in dict.fromkeys(chain.from_iterable(cut)) if w not in special]
            kept, long = [w for w in own if len(w) <= _KEPT_SYMBOLS], [w for w in own if len(w) > _KEPT_SYMBOLS]
            ids = special | dict(zip(kept + long, self.known_words.all(kept, self.words_ids) + self.words_ids(long), strict=True))
            out += [b"".join([ids[w] for w in words]) for words in cut]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each row's begin) of rows of text."""
        starts, _ = W.word_spans(data, offsets, W.EXACT_WORDS.inside)
        numbers, chunks = C.distinct(data, np.append(starts, len(data)) if len(starts) else starts)
        raw, at = C.rejoined(self.known.all(chunks, self.chunks_ids), numbers, np.searchsorted(starts, offsets))
        return raw.view("<u4"), at // 4

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(UTF-8 of all tokens, each with a blank; where each row begins; where it ends)."""
        inner = self.strings.take(pa.array(ids.astype(np.int64)))
        if not len(ids):
            return np.zeros(0, np.uint8), np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
        _, at, data = inner.buffers()
        at = np.frombuffer(at, np.int64)[inner.offset : inner.offset + len(inner) + 1]
        begin, end = at[offsets[:-1]], at[offsets[1:]]
        return np.frombuffer(data, np.uint8), begin, np.where(end > begin, end - 1, end)


@lru_cache(maxsize=2)
def _codec(text: str) -> ForcedBoundaryBPE:
    return ForcedBoundaryBPE(text)


@tidied
def _round_trip(batches: Iterator[pa.RecordBatch], sent, decoded: bool, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    codec = _codec(sent.value)
    for batch in batches:
        data, offsets, parts = C.text_ranges(batch.column("text"), block_bytes)
        for lo, hi in parts:
            own = offsets[lo : hi + 1]
            ids, at = codec.encode(data[own[0] : own[-1]], own - own[0])
            part = batch.slice(lo, hi - lo)
            columns = [part.column("doc_id"), part.column("k1"), part.column("k2"), C.binary_column(ids.view(np.uint8), at * 4, pa.large_binary())]
            if decoded:
                text, begin, end = codec.decode(ids, at)
                raw = text.tobytes()
                columns.append(pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *KEY, "ids", "decoded"][: len(columns)])


def _decoded(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    codec = _codec(sent.value)
    for batch in batches:
        rows = [np.frombuffer(x or b"", "<u4") for x in batch.column("ids").to_pylist()]
        ids = np.concatenate([*rows, np.zeros(0, "<u4")])
        text, begin, end = codec.decode(ids, np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64))
        raw = text.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary()).cast(pa.string())],
                                         [*batch.schema.names, "decoded"])


def _vocabulary(spark: SparkSession, path: str):
    """The vocabulary file, read on the driver and sent to tasks (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, decoded: bool = False,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, k1, k2, ids[, decoded]) for every row of ``docs``.

    ids are the token ids of the whole text as little-endian unsigned 32-bit numbers, equal to those the tokenizers
    library gives without special tokens being added; strings of special tokens in the text are those tokens, as there.
    ``decoded`` adds the text decoded from the ids in the same pass. Null and empty texts have no ids (an empty value)
    and decode to an empty text. Rows stay as they are, repeated or with a null id; other columns play no part.
    Smaller blocks take less memory in the tasks and somewhat more time.
    """
    prepare(spark)
    fields = "doc_id long, k1 long, k2 long, ids binary" + ", decoded string" * decoded
    return keyed(docs, id_col, text_col).mapInArrow(partial(_round_trip, sent=_vocabulary(spark, path), decoded=decoded, block_bytes=block_bytes), fields)


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with the text that its column ids stands for, in a column decoded."""
    prepare(spark)
    own = encoded.drop("decoded")
    schema = ", ".join(f"`{n}` {t}" for n, t in own.dtypes) + ", decoded string"
    return own.mapInArrow(partial(_decoded, sent=_vocabulary(spark, path)), schema)


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what ``encode(..., decoded=True)`` returns."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
