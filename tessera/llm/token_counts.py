"""Token counts by a whole-token shortcut.

A piece vocabulary marks blanks inside pieces. Where no piece has a blank after
another character, a text falls apart before every run of blanks, and the parts
(pre-tokens) are merged on their own. Which vocabulary strings encode alone as
one token is proved offline, each with the library; a pre-token that is such a
string counts one, by lookup. Only the others are merged, each distinct one once
while it is remembered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tessera.llm import words as W
from tessera.llm.stage import prepare

LIMIT = 4096
#: What the vocabulary has for a blank; as bytes it may also stand in a text, and then means the same.
BLANK = "▁"
_BLANK_BYTES = np.frombuffer(BLANK.encode(), np.uint8)
#: Pre-tokens longer than this aren't remembered.
_KEPT_BYTES = 64
_BPE, _NORMAL, _BYTE, _UNKNOWN, _CONTROL = 2, 1, 6, 2, 3


class Vocabulary:
    """A piece vocabulary (BPE with byte fallback) and its proved whole tokens."""

    def __init__(self, raw: bytes, proved: list[bytes] | None = None):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        if proved is None:
            proved = self._prove(raw)
        #: Strings, blanks in front, that encode alone as one token.
        self.whole = proved
        self.table = pa.array(proved, pa.large_binary())
        self.known: dict[bytes, int] = {}

    def _prove(self, raw: bytes) -> list[bytes]:
        model = model_pb2.ModelProto()
        model.ParseFromString(raw)
        rule, spec = model.normalizer_spec, model.trainer_spec
        if spec.model_type != _BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or rule.precompiled_charsmap or rule.remove_extra_whitespaces \
                or not rule.add_dummy_prefix or not rule.escape_whitespaces or any(p.type not in (_NORMAL, _BYTE, _UNKNOWN, _CONTROL) for p in model.pieces):
            raise ValueError("the vocabulary needs steps that this counter doesn't have")
        pieces = [p.piece for p in model.pieces if p.type == _NORMAL]
        if BLANK not in pieces or any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece has a blank after another character, or none is a blank alone: texts can't be cut there")
        # the library puts one blank in front of what it encodes; a blank alone is one symbol, and so one token
        texts = [p[1:].replace(BLANK, " ") for p in pieces if p.startswith(BLANK) and len(p) > 1]
        return [b" "] + [b" " + t.encode() for t, ids in zip(texts, self.library.encode(texts, num_threads=1), strict=True) if len(ids) == 1]

    def merged(self, parts: list[bytes]) -> list[int]:
        """The number of tokens of pre-tokens (which begin with a blank), merged by the library."""
        known = self.known
        new = [x for x in parts if x not in known]
        counts = dict(zip(new, map(len, self.library.encode([x[1:].decode() for x in new], num_threads=1)), strict=True))
        out = [counts[x] if x in counts else known[x] for x in parts]
        if len(known) > 200_000:
            known.clear()
        known.update((x, n) for x, n in counts.items() if len(x) <= _KEPT_BYTES)
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of each row of text."""
        rows = np.flatnonzero(np.diff(offsets))
        out = np.zeros(len(offsets) - 1, np.int64)
        if not len(rows):
            return out
        data = np.insert(data, offsets[:-1][rows], 0x20)  # the blank that the library puts in front
        first = offsets[:-1][rows] + np.arange(len(rows))
        if (data == _BLANK_BYTES[0]).any():
            data, first = _plain_blanks(data, first)
        blank = data == 0x20
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        cut[first] = True
        starts = np.flatnonzero(cut)
        parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        distinct = parts.dictionary
        number = np.ones(len(distinct), np.int64)
        rest = np.flatnonzero(np.asarray(pc.is_null(pc.index_in(distinct, self.table))))
        number[rest] = self.merged(distinct.take(pa.array(rest)).to_pylist())
        total = np.concatenate([[0], np.cumsum(number[np.asarray(parts.indices)])])
        at = np.searchsorted(starts, np.append(first, len(data)))
        out[rows] = total[at[1:]] - total[at[:-1]]
        return out


def _plain_blanks(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with the vocabulary's sign for a blank as a blank, and where rows begin then."""
    found = np.zeros(len(data), bool)
    found[: len(data) - 2] = (data[:-2] == _BLANK_BYTES[0]) & (data[1:-1] == _BLANK_BYTES[1]) & (data[2:] == _BLANK_BYTES[2])
    at = np.flatnonzero(found)
    data = data.copy()
    data[at] = 0x20
    stay = np.ones(len(data), bool)
    stay[at + 1] = stay[at + 2] = False
    return data[stay], first - 2 * np.searchsorted(at, first)


@lru_cache(maxsize=2)
def _vocabulary(raw: bytes, whole: tuple[bytes, ...]) -> Vocabulary:
    return Vocabulary(raw, list(whole))


def _counted(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    vocabulary = _vocabulary(*sent.value)
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        parts = [vocabulary.counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in W.ranges(offsets, 4 * W.BLOCK_BYTES)]
        n = np.concatenate([*parts, np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])


def count_tokens(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    n_tokens is the number of ids that the library gives for the whole text, without begin and end; strings of control
    tokens in a text are ordinary text, as there. Null and empty texts have 0 bytes and 0 tokens. Rows stay as they are,
    repeated or with a null id; other columns play no part. The vocabulary (a few MB) is proved on the driver and sent.
    """
    prepare(spark)
    with open(path, "rb") as file:
        raw = file.read()
    sent = spark.sparkContext.broadcast((raw, tuple(Vocabulary(raw).whole)))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(partial(_counted, sent=sent), "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
