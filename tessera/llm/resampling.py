"""Importance resampling of documents towards a target's distribution of hashed words and word pairs.

A feature is a word or two neighbouring words joined by a blank; its bucket is
its crc32 modulo the number of buckets. A head vocabulary is broadcast: the most
frequent words with their CRC states, from which a pair's CRC goes on, and the
most frequent pairs with their buckets. Words and pairs of the tail, which the
head doesn't have, take their CRC directly from their bytes. Whichever way a
feature takes, its bucket is the same, and all of them feed the exact totals.

    1. the head: each block of texts names its most frequent words and pairs, the counts are summed
    2. totals of every bucket, in documents and target
    3. the mean gain of each document's features, its score and its rank
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.sharding import numbered
from tessera.llm.stage import prepare, written

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Bounds of what is broadcast: words and pairs of the head (all that come often enough for so many), and their bytes.
#: What is left out takes the direct way.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 8192, 32_768, 48
#: Words and pairs that a block of texts names for the head.
NAMED_WORDS, NAMED_PAIRS = 2048, 4096
#: A pair's CRC goes on by tables up to so many bytes, byte by byte beyond.
_STEPS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _shift() -> np.ndarray:
    """[n, byte of the state, its value]: what a CRC becomes when ``n`` bytes follow, those bytes' own CRC aside."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (one & np.uint32(1)))
    out = np.zeros((_STEPS + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_STEPS):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ one[out[n] & np.uint32(255)]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC of two byte strings one after the other, from the CRC of each and the second one's length (``_STEPS`` at most)."""
    t, out = _shift(), second.copy()
    for b in range(4):
        out ^= t[length, b, (first >> np.uint32(8 * b)) & np.uint32(255)]
    return out


class Head:
    """Frequent words with their CRC states, frequent pairs of them with their buckets."""

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int = BUCKETS):
        self.words, self.buckets = pa.array(words, pa.large_binary()), buckets
        self.states = np.array([zlib.crc32(w) for w in words], np.uint32)
        number = {w: i for i, w in enumerate(words)}
        cut = [p.split(b" ") for p in pairs]
        named = [(number[a] * len(words) + number[b], zlib.crc32(p) % buckets) for p, (a, b) in zip(pairs, cut, strict=True) if a in number and b in number]
        self.pairs = pa.array([k for k, _ in named], pa.int64())
        self.pair_buckets = np.array([b for _, b in named], np.int64)

    def features(self, block: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(buckets of all words, buckets of all pairs) of a block."""
        distinct, codes = block.distinct, block.codes
        head = np.asarray(pc.fill_null(pc.index_in(distinct, self.words), -1)).astype(np.int64)
        values = distinct.to_pylist()
        tail = np.flatnonzero(head < 0)
        crc = np.zeros(len(values), np.uint32)
        crc[head >= 0] = self.states[head[head >= 0]]
        crc[tail] = [zlib.crc32(values[i]) for i in tail.tolist()]
        length = np.diff(np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]) + 1
        a, b = codes[block.pairs], codes[block.pairs + 1]
        out = np.full(len(a), -1, np.int64)
        both = np.flatnonzero((head[a] >= 0) & (head[b] >= 0))
        known = np.asarray(pc.fill_null(pc.index_in(pa.array(head[a[both]] * len(self.words) + head[b[both]]), self.pairs), -1)).astype(np.int64)
        out[both[known >= 0]] = self.pair_buckets[known[known >= 0]]
        rest = np.flatnonzero(out < 0)
        blank = zlib.crc32(b" ")
        follow = np.array([zlib.crc32(v, blank) for v in values], np.uint32)
        long = length[b[rest]] > _STEPS
        short = rest[~long]
        out[short] = joined_crc(crc[a[short]], follow[b[short]], length[b[short]]) % np.uint32(self.buckets)
        for i in rest[long].tolist():
            out[i] = zlib.crc32(values[b[i]], zlib.crc32(b" ", int(crc[a[i]]))) % self.buckets
        return (crc % np.uint32(self.buckets)).astype(np.int64)[codes], out


class Texts:
    """Words of some rows: each one's number among the distinct ones, and where pairs within a row begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends = W.word_spans(data, offsets, W.PLAIN_WORDS.inside)
        packed = _LOWER[data[W.PLAIN_WORDS.inside[data]]]
        at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)]).dictionary_encode()
        self.distinct, self.codes = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        #: Row i has the words first[i] to first[i + 1].
        self.first = np.searchsorted(starts, offsets)
        last = np.zeros(len(starts) + 1, bool)
        last[self.first[1:]] = True
        self.pairs = np.flatnonzero(~last[1:]) if len(starts) else np.zeros(0, np.int64)


def _texts(column) -> Iterator[tuple[int, int, Texts]]:
    data, offsets = W.utf8(column)
    for lo, hi in W.ranges(offsets, 4 * W.BLOCK_BYTES):
        yield lo, hi, Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def _frequent(keys: np.ndarray, most: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` most frequent keys that come ``least`` times, and how often each comes."""
    found, n = np.unique(keys, return_counts=True)
    found, n = found[n >= least], n[n >= least]
    take = np.argsort(-n, kind="stable")[:most]
    return found[take], n[take]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, feature, n): frequent words and pairs of each block."""
    for batch in batches:
        for _, _, block in _texts(batch.column("text")):
            values, size = block.distinct.to_pylist(), max(1, len(block.distinct))
            codes, n = _frequent(block.codes, NAMED_WORDS, 1)
            keys, m = _frequent(block.codes[block.pairs] * size + block.codes[block.pairs + 1], NAMED_PAIRS, 2)
            words = [values[c] for c in codes.tolist()]
            pairs = [values[k // size] + b" " + values[k % size] for k in keys.tolist()]
            rows = [(False, w, c) for w, c in zip(words, n.tolist(), strict=True)] + [(True, p, c) for p, c in zip(pairs, m.tolist(), strict=True)]
            rows = [r for r in rows if len(r[1]) <= HEAD_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())], ["pair", "feature", "n"])


def head(spark: SparkSession, texts: DataFrame, buckets: int = BUCKETS) -> Head:
    """The head vocabulary of a column ``text``, read in whole. Which features are in it changes no result."""
    counts = texts.mapInArrow(_named, "pair boolean, feature binary, n long").groupBy("pair", "feature").agg(F.sum("n").alias("n"))
    counts = written(spark, counts, "resampling-named")

    # how many features have a count of about 2**(step / 8): some hundreds of rows say from which count on they fit
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = sorted(((r.pair, r.step, r.features) for r in counts.groupBy("pair", step.alias("step")).agg(F.count("*").alias("features")).collect()), reverse=True)

    def most(pair: bool, k: int) -> list[bytes]:
        least, room = 1 << 20, k
        for _, s, features in (x for x in steps if x[0] == pair):
            room -= features
            if room < 0:
                break
            least = s
        return sorted(bytes(r.feature) for r in counts.where((F.col("pair") == pair) & (step >= least)).select("feature").collect())

    return Head(most(False, HEAD_WORDS), most(True, HEAD_PAIRS), buckets)


def _totals(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """(target, bucket, n) of a task's rows."""
    vocabulary = sent.value
    total = np.zeros((2, vocabulary.buckets), np.int64)
    for batch in batches:
        target = np.asarray(batch.column("target").cast(pa.int8()))
        for side in (0, 1):
            for _, _, block in _texts(batch.column("text").filter(pa.array(target == side))):
                for found in vocabulary.features(block):
                    total[side] += np.bincount(found, minlength=vocabulary.buckets)
    side, bucket = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(side == 1), pa.array(bucket), pa.array(total[side, bucket])], ["target", "bucket", "n"])


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of B buckets, S and T being the sums of s and t."""
    n = len(source)
    s_all, t_all = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor(-1000 ln(-ln(u))), u from the digest of seed and id."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(batches: Iterator[pa.RecordBatch], sent, sent_gains, seed: int) -> Iterator[pa.RecordBatch]:
    vocabulary, gain = sent.value, sent_gains.value
    for batch in batches:
        n_words, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for lo, hi, block in _texts(batch.column("text")):
            words, pairs = vocabulary.features(block)
            n_words[lo:hi] = np.diff(block.first)
            for at, found in ((block.first, words), (np.searchsorted(block.pairs, block.first), pairs)):
                total = np.concatenate([[0], np.cumsum(gain[found])])
                sums[lo:hi] += total[at[1:]] - total[at[:-1]]
        n = np.maximum(2 * n_words - 1, 0)
        weight = np.where(n > 0, sums // np.maximum(n, 1), 0)
        score = weight + np.array([noise(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), pa.array(n), pa.array(weight), pa.array(score)], ["doc_id", "n_words", "n_features", "weight", "score"])


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", *,
             buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``.

    weight is the mean gain of the row's features, floored (0 without features); score adds the row's noise, which
    depends on seed and id alone. Of the N rows with ``least_words`` words, floor(percent N / 100) are drawn, highest
    score first, ties to the smaller id; rank counts them from 1 and is null for the others. Null and empty texts have
    no features. A null id has the noise of an empty name and comes before other ids at a tie; rows that repeat an
    id have the same noise, and at a tie come by features and weight. An empty target gives every bucket t = 0. Other columns play no part.
    """
    prepare(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    both = own.select(F.lit(False).alias("target"), "text").unionByName(target.select(F.lit(True).alias("target"), F.col(target_text_col).cast("string").alias("text"))).where("text is not null")
    vocabulary = spark.sparkContext.broadcast(head(spark, both.select("text"), buckets))
    counts = both.mapInArrow(partial(_totals, sent=vocabulary), "target boolean, bucket long, n long").groupBy("target", "bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros((2, buckets), np.int64)
    for r in counts.collect():  # two rows a bucket at most
        totals[int(r.target), r.bucket] = r.n
    gain = spark.sparkContext.broadcast(gains(totals[0], totals[1]))
    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    weighed = written(spark, own.mapInArrow(partial(_weighed, sent=vocabulary, sent_gains=gain, seed=seed), schema), "resampling-weights")
    rows, n = numbered(spark, weighed.where(F.col("n_words") >= least_words).withColumn("order", -F.col("score")), "order", "doc_id", "n_features", "weight")
    rank = F.when(F.col("row") < percent * n // 100, F.col("row") + 1).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return rows.select(*columns, rank).unionByName(weighed.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))
