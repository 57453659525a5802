"""Sharding by a Feistel permutation of global row numbers.

All rows are numbered from 0 in id order. A keyed Feistel network permutes the
smallest even-bit range that holds all numbers; a result beyond the last row is
sent through again (cycle walking), which makes it a permutation of the row
numbers alone. Row g goes to shard ``p(g) % shards`` at slot ``p(g) // shards``:
counts differ by one at most, the shuffle is the same in every run, and shard
and slot of any row, and the row at any slot, can be computed without data.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.stage import prepare, written

SHARDS, SEED, ROUNDS = 16, 20240229, 6


class FeistelPermutation:
    """A permutation of 0 to n - 1 that needs no memory."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.low = np.uint64((1 << int(self.half)) - 1)
        self.keys = W.mix(np.arange(rounds, dtype=np.uint64) + np.uint64(seed % (1 << 64)))

    def _network(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.low
        for key in keys:
            left, right = right, left ^ (W.mix(right ^ key) & self.low)
        return right << self.half | left  # halves exchanged: with the keys in reverse order this undoes itself

    def _walked(self, x: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = self._network(x, keys)
        beyond = np.flatnonzero(out >= np.uint64(self.n))
        while len(beyond):
            out[beyond] = self._network(out[beyond], keys)
            beyond = beyond[out[beyond] >= np.uint64(self.n)]
        return out

    def forward(self, rows) -> np.ndarray:
        return self._walked(np.atleast_1d(rows).astype(np.uint64), self.keys).astype(np.int64)

    def backward(self, places) -> np.ndarray:
        return self._walked(np.atleast_1d(places).astype(np.uint64), self.keys[::-1]).astype(np.int64)


def locate(rows, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of rows by their global numbers, among ``n`` rows."""
    place = FeistelPermutation(n, seed).forward(rows)
    return place % shards, place // shards


def row_at(shard, slot, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Global number of the row at a slot of a shard, among ``n`` rows."""
    return FeistelPermutation(n, seed).backward(np.asarray(slot) * shards + np.asarray(shard))


def _placed(batches: Iterator[pa.RecordBatch], n: int, shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shard, slot = locate(np.asarray(batch.column("row")), n, shards, seed)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard.astype(np.int32)), pa.array(slot)], [*batch.schema.names, "shard", "slot"])


def numbered(spark: SparkSession, rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` (written) with their global number ``row`` by ``order``, and how many there are.

    Range partitions are sorted on their own; their sizes, a row per partition, give each one's first number.
    """
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(spark, sorted_.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "sorted")
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("base", before).select("part", "base")
    return parts.join(F.broadcast(sizes), "part").withColumn("row", F.col("base") + F.col("place")).drop("part", "place", "base"), parts.count()


def shard(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, row, shard, slot, grown_shard) for every row of ``docs``.

    Rows are numbered by id (nulls first), then by a hash of the text, so that repeated ids come in a fixed order;
    rows that repeat both are alike. size is the UTF-8 length of the text plus 1, text_crc32 its checksum; a null
    text has size 1 and the checksum of no bytes, as an empty one. The law is ``rows``; grown_shard is null, since
    another number of shards deals all rows anew. Other columns play no part.
    """
    prepare(spark)
    raw = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.xxhash64(raw).alias("digest"))
    rows, n = numbered(spark, rows, "doc_id", "digest")
    schema = "doc_id long, size long, text_crc32 long, row long, shard int, slot long"
    out = rows.select("doc_id", "size", "text_crc32", "row").mapInArrow(partial(_placed, n=n, shards=shards, seed=seed), schema)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "row", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
