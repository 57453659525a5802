"""Approximate nearest neighbours with an adaptive dimension scan.

Vectors are dealt to the lists of a coarse index (k-means centres fitted on a
bounded sample) and rotated by one random rotation, after which any few
columns estimate a whole distance. A query scans each probed list column block
by column block: the partial distance, scaled to all columns, is tested against
the tenth-best distance so far, and a candidate that is too far by more than
chance is abandoned. Survivors are measured on the original vectors.

Lists are cut into blocks of bounded size and so are the queries of a list, so
a list that holds a third of all vectors is many tasks' work.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.stage import prepare, written

#: The index is fitted on at most so many vectors (those with the smallest hash of their id).
SAMPLE = 20_000
#: Share of the lists that a query probes.
PROBE_SHARE = 0.75
#: Columns in a block, and how far beyond chance a candidate must be to be abandoned (2.1 is a chance of about 0.0001 each).
COLUMNS, EPSILON = 16, 2.1
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024


class Index:
    """Centres of the lists and the rotation."""

    def __init__(self, sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 11):
        rng = np.random.default_rng(seed)
        d = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        self.centres = sample[rng.permutation(len(sample))[:lists]].copy()
        for _ in range(rounds):
            near = self.lists_of(sample)
            total = np.zeros_like(self.centres)
            np.add.at(total, near, sample)
            n = np.bincount(near, minlength=len(self.centres))
            self.centres[n > 0] = total[n > 0] / n[n > 0, None]

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors**2).sum(axis=1)[:, None] - 2 * vectors @ self.centres.T + (self.centres**2).sum(axis=1)

    def lists_of(self, vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([self.distances(vectors[i : i + 4096]).argmin(axis=1) for i in range(0, len(vectors), 4096)])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), d)


def _raw(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _rows(vectors: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in vectors], pa.binary())


def _indexed(batches: Iterator[pa.RecordBatch], sent, d: int) -> Iterator[pa.RecordBatch]:
    index: Index = sent.value
    for batch in batches:
        vectors = _matrix(batch.column("embedding"), d)
        if len(vectors):
            yield pa.RecordBatch.from_arrays([pa.array(index.lists_of(vectors).astype(np.int32)), batch.column("vec_id"), _rows(vectors), _rows(vectors @ index.rotation)],
                                             ["list", "vec_id", "vector", "rotated"])


def _probes(batches: Iterator[pa.RecordBatch], sent, d: int, share: float, least: int) -> Iterator[pa.RecordBatch]:
    """For each query its nearest lists: the share of all, and more until they hold ``least`` vectors."""
    index, sizes = sent.value
    for batch in batches:
        vectors = _matrix(batch.column("embedding"), d)
        if not len(vectors):
            continue
        order = index.distances(vectors).argsort(axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1)
        count = np.maximum(int(np.ceil(share * len(sizes))), (held < least).sum(axis=1) + 1).clip(max=len(sizes))
        which = np.repeat(np.arange(len(vectors)), count)
        chosen = np.concatenate([row[:n] for row, n in zip(order, count, strict=True)]).astype(np.int32)
        raw, rotated = _rows(vectors), _rows(vectors @ index.rotation)
        take = pa.array(which)
        yield pa.RecordBatch.from_arrays([pa.array(chosen), batch.column("vec_id").take(take), raw.take(take), rotated.take(take)], ["list", "query_id", "vector", "rotated"])


def nearest_in_block(query: np.ndarray, rotated_query: np.ndarray, vectors: np.ndarray, rotated: np.ndarray, ids: np.ndarray, k: int,
                     columns: int = COLUMNS, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """(rows, distances) of a block's ``k`` nearest to a query, by distance and then id, as the scan finds them."""
    d, n = rotated.shape[1], len(vectors)
    alive, bound = np.arange(n), np.inf
    if n > 4 * k:  # a first few, measured in full, give the bound for the tests
        bound = np.partition(((vectors[: 4 * k] - query) ** 2).sum(axis=1), k - 1)[k - 1]
    partial_sum = np.zeros(n)
    for begin in range(0, d, columns):
        end = min(d, begin + columns)
        partial_sum += ((rotated[alive, begin:end] - rotated_query[begin:end]) ** 2).sum(axis=1)
        if end < d:
            keep = partial_sum <= bound * (end / d) * (1 + epsilon / np.sqrt(end)) ** 2 + 1e-12
            alive, partial_sum = alive[keep], partial_sum[keep]
            if len(alive) > k:  # distances are measured in full for the most promising, to tighten the bound
                best = alive[np.argpartition(partial_sum, k - 1)[:k]]
                bound = min(bound, ((vectors[best] - query) ** 2).sum(axis=1).max())
    distance = np.sqrt(((vectors[alive] - query) ** 2).sum(axis=1))
    order = np.lexsort((ids[alive], distance))[:k]
    return alive[order], distance[order]


def _scanned(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Nearest of one block of a list to one block of its queries."""
    out: list[tuple] = []
    if left.num_rows and right.num_rows:
        left, right = left.combine_chunks(), right.combine_chunks()
        vectors, rotated, ids = _raw(left["vector"]), _raw(left["rotated"]), np.asarray(left["vec_id"])
        for query_id, query, turned in zip(right["query_id"].to_pylist(), _raw(right["vector"]), _raw(right["rotated"]), strict=True):
            others = np.flatnonzero(ids != query_id)
            mine = (vectors, rotated, ids) if len(others) == len(ids) else (vectors[others], rotated[others], ids[others])
            rows, distances = nearest_in_block(query, turned, *mine, k)
            out += zip([query_id] * len(rows), mine[2][rows].tolist(), distances.tolist(), strict=True)
    return pa.Table.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part: of the most common length (the larger of equals)."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    own = own.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    common = own.groupBy(F.size("embedding").alias("d")).count().agg(F.max(F.struct("count", "d")).getField("d")).first()[0]
    return own.where(F.size("embedding") == F.lit(common or 0))


def search(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 10, every: int = 100,
           share: float = PROBE_SHARE, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every vector whose id is divisible by ``every``.

    score is the Euclidean distance of the original vectors in double precision; ties go to the smaller id, and the
    query's own id is no candidate. Vectors that are null, all zero, hold null or non-finite components, have a null id
    or another length than most take no part. Rows that repeat an id are candidates each; of several query rows of
    one id all are searched and the best ``k`` returned. Other columns play no part.
    """
    prepare(spark)
    own = written(spark, usable(vectors, id_col, vector_col), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = own.count()
    if not n:
        return empty
    share_of = min(1.0, sample / n)
    chosen = own.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)) < int(share_of * (1 << 40))).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    taken = chosen.toArrow().combine_chunks()
    d = own.select(F.size("embedding")).first()[0]
    fitted = _matrix(taken["embedding"].combine_chunks() if isinstance(taken["embedding"], pa.ChunkedArray) else taken["embedding"], d)
    if not len(fitted):
        fitted = _matrix(own.limit(1).toArrow()["embedding"].combine_chunks(), d)
    index = Index(fitted, max(1, min(round(n**0.5), len(fitted), sample // 16)))
    lists = written(spark, own.mapInArrow(partial(_indexed, sent=spark.sparkContext.broadcast(index), d=d), "list int, vec_id long, vector binary, rotated binary"), "lists")

    sizes = np.zeros(len(index.centres), np.int64)
    for r in lists.groupBy("list").count().collect():  # a row per list
        sizes[r[0]] = r[1]
    queries = own.where(F.col("vec_id") % every == 0)
    sent = spark.sparkContext.broadcast((index, sizes))
    probes = written(spark, queries.mapInArrow(partial(_probes, sent=sent, d=d, share=share, least=2 * k + 1), "list int, query_id long, vector binary, rotated binary"), "probes")
    asked = {r[0]: r[1] for r in probes.groupBy("list").count().collect()}
    cuts = [(i, int(-(-m // BLOCK_ROWS)), int(-(-asked.get(i, 0) // BLOCK_QUERIES))) for i, m in enumerate(sizes.tolist()) if m and asked.get(i)]
    if not cuts:
        return empty
    cuts = F.broadcast(spark.createDataFrame(cuts, "list int, row_blocks int, query_blocks int"))
    both = lists.join(cuts, "list").withColumn("row_block", F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")))
    both = both.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - F.lit(1).cast("long"))))
    asking = probes.join(cuts, "list").withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")))
    asking = asking.withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - F.lit(1).cast("long"))))
    key = ["list", "row_block", "query_block"]
    left = both.select(*key, "vec_id", "vector", "rotated").groupBy(*key)
    right = asking.select(*key, "query_id", "vector", "rotated").groupBy(*key)
    found = left.cogroup(right).applyInArrow(partial(_scanned, k=k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
