"""MinHash near-duplicate detection with circulant permutations.

Two permutations make all signature coordinates: sigma scatters a shingle over
a ring of 2**32 places, pi values the places, and coordinate k is the least
value of pi over the set when the ring is shifted by k. Coordinates are cut
into bands; documents that agree on a band are candidates, and a link counts
only after an exact comparison of the two full shingle sets.

Equal sets are one *class* and are compared once. In each band bucket the class
that shares most with the others is the hub and is compared first; classes of a
bucket that are still in different components are then joined by the rarest of
their shingles (an exact prefix filter on the full sets), so no link between
different components is left out and no group is compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import rows as rows_of
from tessera.llm import words as W
from tessera.llm.components import components
from tessera.llm.stage import matched, prepare, tidied, written

SHINGLE_WORDS = 5
#: 32 bands of 4: a pair of similarity 0.75 shares none with a chance of 0.000006.
BANDS, ROWS = 32, 4
#: Share of equal coordinates below which a candidate pair is not compared: 6.5 standard errors under 0.75.
LEAST_AGREEMENT = 0.5

_SIGNED = "doc_id long, k1 long, k2 long, node long, node2 long, n_shingles long, sketch binary, bands array<long>"


def _pi(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, a bijection of 32-bit numbers, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 0)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)
    return x


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` circulant MinHash coordinates of a set of 64-bit shingle hashes (not empty)."""
    places = (W.mix(shingles ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)  # sigma
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(places), 512):
        ring = places[None, i : i + 512] - shifts
        np.minimum(least, _pi(ring, np.empty_like(ring)).min(axis=1), out=least)
    return least


def set_id(shingles: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit numbers that name a shingle set."""
    a = W.mix(shingles).sum(dtype=np.uint64)
    b = W.mix(shingles ^ np.uint64(0x8EBC6AF09C88C6E3)).sum(dtype=np.uint64)
    return int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64)))


@tidied
def _signed(batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    weights = W.mix(np.arange(rows, dtype=np.uint64)) | np.uint64(1)
    salts = W.mix(np.arange(bands, dtype=np.uint64) + np.uint64(1 << 40))
    for batch in batches:
        at = 0
        for block in W.blocks(batch.column("text"), W.LOWER_WORDS):
            ids, sizes, signs, full = [], [], [], []
            for shingles in W.shingle_sets(block, k):
                sizes.append(len(shingles))
                full.append(len(shingles) > 0)
                ids.append(set_id(shingles) if len(shingles) else (None, None))
                if len(shingles):
                    signs.append(signature(shingles, bands * rows))
            got = np.array(signs, np.uint32).reshape(-1, bands, rows)
            keys = W.mix((got.astype(np.uint64) * weights).sum(axis=2, dtype=np.uint64) + salts).view(np.int64)
            sketch = iter(got.reshape(-1, bands * rows).astype(np.uint8))
            band = iter(keys)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c).slice(at, len(sizes)) for c in ("doc_id", "k1", "k2")),
                pa.array([a for a, _ in ids], pa.int64()), pa.array([b for _, b in ids], pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array([next(sketch).tobytes() if f else None for f in full], pa.binary()),
                pa.array([next(band) if f else None for f in full], pa.list_(pa.int64())),
            ], ["doc_id", "k1", "k2", "node", "node2", "n_shingles", "sketch", "bands"])
            at += len(sizes)


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches agree on enough coordinates."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
        agree = (a == b).mean(axis=1) >= least
        yield batch.select([0, 1]).filter(pa.array(agree))


@tidied
def _compared(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets, made again from the texts, are similar enough."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        left = (x for block in W.blocks(batch.column(2), W.LOWER_WORDS) for x in W.shingle_sets(block, k))
        right = (x for block in W.blocks(batch.column(3), W.LOWER_WORDS) for x in W.shingle_sets(block, k))
        for i, (a, b) in enumerate(zip(left, right, strict=True)):
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep[i] = 100 * common >= percent * (len(a) + len(b) - common)
        yield batch.select([0, 1]).filter(pa.array(keep))


@tidied
def _named(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Texts with the class their words make; rows that only share the key of its representative go."""
    for batch in batches:
        ids = [set_id(x) if len(x) else (None, None) for block in W.blocks(batch.column(1), W.LOWER_WORDS) for x in W.shingle_sets(block, k)]
        same = np.array([a == b for (a, _), b in zip(ids, batch.column(0).to_pylist(), strict=True)], bool)
        yield batch.filter(pa.array(same, pa.bool_()))


@tidied
def _exploded(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each class."""
    for batch in batches:
        for block in W.blocks(batch.column("text"), W.LOWER_WORDS):
            sets = list(W.shingle_sets(block, k))
            nodes = np.repeat(np.asarray(batch.column("node").slice(block.lo, len(sets))), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(sets).view(np.int64))], ["node", "shingle"])


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, keyed: bool = False,
                    percent: int = 75, k: int = SHINGLE_WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``; with ``keyed`` also (k1, k2), see ``rows``, and ``survives``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their
    distinct ``k``-word shingles (words lower-cased for A-Z, cut at blanks; a
    text of fewer words is one shingle). component_id is the smallest doc_id that
    links reach, the row's own included; ``kept`` marks the rows that carry it.

    A null or empty text has no shingles, is linked with nothing and is kept.
    Rows of equal texts are linked; rows that repeat a doc_id stay separate rows.
    A null doc_id can be linked but names no component unless no other is there:
    then component_id is null and the row is kept. Other columns play no part.

    ``survives`` marks one key (k1, k2) of each component, by doc_id (null ids last) and key, and all rows without
    shingles: unlike ``kept`` it tells rows apart that repeat an id, or have none.
    """
    prepare(spark)
    own = rows_of.keyed(docs, id_col, text_col)
    signed = written(spark, own.mapInArrow(partial(_signed, k=k, bands=bands, rows=rows), _SIGNED), "signed")
    classes = written(spark, signed.where("node is not null").groupBy("node", "node2", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(*rows_of.KEY)).alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *rows_of.KEY)).alias("survivor"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "classes")

    # buckets of two classes or more, each with its hub: the class that meets most others in all its buckets
    spread = classes.select("node", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    spread = written(spark, spread.join(shared, "bucket"), "buckets")
    weight = spread.groupBy("node").agg(F.sum("members").alias("weight"))
    spread = spread.join(weight, "node")
    hubs = spread.groupBy("bucket").agg(F.max(F.struct("weight", "node")).getField("node").alias("hub"))
    met = spread.select("bucket", "node").join(hubs, "bucket")
    sketches = classes.select("node", "n_shingles", "sketch")
    stars = _candidates(met.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(),
                        sketches, percent)
    stars = written(spark, stars, "stars")

    # the texts of all classes that share a bucket, once: that of the row with the smallest key, for an id can be null
    members = written(spark, classes.join(spread.select("node").distinct(), "node", "left_semi").select("node", "rep.*"), "members")
    texts = matched(own.select("text", *rows_of.KEY), members, rows_of.KEY).select("node", "text")
    texts = written(spark, texts.mapInArrow(partial(_named, k=k), "node long, text string").dropDuplicates(["node"]), "texts")
    linked = written(spark, _links(stars, texts, k, percent), "linked")

    # what hubs did not decide: classes of one bucket in different components
    root = components(spark, linked)
    placed = spread.select("bucket", "node").join(root, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("bucket")
    open_ = written(spark, placed.join(mixed, "bucket", "left_semi").select("node", "root").distinct(), "open")
    owned = open_.select("node").join(texts, "node").mapInArrow(partial(_exploded, k=k), "node long, shingle long")
    rest = _crossing(spark, written(spark, owned, "owned"), open_.join(sketches.select("node", "n_shingles"), "node"), percent).join(stars, ["a", "b"], "left_anti")
    rest = written(spark, _candidates(rest, sketches, percent), "rest")
    more = written(spark, _links(rest, texts, k, percent), "linked")

    root = components(spark, linked.unionByName(more))
    found = classes.select("node", "node2", "n_shingles", "doc_id", "survivor").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = found.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min("survivor").alias("survivor"))
    found = found.drop("survivor").join(least, "root").select("node", "node2", "n_shingles", "component_id", "survivor")
    out = signed.select("doc_id", *rows_of.KEY, "node", "node2", "n_shingles").join(found, ["node", "node2", "n_shingles"], "left")
    out = out.withColumn("component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    survives = F.col("node").isNull() | ((F.col("k1") == F.col("survivor.k1")) & (F.col("k2") == F.col("survivor.k2")))
    return out.select("doc_id", *rows_of.KEY * keyed, "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), *[survives.alias("survives")] * keyed)


def _crossing(spark: SparkSession, owned: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ``nodes`` in different components whose sets (``owned``) may be similar enough: a prefix-filtered set join.

    With shingles in order of rarity, sets of n and m shingles that share ``s = percent * (n + m) / (100 + percent)``
    share one of the first n - s + 1 and m - s + 1. Prefixes are cut for each class of partner sizes (powers of 1.1),
    and a match must leave room for the rest. A shingle's classes of its most frequent component meet only the others.
    """
    several = owned.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    by_node = Window.partitionBy("node")
    ranked = owned.join(several, "shingle").withColumn("rank", F.row_number().over(by_node.orderBy("df", "shingle"))).withColumn("known", F.count("*").over(by_node))
    ranked = ranked.select("node", "shingle", "rank", "known").join(nodes, "node").withColumn("pos", F.expr("n_shingles - known + rank"))
    size_class = "cast(floor(ln({}) / ln(1.1)) as int)"
    smallest, largest = f"greatest(ceil({percent} * n_shingles / 100D), 1)", f"floor(100D * n_shingles / {percent})"
    needed = f"ceil({percent} * (n_shingles + greatest(floor(pow(1.1D, c) * 0.999999), {smallest})) / {100 + percent}D - 0.000001)"
    partners = f"filter(sequence({size_class.format(smallest)}, {size_class.format(largest)}), c -> pos <= n_shingles - {needed} + 1)"
    posted = ranked.withColumn("own", F.expr(size_class.format("n_shingles"))).withColumn("partner", F.explode(F.expr(partners)))
    posted = posted.select("shingle", F.least("own", "partner").alias("c1"), F.greatest("own", "partner").alias("c2"), "node", "root", "n_shingles", "pos")
    posted = written(spark, posted, "posted")
    key = ["shingle", "c1", "c2"]
    main = posted.groupBy(*key, "root").agg(F.count("*").alias("n")).groupBy(*key).agg(F.max(F.struct("n", "root")).getField("root").alias("main"), F.count("*").alias("roots"))
    posted = posted.join(main.where("roots > 1").drop("roots"), key)
    x, y = posted.where("root <> main").alias("x"), posted.alias("y")
    both = F.col("x.n_shingles") + F.col("y.n_shingles")
    room = 1 + F.least(F.col("x.n_shingles") - F.col("x.pos"), F.col("y.n_shingles") - F.col("y.pos"))
    met = x.join(y, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in key] + [F.col("x.root") != F.col("y.root"), (100 + percent) * room >= percent * both])
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _candidates(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sizes and sketches allow to be similar."""
    left = sketches.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return both.select("a", "b", "sa", "sb").mapInArrow(partial(_likely, least=LEAST_AGREEMENT), "a long, b long")


def _links(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(partial(_compared, k=k, percent=percent), "a long, b long")
