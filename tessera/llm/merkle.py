"""A Merkle manifest of a dataset: hash trees of 16, kept as postorder append logs.

Every row is a leaf. The leaves of a source, in id order, make a tree; the roots
of the sources' trees, in name order, make the top tree, whose root stands for
the whole table. A tree is built by aligned builders: each takes 4096 leaves
that begin at a multiple of 4096 and writes its nodes in the order in which they
are completed (16 leaves, their parent, the next 16, ...), as one segment. The
roots of the segments are the leaves of the next tier. Where a node stands in
such a log follows from the sizes of the subtrees before it alone, so the
siblings of a proof are addressed without any pointer or search.

The hash is SHA-256 over the digests' hexadecimal text, joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.stage import prepare, written

FANOUT = 16
#: Levels that a builder adds; it takes FANOUT**TALL leaves at most, 128 KB of digests.
TALL = 3
SPAN = FANOUT**TALL
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    up = 0
    while leaves > 1:
        leaves, up = -(-leaves // FANOUT), up + 1
    return up


def position(level: int, index, leaves: int) -> np.ndarray:
    """Where the nodes ``index`` of a level stand in the postorder log of a tree of ``leaves`` leaves, from 0.

    Before a node stand all nodes below its last leaf's end, the earlier nodes of its level, and the higher nodes that
    were complete when its first leaf came.
    """
    index = np.asarray(index, np.int64)
    end = np.minimum((index + 1) * FANOUT**level, leaves)
    place = index.copy()
    for j in range(level):
        place += -(-end // FANOUT**j)
    higher = index // FANOUT
    while higher.any():
        place += higher
        higher = higher // FANOUT
    return place


def tamper(column: Column) -> Column:
    """Text whose letters A-Z are a-z."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _leaf(values: list[Column]) -> Column:
    """Digest of a row: every value as its length in UTF-8, a colon and itself; ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.unhex(F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)).cast("binary"), 256))


def _nth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each row's number within its tree's run of rows in this partition."""
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("tree").dictionary_encode()
        codes, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
        begin = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
        nth = np.arange(len(codes)) - np.repeat(begin, np.diff(np.append(begin, len(codes))))
        if names[codes[0]] == last:
            nth[: begin[1] if len(begin) > 1 else None] += seen
        last, seen = names[codes[-1]], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], [*batch.schema.names, "nth"])


def _numbered(spark: SparkSession, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the number of a row in its ``tree`` by ``order``; no tree is gathered in one task.

    Rows are dealt by ranges of (tree, order) and sorted. Only the first tree of a partition can have begun before it,
    so a row per partition says with which number that tree goes on.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"{n} {t}" for n, t in dealt.dtypes) + ", nth long"
    dealt = written(spark, dealt.mapInArrow(_nth, schema), "merkle-rows")
    sizes = dealt.groupBy("tree", "part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = sizes.withColumn("before", before).where("before > 0").select("tree", "part", "before")
    # a row per partition at most: far below the bound of a broadcast
    return dealt.join(F.broadcast(carried), ["tree", "part"], "left").withColumn("i", F.col("nth") + F.coalesce("before", F.lit(0))).drop("part", "nth", "before")


def _segment(key: tuple, rows: pa.Table) -> pa.Table:
    """The log of an aligned block of a tree's leaves."""
    tree, block = (k.as_py() for k in key)
    rows = rows.sort_by("i")
    n = rows.num_rows
    level = b"".join(rows.column("digest").to_pylist())
    up = TALL if block else height(n)
    sizes = [-(-n // FANOUT**k) for k in range(up + 1)]
    log = np.zeros((sum(sizes), 32), np.uint8)
    for k, size in enumerate(sizes):
        if k:
            text = level.hex().encode()
            step = 64 * FANOUT
            level = b"".join(sha256(text[a : a + step]).digest() for a in range(0, len(text), step))
        log[position(k, np.arange(size), n)] = np.frombuffer(level, np.uint8).reshape(size, 32)
    return pa.table({"tree": [tree], "block": [block], "n": [n], "nodes": [log.tobytes()]},
                    pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("nodes", pa.binary())]))


def _grown(spark: SparkSession, leaves: DataFrame) -> list[DataFrame]:
    """Segments (tree, block, n, nodes) of all trees, a table per tier; ``leaves`` has tree, i and digest."""
    tiers = []
    while True:
        blocks = leaves.select("tree", (F.col("i") / SPAN).cast("long").alias("block"), "i", "digest")
        tiers.append(written(spark, blocks.groupBy("tree", "block").applyInArrow(_segment, "tree string, block long, n long, nodes binary"), f"merkle-tier-{len(tiers)}"))
        open_ = tiers[-1].where(_goes_on())
        if open_.isEmpty():
            return tiers
        leaves = open_.select("tree", F.col("block").alias("i"), F.substring("nodes", -32, 32).alias("digest"))


def _goes_on() -> Column:
    """Whether a segment has a parent in the next tier: all but the only segment of a tree that isn't full."""
    return (F.col("block") > 0) | (F.col("n") == SPAN)


def _runs(n: int, block: int, nodes: bytes) -> list[tuple[list[str], int]]:
    """For every level of a segment below its root, the hexadecimal text of each run of siblings."""
    up = TALL if block else height(n)
    log, out = np.frombuffer(nodes, np.uint8).reshape(-1, 32), []
    for k in range(up):
        size = -(-n // FANOUT**k)
        text = log[position(k, np.arange(size), n)].tobytes().hex()
        out.append([text[a : a + 64 * FANOUT] for a in range(0, len(text), 64 * FANOUT)])
    return out


def _siblings(runs: list[list[str]], leaf: int) -> list[tuple[str, str]]:
    """(those before, those after) a leaf's node in its run, level by level."""
    out = []
    for level in runs:
        run, own = level[leaf // FANOUT], 64 * (leaf % FANOUT)
        out.append((run[:own], run[own + 64 :]))
        leaf //= FANOUT
    return out


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each leaf of a segment, its siblings up to the root of all: those in the segment, then ``above``."""
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    for batch in batches:
        for r in batch.to_pylist():
            runs, rows = _runs(r["n"], r["block"], r["nodes"]), range(r["n"])
            above = r["above"] or []
            paths = [[{"before": a, "after": b} for a, b in _siblings(runs, j)] + above for j in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * len(rows), pa.string()), pa.array([r["block"] * SPAN + j for j in rows], pa.int64()), pa.array(paths, kind)],
                                             ["tree", "i", "path"])


_PATH = "path array<struct<before: string, after: string>>"


def _above(spark: SparkSession, tiers: list[DataFrame], top: DataFrame) -> DataFrame:
    """The first tier with ``above``: the siblings from each segment's root up; ``top`` has tree and path of the trees' roots."""
    found = None
    for t, tier in reversed(list(enumerate(tiers))):
        first = tier.where(~_goes_on()).join(top.withColumnRenamed("path", "above"), "tree", "left")
        inner = tier.where(_goes_on())
        if found is not None:
            found = first.unionByName(inner.join(found.select("tree", F.col("i").alias("block"), F.col("path").alias("above")), ["tree", "block"]))
        else:
            found = first
        if t:
            found = found.select("tree", "block", "n", "nodes", "above").mapInArrow(_paths, f"tree string, i long, {_PATH}")
    return found


def fold(leaf: str, path) -> str:
    """The root that a leaf's digest and its siblings (before, after) give."""
    for before, after in path:
        leaf = sha256((before + leaf + after).encode()).hexdigest()
    return leaf


def _proved(key: tuple, leaves: pa.Table, segment: pa.Table, proofs: bool) -> pa.Table:
    """Proof, root folded from the changed (else own) leaf, and verdict for each leaf of a segment."""
    s = segment.to_pylist()[0]
    runs, above = _runs(s["n"], s["block"], s["nodes"]), [(x["before"], x["after"]) for x in s["above"] or []]
    digests, folded, paths = [], [], []
    for i, digest, changed in zip(leaves.column("i").to_pylist(), leaves.column("digest").to_pylist(), leaves.column("changed").to_pylist(), strict=True):
        path = _siblings(runs, i % SPAN) + above
        digests.append(sha256("".join(x for pair in path for x in pair).encode()).hexdigest())
        folded.append(fold((digest if changed is None else changed).hex(), path))
        if proofs:
            paths.append([{"before": a, "after": b} for a, b in path])
    n = leaves.num_rows
    columns = {"doc_id": leaves.column("doc_id"), "leaf": pa.array([x.hex() for x in leaves.column("digest").to_pylist()], pa.string()),
               "subroot": pa.array([s["subroot"]] * n, pa.string()), "root": pa.array([s["root"]] * n, pa.string()),
               "proof_sha256": pa.array(digests, pa.string()), "folded_root": pa.array(folded, pa.string()),
               "verified": pa.array([x == s["root"] for x in folded], pa.bool_())}
    if proofs:
        columns["proof"] = pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))
    return pa.table(columns)


@dataclass
class Manifest:
    """The trees of a table.

    ``leaves``: tree, i, doc_id, digest, changed; ``tiers``: segments of the sources' trees; ``subroots``: tree, i,
    digest; ``top``: segments of the top tree. A tree's name is ``s`` and its source; the null source's is empty.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, digest): the last node of each tree's last segment."""
    out = None
    for tier in tiers:
        own = tier.where(~_goes_on()).select("tree", F.substring("nodes", -32, 32).alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


def build(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> Manifest:
    """The manifest of ``docs``: a leaf per row, a tree per value of ``group_col``, the top tree.

    A leaf is the digest of ``fields``; in a tree leaves ascend by id (nulls first), rows that repeat an id by digest.
    Nulls in any field are told from empty texts; the null source has a tree of its own, which comes first. ``changed``
    is the leaf of a row whose id's crc32 5 divides, with the text's A-Z as a-z, where that is another one (proofs that
    must fail). Texts are read once and don't move; an empty table has no tree. Other columns play no part.
    """
    prepare(spark)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("group"), F.struct(*fields).alias("f"))
    values = [F.col(f"f.`{n}`") for n in fields]
    other = [tamper(v.cast("string")) if n == text_col else v for n, v in zip(fields, values, strict=True)]
    picked = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col(f"f.`{text_col}`").isNotNull()
    hashed = own.select(F.when(F.col("group").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), "group")).alias("tree"), "doc_id",
                        _leaf(values).alias("digest"), F.when(picked, _leaf(other)).alias("changed"))
    leaves = written(spark, _numbered(spark, written(spark, hashed, "merkle-leaves"), ["doc_id", "digest"]), "merkle-numbered")
    tiers = _grown(spark, leaves)
    named = _roots(tiers).select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = written(spark, _numbered(spark, written(spark, named, "merkle-roots"), ["name"]), "merkle-subroots")
    return Manifest(leaves, tiers, subroots.select(F.col("name").alias("tree"), "i", "digest"), _grown(spark, subroots))


def prove(spark: SparkSession, made: Manifest, *, proofs: bool = False) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified[, proof]) for every leaf.

    A proof holds the siblings at each level up to the root, before and after the own node (hexadecimal); proof_sha256
    is the digest of all of them, left to right and bottom up. folded_root is what the changed leaf, or else the own
    one, folds to; verified says whether that is the root.
    """
    none = made.top[0].where("false").select("tree", F.lit(None).cast("array<struct<before: string, after: string>>").alias("path"))
    top = _above(spark, made.top, none).select("tree", "block", "n", "nodes", "above").mapInArrow(_paths, f"tree string, i long, {_PATH}")
    root = _roots(made.top).first()  # a single row, none for an empty table
    root = F.lit(root.digest.hex() if root else None).cast("string").alias("root")
    top = written(spark, made.subroots.join(top.select("i", "path"), "i").select("tree", F.lower(F.hex("digest")).alias("subroot"), root, "path"), "merkle-top")
    segments = _above(spark, made.tiers, top.select("tree", "path")).join(top.select("tree", "subroot", "root"), "tree")
    blocks = made.leaves.withColumn("block", (F.col("i") / SPAN).cast("long"))
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if proofs:
        schema += ", proof array<struct<before: string, after: string>>"
    return blocks.groupBy("tree", "block").cogroup(segments.groupBy("tree", "block")).applyInArrow(lambda key, own, segment: _proved(key, own, segment, proofs), schema)


def _placed(batches: Iterator[pa.RecordBatch], tier: int) -> Iterator[pa.RecordBatch]:
    """The nodes of segments at their places in the log of the whole tree (the tier below has a segment's leaves)."""
    for batch in batches:
        for r in batch.to_pylist():
            n, log = r["n"], np.frombuffer(r["nodes"], np.uint8).reshape(-1, 32)
            up = TALL if r["block"] else height(n)
            for k in range(0 if tier == 0 else 1, up + 1):
                size = -(-n // FANOUT**k)
                index = r["block"] * FANOUT ** (TALL - k) + np.arange(size)
                own = [x.tobytes() for x in log[position(k, np.arange(size), n)]]
                level = TALL * tier + k
                yield pa.RecordBatch.from_arrays([pa.array([r["tree"]] * size, pa.string()), pa.array(position(level, index, r["leaves"])), pa.array([level] * size, pa.int32()), pa.array(index), pa.array(own, pa.binary())],
                                                 ["tree", "place", "level", "i", "digest"])


def postorder(made: Manifest) -> DataFrame:
    """(tree, place, level, i, digest): every node of the sources' trees at its place in its tree's log, gapless from 0."""
    sizes, out = made.leaves.groupBy("tree").agg(F.count("*").alias("leaves")), None
    for t, tier in enumerate(made.tiers):
        own = tier.join(sizes, "tree").mapInArrow(partial(_placed, tier=t), "tree string, place long, level int, i long, digest binary")
        out = own if out is None else out.unionByName(own)
    return out


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """What ``prove`` returns for the manifest of ``docs``."""
    return prove(spark, build(spark, docs))
