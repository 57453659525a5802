"""Substring deduplication by level-wise doubling.

Level 1: in every window of 50 words the 25-word run with the least hash is its
anchor, so equal windows have equal anchors. Neighbouring windows of one anchor
are one *stretch*. Level 2: only stretches whose 25-word anchor occurs in two
documents or more are extended to twice that length. Equal stretches are
settled at once by their smallest document; of stretches that share an anchor
but differ, one document each is compared window by window. No candidates
survive that: a repeated window of 100 words consists of words that repeated
windows of 50 cover already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.rows import KEY, keyed
from tessera.llm.stage import prepare, written

WINDOW_WORDS = 50


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    out, span = x, 1
    while 2 * span <= width:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _stretches(block: W.Block, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, content hash, first word in its row, windows, row) of each stretch of a block."""
    half = window // 2
    at, row = W.run_rows(block, window)
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    anchor = _sliding_min(W.runs(block.hashes, half), window - half + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    first = at[begin]
    content = W.spans(block.hashes, first, first + count + window - 1) ^ W.mix(count.astype(np.uint64))
    return anchor[begin], content, first - block.first[:-1][row[begin]], count, row[begin]


def _listed(fields: dict[str, np.ndarray], row: np.ndarray, rows: int) -> pa.Array:
    """One list of structs per row, from values in row order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(ends), values)


_SURVEYED = "doc_id long, k1 long, k2 long, n_words long, words_sha256 string, stretches array<struct<anchor:long,content:long,pos:int,n:int>>"


def _surveyed(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text"), W.EXACT_WORDS):
            anchor, content, pos, n, row = _stretches(block, window)
            cut, rows = slice(block.lo, block.hi), block.hi - block.lo
            raw = block.data.tobytes()
            plain = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(block.offsets[:-1], block.offsets[1:], strict=True)]
            part = batch.slice(cut.start, rows)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(block.counts, pa.int64()), pa.array(plain, pa.string()),
                _listed({"anchor": anchor.view(np.int64), "content": content.view(np.int64), "pos": pos.astype(np.int32), "n": n.astype(np.int32)}, row, rows),
            ], ["doc_id", "k1", "k2", "n_words", "words_sha256", "stretches"])


_WINDOWS = "anchor long, content long, doc_id long, row long, pos int"


def _opened(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Every window of the stretches that are to be compared word by word."""
    for batch in batches:
        lists = batch.column("stretches")
        for block in W.blocks(batch.column("text"), W.EXACT_WORDS):
            part = lists.slice(block.lo, block.hi - block.lo)
            flat, sizes = part.flatten(), np.asarray(part.value_lengths().fill_null(0))
            if not len(flat):
                continue
            pos, n, anchor = (np.asarray(flat.field(i)).astype(np.int64) for i in range(3))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            each = np.repeat(np.arange(len(n)), n)
            place = pos[each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            owner = owner[each]
            content = W.runs(block.hashes, window)[block.first[:-1][owner] + place]
            named = batch.slice(block.lo, len(sizes))
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor[each]), pa.array(content.view(np.int64)), named.column("doc_id").take(pa.array(owner)),
                named.column("row").take(pa.array(owner)), pa.array(place.astype(np.int32)),
            ], ["anchor", "content", "doc_id", "row", "pos"])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Texts without the words that repeated windows cover: (row, n_removed, kept_text)."""
    for batch in batches:
        lists = batch.column("repeated")
        data, offsets = W.utf8(batch.column("text"))
        for lo, hi in W.ranges(offsets):
            spans = lists.slice(lo, hi - lo)
            pos, n = (np.asarray(spans.flatten().field(i)) for i in range(2))
            ends = np.cumsum(np.asarray(spans.value_lengths()))
            removed, texts = [], []
            for i, (begin, end) in enumerate(zip(offsets[lo:hi].tolist(), offsets[lo + 1 : hi + 1].tolist(), strict=True)):
                words = data[begin:end].tobytes().split()
                mine = slice(ends[i - 1] if i else 0, ends[i])
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, pos[mine], 1)
                np.add.at(edge, pos[mine] + n[mine] + window - 1, -1)
                covered = np.cumsum(edge)[:-1] > 0
                removed.append(int(covered.sum()))
                texts.append(b" ".join(w for w, c in zip(words, covered.tolist(), strict=True) if not c))
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(lo, hi - lo), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())],
                                             ["row", "n_removed", "kept_text"])


def substring_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, k1, k2, n_words, n_removed, words_sha256, kept_text) for every row of ``docs``.

    Words are cut at blanks (0x20, 0x09-0x0D). A word goes if it lies in a window of ``window`` words that also
    starts in a document with a smaller id; windows are those of the input. kept_text joins the kept words by one
    space where any word went and is null elsewhere (nothing changes there); words_sha256 is the digest of all words
    joined by one space. (k1, k2) name the row's id and text, see ``rows.keyed``.

    Null and empty texts have no words. Rows that repeat a doc_id are documents of the same id: they don't remove
    words from each other. A row with a null id removes nothing and loses nothing. Other columns play no part.
    """
    prepare(spark)
    own = keyed(docs, id_col, text_col)
    surveyed = own.mapInArrow(partial(_surveyed, window=window), _SURVEYED).withColumn("row", F.monotonically_increasing_id())
    surveyed = written(spark, surveyed, "surveyed")

    # level 1: anchors of half the length that occur in several documents
    stretches = surveyed.where("doc_id is not null").select("row", "doc_id", F.explode("stretches").alias("s")).select("row", "doc_id", "s.*")
    anchors = stretches.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi").select("anchor")
    anchors = written(spark, anchors, "anchors")  # written, so that a join with a very frequent key can be split
    alive = written(spark, stretches.join(anchors, "anchor"), "alive")

    # level 2: equal stretches first, then windows of the smallest document of each of several stretches
    equal = written(spark, alive.groupBy("anchor", "content").agg(F.min("doc_id").alias("least")), "equal")
    several = equal.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    alive = written(spark, alive.join(equal, ["anchor", "content"]), "alive")
    whole = alive.where("doc_id > least").select("row", "pos", "n")
    split = alive.where("doc_id = least").join(several, "anchor").select("row", "pos", "n", "anchor")
    split = split.groupBy("row").agg(F.collect_list(F.struct("pos", "n", "anchor")).alias("stretches"))
    rows = alive.select("row").distinct().join(split, "row", "left").join(surveyed.select("row", "doc_id", *KEY), "row")
    texts = own.select(*KEY, "text").dropDuplicates(KEY)
    texts = written(spark, rows.join(texts, KEY).select("row", "doc_id", "text", "stretches"), "texts")
    windows = texts.where("stretches is not null").mapInArrow(partial(_opened, window=window), _WINDOWS)
    windows = written(spark, windows, "windows")
    least = windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least <> most")
    least = written(spark, least, "least")
    single = windows.join(least, ["anchor", "content"]).where("doc_id > least").select("row", "pos", F.lit(1).alias("n"))

    repeated = whole.unionByName(single).groupBy("row").agg(F.collect_list(F.struct("pos", "n")).alias("repeated"))
    cut = texts.select("row", "text").join(repeated, "row").mapInArrow(partial(_cut, window=window), "row long, n_removed long, kept_text string")
    out = surveyed.drop("stretches").join(cut, "row", "left")
    return out.select("doc_id", *KEY, "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), "words_sha256", "kept_text")


def digests(deduped: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of what ``substring_dedup`` returns."""
    kept = F.when(F.col("kept_text").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept_text", 256))
    return deduped.select("doc_id", "n_words", "n_removed", kept.alias("kept_sha256"))
