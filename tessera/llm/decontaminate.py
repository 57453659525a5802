"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of 10 words (a shorter item is one
window), a window into shingles of 3 words. Shingles are ordered by rarity:
the number of documents they occur in, counted over the whole corpus. A
document that holds a window holds all of its shingles, so the prefix that must
be joined is the window's rarest shingle. Where a document has it, length and
place bounds say where the window would lie, and all its words are compared.

The windows go to the tasks in blocks of bounded, measured size; documents are
never shuffled. A larger benchmark takes more blocks, each a scan of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.rows import KEY, keyed
from tessera.llm.stage import prepare, tidied, written

WINDOW_WORDS, SHINGLE_WORDS = 10, 3
#: Windows sent to tasks at once, at most: about 12 MB.
BLOCK_WINDOWS = 100_000

_WINDOWS = "item_id long, wid long, words array<long>"
_SPANS = "k1 long, k2 long, n_hit long, spans array<struct<pos:long,n:long>>"
_HITS = "doc_id long, k1 long, k2 long, n_words long, starts array<int>, lengths array<int>, wids array<long>"


def _item_windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, wids, words = [], [], []
        for block in W.blocks(batch.column("text"), W.PLAIN_WORDS):
            names = batch.column("item_id").slice(block.lo, block.hi - block.lo).to_pylist()
            for i, name in enumerate(names):
                own = block.hashes[block.first[i] : block.first[i + 1]]
                size = min(window, len(own))
                if size:
                    for part in np.lib.stride_tricks.sliding_window_view(own, size):
                        ids.append(name)
                        wids.append(int((W.runs(part, size) ^ W.mix(np.uint64([size]))).view(np.int64)[0]))
                        words.append(part.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(wids, pa.int64()), pa.array(words, pa.list_(pa.int64()))], ["item_id", "wid", "words"])


def _among(values: np.ndarray, keys: np.ndarray, coarse: np.ndarray) -> np.ndarray:
    """Places of the values that are in sorted ``keys``; ``coarse`` tells most others apart by their top 20 bits."""
    at = np.flatnonzero(coarse[values >> np.uint64(44)])
    found = values[at]
    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    return at[keys[place] == found]


def _coarse(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[keys >> np.uint64(44)] = True
    return out


def _row_shingles(block: W.Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, row) of all shingles of ``size`` words within rows."""
    at, row = W.run_rows(block, size)
    return W.runs(block.hashes, size)[at] if len(at) else np.zeros(0, np.uint64), at, row


@tidied
def _occurrences(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """How many rows of each block of texts hold each of the sent shingles."""
    total: dict[int, int] = {}
    for batch in batches:
        for block in W.blocks(batch.column("text"), W.PLAIN_WORDS):
            for size, (keys, coarse) in sent.value.items():
                hashes, _, row = _row_shingles(block, size)
                at = _among(hashes, keys, coarse)
                if len(at):
                    pairs = np.unique(np.stack([hashes[at], row[at].astype(np.uint64)]), axis=1)
                    for key, n in zip(*(x.tolist() for x in np.unique(pairs[0], return_counts=True)), strict=True):
                        total[key] = total.get(key, 0) + n
    yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(total, np.uint64, len(total)).view(np.int64)),
                                      pa.array(list(total.values()), pa.int64())], ["shingle", "documents"])


class _Prefixes:
    """Windows of one length: their words, and by rarest shingle the windows that have it and where."""

    def __init__(self, words: np.ndarray, wids: np.ndarray, size: int, documents: dict[int, int]):
        each = np.stack([W.runs(words[:, i : i + size].reshape(-1), size)[::size] for i in range(words.shape[1] - size + 1)], axis=1)
        known = np.array(sorted(documents), np.uint64)
        counts = np.array([documents[k] for k in known.tolist()], np.int64)
        place = np.minimum(np.searchsorted(known, each), max(len(known) - 1, 0))
        rarity = np.where(known[place] == each, counts[place], 0) if len(known) else np.zeros(each.shape, np.int64)
        offset = rarity.argmin(axis=1)
        key = each[np.arange(len(each)), offset]
        order = np.argsort(key, kind="stable")
        self.size, self.words, self.wids = size, words[order], wids[order]
        self.key, self.offset = key[order], offset[order]
        self.coarse = _coarse(self.key)

    def hits(self, block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, row, window) of all occurrences in a block."""
        hashes, at, row = _row_shingles(block, self.size)
        found = _among(hashes, self.key, self.coarse) if len(hashes) else np.zeros(0, np.int64)
        lo, hi = (np.searchsorted(self.key, hashes[found], side) for side in ("left", "right"))
        n = hi - lo
        window = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        row, start = np.repeat(row[found], n), np.repeat(at[found], n) - self.offset[window]
        length = self.words.shape[1]
        fits = (start >= block.first[:-1][row]) & (start + length <= block.first[1:][row])
        start, row, window = start[fits], row[fits], window[fits]
        same = np.ones(len(start), bool)
        for i in range(length):
            same[same] = block.hashes[start[same] + i] == self.words[window[same], i]
        return start[same], row[same], window[same]


@tidied
def _scanned(batches: Iterator[pa.RecordBatch], sent, everything: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch.column("text"), W.PLAIN_WORDS):
            rows, part = block.hi - block.lo, batch.slice(block.lo, block.hi - block.lo)
            starts, lengths, wids = [[] for _ in range(rows)], [[] for _ in range(rows)], [[] for _ in range(rows)]
            for prefixes in sent.value:
                start, row, window = prefixes.hits(block)
                order = np.lexsort((start, row))
                start, row, window = start[order], row[order], window[order]
                for i in np.unique(row).tolist():
                    mine = slice(*np.searchsorted(row, [i, i + 1]))
                    places = np.unique(start[mine] - block.first[i])
                    starts[i] += places.tolist()
                    lengths[i] += [prefixes.words.shape[1]] * len(places)
                    wids[i] += np.unique(prefixes.wids[window[mine]]).tolist()
            out = pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(block.counts, pa.int64()),
                pa.array(starts, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32())), pa.array(wids, pa.list_(pa.int64())),
            ], ["doc_id", "k1", "k2", "n_words", "starts", "lengths", "wids"])
            yield out if everything else out.filter(pa.array([bool(x) for x in wids], pa.bool_()))


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences that touch or overlap as one span each, and the words they cover."""
    for batch in batches:
        spans, covered = [], []
        for starts, lengths in zip(batch.column("starts").to_pylist(), batch.column("lengths").to_pylist(), strict=True):
            done: list[list[int]] = []
            for start, n in sorted(zip(starts, lengths, strict=True)):
                if done and start <= done[-1][0] + done[-1][1]:
                    done[-1][1] = max(done[-1][1], start + n - done[-1][0])
                else:
                    done.append([start, n])
            spans.append([{"pos": a, "n": n} for a, n in done])
            covered.append(sum(n for _, n in done))
        yield pa.RecordBatch.from_arrays([batch.column("k1"), batch.column("k2"), pa.array(covered, pa.int64()),
                                          pa.array(spans, pa.list_(pa.struct([("pos", pa.int64()), ("n", pa.int64())])))], [*KEY, "n_hit", "spans"])


def _blocks(windows: DataFrame, most: int) -> tuple[DataFrame, int]:
    """The windows with a block number each; no block has more than ``most``."""
    n = windows.count()
    blocks = -(-n // most)
    while blocks > 1:
        numbered = windows.withColumn("block", F.pmod("wid", F.lit(blocks)))
        if numbered.groupBy("block").count().agg(F.max("count")).first()[0] <= most:
            return numbered, blocks
        blocks = blocks * 5 // 4 + 1
    return windows.withColumn("block", F.lit(0).cast("long")), blocks


def _windows(spark: SparkSession, items: DataFrame, item_col: str, item_text_col: str, window: int, most: int) -> tuple[DataFrame, DataFrame, int]:
    """(items of each window; the distinct windows, with a block number each; the number of blocks)."""
    named = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    made = written(spark, named.mapInArrow(partial(_item_windows, window=window), _WINDOWS), "item-windows")
    owners = made.where("item_id is not null").select("item_id", "wid").distinct()
    windows, blocks = _blocks(written(spark, made.select("wid", "words").dropDuplicates(["wid"]), "windows"), most)
    return owners, windows, blocks


def _block(spark: SparkSession, texts: DataFrame, windows: DataFrame, number: int, shingle: int):
    """A block of windows by their rarest shingle in ``texts``, sent to tasks."""
    block = windows.where(F.col("block") == number).select("wid", "words").toArrow().combine_chunks()
    wids, lengths = (np.asarray(x) for x in (block["wid"], pc.list_value_length(block["words"])))
    arrays = {}
    for n in np.unique(lengths).tolist():
        mine = pa.array(np.flatnonzero(lengths == n))
        flat = np.asarray(block["words"].take(mine).combine_chunks().flatten())
        arrays[n] = (flat.view(np.uint64).reshape(-1, n), wids[lengths == n])
    sizes: dict[int, list] = {}
    for n, (words, _) in arrays.items():
        k = min(shingle, n)
        sizes.setdefault(k, []).extend(W.runs(words[:, i : i + k].reshape(-1), k)[::k] for i in range(n - k + 1))
    wanted = {k: np.unique(np.concatenate(v)) for k, v in sizes.items()}
    asked = spark.sparkContext.broadcast({k: (v, _coarse(v)) for k, v in wanted.items()})
    counted = texts.mapInArrow(partial(_occurrences, sent=asked), "shingle long, documents long") if wanted else None
    documents = {r[0] & (1 << 64) - 1: r[1] for r in counted.groupBy("shingle").agg(F.sum("documents")).collect()} if wanted else {}
    return spark.sparkContext.broadcast([_Prefixes(words, wids, min(shingle, n), documents) for n, (words, wids) in sorted(arrays.items())])


@tidied
def _passed(batches: Iterator[pa.RecordBatch], sent, column: str) -> Iterator[pa.RecordBatch]:
    """The rows without any window, all columns as they are."""
    for batch in batches:
        clean = np.ones(batch.num_rows, bool)
        for block in W.blocks(batch.column(column), W.PLAIN_WORDS):
            for prefixes in sent.value:
                clean[block.lo + prefixes.hits(block)[1]] = False
        yield batch.filter(pa.array(clean))


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *,
          window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that ``contamination`` gives no hit, with their columns, from the scan itself: nothing is joined.

    Null and empty texts stay. A benchmark of several blocks takes a scan for each, every one over what the last left.
    """
    prepare(spark)
    _, windows, blocks = _windows(spark, items, item_col, item_text_col, window, block_windows)
    for b in range(blocks):
        if b:
            docs = written(spark, docs, "clean")
        sent = _block(spark, docs.select(F.col(text_col).cast("string").alias("text")), windows, b, shingle)
        docs = docs.mapInArrow(partial(_passed, sent=sent, column=text_col), docs.schema)
    return docs


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW_WORDS,
                  shingle: int = SHINGLE_WORDS, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """(doc_id, k1, k2, n_words, n_hit, spans, items) for every row of ``docs``.

    Words are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. spans lists the hit words as
    (first word, words), items the ids of the items with a window in the text. (k1, k2) name the row's id and text.

    Null and empty texts have no words, and items without words no windows. An item with a null id hits words but is
    not listed; items may repeat. Rows that repeat a doc_id stay separate. Other columns play no part.
    """
    prepare(spark)
    own = keyed(docs, id_col, text_col)
    owners, windows, blocks = _windows(spark, items, item_col, item_text_col, window, block_windows)
    scans = []
    for b in range(max(blocks, 1)):
        sent = _block(spark, own.select("text"), windows, b, shingle)
        scans.append(written(spark, own.mapInArrow(partial(_scanned, sent=sent, everything=b == 0), _HITS), "hits"))

    base = scans[0].select("doc_id", *KEY, "n_words")
    hit = reduce(DataFrame.unionByName, [s.where(F.size("wids") > 0).select(*KEY, "starts", "lengths", "wids").dropDuplicates(KEY) for s in scans])
    if len(scans) > 1:
        hit = hit.groupBy(*KEY).agg(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "lengths", "wids")))
    listed = hit.select(*KEY, F.explode("wids").alias("wid")).join(owners, "wid").groupBy(*KEY).agg(F.collect_set("item_id").alias("items"))
    joined = hit.select(*KEY, "starts", "lengths").mapInArrow(_united, _SPANS).join(listed, KEY, "left")
    out = base.join(joined, KEY, "left")
    return out.select("doc_id", *KEY, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "spans",
                      F.coalesce(F.array_sort("items"), F.array().cast("array<bigint>")).alias("items"))


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of what ``contamination`` returns."""
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
