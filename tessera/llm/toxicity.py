"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear (logistic) models over
the byte 5-grams of the whole text: whether a gram occurs, and whether it
occurs at some rate, for a sign may be a gram that any text has now and then.
Each model also gets the probabilities of the categories before it. To train
it, those probabilities are predicted out of fold, by features that were
chosen without the fold's labels, so the later model sees them as they will be
for new texts. Features are chosen in steps: each takes those that tell most
about what the ones before leave unexplained (out of fold), so the signs of one
language don't keep out those of another. Spark writes once which texts of the sample have each feature; only texts' numbers
under chosen features come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.language_id import _grams
from tessera.llm.stage import prepare, written

#: (category, label column, value that means yes), in chain order.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
#: Bounds of the fit: labelled documents (those with the smallest hash of their id), texts of them, and features a category.
SAMPLE, FEATURES = 10_000, 600
#: Features are chosen in so many steps; each occurs in so many texts at least.
STEPS, SUPPORT = 5, 3
#: A gram that occurs twice or more is a feature also for each of these rates (once in so many bytes) that it reaches.
RATES = (2048, 1024, 512, 256, 128)
#: The ridge penalty weighs as much as so many texts.
RIDGE_TEXTS = 0.5
GRAM_BYTES, FOLDS, ROUNDS = 5, 5, 400
#: Rounds of the fits whose residuals choose features.
DRAFT_ROUNDS = 100
_GRAM = np.uint64((1 << 8 * GRAM_BYTES) - 1)


def _features(data: np.ndarray, offsets: np.ndarray, known: tuple | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the features of each row; with ``known`` only those, as their numbers.

    A feature is a gram (it occurs) or a gram with the number of a rate above its bytes (it occurs that often).
    """
    grams = _grams(data, offsets, GRAM_BYTES - 1)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    if known is not None:
        at = np.flatnonzero(known[1][W.mix(grams) >> np.uint64(44)])
        row, grams = row[at], grams[at]
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    first = np.flatnonzero(new)
    times, row, grams = np.diff(np.append(first, len(row))), row[first], grams[first]
    often = np.flatnonzero(times >= 2)
    rows, features = [row], [grams]
    for i, rate in enumerate(RATES, 1):
        often = often[times[often] * rate >= np.diff(offsets)[row[often]]]
        rows.append(row[often])
        features.append(grams[often] | np.uint64(i << 8 * GRAM_BYTES))
    row, feature = np.concatenate(rows), np.concatenate(features)
    if known is None:
        return row, feature
    place = np.minimum(np.searchsorted(known[0], feature), len(known[0]) - 1)
    hit = known[0][place] == feature
    return row[hit], place[hit]


def _lookup(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    coarse = np.zeros(1 << 20, bool)
    coarse[W.mix(keys & _GRAM) >> np.uint64(44)] = True
    return keys, coarse


def _numbers(starts: np.ndarray, numbers: np.ndarray) -> pa.Array:
    """Lists of 32-bit numbers, each from its start on, as bytes."""
    data = np.ascontiguousarray(numbers, np.int32)
    ends = np.append(starts, len(data)).astype(np.int64) * 4
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def _listed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, numbers) of lists of 32-bit numbers as bytes."""
    lists = column.cast(pa.large_binary())
    _, offsets, data = lists.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lists.offset : lists.offset + len(lists) + 1]
    return (offsets - offsets[0]) // 4, np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.int32)


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each feature the numbers of the texts that have it, block by block."""
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        number = np.asarray(batch.column("number"))
        for lo, hi in W.ranges(offsets, 4 * W.BLOCK_BYTES):
            part = offsets[lo : hi + 1]
            row, feature = _features(data[part[0] : part[-1]], part - part[0], None)
            order = np.argsort(feature, kind="stable")
            keys, starts = np.unique(feature[order], return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), _numbers(starts, number[lo:hi][row[order]])], ["feature", "texts"])


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each feature's lists as one, in order; features of too few texts are left out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("parts")
        offsets, numbers = _listed(parts.flatten())
        of = np.repeat(np.repeat(np.arange(len(parts)), np.asarray(parts.value_lengths())), np.diff(offsets))
        size = np.bincount(of, minlength=len(parts))
        keep = size >= SUPPORT
        of, numbers = of[keep[of]], numbers[keep[of]]
        starts = np.cumsum(size[keep]) - size[keep]
        yield pa.RecordBatch.from_arrays([batch.column("feature").filter(pa.array(keep)), _numbers(starts, numbers[np.lexsort((numbers, of))])], ["feature", "texts"])


def _telling(batches: Iterator[pa.RecordBatch], sent, most: int) -> Iterator[pa.RecordBatch]:
    """For each view the features that gain most: what the residuals of their texts sum up to, in standard deviations."""
    views = sent.value
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, numbers = _listed(batch.column("texts"))
        feature = np.asarray(batch.column("feature"))
        for v, (residual, variance, chosen) in enumerate(views):
            gain = np.abs(np.add.reduceat(residual[numbers], offsets[:-1])) / np.sqrt(np.add.reduceat(variance[numbers], offsets[:-1]) + 1)
            texts = np.add.reduceat((variance > 0)[numbers].astype(np.int64), offsets[:-1])
            gain[(texts < SUPPORT) | np.isin(feature, chosen)] = 0
            best = np.lexsort((feature, -gain))[:most]
            best = best[gain[best] > 0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), v, np.int32)), pa.array(feature[best]), pa.array(gain[best])], ["view", "feature", "gain"])


@dataclass
class Linear:
    """A logistic model: weights of features, weights of earlier probabilities, bias."""

    weights: np.ndarray
    chain: np.ndarray
    bias: float

    def probability(self, row: np.ndarray, feature: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        z = np.bincount(row, self.weights[feature], len(earlier)) + earlier @ self.chain + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(row: np.ndarray, feature: np.ndarray, earlier: np.ndarray, y: np.ndarray, n_features: int, rounds: int = ROUNDS) -> Linear:
    """Accelerated gradient descent on the ridge-penalised logistic loss of sparse presence features."""
    n, m = earlier.shape
    ridge = RIDGE_TEXTS / n

    def times(v):
        return np.bincount(row, v[:n_features][feature], n) + earlier @ v[n_features : n_features + m] + v[-1]

    def transposed(r):
        return np.concatenate([np.bincount(feature, r[row], n_features), earlier.T @ r, [r.sum()]])

    v = np.ones(n_features + m + 1)
    for _ in range(15):  # the largest curvature sets the step
        v = transposed(times(v / np.linalg.norm(v)))
    step = 1 / (0.25 * max(np.linalg.norm(v), 1) / n + ridge)
    w, ahead = np.zeros(len(v)), np.zeros(len(v))
    for i in range(rounds):
        slope = transposed(1 / (1 + np.exp(-np.clip(times(ahead), -500, 500))) - y) / n + ridge * ahead
        new = ahead - step * slope
        ahead, w = new + i / (i + 3) * (new - w), new
    return Linear(w[:n_features], w[n_features : n_features + m], float(w[-1]))


def _known(known: np.ndarray, row: np.ndarray, feature: np.ndarray, earlier: np.ndarray, y: np.ndarray) -> tuple:
    """What ``fit`` gets of the known texts."""
    place, mine = np.cumsum(known) - 1, known[row]
    return place[row[mine]], feature[mine], earlier[known], y[known]


def out_of_fold(row: np.ndarray, feature: np.ndarray, earlier: np.ndarray, y: np.ndarray, n_features: int, rounds: int = ROUNDS, folds: int = FOLDS) -> np.ndarray:
    """The probability of each text by a model that hasn't learned from it; ``y`` has NaN where it is unknown.

    The features are given: they must have been chosen without ``y``, or the result serves to choose more of them only.
    """
    fold = np.arange(len(y)) % folds  # rows come in hash order
    known, out = np.isfinite(y), np.zeros(len(y))
    for f in range(folds):
        others = known & (fold != f)
        model = fit(*_known(others if others.any() else known, row, feature, earlier, y), n_features, rounds)
        out[fold == f] = model.probability(row, feature, earlier)[fold == f]
    return out


def fit_chain(row: np.ndarray, feature: np.ndarray, labels: np.ndarray, n_features: int, own: np.ndarray, held_out: np.ndarray) -> list[Linear]:
    """One model a category; column i of ``labels`` is its 0, 1 or NaN (unknown: not learned from).

    Row i of ``own`` says which features the model of category i may use; column i of ``held_out`` has the
    probabilities of category i that later models learn from, each by a model and features that don't know the text.
    """
    models = []
    for i, y in enumerate(labels.T):
        mine = own[i][feature]
        models.append(fit(*_known(np.isfinite(y), row[mine], feature[mine], held_out[:, :i], y), n_features))
    return models


class _Pick:
    """The features chosen from one view of the labels, and the texts that have them."""

    def __init__(self):
        self.row, self.feature, self.chosen = np.zeros((3, 0), np.int64)

    def add(self, features: list[int], texts: dict[int, np.ndarray]) -> None:
        at = len(self.chosen)
        self.row = np.concatenate([self.row, *(texts[f] for f in features)])
        self.feature = np.concatenate([self.feature, *(np.full(len(texts[f]), at + i) for i, f in enumerate(features))])
        self.chosen = np.concatenate([self.chosen, np.array(features, np.int64)])

    def learned(self, earlier: np.ndarray, y: np.ndarray, rounds: int) -> np.ndarray:
        """The probability of every text by a model of the known ones."""
        known = np.isfinite(y)
        if not known.any():
            return np.zeros(len(y))
        return fit(*_known(known, self.row, self.feature, earlier, y), len(self.chosen), rounds).probability(self.row, self.feature, earlier)


def _honest(picks: list[_Pick], views: list[np.ndarray], earlier: np.ndarray, rounds: int) -> np.ndarray:
    """The probability of each text by features and a model from the labels of the other folds."""
    fold, out = np.arange(len(earlier)) % FOLDS, np.zeros(len(earlier))
    for f in range(FOLDS):
        out[fold == f] = picks[f].learned(earlier, views[f], rounds)[fold == f]
    return out


def choose(spark: SparkSession, index: DataFrame, labels: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of the feature, features in order, whose they are, held-out probabilities): at most ``features`` a category.

    Features are chosen step by step from six views of a category's labels at once, each a pass over ``index``: without
    one of the folds, and with all. A text's held-out probability comes from the view that lacks its fold, features and
    model alike; the view of all labels leaves the features, and its residuals are against those probabilities.
    """
    n, found, held_out = len(labels), [], np.zeros((len(labels), 0))
    fold = np.arange(n) % FOLDS
    for y in labels.T:
        views = [np.where(fold == f, np.nan, y) for f in range(FOLDS)] + [y]
        picks = [_Pick() for _ in views]
        known = np.isfinite(y)
        for step in range(STEPS if 0 < y[known].sum() < known.sum() else 0):
            most = features * (step + 1) // STEPS - features * step // STEPS
            asked = []
            for f, (pick, view) in enumerate(zip(picks, views, strict=True)):
                told = np.isfinite(view)
                if not step and not held_out.shape[1]:
                    chance = np.full(n, view[told].mean() if told.any() else 0.0)
                elif f < FOLDS:
                    chance = out_of_fold(pick.row, pick.feature, held_out, view, len(pick.chosen), DRAFT_ROUNDS, 2) if told.any() else np.zeros(n)
                else:
                    chance = _honest(picks, views, held_out, DRAFT_ROUNDS)
                asked.append((np.where(told, view - chance, 0.0), np.where(told, np.maximum(chance * (1 - chance), 1e-9), 0.0), pick.chosen))
            sent = spark.sparkContext.broadcast(asked)
            best = index.mapInArrow(partial(_telling, sent=sent, most=most), "view int, feature long, gain double")
            best = best.withColumn("place", F.row_number().over(Window.partitionBy("view").orderBy(F.desc("gain"), "feature"))).where(F.col("place") <= most).toArrow()
            if not best.num_rows:
                break
            got = index.where(F.col("feature").isin(sorted(set(best["feature"].to_pylist())))).toArrow().combine_chunks()
            offsets, numbers = _listed(got["texts"].combine_chunks())
            texts = {f: numbers[a:b].astype(np.int64) for f, a, b in zip(got["feature"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)}
            view, feature = (np.asarray(best[c]) for c in ("view", "feature"))
            for v, pick in enumerate(picks):
                pick.add(sorted(feature[view == v].tolist()), texts)
        held_out = np.column_stack([held_out, _honest(picks, views, held_out, ROUNDS)])
        found.append(picks[-1])
    keys = np.unique(np.concatenate([x.chosen.view(np.uint64) for x in found]))
    own = np.array([np.isin(keys, x.chosen.view(np.uint64)) for x in found])
    pairs = np.unique(np.concatenate([x.row * len(keys) + np.searchsorted(keys, x.chosen.view(np.uint64))[x.feature] for x in found]))
    return pairs // max(len(keys), 1), pairs % max(len(keys), 1), keys, own, held_out


def _scored(batches: Iterator[pa.RecordBatch], sent, names: list[str], threshold: float) -> Iterator[pa.RecordBatch]:
    known, models = sent.value
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        for lo, hi in W.ranges(offsets):
            part = offsets[lo : hi + 1]
            row, feature = _features(data[part[0] : part[-1]], part - part[0], known)
            feature, earlier = feature.astype(np.int64), np.zeros((hi - lo, 0))
            for model in models:
                earlier = np.column_stack([earlier, model.probability(row, feature, earlier)])
            earlier[np.diff(part) == 0] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *(pa.array(x) for x in earlier.T), *(pa.array(x >= threshold) for x in earlier.T)],
                                             ["doc_id", *(f"p_{n}" for n in names), *names])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, categories=CATEGORIES, *, sample: int = SAMPLE, features: int = FEATURES):
    """((keys, lookup) of the features, models) from the labelled sample; None if nothing is labelled."""
    names = [c[0] for c in categories]
    # one label a document; labels that contradict each other mean yes
    yes = [F.max((F.col(column).cast("double") == value).cast("int")).alias(name) for name, column, value in categories]
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *{c[1] for c in categories}).where("doc_id is not null").groupBy("doc_id").agg(*yes)
    chosen = named.where(F.coalesce(*names).isNotNull()).join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = written(spark, chosen, "labelled-ids")
    # equal texts of equal labels are one; their order by hash numbers them
    shown = F.concat_ws("\0", *(F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in names), "text")
    rows = docs.where(F.octet_length("text") > 0).join(F.broadcast(chosen), "doc_id").withColumn("key", F.md5(shown.cast("binary")))
    distinct = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), *(F.first(n).alias(n) for n in names))
    got = distinct.orderBy("key").limit(sample).toArrow()  # an id can repeat over many texts: the bound holds for rows
    if not got.num_rows:
        return None
    y = np.column_stack([np.asarray(got[n].cast(pa.float64()).fill_null(np.nan)) for n in names])
    numbers = spark.createDataFrame(got.select(["key", "doc_id"]).append_column("number", pa.array(np.arange(len(got), dtype=np.int32))))
    texts = written(spark, rows.join(F.broadcast(numbers), ["key", "doc_id"]).dropDuplicates(["number"]).select("number", "text"), "labelled")
    index = texts.mapInArrow(_texts_of, "feature long, texts binary").groupBy("feature").agg(F.collect_list("texts").alias("parts"))
    index = written(spark, index.mapInArrow(_together, "feature long, texts binary"), "grams")
    row, feature, keys, own, held_out = choose(spark, index, y, features)
    if not len(keys):
        return None
    return _lookup(keys), fit_chain(row, feature, y, len(keys), own, held_out)


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, categories=CATEGORIES,
             threshold: float = 0.5, **bounds) -> DataFrame:
    """(doc_id, p_<category>..., <category>...) for every row of ``docs``: probabilities and whether they reach ``threshold``.

    Null and empty texts have probability 0. Without labels of both kinds every probability is 0. Labels without a
    document, or null, are not learned from; equal texts of equal labels are learned from once. Rows stay as they are, repeated or with a null id; other columns of either
    table play no part.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prepare(spark)
    names = [c[0] for c in categories]
    model = train(spark, own, labels, categories, **bounds)
    if model is None:
        return own.select("doc_id", *(F.lit(0.0).alias(f"p_{n}") for n in names), *(F.lit(False).alias(n) for n in names))
    schema = "doc_id long, " + ", ".join([*(f"p_{n} double" for n in names), *(f"{n} boolean" for n in names)])
    return own.mapInArrow(partial(_scored, sent=spark.sparkContext.broadcast(model), names=names, threshold=threshold), schema)
