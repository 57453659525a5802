"""Language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts of up to ``order`` bytes counts what
follows them in training texts. Frozen, it gives the exact length of a code
for a text: a byte seen in its longest known context costs its share of the
counts there, any other costs an escape (method C: as likely as the number of
distinct bytes seen) and is coded in the next shorter context, at last with 8
bits. The language with the shortest code is predicted; its score is the
probability of that language given the code lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import rows
from tessera.llm import words as W
from tessera.llm.stage import prepare, tidied, written

ORDER = 3
#: Bound of the labelled sample: documents for each language. Languages are learned and scored so many at a time.
DOCS_PER_LANGUAGE, LANGUAGES = 1000, 200
#: Languages learned from all their texts go together while their grams times their number are no more (8 bytes each).
CELLS = 4_000_000
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte, the byte and the ``order`` before it as one number; before a row's start there are zeros."""
    low = _LOWER[data]
    after = np.zeros(len(low), bool)
    after[1:] = low[:-1] == 0xC3
    low[after & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)] += 0x20  # the capitals of Latin-1
    place = np.arange(len(low)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = low.astype(np.uint64)
    for back in range(1, order + 1):
        before = np.zeros(len(low), np.uint64)
        before[back:] = low[:-back]
        before[place < back] = 0
        out |= before << np.uint64(8 * back)
    return out


class Model:
    """Frozen statistics of all languages."""

    def __init__(self, languages: list[str], language: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int):
        self.languages, self.order, n = languages, order, len(languages)
        self.tables = []
        shorter = None
        for o in range(order + 1):
            mask = np.uint64((1 << 8 * (o + 1)) - 1)
            keys, at = np.unique(grams & mask, return_inverse=True)
            seen = np.zeros((len(keys), n))
            np.add.at(seen, (at, language), counts)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            whole = np.maximum(total + kinds, 1)
            escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0.0)
            below = 8.0 if shorter is None else shorter(keys)
            cost = np.where(seen > 0, -np.log2(np.maximum(seen, 1) / whole[of]), escape[of] + below)
            self.tables.append((keys, cost, contexts, escape))
            shorter = partial(self.cost, order=o)

    def cost(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Bits that the last byte of each gram costs after the bytes before it, for each language."""
        if order < 0:
            return np.full((len(grams), len(self.languages)), 8.0)
        keys, cost, contexts, escape = self.tables[order]
        wanted = grams & np.uint64((1 << 8 * (order + 1)) - 1)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        out = cost[at]
        new = np.flatnonzero(keys[at] != wanted)
        if len(new):
            context = wanted[new] >> np.uint64(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            out[new] = np.where((contexts[at] == context)[:, None], escape[at], 0.0) + self.cost(wanted[new], order - 1)
        return out

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row for each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if len(data):
            keys, at = np.unique(_grams(data, offsets, self.order), return_inverse=True)
            cost = self.cost(keys, self.order)
            full = np.flatnonzero(np.diff(offsets))
            for i in range(len(self.languages)):
                out[full, i] = np.add.reduceat(cost[:, i][at], offsets[full])
        return out


@tidied
def _counted(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        languages = np.array(batch.column("lang").to_pylist(), object)
        for language in sorted(set(languages.tolist())):
            own = batch.column("text").filter(pa.array(languages == language))
            data, offsets = W.utf8(own)
            for lo, hi in W.ranges(offsets):
                part = offsets[lo : hi + 1]
                keys, n = np.unique(_grams(data[part[0] : part[-1]], part - part[0], order), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])


@tidied
def _scored(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """For each row the best of the model's languages, its code length, and the sum of all languages' probabilities against it."""
    model: Model = sent.value
    for batch in batches:
        data, offsets = W.utf8(batch.column("text"))
        without = ~np.asarray(batch.column("letters"))
        for lo, hi in W.ranges(offsets):
            part = offsets[lo : hi + 1]
            bits = model.bits(data[part[0] : part[-1]], part - part[0])
            best, least = bits.argmin(axis=1), bits.min(axis=1)
            none = without[lo:hi]
            out = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                out.column("doc_id"), out.column("k1"), out.column("k2"), pa.array(np.array(model.languages, object)[best], pa.string(), mask=none),
                pa.array(least, mask=none), pa.array(np.exp2(least[:, None] - bits).sum(axis=1), mask=none), pa.array(np.diff(part)),
            ], ["doc_id", *rows.KEY, "lang_pred", "least", "total", "n_bytes"])


_SCORES = "doc_id long, k1 long, k2 long, lang_pred string, least double, total double, n_bytes long"


def held_out(id_col: str):
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2 (so are null ids)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


class _Labelled:
    """All labelled texts, row by row. Held-out documents, null texts and null languages are never learned from."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, lang_col: str):
        usable = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        self.usable = usable.where(~held_out("doc_id") & F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") > 0))

    def models(self, order: int, languages: int, cells: int = CELLS) -> list[Broadcast]:
        """The models of all languages, counted in one scan: so many languages and cells of a table of costs in each."""
        spark = self.usable.sparkSession
        grams = written(spark, _gram_counts(self.usable.select("lang", "text"), order), "grams")
        parts, n_grams = [], 0
        for lang, n in grams.groupBy("lang").count().orderBy("lang").collect():  # a row per language
            if parts and len(parts[-1]) < languages and (n_grams + n) * (len(parts[-1]) + 1) <= cells:
                parts[-1].append(lang)
                n_grams += n
            else:
                parts.append([lang])
                n_grams = n
        return [spark.sparkContext.broadcast(_model(part, grams.where(F.col("lang").isin(part)), order)) for part in parts]


class _Sample(_Labelled):
    """The labelled sample: for each language the documents with the smallest hash of id and text."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int):
        super().__init__(docs, id_col, text_col, lang_col)
        self.most = most
        self.languages = [tuple(r) for r in self.usable.groupBy("lang").count().orderBy("lang").collect()]  # a row per language

    def texts(self, languages: list[tuple[str, int]]) -> DataFrame:
        """(lang, text) of the sample of some languages."""
        spark = self.usable.sparkSession
        common = spark.createDataFrame(languages, "lang string, count long")
        # a share of each language by hash, a little more than is wanted: only those are ranked, whatever a language's size;
        # rows are hashed by id and text, so that an id that repeats over many texts is many documents
        hashed = self.usable.withColumn("hash", F.xxhash64("doc_id", "text"))
        hashes = hashed.select("lang", "hash").join(F.broadcast(common), "lang").withColumn("share", F.pmod("hash", F.lit(1 << 40)))
        some = hashes.where(F.col("share") < (1 << 40) * (1.5 * self.most + 100) / F.col("count")).select("lang", "hash", "share").distinct()
        ranked = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("share", "hash")))
        sample = ranked.where(F.col("place") <= self.most).select("lang", "hash")
        return hashed.join(F.broadcast(sample), ["lang", "hash"], "left_semi").dropDuplicates(["lang", "hash"]).select("lang", "text")

    def models(self, order: int, languages: int) -> list[Broadcast]:
        parts = [self.languages[at : at + languages] for at in range(0, len(self.languages), languages)]
        return [self.usable.sparkSession.sparkContext.broadcast(_model([x for x, _ in part], _gram_counts(self.texts(part), order), order)) for part in parts]


def _gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) of rows (lang, text)."""
    return texts.mapInArrow(partial(_counted, order=order), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _model(languages: list[str], grams: DataFrame, order: int) -> Model:
    counted = grams.toArrow()
    number = {x: i for i, x in enumerate(languages)}
    return Model(languages, np.array([number[x] for x in counted["lang"].to_pylist()]), np.asarray(counted["gram"]).astype(np.int64).view(np.uint64),
                 np.asarray(counted["n"]).astype(np.float64), order)


def _scores(spark: SparkSession, own: DataFrame, models: list[Broadcast]) -> DataFrame:
    """``_SCORES`` for every row of ``own``, the best of all models; the language is null if ``letters`` isn't set."""
    if not models:
        none = F.lit(None).cast("double")
        return own.select("doc_id", *rows.KEY, F.lit(None).cast("string").alias("lang_pred"), none.alias("least"), none.alias("total"), F.lit(0).cast("long").alias("n_bytes"))
    scans = [own.mapInArrow(partial(_scored, sent=sent), _SCORES) for sent in models]
    if len(scans) == 1:
        return scans[0]
    # the best of every part by key (rows of a key are alike), then one probability from all parts
    each = written(spark, reduce(DataFrame.unionByName, scans), "language-scores")
    best = each.groupBy(*rows.KEY).agg(F.min(F.struct("least", "lang_pred")).alias("best"), F.collect_set(F.struct("lang_pred", "least", "total")).alias("parts"))
    total = F.aggregate("parts", F.lit(0.0), lambda t, p: t + p["total"] * F.pow(F.lit(2.0), F.col("best.least") - p["least"]))
    best = best.select(*rows.KEY, F.col("best.lang_pred").alias("lang_pred"), F.col("best.least").alias("least"), total.alias("total"))
    return own.select("doc_id", *rows.KEY, F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).join(best, rows.KEY).select("doc_id", *rows.KEY, "lang_pred", "least", "total", "n_bytes")


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
             keyed: bool = False, order: int = ORDER, docs_per_language: int = DOCS_PER_LANGUAGE, languages: int = LANGUAGES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for every row of ``docs``; with ``keyed`` also (k1, k2), see ``rows``.

    The prediction sees the whole text only. A null text, and one without a letter, is ``und`` with score 0; so is
    every text if there is nothing to learn from. Equal code lengths go to the language that comes first by name.
    Every labelled language is learned, ``languages`` at a time: more of them take a scan for each such part.
    Rows stay as they are, repeated or with a null id; other columns play no part.
    """
    prepare(spark)
    sample = _Sample(docs, id_col, text_col, lang_col, docs_per_language)
    own = rows.keyed(docs, id_col, text_col).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    out = _scores(spark, own, sample.models(order, languages))
    known = F.col("lang_pred").isNotNull()
    return out.select("doc_id", *rows.KEY * keyed, held_out("doc_id").alias("held_out"), F.coalesce("lang_pred", F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(known, 1 / F.col("total")).otherwise(F.lit(0.0)).alias("score"), F.when(known, F.col("least") / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


#: What a text may cost a byte beyond the labelled texts of its language: a share of their bound, and bits that
#: a short text may cost more, falling with the root of its length.
SLACK, SHORT_BITS = 2.0, 24.0
#: Bounds are counted in so many steps a bit.
STEPS = 1024


def _learned_bounds(scores: DataFrame) -> list:
    """(language, bound), a row per language: the least step that 99.9 % of its texts of 200 bytes or more cost a byte at most.

    Every text is counted; the steps of a language are few, whatever the number of its texts."""
    step = F.ceil(F.col("least") / F.col("n_bytes") * STEPS)
    counted = scores.where("n_bytes >= 200 AND lang_pred IS NOT NULL").groupBy("lang_pred", step.alias("step")).agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang_pred")
    counted = counted.withColumns({"upto": F.sum("n").over(own.orderBy("step")), "all": F.sum("n").over(own)})
    return counted.where("1000 * upto >= 999 * all").groupBy("lang_pred").agg((F.min("step") / STEPS).alias("bound")).collect()


@tidied
def _judged(batches: Iterator[pa.RecordBatch], sent, bounds: dict[str, float], column: str, name: str, drop: bool) -> Iterator[pa.RecordBatch]:
    """Rows whose text some language of the model codes within its bound: the others go, or are told apart by ``name``."""
    model: Model = sent.value
    most = np.array([bounds.get(x, 8.0) for x in model.languages])
    for batch in batches:
        data, offsets = W.utf8(batch.column(column))
        within = np.zeros(batch.num_rows, bool)
        for lo, hi in W.ranges(offsets):
            part = offsets[lo : hi + 1]
            n = np.maximum(np.diff(part), 1)[:, None]
            bits = model.bits(data[part[0] : part[-1]], part - part[0])
            within[lo:hi] = (bits / n <= SLACK * most + SHORT_BITS / np.sqrt(n)).any(axis=1)
        within &= np.asarray(batch.column(name))
        at = batch.schema.get_field_index(name)
        yield batch.drop_columns([name]).filter(pa.array(within)) if drop else batch.set_column(at, name, pa.array(within))


def keep_languages(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
                   order: int = ORDER, languages: int = LANGUAGES, cells: int = CELLS) -> DataFrame:
    """The rows of ``docs``, with their columns, that are in one of the learned languages; judged and kept in one scan.

    A text must have a letter, and some language must code it in no more bits a byte than its own texts take (their
    99.9 % bound, by ``SLACK`` and, for short texts, ``SHORT_BITS`` / root of the length more): random strings, code and
    languages that weren't learned cost more. Models and bounds are learned from all labelled texts that aren't held
    out, a row that repeats as often as it does. Null texts go; without any labelled text nothing can be judged, and
    all texts with a letter stay. Many languages or grams are learned in parts; what stays doesn't depend on them.
    """
    prepare(spark)
    labelled = _Labelled(docs, id_col, text_col, lang_col)
    name = "__letters"
    marked = docs.withColumn(name, F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)))
    models = labelled.models(order, languages, cells)
    if not models:
        return marked.where(name).drop(name)
    bounds = {r.lang_pred: r.bound for r in _learned_bounds(_scores(spark, rows.keyed(labelled.usable, "doc_id", "text").withColumn("letters", F.lit(True)), models))}
    out = []
    for sent in models:
        judged = partial(_judged, sent=sent, bounds=bounds, column=text_col, name=name)
        if sent is models[-1]:
            out.append(marked.mapInArrow(partial(judged, drop=True), docs.schema))
        else:  # what these languages don't let through is put to the next ones
            told = written(spark, marked.where(name).mapInArrow(partial(judged, drop=False), marked.schema), "judged")
            out.append(told.where(name).drop(name))
            marked = told.where(~F.col(name)).withColumn(name, F.lit(True))
    return reduce(DataFrame.unionByName, out)
