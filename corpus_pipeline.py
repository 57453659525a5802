"""The corpus pipeline: five stages over ``documents``, each an operator of ``tessera.llm``.

    language_id      texts that no learned language codes in few enough bits go
    near_dedup       of each component of near duplicates one document stays, that with the smallest id
    substring_dedup  words that repeat 50 words of a document with a smaller id go from the texts; a text that loses
                     all its words goes; n_chars follows the text
    decontaminate    documents that hold a 10-word window of a benchmark item go
    encode           token ids of what is left

Every stage gets the table that the one before it wrote, and that table must be written before the next stage is
called: a stage first removes the tables that the one before it worked with. All but the last return the columns of
documents. Language, decontamination and encoding judge and keep in one scan; the others send keys to the texts,
or by a shuffle where there are very many, and only texts that change move.

Rows are told apart by id and text, so a repeated id names as many documents as it has texts, and rows without an id
take part like others (they lose no words to substring_dedup and come last when one of a component is chosen). Of
rows that repeat both id and text near_dedup keeps one. Null texts and texts without a letter go in the first stage.
Extra columns are kept up to the last stage.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, language_id, near_dedup, substring_dedup
from tessera.llm.rows import KEY, key_columns
from tessera.llm.stage import dropped, matched, noted, small_batches, table, written

_KEYS = ["__k1", "__k2"]
#: Batches between Spark and Python: five operators follow each other in the same executors and workers.
BATCH_BYTES = "3m"
#: Bytes of text that the last stage encodes at a time.
BLOCK_BYTES = 1 << 20
#: The tables of the stage called last, by application.
_left: dict[str, list[str]] = {}


def _stage(function):
    """The stage's intermediate tables go when the next stage is called, its result being written by then."""

    @wraps(function)
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        paths = _left.setdefault(spark.sparkContext.applicationId, [])
        dropped(spark, paths)
        small_batches(spark, BATCH_BYTES)
        with noted() as made:
            out = function(spark, docs, sf_dir)
        paths += made
        return out

    return called


def _marked(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of each row's id and text."""
    return docs.withColumns(dict(zip(_KEYS, key_columns("doc_id", "text"), strict=True)))


def _keys(of: DataFrame, *more: str) -> DataFrame:
    return of.select(*[F.col(k).alias(name) for k, name in zip(KEY, _KEYS, strict=True)], *more)


@_stage
def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_languages(spark, docs)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(spark, docs, keyed=True)
    found = found.groupBy(*KEY).agg(F.max("survives").alias("survives"), F.count("*").alias("rows"))
    named = written(spark, _keys(found.where("NOT survives OR rows > 1"), "survives"), "pipeline-gone")
    out = matched(_marked(docs), named.select(_KEYS), _KEYS, "left_anti")
    again = named.where("survives").select(_KEYS)
    if not again.isEmpty():  # rows that repeat id and text: one of them
        out = out.unionByName(matched(_marked(docs), again, _KEYS, "left_semi").dropDuplicates(_KEYS))
    return out.select(docs.columns)


@_stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    changed = substring_dedup.substring_dedup(spark, docs).where("n_removed > 0").dropDuplicates(KEY)
    changed = written(spark, _keys(changed, F.col("kept_text").alias("__kept")), "pipeline-changed")
    keys = written(spark, changed.select(_KEYS), "pipeline-changed-keys")
    same = matched(_marked(docs), keys, _KEYS, "left_anti").select(docs.columns)
    cut = matched(_marked(docs), keys, _KEYS, "left_semi").join(changed, _KEYS).where("__kept <> ''").withColumn("text", F.col("__kept"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return same.unionByName(cut.select(docs.columns))


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(spark, docs, public_tokenizers.path("word_bpe_49k.json"), decoded=True, block_bytes=BLOCK_BYTES)
    return bpe.digests(encoded)


STAGES = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

#: SQL can express neither the language model nor the encoder; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the written result of the one before; older results are removed."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        with noted() as own:
            docs = written(spark, result, f"pipeline-{name}")
        dropped(spark, before)
        before = own
    return STAGES[-1][1](spark, docs, sf_dir)
