"""Row identity without a unique key: rows that agree on id and text are the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["k1", "k2"]


def key_columns(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits that name the pair of id and text."""
    name, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    return F.xxhash64(name, text, text.isNull()), F.xxhash64(F.lit(7), text.isNull(), text, name)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, k1, k2); other columns are left out."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    k1, k2 = key_columns("doc_id", "text")
    return own.withColumn("k1", k1).withColumn("k2", k2)
