"""A keyed table in hash buckets: a merge moves the batch, not the table (SNK-2, SNK-3).

Versions are Parquet tables bucketed and sorted by the key, written with Spark's
``bucketBy``. A merge joins the latest version with the batch on the key: the
base is read bucket by bucket where it lies, only the batch is shuffled, and
each task writes the bucket it has read.

Every version names the syncs that it holds. A sync that comes again adds
nothing; of two syncs that run at once, the second to finish finds its version
taken and merges again onto the first one's, so neither is lost.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.streaming.sinks import _fs, committed_ids

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class BucketedTable:
    """Versions ``root/v=<n>`` of a table with ``schema`` (DDL), in ``buckets`` hash buckets of ``key``.

    The number of buckets is the table's for good; each should hold what one task can read (some hundred MB).
    ``keep`` versions stay for readers that have begun on them.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, buckets: int = 64, keep: int = 5):
        self.spark, self.root, self.schema, self.key, self.buckets, self.keep = spark, root.rstrip("/"), schema, key, buckets, keep

    def versions(self) -> list[int]:
        return committed_ids(self.spark, self.root, "v")

    def _table(self, path: str) -> str:
        """The catalog's name for a version's files; the catalog tells Spark of the buckets."""
        name = f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def read(self, version: int | None = None) -> DataFrame:
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self._table(f"{self.root}/v={versions[-1] if version is None else version}"))

    def applied(self, version: int | None) -> list[int]:
        """The syncs that a version holds."""
        if version is None:
            return []
        fs, path = _fs(self.spark, f"{self.root}/v={version}/_applied.json")
        file = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8"))
        finally:
            file.close()

    def _write(self, df: DataFrame, applied: list[int]) -> str:
        staged = f"{self.root}/staged-{uuid.uuid4().hex}"
        name = f"staged_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", staged).mode("overwrite").format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # of the catalog; the files stay
        fs, path = _fs(self.spark, f"{staged}/_applied.json")
        out = fs.create(path, True)
        out.write(bytearray(json.dumps(applied).encode()))
        out.close()
        return staged

    def _put(self, staged: str, version: int) -> bool:
        """Make staged files version ``version`` unless there is one: a rename that doesn't replace."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        fs, source = _fs(self.spark, staged)
        source, target = fs.makeQualified(source), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={version}"))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(source, target, options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        return True

    def merge(self, incoming: DataFrame, sync_id: int, merge_fn: Merge) -> int:
        """Apply ``incoming`` once, whatever else runs; returns the version that holds it.

        ``merge_fn(base, incoming)`` must give the same for a batch in any order with others.
        """
        while True:
            versions = self.versions()
            base = versions[-1] if versions else None
            applied = self.applied(base)
            if sync_id in applied:
                return base
            merged = merge_fn(self.read(base), incoming)
            staged = self._write(merged, sorted([*applied, sync_id]))
            if self._put(staged, next_ := 0 if base is None else base + 1):
                self._expire(next_)
                return next_
            fs, path = _fs(self.spark, staged)
            fs.delete(path, True)

    def _expire(self, latest: int) -> None:
        for v in self.versions():
            if v <= latest - self.keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(f'{self.root}/v={v}')}")
                fs, path = _fs(self.spark, f"{self.root}/v={v}")
                fs.delete(path, True)


def blacklist_join(existing: DataFrame, batch: DataFrame, user_col: str = "userName", order_col: str = "window_end",
                   initial_cnt: int = 1, buckets: int = 64) -> DataFrame:
    """``tables.blacklist_merge`` as a join of a bucketed base with the batch, a row per player of it (SNK-2/3).

    The batch is dealt into the base's buckets, so the join needs no exchange of the base.
    """
    new = batch.groupBy(user_col).agg(F.count(F.lit(1)).alias("_k"), F.max_by(F.col("avgTime").cast("double"), F.col(order_col)).alias("_avg")).repartition(buckets, user_col)
    old = existing.select(user_col, "avgTime", "cnt")
    both = old.join(new, user_col, "full_outer")
    cnt = F.when(F.col("cnt").isNull(), F.lit(initial_cnt) + F.col("_k") - 1).otherwise(F.col("cnt") + F.coalesce("_k", F.lit(0)))
    return both.select(user_col, F.coalesce("_avg", "avgTime").alias("avgTime"), cnt.cast("int").alias("cnt"))
