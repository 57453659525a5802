"""Idempotent batch outputs and versioned tables on plain files (SNK-1..5, SNK-7, STR-10/11).

``foreachBatch`` is at-least-once: after a failure Spark replays the last batch
with the same ``batch_id``. Every writer here is keyed by that id and
overwrites its own folder, so a replay rewrites the same output instead of
adding to it. A folder counts only once Spark's committer has written
``_SUCCESS`` in it, so a half-written attempt (lost executor, killed driver) is
never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def committed_ids(spark: SparkSession, root: str, prefix: str, after: int = -1) -> list[int]:
    """Ids ``n`` over ``after`` of sub-folders ``<prefix>=<n>`` of ``root`` that hold ``_SUCCESS``."""
    fs, hroot = _fs(spark, root)
    if not fs.exists(hroot):
        return []
    out = []
    for st in fs.listStatus(hroot):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix + "=") and int(name.split("=", 1)[1]) > after:
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
    return sorted(out)


class VersionedTable:
    """A keyed table kept as numbered parquet versions ``root/v=<n>``.

    ``commit(df, n)`` writes version ``n`` (a replay of ``n`` overwrites it);
    ``read()`` returns the highest committed version. A new version is always
    written to a new folder, never over the one being read.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def versions(self) -> list[int]:
        return committed_ids(self.spark, self.root, "v")

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def read(self, before: int | None = None) -> DataFrame | None:
        vs = [v for v in self.versions() if before is None or v < before]
        if not vs:
            if self.schema is None:
                return None
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(self.path(vs[-1]))

    def commit(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self.path(version))

    def merge(self, incoming: DataFrame, version: int,
              merge_fn: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Write ``merge_fn(latest version below `version`, incoming)`` as ``version``.

        Basing the merge on versions *below* ``version`` makes a replayed batch
        produce the same table again, so counters are not incremented twice.
        """
        base = self.read(before=version)
        self.commit(incoming if base is None else merge_fn(base, incoming), version)


class DeltaLogTable:
    """A keyed table kept as an append-only log of batch deltas plus compacted bases.

    ``append(df, batch_id, run)`` writes only that batch's rows to
    ``<deltas>/run=<run>/batch=<id>``: O(batch) per trigger, not O(table). ``run``
    names the stream query (a checkpoint keeps its query id), so a query that
    starts again from a new checkpoint never meets the batch ids of the old one; a
    replayed id overwrites its own folder. ``read(merge_fn)`` is
    ``merge_fn(latest base, deltas that it does not hold)``; ``merge_fn`` must be
    associative over deltas, which holds for the blacklist (counts add, the latest
    window wins) and the flagged map. ``compact`` folds the deltas into a new base
    with a manifest: the last batch of each run that the base holds. ``expire``
    removes deltas that every table of the log has held for one base already, so
    listings stay as short as the time between compactions.
    """

    def __init__(self, spark: SparkSession, root: str, table_schema: str, delta_schema: str,
                 deltas: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.table_schema, self.delta_schema = table_schema, delta_schema
        # several tables may be views of one delta log (written once per batch)
        self.deltas = (deltas or f"{self.root}/deltas").rstrip("/")

    def append(self, df: DataFrame, batch_id: int, run: str = "0") -> None:
        df.write.mode("overwrite").parquet(f"{self.deltas}/run={run}/batch={batch_id}")

    def bases(self) -> list[int]:
        """Bases with data and manifest; the manifest is written last."""
        return [v for v in committed_ids(self.spark, f"{self.root}/base", "v")
                if committed_ids(self.spark, f"{self.root}/base/v={v}", "manifest")]

    def held(self, base: int | None) -> dict[str, int]:
        """Last batch of each run that a base holds: one row per run."""
        if base is None:
            return {}
        rows = self.spark.read.schema("run STRING, batch BIGINT").parquet(f"{self.root}/base/v={base}/manifest=0").collect()
        return {r["run"]: r["batch"] for r in rows}

    def _pending(self, held: dict[str, int]) -> dict[str, list[int]]:
        fs, hroot = _fs(self.spark, self.deltas)
        if not fs.exists(hroot):
            return {}
        names = [st.getPath().getName() for st in fs.listStatus(hroot) if st.isDirectory()]
        runs = [n.split("=", 1)[1] for n in names if n.startswith("run=")]
        found = {r: committed_ids(self.spark, f"{self.deltas}/run={r}", "batch", after=held.get(r, -1)) for r in runs}
        return {r: ids for r, ids in found.items() if ids}

    def _data(self, base: int | None) -> DataFrame:
        if base is None:
            return self.spark.createDataFrame([], self.table_schema)
        return self.spark.read.schema(self.table_schema).parquet(f"{self.root}/base/v={base}/data=0")

    def _merged(self, base: int | None, pending: dict[str, list[int]], merge_fn) -> DataFrame:
        if not pending:
            return self._data(base)
        folders = [f"{self.deltas}/run={r}/batch={i}" for r, ids in sorted(pending.items()) for i in ids]
        return merge_fn(self._data(base), self.spark.read.schema(self.delta_schema).parquet(*folders))

    def read(self, merge_fn: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        base = max(self.bases(), default=None)
        return self._merged(base, self._pending(self.held(base)), merge_fn)

    def compact(self, merge_fn: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        base = max(self.bases(), default=None)
        held = self.held(base)
        pending = self._pending(held)
        if not pending:
            return
        new = f"{self.root}/base/v={0 if base is None else base + 1}"
        self._merged(base, pending, merge_fn).write.mode("overwrite").parquet(f"{new}/data=0")
        held.update({r: ids[-1] for r, ids in pending.items()})
        rows = self.spark.createDataFrame(sorted(held.items()), "run STRING, batch BIGINT")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{new}/manifest=0")
        fs, mark = _fs(self.spark, f"{new}/_SUCCESS")
        fs.create(mark, True).close()


def expire(*tables: DeltaLogTable) -> int:
    """Remove deltas that the base before the latest of every table holds (readers of the latest base miss none), and
    bases older than that; returns the number of deltas removed."""
    keep = [sorted(t.bases())[-2:] for t in tables]
    if any(len(b) < 2 for b in keep):
        return 0
    held = [t.held(b[0]) for t, b in zip(tables, keep, strict=True)]
    removed = 0
    for run in set.intersection(*(set(h) for h in held)):
        last = min(h[run] for h in held)
        for i in committed_ids(tables[0].spark, f"{tables[0].deltas}/run={run}", "batch"):
            if i <= last:
                fs, path = _fs(tables[0].spark, f"{tables[0].deltas}/run={run}/batch={i}")
                removed += bool(fs.delete(path, True))
    for t, b in zip(tables, keep, strict=True):
        for v in t.bases():
            if v < b[0]:
                fs, path = _fs(t.spark, f"{t.root}/base/v={v}")
                fs.delete(path, True)
    return removed


class DatedTable:
    """A keyed table with one folder per date: writing some dates replaces those folders and no others.

    Two reports of different dates can be written at the same time; neither can
    lose the other's rows, and a rerun replaces its own.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str = "date"):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key

    def replace(self, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.key).parquet(self.root))

    def read(self) -> DataFrame:
        fs, root = _fs(self.spark, self.root)
        if not fs.exists(root) or not any(st.getPath().getName().startswith(f"{self.key}=") for st in fs.listStatus(root)):
            return self.spark.createDataFrame([], self.schema)
        empty = self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(empty.schema).parquet(self.root).select(empty.columns)


def batch_folder_writer(root: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: batch ``n`` goes to ``root/batch=<n>``, overwritten on replay."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    return write


def read_last_batch(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """The latest committed batch (the whole result table of a complete-mode query)."""
    ids = committed_ids(spark, root, "batch")
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(f"{root}/batch={ids[-1]}")


def read_all_batches(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All committed batches (the output of an append-mode query)."""
    ids = committed_ids(spark, root, "batch")
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*[f"{root}/batch={i}" for i in ids])
