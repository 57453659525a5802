"""Tables in and between steps, and the code that tasks need."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path, ship_code

#: Keys that are broadcast at most (some 50 MB where they are held); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Bytes of a batch that goes between Spark and Python at most, unless the session has a setting of its own.
BATCH_BYTES = "8m"
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str) -> None:
    """Bound batches to ``size`` in this session, unless it has a bound of its own."""
    if spark.conf.get(_BATCH_CONF, None) in (None, "64MB", "67108864b", "67108864", BATCH_BYTES):
        spark.conf.set(_BATCH_CONF, size)


def prepare(spark: SparkSession) -> None:
    """What every operator needs of its session: code on the executors and batches that fit beside other workers.

    The package's code is sent once per application, as ``--py-files`` would; nothing is sent where it came from an
    archive itself. Batches are bounded in bytes if the session has the default bound: long texts come in small batches.
    """
    ship_code(spark)
    if spark.conf.get(_BATCH_CONF, None) in (None, "64MB", "67108864b", "67108864"):
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def tidy() -> None:
    """Give memory that is free back to the system: a worker lives on and works for other operators beside its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def tidied(function):
    """A function over a task's batches that tidies up after each of them."""

    @wraps(function)
    def run(batches, *args, **named):
        def each():
            for batch in batches:
                yield batch
                del batch
                tidy()

        yield from function(each(), *args, **named)
        tidy()

    return run


_scopes: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collects the paths of the tables that are written inside."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield paths
    finally:
        _scopes.remove(paths)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Remove written tables that nothing reads any more."""
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def matched(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``keys``, a written table that is counted first: up to ``BROADCAST_ROWS`` keys go to the rows,
    so that these stay where they are; more meet them by a shuffle of both."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on, how)


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under the session's shared folder, read back.

    A written table cuts lineage, lives in the shared folder and survives lost executors.
    """
    path = scratch_path(spark, f"llm-{name}")
    for paths in _scopes:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
