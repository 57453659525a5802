"""Session construction and the shared scratch folder.

Library code never builds its own session: every function takes the caller's
``SparkSession``. ``local_session`` exists for tests, the bench and the smoke
entry point.

Intermediate data (stream checkpoints, derived fixture files, table versions)
goes under the folder the cluster names in ``spark.checkpoint.dir``. That folder
must be shared storage (HDFS, object store) on a cluster, so a lost executor
does not take its files with it. Only when the setting is missing *and* the
master is local do we pick a temporary folder ourselves.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session tuned like the cluster one (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # plans name every folder that a scan prunes to
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.driver.memory", "8g")
        # GB2312 text logs need the legacy JDK charset list.
        .config("spark.sql.legacy.javaCharsets", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


# Settings for a large cluster (hundreds of TB of logs). Applied by the deployment, not by library code:
# ``cli.py cluster-conf > cluster.conf`` writes them for ``spark-submit --properties-file cluster.conf``.
CLUSTER_CONF = {
    # start with many shuffle partitions; AQE coalesces them to ~advisory size at run time
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast only on measured sizes: no estimate-based broadcast at planning time; AQE converts a join
    # to a broadcast after the shuffle has measured the small side (explicit hints stay for proven bounds)
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # input splits of 256 MB keep tasks short and memory-safe
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    # sliding-window state of millions of (window, user) keys: RocksDB, not the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # shared storage for stream checkpoints, derived files and table versions
    # "spark.checkpoint.dir": "hdfs:///shared/checkpoints",
}


def configure(spark: SparkSession) -> None:
    """Settings every job in this package relies on; safe to call repeatedly. The caller's time zone stays as it is."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    if spark.conf.get("spark.sql.adaptive.enabled", "true") != "true":
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Set only when unset and running locally (tests, bench); on a cluster a
    missing setting is an error rather than a silent machine-local path.
    """
    sc = spark.sparkContext
    base = (
        spark.conf.get(CHECKPOINT_CONF, None)
        or sc.getConf().get(CHECKPOINT_CONF, None)
        or sc.getCheckpointDir()
    )
    if not base:
        if not _is_local(spark):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would, for operators whose tasks run
    Python; nothing is sent where the code came from an archive itself."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId not in _shipped and package.is_dir():
        folder = os.path.realpath(tempfile.mkdtemp(prefix="tessera-code-"))
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}-code", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
