"""Messages with partitions and offsets in shared storage: a stream source and sink of their own (SRC-3, SRC-4, STR-11, SNK-4).

What a broker topic gives a stream, without a broker: numbered messages, a start
position (``earliest``, ``latest`` or offsets), and each message once over
restarts. The format is written with Spark's Python data source API, so it is
used as any other:

    spark.dataSource.register(MessageSource)      # ``register(spark)`` also ships the code
    df.write.format("messages").mode("append").option("partitions", 4).save(root)
    spark.readStream.format("messages").option("startingOffsets", "latest").load(root)
    stream.writeStream.format("messages").option("writer", "w1").start(root)

A topic folder holds

    data/<name>.parquet   what one task wrote: open, process, close
    index/<n>.json        append n: its files with partition, first offset and count, and where every partition ends

The tasks of an append only write files of their own; the append counts when its
index file is put in place, once, after all tasks have said what they wrote. A
task that fails and runs again leaves a file that no index names; a batch that a
restarted stream writes again is known by (writer, batch) and adds nothing. One
append at a time: writers of the same topic take turns.

An ``availableNow`` run takes what is there as one batch (Spark gives sources in Python no limits), and no
empty batch after it: windows that it closes come with the next batch that has messages.

Messages travel as Arrow batches between files, tasks and Spark. Readers list
the index files that a batch needs, newest first, so a batch costs what it
reads, whatever the topic's age.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from tessera.session import ship_code

FORMAT = "messages"
SCHEMA = "value STRING, timestamp TIMESTAMP_NTZ, partition INT, offset BIGINT"
#: Partitions of a topic unless its first append says otherwise.
PARTITIONS = 4
#: Messages that one task reads at most, and that a batch between file and Spark holds.
TASK_ROWS, BATCH_ROWS = 1_000_000, 10_000
_STORED = pa.schema([("value", pa.string()), ("timestamp", pa.timestamp("us"))])


class Topic:
    """The files of a topic, on any file system that has an address."""

    def __init__(self, root: str):
        if "://" not in root and root.startswith("file:"):
            root = "file://" + root.removeprefix("file:")
        self.fs, self.root = pafs.FileSystem.from_uri(root)

    def path(self, *parts: str) -> str:
        return posixpath.join(self.root, *parts)

    def numbers(self) -> list[int]:
        """Appends, in order."""
        found = self.fs.get_file_info(pafs.FileSelector(self.path("index"), allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))

    def append(self, number: int) -> dict:
        with self.fs.open_input_stream(self.path("index", f"{number:012d}.json")) as file:
            return json.loads(file.read())

    def last(self) -> dict:
        numbers = self.numbers()
        return self.append(numbers[-1]) | {"number": numbers[-1]} if numbers else {"number": -1, "end": {}, "writers": {}, "files": []}

    def put(self, folder: str, name: str, content: dict) -> None:
        """A small file, complete when it can be seen."""
        self.fs.create_dir(self.path(folder), recursive=True)
        staged = self.path(folder, f".{name}-{uuid.uuid4().hex}")
        with self.fs.open_output_stream(staged) as file:
            file.write(json.dumps(content).encode())
        self.fs.move(staged, self.path(folder, name))

    def write_file(self, batches: Iterator[pa.RecordBatch]) -> tuple[str, int] | None:
        """A task's messages as a new file; None if there are none."""
        name, writer, count = f"{uuid.uuid4().hex}.parquet", None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.table({"value": batch.column("value"), "timestamp": batch.column("timestamp")}).cast(pa.schema([("value", pa.string()), ("timestamp", batch.schema.field("timestamp").type)]))
            rows = pa.table([rows.column("value"), rows.column("timestamp").cast(pa.timestamp("us", tz=rows.schema.field("timestamp").type.tz)).cast(pa.timestamp("us"))], schema=_STORED)
            if writer is None:
                self.fs.create_dir(self.path("data"), recursive=True)
                out = self.fs.open_output_stream(self.path("data", name))
                writer = pq.ParquetWriter(out, _STORED, compression="zstd")
            writer.write_table(rows)
            count += rows.num_rows
        if writer is None:
            return None
        writer.close()
        out.close()
        return name, count

    def commit(self, wrote: list[Wrote], partitions: int, writer: str | None = None, batch: int | None = None) -> None:
        """Put an append in place: its files, numbered on from where their partitions end."""
        last = self.last()
        if writer is not None and last["writers"].get(writer, -1) >= batch:
            return  # this batch is there already
        begin = dict(last["end"])
        n = last.get("partitions", partitions)
        end = {str(p): begin.get(str(p), 0) for p in range(n)}
        files = []
        for w in sorted(wrote, key=lambda w: w.task):
            p = str(w.task % n)
            files.append({"partition": int(p), "first": end[p], "count": w.count, "file": w.file})
            end[p] += w.count
        writers = last["writers"] | ({writer: batch} if writer is not None else {})
        self.put("index", f"{last['number'] + 1:012d}.json", {"partitions": n, "begin": begin, "end": end, "writers": writers, "files": files})

    def ranges(self, start: dict[str, int], end: dict[str, int]) -> list[Range]:
        """The parts of files that hold the offsets from ``start`` to before ``end``."""
        out = []
        for number in reversed(self.numbers()):
            one = self.append(number)
            for f in one["files"]:
                lo = max(f["first"], start.get(str(f["partition"]), 0))
                hi = min(f["first"] + f["count"], end.get(str(f["partition"]), 0))
                out += [Range(f["file"], f["partition"], f["first"], a, min(a + TASK_ROWS, hi)) for a in range(lo, hi, TASK_ROWS)]
            if all(one["begin"].get(p, 0) <= start.get(p, 0) for p in one["end"]):
                break  # older appends lie before the start
        return sorted(out, key=lambda r: (r.partition, r.lo))

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(self.path("data", part.file)) as file:
            at = part.first
            for batch in pq.ParquetFile(file).iter_batches(BATCH_ROWS):
                a, b = max(part.lo - at, 0), min(part.hi - at, batch.num_rows)
                if a < b:
                    own = batch.slice(a, b - a)
                    offsets = pa.array(range(at + a, at + b), pa.int64())
                    yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array([part.partition] * (b - a), pa.int32()), offsets], ["value", "timestamp", "partition", "offset"])
                at += batch.num_rows
                if at >= part.hi:
                    break


@dataclass
class Range(InputPartition):
    """Offsets ``lo`` to before ``hi`` of a partition, in a file that begins with offset ``first``."""

    file: str
    partition: int
    first: int
    lo: int
    hi: int


@dataclass
class Wrote(WriterCommitMessage):
    task: int
    file: str
    count: int


def _start(topic: Topic, position: str) -> dict[str, int]:
    end = topic.last()["end"]
    if position == "latest":
        return end
    if position == "earliest":
        return {p: 0 for p in end}
    given = json.loads(position)
    return {p: int(given.get(p, 0)) for p in sorted({*end, *given})}


class _Batch(DataSourceReader):
    def __init__(self, root: str, position: str):
        self.root, self.position = root, position

    def partitions(self) -> list[Range]:
        topic = Topic(self.root)
        return topic.ranges(_start(topic, self.position), topic.last()["end"]) or [Range("", 0, 0, 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return Topic(self.root).read(partition) if partition.file else iter(())


class _Stream(DataSourceStreamReader):
    """Offsets are the next message of each partition; the checkpoint keeps them, so a restart goes on where it was."""

    def __init__(self, root: str, position: str, group: str | None):
        self.root, self.position, self.group = root, position, group

    def initialOffset(self) -> dict:
        return _start(Topic(self.root), self.position)

    def latestOffset(self) -> dict:
        return Topic(self.root).last()["end"]

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return Topic(self.root).ranges(start, end)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return Topic(self.root).read(partition)

    def commit(self, end: dict) -> None:
        """Note how far the group has come, for whoever watches its lag."""
        if self.group:
            Topic(self.root).put("groups", f"{self.group}.json", end)


class _Writing:
    """Open, process and close of a task: one file, and what it holds."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        from pyspark import TaskContext

        found = Topic(self.root).write_file(iterator)
        return Wrote(TaskContext.get().partitionId(), *(found or ("", 0)))

    @staticmethod
    def _kept(messages) -> list[Wrote]:
        return [m for m in messages if m is not None and m.count]


class _BatchWriter(_Writing, DataSourceArrowWriter):
    def __init__(self, root: str, partitions: int):
        self.root, self.parts = root, partitions

    def commit(self, messages) -> None:
        Topic(self.root).commit(self._kept(messages), self.parts)

    def abort(self, messages) -> None:
        """No index names the files: nothing to take back."""


class _StreamWriter(_Writing, DataSourceStreamArrowWriter):
    def __init__(self, root: str, partitions: int, writer: str):
        self.root, self.parts, self.writer = root, partitions, writer

    def commit(self, messages, batchId: int) -> None:
        Topic(self.root).commit(self._kept(messages), self.parts, self.writer, batchId)

    def abort(self, messages, batchId: int) -> None:
        """As for a batch."""


class MessageSource(DataSource):
    """Format ``messages``. Options: ``path``; reading: ``startingOffsets`` (``earliest``, the default of a batch read;
    ``latest``, the default of a stream; or JSON such as ``{"0": 12}``), ``group``; writing: ``partitions``, and for a
    stream ``writer``, its name over restarts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def _root(self) -> str:
        return self.options["path"].rstrip("/")

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self._root(), self.options.get("startingOffsets", "earliest"))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self._root(), self.options.get("startingOffsets", "latest"), self.options.get("group"))

    def _parts(self) -> int:
        return int(self.options.get("partitions", PARTITIONS))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("messages are appended")
        return _BatchWriter(self._root(), self._parts())

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        if "writer" not in self.options:
            raise ValueError("option writer: the stream's name over restarts")
        return _StreamWriter(self._root(), self._parts(), self.options["writer"])


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and the code to its executors."""
    ship_code(spark)
    spark.dataSource.register(MessageSource)


def append(messages, root: str, partitions: int = PARTITIONS) -> None:
    """Append ``messages`` (value, timestamp) to a topic."""
    register(messages.sparkSession)
    messages.select("value", "timestamp").write.format(FORMAT).mode("append").option("partitions", partitions).save(root)
