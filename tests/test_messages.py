"""The message format: offsets, start positions, restarts, and writers that fail."""

import datetime as dt
import json

import pyarrow as pa
import pytest

from tessera.streaming import messages
from tessera.streaming.messages import Topic
from tessera.streaming.runner import run_available
from tessera.streaming.sinks import batch_folder_writer, read_all_batches
from tessera.streaming.sources import stream_lines

T0 = dt.datetime(2024, 1, 1)


def lines(spark, first, n, partitions=3):
    return spark.range(first, first + n, 1, partitions).selectExpr("concat('m', id) AS value", "timestampadd(SECOND, id, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS timestamp", "id AS offset")


def values(df):
    return sorted(int(r.value[1:]) for r in df.collect())


class Consumer:
    """A stream over a topic that runs, stops and starts again from its checkpoint."""

    def __init__(self, spark, scratch, root, **options):
        self.spark, self.root, self.options, self.out, self.ckpt = spark, root, options, scratch("out"), scratch("ckpt")

    def run(self):
        stream = self.spark.readStream.format("messages").options(**self.options).load(self.root)
        run_available(stream, batch_folder_writer(self.out), self.ckpt)
        return values(read_all_batches(self.spark, self.out, "value string"))


def test_append_and_read(spark, scratch):
    root = scratch("topic")
    messages.append(lines(spark, 0, 10), root, 2)
    messages.append(lines(spark, 10, 7, 4), root, 9)  # the topic keeps its partitions
    messages.append(lines(spark, 0, 5).where("false"), root)
    rows = spark.read.format("messages").load(root).collect()
    assert sorted(int(r.value[1:]) for r in rows) == list(range(17))
    assert all(r.timestamp == T0 + dt.timedelta(seconds=int(r.value[1:])) for r in rows)
    for p in (0, 1):
        offsets = sorted(r.offset for r in rows if r.partition == p)
        assert offsets == list(range(len(offsets)))
    end = Topic(root).last()["end"]
    assert set(end) == {"0", "1"} and sum(end.values()) == 17
    some = spark.read.format("messages").option("startingOffsets", json.dumps({"0": end["0"] - 2, "1": end["1"]})).load(root)
    assert {(r.partition, r.offset) for r in some.collect()} == {(0, end["0"] - 2), (0, end["0"] - 1)}
    assert spark.read.format("messages").load(scratch("none")).count() == 0
    with pytest.raises(Exception, match="appended"):
        lines(spark, 0, 1).select("value", "timestamp").write.format("messages").mode("overwrite").save(root)


def test_latest_gives_only_what_comes_later_and_a_restart_each_once(spark, scratch):
    root = scratch("topic")
    messages.append(lines(spark, 0, 10), root)
    later, all_ = Consumer(spark, scratch, root, startingOffsets="latest", group="g"), Consumer(spark, scratch, root, startingOffsets="earliest")
    assert later.run() == [] and all_.run() == list(range(10))
    messages.append(lines(spark, 10, 6), root)
    assert later.run() == list(range(10, 16)) and all_.run() == list(range(16))
    assert later.run() == list(range(10, 16))  # nothing new
    messages.append(lines(spark, 16, 1), root)
    messages.append(lines(spark, 17, 5, 7), root)
    assert later.run() == list(range(10, 22)) and all_.run() == list(range(22))


def test_a_batch_lists_only_the_appends_it_needs(spark, scratch, monkeypatch):
    root = scratch("topic")
    topic, opened = Topic(root), []
    for k in range(30):
        topic.commit([messages.Wrote(0, f"f{k}", 10)], 2)
    monkeypatch.setattr(Topic, "append", lambda self, n, f=Topic.append: (opened.append(n), f(self, n))[1])
    got = topic.ranges({"0": 285, "1": 0}, topic.last()["end"])
    assert [(r.file, r.lo, r.hi) for r in got] == [("f28", 285, 290), ("f29", 290, 300)] and set(opened) == {28, 29}


def test_large_files_are_read_by_several_tasks(scratch, monkeypatch):
    monkeypatch.setattr(messages, "TASK_ROWS", 4)
    monkeypatch.setattr(messages, "BATCH_ROWS", 3)
    topic = Topic(scratch("topic"))
    batch = pa.RecordBatch.from_pydict({"value": [f"m{i}" for i in range(10)], "timestamp": pa.array([T0] * 10, pa.timestamp("us"))})
    name, count = topic.write_file(iter([batch]))
    topic.commit([messages.Wrote(3, name, count)], 2)
    parts = topic.ranges({}, topic.last()["end"])
    assert [(r.partition, r.lo, r.hi) for r in parts] == [(1, 0, 4), (1, 4, 8), (1, 8, 10)]
    assert [v for r in parts for b in topic.read(r) for v in b.column("value").to_pylist()] == [f"m{i}" for i in range(10)]


def test_a_task_that_fails_and_runs_again_leaves_one_copy(scratch):
    topic = Topic(scratch("topic"))
    batch = pa.RecordBatch.from_pydict({"value": ["a", "b"], "timestamp": pa.array([T0] * 2, pa.timestamp("us"))})

    def fails():
        yield batch
        raise OSError("lost executor")

    with pytest.raises(OSError):
        topic.write_file(fails())
    topic.write_file(iter([batch]))  # written in whole, but never committed
    name, count = topic.write_file(iter([batch]))
    for _ in range(2):  # the batch comes again after a restart
        topic.commit([messages.Wrote(0, name, count)], 1, "w", 0)
    topic.commit([messages.Wrote(0, *topic.write_file(iter([batch])))], 1, "other", 0)
    got = [v for r in topic.ranges({}, topic.last()["end"]) for b in topic.read(r) for v in b.column("value").to_pylist()]
    assert got == ["a", "b", "a", "b"] and topic.last()["writers"] == {"w": 0, "other": 0}


def test_a_failing_task_of_a_job(spark, scratch):
    """A job whose tasks fail leaves nothing that a reader sees; the next append is whole."""
    root = scratch("topic")
    bad = lines(spark, 0, 9).selectExpr("IF(offset = 5, CAST(raise_error('broken') AS STRING), value) AS value", "timestamp")
    with pytest.raises(Exception, match="broken"):
        messages.append(bad, root)
    assert spark.read.format("messages").load(root).count() == 0
    messages.append(lines(spark, 0, 9), root)
    assert values(spark.read.format("messages").load(root)) == list(range(9))


def test_stream_to_stream(spark, scratch):
    """A stream writes what it reads to a second topic; a restart adds only what is new."""
    root, copy, ckpt = scratch("topic"), scratch("copy"), scratch("ckpt")
    for first in (0, 10):
        messages.append(lines(spark, first, 10), root)
        stream = spark.readStream.format("messages").option("startingOffsets", "earliest").load(root)
        query = stream.select("value", "timestamp").writeStream.format("messages").option("writer", "copy").option("checkpointLocation", ckpt).trigger(availableNow=True).start(copy)
        query.awaitTermination()
        assert query.exception() is None
        assert values(spark.read.format("messages").load(copy)) == list(range(first + 10))


def test_stream_lines_takes_a_start_position(spark, scratch):
    root, out, ckpt = scratch("topic"), scratch("out"), scratch("ckpt")
    messages.append(lines(spark, 0, 4), root)
    for n in (0, 3):
        if n:
            messages.append(lines(spark, 4, n), root)
        run_available(stream_lines(spark, root, fmt="messages"), batch_folder_writer(out), ckpt)
    got = read_all_batches(spark, out)
    assert got.columns == ["value", "ingest_ts"] and values(got) == [4, 5, 6]
    with pytest.raises(ValueError):
        stream_lines(spark, root, fmt="text", starting_offsets="latest")
