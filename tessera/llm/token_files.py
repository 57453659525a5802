"""Token ids in Arrow files of equal-length sequences.

The ids of all documents, each with an end id, form one stream in ascending
doc_id order. Every range partition writes its part as an Arrow IPC file (the
stream format with a footer) of fixed-size lists: ``ids`` (16 bits a token if
the vocabulary allows it), ``mask`` (false for the padding of a file's last
sequence) and ``begins`` (true at a document's first token). Sequence i of a
file lies at a place known beforehand and is read without a copy. A second
file lists the documents. The manifest names the files that count, so an
attempt lost with its executor leaves nothing behind that is read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import chunks as C
from tessera.llm import shared_files as S
from tessera.llm.stage import prepare, tidied, written
from tessera.session import scratch_path

SEQUENCE_TOKENS = 2048
#: Sequences a batch: 1 MB of 16-bit ids.
BATCH_SEQUENCES = 256

_MANIFEST = "part int, file string, documents string, n_docs long, n_ids long"
_MADE = pa.schema([("part", pa.int32()), ("file", pa.string()), ("documents", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class LibraryEncoder:
    """The tokenizers library, asked once for each distinct chunk of a block that isn't remembered.

    Chunks go to it joined, so many bytes at a time, where the place between two of them is a boundary in any text; the
    bytes that each token stands for then tell where a chunk's ids end.
    """

    JOINED_BYTES = 1 << 14

    def __init__(self, text: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_str(text)
        self.known = C.Remembered(250_000)
        # in a byte-level vocabulary each character of a token is a byte; elsewhere the lengths don't add up and chunks go alone
        self.sizes = np.array([len(self.library.id_to_token(i) or "") for i in range(self.library.get_vocab_size(with_added_tokens=True))], np.int64)

    def _alone(self, chunks: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast([c.decode() for c in chunks], add_special_tokens=False)]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        ends = np.cumsum([len(c) for c in chunks])
        data = np.frombuffer(b"".join(chunks), np.uint8)
        sure = np.isin(ends, C.after_blanks(data, np.array([0, len(data)])))
        groups, begin, first = [], 0, 0
        for i, (end, cut) in enumerate(zip(ends.tolist(), sure.tolist(), strict=True)):
            if not cut or end - begin >= self.JOINED_BYTES or i + 1 == len(chunks):
                groups.append((first, i + 1, begin, end))
                begin, first = end, i + 1
        raw = data.tobytes()
        out: list[bytes] = []
        for (a, b, begin, end), ids in zip(groups, self._alone([raw[x:y] for _, _, x, y in groups]), strict=True):
            upto = np.cumsum(self.sizes[ids])
            places = np.searchsorted(upto, ends[a:b] - begin)
            if not len(ids) or upto[-1] != end - begin or (upto[places] != ends[a:b] - begin).any():
                out += [x.tobytes() for x in self._alone(chunks[a:b])]
                continue
            own, at = ids.tobytes(), [0, *((places + 1) * 4).tolist()]
            out += [own[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each row's begin) of rows of text."""
        places = C.after_blanks(data, offsets)
        numbers, chunks = C.distinct(data, places)
        raw, at = C.rejoined(self.known.all(chunks, self._ids), numbers, np.searchsorted(places, offsets))
        return raw.view("<u4"), at // 4


@lru_cache(maxsize=2)
def _encoder(text: str) -> LibraryEncoder:
    return LibraryEncoder(text)


def sequence_schema(length: int, wide: bool) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("mask", pa.list_(pa.bool_(), length)), ("begins", pa.list_(pa.bool_(), length))])


class SequenceWriter:
    """Appends tokens to an Arrow file of sequences; full batches leave memory at once."""

    def __init__(self, sink, length: int, wide: bool):
        self.schema, self.length, self.n = sequence_schema(length, wide), length, 0
        self.kind = np.uint32 if wide else np.uint16
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.ids, self.begins = np.zeros(0, self.kind), np.zeros(0, bool)

    def append(self, ids: np.ndarray, begins: np.ndarray) -> None:
        self.n += len(ids)
        self.ids = np.concatenate([self.ids, ids.astype(self.kind)])
        self.begins = np.concatenate([self.begins, begins])
        step = self.length * BATCH_SEQUENCES
        while len(self.ids) >= step:
            self._write(self.ids[:step], self.begins[:step], step)
            self.ids, self.begins = self.ids[step:], self.begins[step:]

    def _write(self, ids: np.ndarray, begins: np.ndarray, real: int) -> None:
        parts = [ids, np.arange(len(ids)) < real, begins]
        self.writer.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip(parts, self.schema, strict=True)], schema=self.schema))

    def close(self) -> None:
        if real := len(self.ids):
            padding = -real % self.length
            self._write(np.pad(self.ids, (0, padding)), np.pad(self.begins, (0, padding)), real)
        self.writer.close()


class SequenceFile:
    """A written file of sequences, mapped into memory where the file system allows it."""

    def __init__(self, folder: str, name: str):
        system, path = S.opened(folder)
        local = system.type_name == "local"
        self.source = pa.memory_map(S.join(path, name)) if local else system.open_input_file(S.join(path, name))
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; the ids are a view of the file."""
        batch = self.reader.get_batch(i // BATCH_SEQUENCES)
        row = batch.slice(i % BATCH_SEQUENCES, 1)
        return np.asarray(row.column("ids").flatten()), np.asarray(row.column("mask").flatten().cast(pa.uint8())).view(bool)

    def tokens(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, begins) without padding, batch by batch."""
        for i in range(self.reader.num_record_batches):
            batch = self.reader.get_batch(i)
            real = np.asarray(batch.column("mask").flatten().cast(pa.uint8())).view(bool)
            begins = np.asarray(batch.column("begins").flatten().cast(pa.uint8())).view(bool)
            yield np.asarray(batch.column("ids").flatten())[real], begins[real]

    def close(self) -> None:
        self.source.close()


@tidied
def _saved(batches: Iterator[pa.RecordBatch], sent, folder: str, end_id: int, length: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    encoder = _encoder(sent.value)
    wide = max(encoder.library.get_vocab_size(with_added_tokens=True), end_id + 1) > 1 << 16
    names = S.attempt_name(part, "arrow"), S.attempt_name(part, "documents.arrow")
    writer = index = None
    n_docs = 0
    system, path = S.opened(folder)
    for batch in batches:
        data, offsets, ranges = C.text_ranges(batch.column("text"))
        for lo, hi in ranges:
            if writer is None:
                sinks = [system.open_output_stream(S.join(path, name)) for name in names]
                writer, index = SequenceWriter(sinks[0], length, wide), pa.ipc.new_file(sinks[1], _INDEX)
            own = offsets[lo : hi + 1]
            ids, at = encoder.encode(data[own[0] : own[-1]], own - own[0])
            ids = np.insert(ids, at[1:], end_id)
            at = at + np.arange(len(at))
            begins = np.zeros(len(ids), bool)
            begins[at[:-1]] = True
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(at[:-1] + writer.n), pa.array(np.diff(at))], schema=_INDEX))
            writer.append(ids, begins)
            n_docs += hi - lo
    if writer is not None:
        writer.close()
        index.close()
        for sink in sinks:
            sink.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "file": names[0], "documents": names[1], "n_docs": n_docs, "n_ids": writer.n}], schema=_MADE)


def save(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *,
         end_id: int = 2, length: int = SEQUENCE_TOKENS) -> tuple[str, DataFrame]:
    """Write the token files of ``docs``; returns their folder (shared) and the manifest, a row per file.

    Documents come in ascending id order (nulls first; rows of one id by their text). Null and empty texts have only
    the end id. A table without rows gives no files. Other columns play no part.
    """
    prepare(spark)
    folder = scratch_path(spark, "llm-tokens")
    system, place = S.opened(folder)
    system.create_dir(place, recursive=True)
    with open(path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # by id and text, so that an id that repeats over many texts spreads over files
    own = own.withColumn("hash", F.xxhash64("text")).repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")
    manifest = own.mapInArrow(partial(_saved, sent=sent, folder=folder, end_id=end_id, length=length), _MANIFEST)
    return folder, written(spark, manifest, "token-manifest")


def _loaded(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, path = S.opened(folder)
    for batch in batches:
        for row in batch.to_pylist():
            file = SequenceFile(folder, row["file"])
            with system.open_input_file(S.join(path, row["documents"])) as source:
                index = pa.ipc.open_file(source)
                tokens, ids, at = file.tokens(), np.zeros(0, "<u4"), 0
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    starts, sizes = np.asarray(part.column("start")), np.asarray(part.column("n_tokens"))
                    sums = []
                    for n in sizes.tolist():
                        crc = 0
                        while n:  # a document may span batches of sequences: its checksum goes on over them
                            if at == len(ids):
                                ids, at = next(tokens)[0].astype("<u4"), 0
                            own = ids[at : at + n]
                            crc, at, n = zlib.crc32(own, crc), at + len(own), n - len(own)
                        sums.append(crc)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(starts + row["base"]), part.column("n_tokens"), pa.array(sums, pa.int64()),
                                                      pa.array([row["file"]] * len(sums)), part.column("start")], ["doc_id", "start", "n_tokens", "ids_crc32", "file", "start_in_file"])
            file.close()


def load(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, start_in_file) of every document, read from the files.

    start counts the ids of all documents before it. The manifest comes to the driver: a row per file, as many as
    there were range partitions.
    """
    rows, base = [], 0
    for r in manifest.orderBy("part").collect():
        rows.append((r.part, r.file, r.documents, base))
        base += r.n_ids
    files = spark.createDataFrame(rows, "part int, file string, documents string, base long")
    files = files.repartitionByRange(max(len(rows), 1), "part")
    return files.mapInArrow(partial(_loaded, folder=folder), "doc_id long, start long, n_tokens long, ids_crc32 long, file string, start_in_file long")


def round_trip(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, end_id: int = 2) -> DataFrame:
    """What ``load`` gives of the files that ``save`` writes."""
    return load(spark, *save(spark, docs, path, id_col, text_col, end_id=end_id))
