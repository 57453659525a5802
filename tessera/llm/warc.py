"""WARC records in ZIP archives, written and read by range.

Each task writes one archive to the shared folder: the stored member
``archive/data.warc.gz`` with every record a gzip member of its own, and the
stored member ``indexes/index.cdxj`` with a line per record: page id, offset,
length, type. A reader finds the index through the central directory (ZIP64
where sizes need it) and range-reads the records. Of equal payloads the one
with the smallest page id is stored, the others are revisits of it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zipfile
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import shared_files as S
from tessera.llm.stage import prepare, written
from tessera.llm.zip_reader import ZipRanges
from tessera.session import scratch_path

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Pages have no date of their own; every record carries this one.
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MADE = pa.schema([("part", pa.int32()), ("file", pa.string()), ("records", pa.int64())])


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head with the length of the payload, not the payload."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = head.decode().split("\r\n")
    return first, {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parsed(raw: bytes) -> dict:
    """What a record says, its payload checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, fields = _fields(head)
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(_fields(http)[1]["content-length"])
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
    refers = fields.get("warc-refers-to")
    return {"page_id": _page_id(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": _page_id(refers) if refers else None, "payload": payload if kind == "response" else None}


def _saved(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    name = S.attempt_name(part, "wacz")
    system, path = S.opened(folder)
    archive = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if archive is None:
            sink = system.open_output_stream(S.join(path, name))
            archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True)
            member, at, lines = archive.open(RECORDS, "w", force_zip64=True), 0, []
        for page, url, html, sha1, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "sha1", "refers_to")), strict=True):
            page, refers = page.as_py(), refers.as_py()
            digest = base64.b32encode(bytes.fromhex(sha1.as_py())).decode()
            packed = gzip.compress(record(page, url.as_py(), html.as_py(), digest, refers), 6, mtime=0)
            member.write(packed)
            lines.append(json.dumps({"page": page, "offset": at, "length": len(packed), "type": "response" if refers is None else "revisit"}))
            at += len(packed)
    if archive is not None:
        member.close()
        with archive.open(INDEX, "w", force_zip64=True) as index:
            for line in lines:
                index.write(line.encode() + b"\n")
        archive.close()
        sink.close()
        yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "records": len(lines)}], schema=_MADE)


def save(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
         least_bytes: int = 0) -> tuple[str, DataFrame]:
    """Write the archives of ``pages``; returns their folder (shared) and the manifest, a row per archive.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at least ``least_bytes`` the one
    with the smallest page id is a response and the others revisit it; rows that share that smallest id are all
    responses, and so are rows of a payload that has no page id at all. Other columns play no part.
    """
    prepare(spark)
    folder = scratch_path(spark, "llm-warc")
    system, place = S.opened(folder)
    system.create_dir(place, recursive=True)
    raw = F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b""))
    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), raw.alias("payload"))
    own = own.withColumn("sha1", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    first = own.where(F.col("size") >= least_bytes).groupBy("sha1", "size").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = written(spark, first, "first-pages")  # written, so that the join can be split at a very frequent payload
    own = own.join(first, ["sha1", "size"], "left").withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
    manifest = own.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(partial(_saved, folder=folder), "part int, file string, records long")
    return folder, written(spark, manifest, "warc-manifest")


_LOADED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _loaded(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    schema = _LOADED if payloads else pa.schema(list(_LOADED)[:-1])
    system, path = S.opened(folder)
    for batch in batches:
        for name in batch.column("file").to_pylist():
            with system.open_input_file(S.join(path, name)) as source:
                archive = ZipRanges(source, source.size())
                index = archive.read(INDEX, 0, archive.members[INDEX].size)
                rows: list[dict] = []
                for line in index.splitlines():
                    entry = json.loads(line)
                    rows.append(parsed(gzip.decompress(archive.read(RECORDS, entry["offset"], entry["length"]))))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)


def load(spark: SparkSession, folder: str, manifest: DataFrame, *, payloads: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]) of every record in the archives.

    payload is null for revisits. The manifest's rows, one per archive, are dealt out one to a task.
    """
    files = manifest.select("part", "file")
    files = files.repartitionByRange(max(files.count(), 1), "part")
    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads
    return files.mapInArrow(partial(_loaded, folder=folder, payloads=payloads), fields)


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """What ``load`` gives of the archives that ``save`` writes."""
    return load(spark, *save(spark, pages, id_col, url_col, html_col))
