"""WARC archives of pages: writing with revisit records, and a sequential reader.

Writing: of pages with equal payloads of ``REVISIT_BYTES`` or more, that with
the smallest page_id is a response record, the others are revisit records that
refer to it and carry no payload.  Which is which is settled by one aggregation
on the payload's digest.  A task writes its partition as one archive, every
record a gzip member of its own.

Reading: an archive is read once from front to end, a few kilobytes at a time.
Each member is inflated incrementally; the record's header ends at an empty
line, its block is framed by Content-Length, the payload follows the block's
HTTP header.  Digests of the block and the payload are computed and compared;
a truncated member, a wrong length or a wrong digest raises ``DamagedArchive``.

Defined results: null html: an empty payload; null url: no target URI; equal
payloads under 100 bytes: all responses; repeated rows (one page_id twice,
equal payloads): both are named as their own response; null page_id: never
the one referred to while another has an id, and named by no id.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import files
from ledgerline.llm.common import ready, stored
from ledgerline.session import scratch_path

REVISIT_BYTES = 100
READ_BYTES = 1 << 16
#: Tasks that read archives at most; beyond that a task reads several, one after another.
READ_TASKS = 10_000
RECORD = "urn:page:"
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

COLUMNS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class DamagedArchive(ValueError):
    """An archive that breaks off, or whose lengths or digests don't hold."""


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member: a response, or a revisit of ``refers_to`` without its payload."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{RECORD}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{RECORD}{refers_to}>" if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None)
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(stream, size: int = READ_BYTES) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one after another."""
    rest = stream.read(size)
    while rest:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not rest:
                raise DamagedArchive("the archive breaks off within a record")
            try:
                out.append(unpacker.decompress(rest))
            except zlib.error as e:
                raise DamagedArchive(str(e)) from e
            rest = unpacker.unused_data if unpacker.eof else stream.read(size)
        yield b"".join(out)
        rest = rest or stream.read(size)


def parsed(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields by lower-case name, HTTP header, payload) of a record, its lengths and digests verified."""
    head, gap, body = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        raise DamagedArchive("no record header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    block, tail = body[:length], body[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise DamagedArchive(f"a block of {len(body)} bytes, not {length}")
    if _digest(block) != fields["warc-block-digest"]:
        raise DamagedArchive("the block's digest doesn't hold")
    http, _, payload = block.partition(b"\r\n\r\n")
    if fields["warc-type"] != "revisit" and _digest(payload) != fields["warc-payload-digest"]:
        raise DamagedArchive("the payload's digest doesn't hold")
    return fields, http, payload


def _write_archive(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    name, n = f"{folder}/pages-{TaskContext.get().partitionId():06d}.warc.gz", 0
    first = next(batches, None)
    if first is None:
        return
    with files.written(name) as out:
        while first is not None:
            columns = (first.column(c) for c in ("page_id", "url", "html", "refers_to"))
            for page_id, url, html, refers in zip(*columns, strict=True):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                out.write(record(page_id.as_py(), url.as_py(), payload, refers.as_py()))
                n += 1
            first = next(batches, None)
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n])], ["file", "records"])


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives of ``pages`` to ``folder`` (shared) and returns their list: file, records."""
    ready(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    # One row per payload that occurs twice; equal payloads combine before the shuffle.
    first = (
        rows.where(f"octet_length(html) >= {REVISIT_BYTES}")
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select("digest", "first")
    )
    # An equal page_id is the response itself; the rest refer to it.
    # Rows that can't be revisits have a key of their own, so that the many empty payloads don't meet in one task.
    key = F.when(F.octet_length("html") >= REVISIT_BYTES, F.col("digest")).otherwise(F.concat(F.lit("short "), F.xxhash64("page_id", "url").cast("string")))
    dealt = rows.withColumn("key", key).join(first.withColumnRenamed("digest", "key"), "key", "left").select(
        "page_id", "url", "html", F.expr("if(page_id <=> first, null, first)").alias("refers_to")
    )
    return stored(dealt.mapInArrow(partial(_write_archive, folder=folder), "file string, records long"), "warc-list")


def _number(field: str | None) -> int | None:
    text = (field or "").strip("<>").removeprefix(RECORD)
    return int(text) if text else None


def _read_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, records in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist(), strict=True):
            rows, n = [], 0
            with files.opened(name) as stream:
                for member in members(stream):
                    fields, http, _ = parsed(member)
                    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    rows.append((_number(fields["warc-record-id"]), size, digest, fields["warc-type"], _number(fields.get("warc-refers-to"))))
                    n += 1
                    if len(rows) == 4096:
                        yield _batch(rows)
                        rows = []
            if n != records:
                raise DamagedArchive(f"{name}: {n} records, not {records}")
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def read(archives: DataFrame) -> DataFrame:
    """A row per record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every archive is a task of its own, up to ``READ_TASKS`` tasks.
    """
    tasks = max(1, min(archives.count(), READ_TASKS))
    return archives.select("file", "records").repartitionByRange(tasks, "file").mapInArrow(_read_archives, COLUMNS)


def round_trip(pages: DataFrame) -> DataFrame:
    return read(write(pages, scratch_path(pages.sparkSession, "warc")))
