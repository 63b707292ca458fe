"""WARC archives of pages: writer with revisit records, and a splittable reader.

Each record is a gzip member.  Nothing in a compressed archive says where members start, so a
reading task scans its byte range for the gzip magic, and takes a place for a member only
if what it decodes to begins with a WARC header.  A task owns the records that start inside
its range and reads the last of them to its end beyond it; a member's end shows where the next
starts, so that only the first has to be searched for.

Archives are opened through ``pyarrow.fs`` by the URI of the shared folder.

Archives of other writers are read too: records that hold no page (``warcinfo``, ``request``,
``metadata`` and the like) are passed over, digests and lengths that a record does not state are
taken from its payload, and what cannot be read becomes a row with the reason in ``error``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.workspace import scratch_dir, stored

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
LEAST_REVISIT = 1000  # bytes of a payload from which repeats are written as revisits
FILE_BYTES = 1 << 30
RANGE_BYTES = 32 << 20
BLOCK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
ANSWER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


HELD = ("response", "resource", "revisit")  # types of records that stand for a page


def opened(folder: str) -> tuple[FileSystem, str]:
    """File system and path of a folder.  Hadoop's names of the S3 scheme mean the same here."""
    scheme, colon, rest = folder.partition("://")
    return FileSystem.from_uri(f"s3://{rest}" if colon and scheme in ("s3a", "s3n") else folder)


def marked(pages: DataFrame) -> DataFrame:
    """Add ``payload``, ``payload_digest``, ``payload_bytes`` and ``refers_to`` (NULL for responses).

    Of equal payloads of at least ``LEAST_REVISIT`` bytes, the one with the greatest page_id
    is the response and the others refer to it.  Rows that repeat the greatest page_id are
    responses too; so are all rows of a payload for which no page_id is known.  NULL html is
    the empty payload.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn(
        "payload_bytes", F.octet_length("payload").cast("bigint")
    )
    repeats = (
        rows.where(F.col("payload_bytes") >= LEAST_REVISIT)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    kept = F.col("page_id").eqNullSafe(F.col("keeper"))
    rows = rows.join(repeats, "payload_digest", "left")
    return rows.withColumn("refers_to", F.when(F.col("keeper").isNotNull() & ~kept, F.col("keeper"))).drop("keeper")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member.  Line breaks in a url are percent-encoded."""
    if refers_to is None:
        kind, block = "response", ANSWER + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    else:
        kind, block = "revisit", ANSWER + b"\r\n"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {_name(refers_to)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _written(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        out, path, size, records = None, "", 0, 0

        def manifest() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"file": pa.array([path]), "bytes": pa.array([size], pa.int64()), "records": pa.array([records], pa.int64())}
            )

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "refers_to"))
            for row in zip(*columns, strict=True):
                made = record(*(v.as_py() for v in row))
                if out is None:
                    # a name of its own: an attempt that is run again never writes into another's file
                    path = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, records = store.open_output_stream(f"{root}/{path}", compression=None), 0, 0
                out.write(made)
                size, records = size + len(made), records + 1
                if size >= file_bytes:
                    yield manifest()
                    out = None
        if out is not None:
            yield manifest()

    return run


def write_archives(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> tuple[DataFrame, str]:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``).

    Returns the manifest (``file``, ``bytes``, ``records``), stored, and the folder.  Files that
    the manifest does not name are of task attempts that did not count.  An empty table writes
    no file.
    """
    spark = pages.sparkSession
    folder = (folder or scratch_dir(spark, "warc")).rstrip("/")
    if folder.startswith("/"):
        folder = f"file://{folder}"
    store, root = opened(folder)
    store.create_dir(root, recursive=True)
    rows = marked(pages).select("page_id", "url", "payload", "payload_digest", "refers_to")
    made = rows.mapInArrow(_written(folder, file_bytes), "file string, bytes bigint, records bigint")
    return stored(made, "warc-manifest"), folder


class _Window:
    """A file seen through a buffer that grows forward and is cut behind."""

    def __init__(self, source, start: int, size: int):
        self.source, self.base, self.size, self.data = source, start, size, bytearray()
        source.seek(start)

    def upto(self, place: int) -> bool:
        """Hold bytes up to ``place`` (a place in the file) if there are so many."""
        while self.base + len(self.data) < min(place, self.size):
            more = self.source.read(BLOCK)
            if not more:
                break
            self.data += more
        return self.base + len(self.data) >= place

    def forget(self, place: int) -> None:
        if place - self.base > 4 * BLOCK:
            del self.data[: place - self.base]
            self.base = place


def _starts_record(window: _Window, place: int) -> bool:
    """Whether the gzip member at ``place`` decodes to a WARC header."""
    window.upto(place + 4096)
    try:
        head = zlib.decompressobj(31).decompress(window.data[place - window.base : place - window.base + 4096], 64)
    except zlib.error:
        return False
    return head.startswith(VERSION)


def _member(window: _Window, place: int) -> tuple[bytes, int]:
    """The decoded member at ``place`` and where it ends."""
    unpack, parts, at = zlib.decompressobj(31), [], place
    while not unpack.eof:
        if not window.upto(at + 1):
            raise ValueError(f"archive ends inside the record at byte {place}")
        chunk = window.data[at - window.base :]
        parts.append(unpack.decompress(chunk))
        at += len(chunk) - len(unpack.unused_data)
    return b"".join(parts), at


def _fields(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


def parse(data: bytes) -> dict | None:
    """Fields of a decoded record, None if it stands for no page; a payload is checked against its SHA-1, if stated.

    Raises ValueError for a record that does not hold what its header says.
    """
    head, blank, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind, length = fields.get("warc-type"), fields.get("content-length", "")
    if not blank or kind is None or not length.isdecimal() or int(length) > len(rest):
        raise ValueError(f"record {fields.get('warc-record-id')} has no type, or fewer bytes than it says")
    if kind not in HELD:
        return None
    block = rest[: int(length)]
    method, _, stated = fields.get("warc-payload-digest", "").partition(":")
    digest = payload = size = None
    if method.lower() == "sha1":
        digest = stated.lower() if len(stated) == 40 else base64.b32decode(stated.upper()).hex()
    if kind == "revisit":
        size = int(fields["payload-length"]) if fields.get("payload-length", "").isdecimal() else None
    else:
        # a response over HTTP has that protocol's header first
        http = kind == "response" and block.startswith(b"HTTP/")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        made, size = hashlib.sha1(payload).hexdigest(), len(payload)
        if digest not in (None, made):
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not have its digest")
        digest = made
    return {
        "page_id": _number(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _number(fields.get("warc-refers-to")),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload,
        "error": None,
    }


def records_in_range(source, size: int, start: int, stop: int) -> Iterator[tuple[int, bytes | Exception]]:
    """Place and decoded bytes of the records that start at ``start`` or later and before ``stop``.

    A member that begins as a record but cannot be decoded to its end gives the error, and the
    search goes on behind its first byte.
    """
    window, place = _Window(source, start, size), start
    while place < stop:
        if not window.upto(place + len(MAGIC)):
            return
        if window.data.startswith(MAGIC, place - window.base) and _starts_record(window, place):
            try:
                data, end = _member(window, place)
            except (ValueError, zlib.error) as broken:
                data, end = broken, place + 1
            yield place, data
            place = end
        else:  # search on, inside what is held
            found = window.data.find(MAGIC, place + 1 - window.base)
            held = window.base + len(window.data)
            place = window.base + found if found >= 0 else max(held - len(MAGIC) + 1, place + 1)
        window.forget(place)


RECORD = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)


def _read(folder: str, fail: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                with store.open_input_file(f"{root}/{row['file']}") as source:
                    for place, data in records_in_range(source, row["bytes"], row["start"], row["stop"]):
                        try:
                            if isinstance(data, Exception):
                                raise data
                            made = parse(data)
                        except (ValueError, zlib.error) as broken:
                            reason = f"{row['file']}, byte {place}: {broken}"
                            if fail:
                                raise ValueError(reason) from broken
                            made, data = {"error": reason}, b""
                        if made is None:
                            continue
                        held.append(made)
                        size += len(data)
                        if size >= 8 * BLOCK:
                            yield pa.RecordBatch.from_pylist(held, RECORD)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, RECORD)

    return run


def read_archives(manifest: DataFrame, folder: str, range_bytes: int = RANGE_BYTES, mode: str = "PERMISSIVE") -> DataFrame:
    """All records of the archives that ``manifest`` (``file``, ``bytes``) names, read by byte ranges.

    Columns: ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest`` (hex),
    ``payload_bytes`` (of the full payload; for revisits as the writer of this module states it, else
    NULL), ``payload`` (NULL for revisits) and ``error``.  A member that cannot be read is a row with ``error`` alone;
    with ``mode`` FAILFAST it fails the job.  Records of other archives have no ``page_id``.
    """
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"mode is PERMISSIVE or FAILFAST, not {mode}")
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = manifest.select("file", "bytes", F.explode(starts).alias("start"))
    ranges = ranges.withColumn("stop", F.least(F.col("start") + range_bytes, F.col("bytes")))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges.repartition(tasks, "file", "start")
    return ranges.mapInArrow(
        _read(folder, mode == "FAILFAST"),
        "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, "
        "payload binary, error string",
    )
