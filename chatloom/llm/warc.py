"""WARC archives: writer, and a reader that salvages what damage leaves.

An archive holds one gzip member for each record and is written by one task, under a temporary name until it is complete,
so a task that runs again or twice leaves one whole file. The reader streams a file; its memory is bounded by one record.
After a failed check (a broken member, version line, header or length, or a wrong digest) it looks for the next member
or version line from which a record can be read, goes on there and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatloom.functions.folders import new_path
from chatloom.llm.common import stored

# Fixed values of the formats: how a gzip member and a WARC record begin, and what ends a header and a record.
_MEMBER, _VERSION, _LINE, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n", b"\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_READ_BYTES = 1 << 20

#: Bytes that no header has; reading on for the end of a header stops there.
_BROKEN = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|(?<!\r)\n|\r(?!\n|\Z)")

RECORD_TYPE = (
    "path string, offset long, kind string, record_id string, refers_to string, target string, digest string, "
    "payload_bytes long, payload binary"
)


def _file_system(path: str):
    """``(file system, path there)`` of a path in any store that Arrow opens; a plain path is local."""
    from pyarrow import fs

    if ":" not in path.split("/")[0]:
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def record_bytes(kind: str, record_id: str, refers_to: str | None, target: str | None, digest: str, payload: bytes) -> bytes:
    """One record. A revisit has no payload; its header still says what the payload's digest is."""
    body = b"" if kind == "revisit" else payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("WARC-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    if target:
        # Control characters would end or break the field.
        fields.append(("WARC-Target-URI", "".join(c for c in target if c >= " " and c != "\x7f")))
    if refers_to:
        fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", _REVISIT_PROFILE)]
    header = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return _VERSION + b"1" + _LINE + header + _LINE + body + _END


def write_warc(records: DataFrame, folder: str, file_bytes: int = 256 << 20) -> DataFrame:
    """Write *records* ``(kind, record_id, refers_to, target, digest, payload)`` to gzip archives in *folder*.

    A task starts a new archive after *file_bytes* of compressed bytes. Returns ``(path, records, bytes)``; reading that
    table writes the files, with the same names and content each time.
    """
    columns = ("kind", "record_id", "refers_to", "target", "digest", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        from pyspark import TaskContext

        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        out = name = temporary = None
        count = size = 0

        def close() -> pa.RecordBatch:
            out.close()
            files.move(temporary, f"{root}/{name}")
            row = {"path": [f"{folder}/{name}"], "records": [count], "bytes": [size]}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, count, size = f"part-{part:06d}-{number:04d}.warc.gz", 0, 0
                    temporary = f"{root}/_{name}.{uuid4().hex}"
                    out = files.open_output_stream(temporary, compression=None)
                coder = zlib.compressobj(6, wbits=31)
                member = coder.compress(record_bytes(**row)) + coder.flush()
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    yield close()
                    out, number = None, number + 1
        if out is not None:
            yield close()

    return records.select(*columns).mapInArrow(run, "path string, records long, bytes long")


class _Window:
    """A stream of which a piece is held; positions count from the start of the file."""

    def __init__(self, stream) -> None:
        self._stream, self.start, self.data, self.ended = stream, 0, b"", False

    def fill(self, upto: int) -> bool:
        """Hold the bytes before position *upto*; whether there are that many."""
        parts, have = [self.data], self.start + len(self.data)
        while have < upto and not self.ended:
            more = self._stream.read(max(_READ_BYTES, upto - have))
            self.ended = not more
            parts.append(more)
            have += len(more)
        self.data = b"".join(parts)
        return have >= upto

    def drop(self, before: int) -> None:
        self.data, self.start = self.data[before - self.start :], before


def _parsed(raw: bytes) -> tuple[dict[str, str], int] | None:
    """``(fields, length of the header)`` of the record that starts *raw*, else None."""
    end = raw.find(_END)
    if not raw.startswith(_VERSION) or end < 0:
        return None
    try:
        lines = raw[:end].decode().split("\r\n")[1:]
    except UnicodeDecodeError:
        return None
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        # Damage that joins two headers shows as a repeated name or as bytes that no header has.
        if not colon or name in fields or any(c < " " and c != "\t" or c == "\x7f" for c in line):
            return None
        fields[name] = value.strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return fields, end + len(_END)


def _row(fields: dict[str, str], body: bytes) -> dict | None:
    """The record's columns; None if its digest does not fit."""
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] != "revisit" and digest and hashlib.sha1(body).hexdigest() != digest:
        return None
    names = {"record_id": "warc-record-id", "refers_to": "warc-refers-to", "target": "warc-target-uri"}
    row = {column: fields.get(name) for column, name in names.items()}
    length = fields.get("warc-payload-length", "")
    row["payload_bytes"] = int(length) if length.isdigit() else len(body)
    return {"kind": fields["warc-type"], "digest": digest or None, "payload": body, **row}


def _plain_record(window: _Window, at: int) -> tuple[dict, int] | None:
    """``(row, end)`` of the uncompressed record at *at*."""
    # A header may have any length, as urls do.
    seen = at
    while (stop := window.data.find(_END, max(at, seen - len(_END)) - window.start)) < 0:
        if _BROKEN.search(window.data, max(at, seen - 1) - window.start):
            return None
        seen = window.start + len(window.data)
        if not window.fill(max(seen + 1, 2 * seen - at)) and window.start + len(window.data) == seen:
            return None
    found = _parsed(window.data[at - window.start : stop + len(_END)])
    if found is None:
        return None
    fields, header = found
    end = at + header + int(fields["content-length"])
    # A broken length may point anywhere. It must lead to a record's end, so no more than the file is read for it.
    if not window.fill(end + len(_END)):
        return None
    own = end - window.start
    row = _row(fields, window.data[at + header - window.start : own])
    return (row, end + len(_END)) if row and window.data[own : own + len(_END)] == _END else None


def _member_record(window: _Window, at: int) -> tuple[dict, int] | None:
    """``(row, end)`` of the record in the gzip member at *at*."""
    coder, parts, begun, fed = zlib.decompressobj(wbits=31), [], False, at
    try:
        while not coder.eof:
            if not window.fill(fed + 1):
                return None
            piece = window.data[fed - window.start :][:_READ_BYTES]
            parts.append(coder.decompress(piece))
            fed += len(piece)
            if not begun:
                head = b"".join(parts)
                if len(head) >= len(_VERSION):
                    if not head.startswith(_VERSION):
                        return None
                    begun = True
    except zlib.error:
        return None
    raw = b"".join(parts)
    found = _parsed(raw)
    if found is None:
        return None
    fields, header = found
    end = header + int(fields["content-length"])
    row = _row(fields, raw[header:end]) if raw[end:] == _END else None
    return (row, fed - len(coder.unused_data)) if row else None


def salvage(stream) -> Iterator[tuple[int, int, dict | None]]:
    """``(start, end, record)`` of each record of an archive, compressed or not, and ``(start, end, None)`` of each gap."""
    window, at, gap = _Window(stream), 0, None
    while window.fill(at + 1):
        # A beginning may lie across the edge of what is held.
        window.fill(at + len(_VERSION))
        head = window.data[at - window.start :][: len(_VERSION)]
        found = None
        if head.startswith(_MEMBER):
            found = _member_record(window, at)
        elif head == _VERSION:
            found = _plain_record(window, at)
        if found:
            if gap is not None:
                yield gap, at, None
                gap = None
            yield at, found[1], found[0]
            at = found[1]
            window.drop(at)
            continue
        gap = at if gap is None else gap
        # The next place that looks like a beginning; a mark may lie across the edge of what is held.
        while True:
            marks = [window.data.find(m, at + 1 - window.start) for m in (_MEMBER, _VERSION)]
            marks = [m for m in marks if m >= 0]
            if marks:
                at = window.start + min(marks)
                break
            held = window.start + len(window.data)
            if not window.fill(held + 1):
                at = held
                break
            at = max(at, held - len(_VERSION))
            window.drop(at)
    if gap is not None:
        yield gap, at, None


def read_warc(paths: DataFrame, whole: bool = False) -> DataFrame:
    """All records of the archives in column ``path``, one task after another taking a file; gaps have kind ``gap``.

    With *whole*, an archive with a gap or with another number of records than in column ``records`` is an error.

    Columns as in :data:`RECORD_TYPE`. A gap's ``offset`` is its first byte and its ``payload_bytes`` says how many it has.
    ``payload_bytes`` of a revisit is the length of the payload that it stands for. An empty archive gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (name, {"long": pa.int64(), "binary": pa.binary()}.get(kind, pa.string()))
                for name, kind in (part.split() for part in RECORD_TYPE.split(", "))
            ]
        )
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist() if whole else repeat(None)):
                files, at = _file_system(path)
                rows, size, count = [], 0, 0
                with files.open_input_stream(at, compression=None) as stream:
                    for start, end, record in salvage(stream):
                        if record is None:
                            if whole:
                                raise ValueError(f"{path}: no record can be read from byte {start} to {end}")
                            record = {"kind": "gap", "payload_bytes": end - start}
                        count += 1
                        rows.append({"path": path, "offset": start, **record})
                        size += len(record.get("payload") or b"")
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if whole and count != expected:
                    raise ValueError(f"{path}: {count} records instead of {expected}")
                yield pa.RecordBatch.from_pylist(rows, schema)

    return paths.select("path", *(["records"] if whole else [])).mapInArrow(run, RECORD_TYPE)


def page_records(
    df: DataFrame, id_column: str = "page_id", payload_column: str = "html", url_column: str = "url", least: int = 1000
) -> DataFrame:
    """A record for each page: of equal payloads of at least *least* bytes the largest id is the response.

    Payloads are UTF-8; NULL is empty. A row without id is always a response, and rows that share the largest id are all
    responses. Only digests and ids are compared, so a payload with very many copies moves no text.
    """
    payload = F.encode(F.coalesce(F.col(payload_column), F.lit("")), "UTF-8")
    rows = df.select(
        F.col(id_column).cast("string").alias("id"), F.col(url_column).alias("target"), payload.alias("payload")
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= least
    # Copies are told by a stronger hash, so that equal SHA-1 of different payloads does not link them.
    rows = rows.withColumn("key", F.when(large, F.sha2("payload", 256)))
    keys = df.select(F.col(id_column).alias("number"), payload.alias("payload")).where(large)
    keys = keys.select("number", F.sha2("payload", 256).alias("key"))
    first = keys.groupBy("key").agg(F.max("number").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = keys.join(first, "key").where("number <> first")
    later = later.select(F.col("number").cast("string").alias("id"), "key", F.col("first").cast("string").alias("first"))
    rows = rows.join(later.distinct(), ["id", "key"], "left")
    revisit = F.col("first").isNotNull()
    name = F.concat(F.lit("<urn:page:"), F.col("id"), F.lit(">"))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.coalesce(name, F.lit("<urn:page:>")).alias("record_id"),
        F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first"), F.lit(">"))).alias("refers_to"),
        "target",
        "digest",
        "payload",
    )


def write_pages(df: DataFrame, folder: str, **options) -> DataFrame:
    """Write all pages of *df* as archives in *folder*; options as in :func:`page_records`. Returns their list, stored."""
    return stored(write_warc(page_records(df, **options), folder), "archives")


def read_pages(archives: DataFrame, whole: bool = False) -> DataFrame:
    """The records of *archives* ``(path, records, ...)``; revisits get the payload length that their header names.

    *whole* as in :func:`read_warc`.
    """
    # One file at a time: as many tasks as files, up to a bound for the scheduler.
    files = archives.select("path", "records").repartition(min(10000, max(1, archives.count())))
    return read_warc(files, whole)


def new_archive_folder(spark: SparkSession) -> str:
    return new_path(spark, "warc")
