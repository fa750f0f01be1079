"""WARC archives of gzip members: a writer, and a reader whose tasks own byte ranges."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pfs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

#: Payloads from this size on are written once; equal ones refer to that record.
LEAST_SHARED = 1000
#: Bytes of one range of the reader, and of one read.
RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
#: Archive bytes after which a writing task begins another file.
FILE_BYTES = 256 << 20
#: Header fields of ours; the format allows extensions.
ID_FIELD, REFERS_FIELD = "X-Page-Id", "X-Refers-To-Page-Id"
_MAGIC = b"\x1f\x8b\x08"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def _urn(page_id: int | None, salt: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}' if page_id is not None else f'row:{salt}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, digest: str, salt: str) -> bytes:
    """One gzip member that holds one record. A revisit keeps the HTTP head, which states the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id, salt)}", f"WARC-Date: {_DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response"]
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if page_id is not None:
        lines.append(f"{ID_FIELD}: {page_id}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to, salt)}", f"{REFERS_FIELD}: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    body = ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


def record_types(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: a response) for each page.

    Largest ids are found by a partial aggregate over digests; pages join it by digest,
    so one payload that a third of all pages share is an ordinary skewed join. Groups of
    one page, the bulk, never reach the join's other side.
    """
    known = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    known = known.withColumn("digest", F.sha1("payload"))
    large = known.where(F.octet_length("payload") >= least)
    first = large.groupBy("digest").agg(F.max("page_id").alias("of"), F.count("*").alias("c")).where("c > 1 AND of IS NOT NULL").select(F.col("digest").alias("d"), "of")
    first = storage.small(storage.cut(first, "shared"), 64)
    found = known.join(first, (F.col("digest") == F.col("d")) & (F.octet_length("payload") >= least), "left")
    return found.withColumn("refers_to", F.when(F.col("of") != F.coalesce("page_id", F.col("of") - 1), F.col("of"))).drop("d", "of")


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write page records (columns of record_types) as .warc.gz files below path; returns the manifest (file, bytes, records).

    Files have names that no other task attempt has, and only files of the manifest, which
    holds those of the attempts that succeeded, are read: a task that runs again leaves
    orphans behind but neither doubles nor loses records.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pfs.FileSystem.from_uri(path)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        done: list[tuple[str, int, int]] = []
        out, name, size, n, row = None, "", 0, 0, 0
        for batch in batches:
            for page_id, url, payload, digest, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                        done.append((name, size, n))
                    name, size, n = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page_id, url, payload, "revisit" if refers is not None else "response", refers, digest, f"{part}.{row}")
                out.write(member)
                size, n, row = size + len(member), n + 1, row + 1
        if out is not None:
            out.close()
            done.append((name, size, n))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.int64())], names=["file", "bytes", "records"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "payload", "digest", F.col("refers_to").cast("long"))
    return storage.cut(rows.mapInArrow(write, "file string, bytes long, records long"), "manifest")


def ranges(manifest: DataFrame, size: int = RANGE_BYTES) -> DataFrame:
    """(file, start, stop) for every `size` bytes of every file."""
    n = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(size))).cast("int")
    each = manifest.select("file", "bytes", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    start = F.col("i").cast("long") * size
    return each.select("file", start.alias("start"), F.least(start + size, "bytes").alias("stop"))


class _Window:
    """Bytes of a file from some place on, read when asked for, dropped when passed."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data = file, start, bytearray()
        file.seek(start)

    def fill(self) -> bool:
        more = self.file.read(READ_BYTES)
        self.data += more
        return bool(more)

    def drop(self, to: int) -> None:
        if to - self.start > READ_BYTES:
            del self.data[: to - self.start]
            self.start = to


def _member(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The decoded record whose gzip member starts at `at`, and the member's end; None if there is none.

    Candidates fall away at the first decoded bytes if these are no record header. A
    member counts only when it decodes whole, checksum included, and its header's length
    is that of its block.
    """
    unzip = zlib.decompressobj(31)
    out, pos = bytearray(), at
    try:
        while not unzip.eof:
            lo = pos - window.start
            if lo >= len(window.data) and not window.fill():
                return None
            piece = bytes(window.data[lo : lo + (4096 if pos == at else READ_BYTES)])
            out += unzip.decompress(piece)
            pos += len(piece)
            if out and not out.startswith(b"WARC/1."[: len(out)]):
                return None
    except zlib.error:
        return None
    return bytes(out), pos - len(unzip.unused_data)


def parse(raw: bytes) -> tuple[dict[str, str], bytes] | None:
    """Header fields (lower-case names) and block of a record, if it is whole."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = fields.get("content-length", "")
    return (fields, rest[: int(length)]) if length.isdigit() and int(length) <= len(rest) else None


def records_in(file, start: int, stop: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, fields and block of the records that start in [start, stop) of an open file.

    The range is searched for the gzip magic. A candidate that is no record is passed over
    by one byte; after a record the search goes on at its end. The last record is read
    beyond the range, the next range's owner finds no start in it.
    """
    window = _Window(file, start)
    at = start
    while at < stop:
        found = window.data.find(_MAGIC, at - window.start)
        if found < 0 or found + window.start >= stop:
            if window.start + len(window.data) >= stop + len(_MAGIC) or not window.fill():
                if found < 0 or found + window.start >= stop:
                    return
            elif found < 0:
                at = max(at, window.start + len(window.data) - READ_BYTES - len(_MAGIC)) if len(window.data) > READ_BYTES + 3 else at
            continue
        at = found + window.start
        member = _member(window, at)
        parsed = parse(member[0]) if member else None
        if parsed is None:
            at += 1
            continue
        yield at, *parsed
        at = member[1]
        window.drop(at)


SCHEMA = "file string, offset long, record_type string, page_id long, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, path: str, manifest: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """All records of the manifest's files, each from the task that owns the byte range it starts in.

    payload_bytes and payload_digest (hex SHA-1) are those of the full payload: of a
    response they are computed from what was read and held against the record's own
    digest; a revisit has them in its head. Ranges are dealt round robin, so one large
    file is read by many tasks; a task holds one record and a read buffer.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]] for f in SCHEMA.split(", ")]
        fs, root = pfs.FileSystem.from_uri(path)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for name, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                with fs.open_input_file(f"{root}/{name}") as file:
                    for offset, fields, block in records_in(file, start, stop):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        kind = fields["warc-type"]
                        said = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if kind == "response":
                            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                            if digest != said:
                                raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                        else:
                            lengths = [x.split(b":")[1] for x in head.lower().split(b"\r\n") if x.startswith(b"content-length:")]
                            size, digest, payload = int(lengths[0]), said, None
                        page, refers = fields.get(ID_FIELD.lower()), fields.get(REFERS_FIELD.lower())
                        rows.append((name, offset, kind, int(page) if page else None, int(refers) if refers else None, fields.get("warc-target-uri"), size, digest, payload if payloads else None))
                        held += len(payload or b"") if payloads else 0
                        if len(rows) >= 2000 or held > 16 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    each = ranges(manifest, range_bytes)
    tasks = max(1, min(each.count(), 100_000))
    return each.repartition(tasks).mapInArrow(read, SCHEMA)


def archive_round_trip(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """Write every page as a record in archives in the shared folder, and read these back.

    Defined cases: null html is an empty payload; of pages with equal payloads of at least
    `least` bytes the one with the largest id is the response and the others revisit it,
    rows that share that id are all responses; a page without an id revisits a group's
    largest id and is a response where no page of the group has one; null urls are written
    empty; an empty table writes no file and gives an empty result; other columns are not
    read.
    """
    spark = pages.sparkSession
    path = storage.fresh_path(spark, "warc")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    manifest = write_archives(record_types(own, least), path)
    return read_archives(spark, path, manifest, payloads=False)
