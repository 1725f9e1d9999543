"""WARC archives: records written by tasks, one gzip member each, and a sequential reader that verifies them.

Every task writes one archive under a name of its own and returns what it wrote; that list is a written table,
so archives of failed or repeated attempts are never looked at. The reader inflates an archive bit by bit,
frames each record by its content length and checks its digests; it holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.session import materialize, shared_folder

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Payloads below this size are always stored.
REVISIT_BYTES = 1000
LEVEL = 3
READ_BYTES = 1 << 18
# Archives are read in a task each, up to this many tasks.
READ_TASKS = 20000
_DATE = "1970-01-01T00:00:00Z"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes


def record_id(page_id: int | None, number: str) -> str:
    """Identifier of a page's record; pages without an id get one from where they were written."""
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{number}>"


def digest_header(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode("ascii")


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in headers)]
    lines.append(b"Content-Length: %d" % len(block))
    data = b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    made = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def read_records(chunks: Iterator[bytes]) -> Iterator[Record]:
    """Records of an archive given as pieces of any size.

    Raises ValueError on a broken member or frame, on data after a record's end, and on a block digest that
    does not fit.
    """
    inflate, data, begun = zlib.decompressobj(31), bytearray(), False
    for chunk in chunks:
        rest = chunk
        while rest:
            begun = True
            data += inflate.decompress(rest)
            rest = inflate.unused_data
            if inflate.eof:
                yield _parse(bytes(data))
                inflate, data, begun = zlib.decompressobj(31), bytearray(), False
            elif not rest:
                break
    if begun:
        raise ValueError("archive ends inside a record")


def _parse(data: bytes) -> Record:
    head, gap, body = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise ValueError("not a record")
    headers = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8").partition(":")
        headers[name.strip().lower()] = value.strip()
    length = int(headers["content-length"])
    if body[length:] != b"\r\n\r\n":
        raise ValueError(f"{headers.get('warc-record-id')}: {len(body) - 4} bytes where {length} are stated")
    block = body[:length]
    stated = headers.get("warc-block-digest")
    if stated and stated != digest_header(hashlib.sha1(block).digest()):
        raise ValueError(f"{headers.get('warc-record-id')}: block digest does not fit")
    return Record(headers, block)


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _write_batches(folder: str):
    """Write the rows of a task into one archive: page_id, url, html, digest, refers_to, refers_url."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{uuid.uuid4().hex}.warc.gz"
        system, base = _filesystem(folder)
        system.create_dir(base, recursive=True)
        path, n, size = f"{base}/{name}", 0, 0
        with system.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for page, url, html, length, sha1, revisit, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    number = f"{name}:{n}"
                    block = b"" if revisit else (html or "").encode("utf-8")
                    headers = [
                        ("WARC-Type", "revisit" if revisit else "response"),
                        ("WARC-Record-ID", record_id(page, number)),
                        ("WARC-Date", _DATE),
                        # A line break in an address would end the header.
                        ("WARC-Target-URI", "".join((url or "").split())),
                        ("WARC-Payload-Digest", digest_header(bytes.fromhex(sha1))),
                        ("X-Payload-Length", str(length)),
                        ("WARC-Block-Digest", digest_header(hashlib.sha1(block).digest())),
                        ("Content-Type", "text/html; charset=utf-8"),
                    ]
                    if revisit:
                        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers, number))]
                    n += 1
                    member = write_record(headers, block)
                    out.write(member)
                    size += len(member)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], names=["name", "records", "bytes"]
            )

    return run


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) into archives below ``folder``.

    The payload is the html in UTF-8, null as empty. Of equal payloads of ``REVISIT_BYTES`` or more the one
    with the largest page_id is stored as a response; the others are revisits that refer to it, without
    payload. Smaller ones are all stored, and so is a payload whose pages all have a null id. Rows that share
    a page_id get a record each. Returns the list of archives: ``name, records, bytes``. Other columns are
    not looked at; an empty table writes nothing. ``folder`` must be one all executors reach.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("length", F.octet_length("html").cast("long")).withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    # Only digests are grouped; a page finds its payload's largest id by a join that may be split when hot.
    newest = rows.where(F.col("length") >= REVISIT_BYTES).groupBy("sha1", "length").agg(
        F.max("page_id").alias("newest"), F.count("*").alias("n")
    )
    newest = newest.where("n > 1 AND newest IS NOT NULL").drop("n")
    rows = rows.join(newest, ["sha1", "length"], "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("newest")) & F.col("newest").isNotNull(), F.lit(False))
    rows = rows.select(
        "page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "length", "sha1", revisit.alias("revisit"),
        F.when(revisit, F.col("newest")).alias("refers_to"),
    )
    return materialize(rows.mapInArrow(_write_batches(folder), "name string, records long, bytes long"), "archives")


_PAGE = "<urn:page:"


def _page_of(identifier: str | None) -> int | None:
    number = (identifier or "").removeprefix(_PAGE).removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def _read_batches(folder: str):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def chunks(path: str, system: fs.FileSystem) -> Iterator[bytes]:
        with system.open_input_stream(path, compression=None) as data:
            while piece := data.read(READ_BYTES):
                yield piece

    def row(r: Record) -> tuple:
        kind, digest = r.headers["warc-type"], base64.b32decode(r.headers["warc-payload-digest"].removeprefix("sha1:"))
        length = int(r.headers["x-payload-length"])
        if kind == "response" and (hashlib.sha1(r.block).digest() != digest or len(r.block) != length):
            raise ValueError(f"{r.headers['warc-record-id']}: payload digest does not fit")
        refers = _page_of(r.headers.get("warc-refers-to"))
        page = _page_of(r.headers["warc-record-id"])
        return page, r.headers["warc-target-uri"], length, digest.hex(), kind, refers, r.block

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _filesystem(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held, size, n = [], 0, 0
                for r in read_records(chunks(f"{base}/{name}", system)):
                    held.append(row(r))
                    size, n = size + len(r.block), n + 1
                    if size > READ_BYTES * 4 or len(held) >= 1000:
                        yield table(held)
                        held, size = [], 0
                if n != records:
                    raise ValueError(f"{name}: {n} records where {records} were written")
                if held:
                    yield table(held)

    return run


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Records of the listed ``archives`` (name, records) below ``folder``, read in order and verified.

    Columns ``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload``; a revisit's
    payload is empty, its digest and size are those of the payload it stands for.
    """
    # A list of names is a few bytes, which adaptive execution would merge into one task without a number.
    spread = archives.select("name", "records").repartition(min(max(archives.count(), 1), READ_TASKS))
    return spread.mapInArrow(
        _read_batches(folder),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " payload binary",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` into archives in the shared folder and read them back."""
    folder = f"{shared_folder(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder), folder)
