"""WARC archives: writing pages, normalising whole-file gzip streams to a member per record, reading by offset.

``write_archives`` writes each partition of pages as one gzip stream over a whole file, as many crawlers do. No record of
such a file can be read without all before it. ``normalise`` inflates each stream once, writes every record again as a
gzip member of its own and returns the offset index. ``read_records`` reads any record by its index row.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import batches, small_batches, staged
from kpiloom.session import scratch_path

CHUNK = 1 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"

INDEX = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string())]
    + [("record_type", pa.string()), ("target_uri", pa.string())]
)
FILES = pa.schema([("file", pa.string()), ("n_records", pa.int64())])
READ = pa.schema(
    [("record_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("record_type", pa.string()), ("refers_to", pa.string())]
)


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)


def record_uri(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object = None, revisit: bool = False) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, with the payload's length, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_uri(page_id)), ("WARC-Date", RECORD_DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", " ".join(url.split())))
    lines.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if revisit:
        lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_uri(refers_to))]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"\r\n".join([VERSION, *(f"{k}: {v}".encode() for k, v in lines), b"", block, b"", b""])


def headers(head: bytes) -> dict[str, str]:
    """Header lines after the first, by lower-case name."""
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:] if line)
    return {k.strip().lower().decode(): v.strip().decode() for k, _, v in pairs}


def inflated(source: BinaryIO) -> Iterator[bytes]:
    """The bytes of a gzip file of one or many members, in pieces."""
    inflate = zlib.decompressobj(31)
    while data := source.read(CHUNK):
        while data:
            if piece := inflate.decompress(data, 4 * CHUNK):
                yield piece
            data = inflate.unconsumed_tail
            if inflate.eof:
                data, inflate = inflate.unused_data, zlib.decompressobj(31)
    if piece := inflate.flush():
        yield piece


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and whole bytes of each record of an inflated stream; holds one record at a time."""
    buffer, at = bytearray(), 0

    def need(n: int) -> bool:
        nonlocal at
        while len(buffer) - at < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            del buffer[:at]
            at = 0
            buffer.extend(piece)
        return True

    while need(1):
        size = 4096
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not need(size) and buffer.find(b"\r\n\r\n", at) < 0:
                raise ValueError("a record's head does not end")
            size = 2 * (len(buffer) - at)
        fields = headers(bytes(buffer[at:end]))
        whole = end - at + 4 + int(fields["content-length"]) + 4
        if not need(whole):
            raise ValueError("a record is cut off")
        yield fields, bytes(buffer[at : at + whole])
        at += whole


def with_verdicts(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """page_id, url, html, digest, first (the page that others of the same payload revisit, else null).

    Only (digest, page_id) is grouped, with sums before the shuffle; pages join the few digests that occur twice.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    repeated = (
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    return rows.join(repeated, "digest", "left").select("page_id", "url", "html", "digest", "first")


def write_archives(
    pages: DataFrame,
    *,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 100,
) -> tuple[DataFrame, str]:
    """Write a record per row, each partition as one whole-file gzip stream; returns the files (file, n_records) and path.

    Of rows with equal payloads of at least ``least_bytes`` bytes those with the smallest id are responses and the others
    revisit it; all smaller payloads are responses. A null page is an empty payload. Null ids sort after all others: a
    row without an id is a response only where no equal payload has one. Rows that share payload and smallest id are all
    responses. A file is named only once its task has ended well; other columns are not read.
    """
    small_batches(pages.sparkSession)
    path = path or scratch_path(pages.sparkSession, "warc")
    rows = with_verdicts(pages, id_col, url_col, html_col, least_bytes)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, inner = fs.FileSystem.from_uri(path)
        name, count, sink = f"whole-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0, None
        deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
        for batch in given:
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    files.create_dir(f"{inner}/whole", recursive=True)
                    sink = files.open_output_stream(f"{inner}/whole/{name}", compression=None)
                revisit = first is not None and page_id != first
                sink.write(deflate.compress(record(page_id, url, html.encode(), digest, first, revisit)))
                count += 1
        if sink is not None:
            sink.write(deflate.flush())
            sink.close()
            yield from batches([(name, count)], FILES)

    return staged(rows.mapInArrow(run, ddl(FILES)), "warc-files"), path


def normalise(files: DataFrame, path: str) -> DataFrame:
    """Rewrite each whole-file stream with a gzip member per record; returns the offset index, a stored table.

    Index: file, offset and length of the member, record_id, record_type, target_uri. One file is one task's work; the
    stream is read once, in pieces. Output names carry a fresh id, so a retried task never writes over another's file.
    """
    small_batches(files.sparkSession)
    n = max(1, files.count())

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)

        def written(name: str) -> Iterator[tuple]:
            target = f"records-{name.split('-')[1]}-{uuid.uuid4().hex}.warc.gz"
            store.create_dir(f"{inner}/records", recursive=True)
            with store.open_input_stream(f"{inner}/whole/{name}", compression=None) as source:
                with store.open_output_stream(f"{inner}/records/{target}", compression=None) as sink:
                    offset = 0
                    for fields, whole in records(inflated(source)):
                        deflate = zlib.compressobj(1, zlib.DEFLATED, 31)
                        member = deflate.compress(whole) + deflate.flush()
                        sink.write(member)
                        yield target, offset, len(member), fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri")
                        offset += len(member)

        for batch in given:
            for name in batch.column(0).to_pylist():
                yield from batches(written(name), INDEX)

    return staged(files.select("file").repartition(n, "file").mapInArrow(run, ddl(INDEX)), "warc-index")


def read_records(index: DataFrame, path: str) -> DataFrame:
    """Read every record of the index by its offset: record_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are taken from its payload and held against its headers; a revisit has no payload, its
    HTTP head and headers carry both. refers_to is a record id, null for responses.
    """
    small_batches(index.sparkSession)
    n = max(1, index.select("file").distinct().count())
    rows = index.select("file", "offset", "length").repartition(n, "file").sortWithinPartitions("file", "offset")

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(path)

        def read() -> Iterator[tuple]:
            name, source = None, None
            for batch in given:
                for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if file != name:
                        name, source = file, store.open_input_file(f"{inner}/records/{file}")
                    source.seek(offset)
                    whole = zlib.decompress(source.read(length), 31)
                    head, _, rest = whole.partition(b"\r\n\r\n")
                    fields = headers(head)
                    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                    size = int(headers(http)["content-length"])
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    if fields["warc-type"] == "response":
                        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{file} at {offset}: the payload does not match its headers")
                    yield fields["warc-record-id"], size, digest, fields["warc-type"], fields.get("warc-refers-to")

        yield from batches(read(), READ, max_rows=4096)

    return rows.mapInArrow(run, ddl(READ))


def page_of(record_id: str, kind: str) -> Column:
    """The page id in a record id; null where the page had none."""
    return F.expr(f"cast(nullif(regexp_extract({record_id}, '^<urn:page:(.*)>$', 1), '') as {kind})")
