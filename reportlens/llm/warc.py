"""WARC archives, index first.

Writing gives, besides the archives, an index with file, offset, length, URL and digest of each
record. Reading starts from index rows: the selected records' byte ranges are sorted, ranges
that touch or nearly touch are read as one, and the records are parsed from there. Nothing scans
an archive.

Archives are gzip files with one member per record, written by the tasks that hold the records
to files of new names in the shared folder. The index is landed from those same tasks, so a
lost or repeated task leaves at most a file that no index row names.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import land, shared_path

#: Payloads from this size on are written once.
REVISIT_FROM = 100
FILE_BYTES = 256 << 20
#: A reading task's share: records and bytes of one file.
CHUNK_RECORDS = 128
CHUNK_BYTES = 8 << 20
#: Reads whose gap is at most this are one read, of at most READ_BYTES unless one record is larger.
GAP_BYTES = 64 << 10
READ_BYTES = 16 << 20

INDEX = (
    "file string, offset long, length long, url string, digest string, page_id long,"
    " record_type string, refers_to long, chunk long"
)
INDEX_KINDS = (
    pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(),
)
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " payload binary"
)


def filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The store and the path within it of a folder given as URI or local path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record as a gzip member. Ids become URNs; a missing URL or id leaves its field out."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 4, mtime=0)


def parse(data: bytes) -> tuple[int | None, str | None, int, str, str, int | None, bytes | None]:
    """The row of ``RECORDS`` of one record; raises if a payload doesn't match its digest."""
    head, _, block = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"record {fields.get('WARC-Record-ID')}: payload and digest differ")
    number = lambda field: int(x[10:-1]) if (x := fields.get(field)) else None
    return (
        number("WARC-Record-ID"), fields.get("WARC-Target-URI"), size, digest, kind,
        number("WARC-Refers-To"), body if kind == "response" else None,
    )


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record per row (``page_id``, ``url``, ``html``) below ``folder``; the landed index.

    A null html is an empty payload. Of equal payloads of ``REVISIT_FROM`` bytes or more the row
    with the smallest page_id is the response and the others revisit it; rows that tie for the
    smallest id are all responses, and so are equal payloads without any id. Other columns are
    ignored; an empty table gives an empty index.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("html"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    large = F.octet_length("html") >= REVISIT_FROM
    first = land(
        rows.where(large)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .drop("n"),
        "repeated",
    )
    original = F.when(large & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    marked = rows.join(first, "digest", "left").withColumn("refers_to", original).drop("first_id")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out, name, at, chunk, in_chunk, chunk_bytes = None, "", 0, 0, 0, 0
        try:
            for batch in batches:
                index = []
                for page_id, url, html, digest, refers_to in zip(
                    *(batch.column(x) for x in ("page_id", "url", "html", "digest", "refers_to"))
                ):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    kind = "revisit" if refers_to.is_valid else "response"
                    values = (page_id.as_py(), url.as_py(), digest.as_py(), refers_to.as_py())
                    data = record(values[0], values[1], html.as_py().encode(), values[2], kind, values[3])
                    out.write(data)
                    if in_chunk >= CHUNK_RECORDS or chunk_bytes >= CHUNK_BYTES:
                        chunk, in_chunk, chunk_bytes = chunk + 1, 0, 0
                    index.append((name, at, len(data), values[1], values[2], values[0], kind, values[3], chunk))
                    at, in_chunk, chunk_bytes = at + len(data), in_chunk + 1, chunk_bytes + len(data)
                columns = list(zip(*index)) or [[]] * len(INDEX_KINDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, INDEX_KINDS)], [x.split()[0] for x in INDEX.split(",")]
                )
        finally:
            if out is not None:
                out.close()

    columns = marked.select("page_id", "url", "html", "digest", "refers_to")
    return land(columns.mapInArrow(archive, INDEX), "warc-index")


def ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) as reads: start, end and the records inside."""
    inside: list[tuple[int, int]] = []
    begin = end = 0
    for offset, length in rows:
        if inside and (offset - end > GAP_BYTES or offset + length - begin > READ_BYTES):
            yield begin, end, inside
            inside = []
        if not inside:
            begin = end = offset
        inside.append((offset, length))
        end = max(end, offset + length)
    if inside:
        yield begin, end, inside


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that ``index`` rows name, parsed from their byte ranges (columns ``RECORDS``).

    Without ``payloads`` the last column is null; payloads are read and checked all the same.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        names = [x.split()[0] for x in RECORDS.split(",")]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
        for batch in batches:
            wanted: dict[str, list[tuple[int, int]]] = {}
            for name, offset, length in zip(*(batch.column(x).to_pylist() for x in ("file", "offset", "length"))):
                wanted.setdefault(name, []).append((offset, length))
            for name, spans in wanted.items():
                with store.open_input_file(f"{root}/{name}") as source:
                    for begin, end, inside in ranges(sorted(spans)):
                        data = source.read_at(end - begin, begin)
                        rows = [parse(data[o - begin : o - begin + n]) for o, n in inside]
                        if not payloads:
                            rows = [(*r[:-1], None) for r in rows]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    shares = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = index.select("file", "offset", "length", "chunk").repartition(shares, "file", "chunk")
    return placed.sortWithinPartitions("file", "offset").mapInArrow(fetch, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives, then read every record back by the index."""
    folder = shared_path(spark, "warc")
    return read(write(pages, folder), folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
