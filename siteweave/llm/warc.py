"""WARC archives with an index that is written first and read by sorted byte ranges."""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import split_join
from ..session import new_table_path
from .common import parallelism, prepare

# A payload shorter than this is stored with every record.
LEAST_REVISIT_BYTES = 100
# One read brings in records that lie this close together, up to the size of a range.
GAP_BYTES = 1 << 16
RANGE_BYTES = 1 << 22
# An archive is closed and the next one begun once it is this large.
ARCHIVE_BYTES = 1 << 28

_NAMES = uuid.UUID("9f0dbe7c-7e7c-5d0c-9a5a-0d8a1f5b6c11")
INDEX = (
    "page_id long, url string, digest string, payload_bytes long, record_type string, refers_to long, "
    "archive string, start long, length long"
)
RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, "
    "payload binary"
)


def _open(path: str):
    """(file system, path in it) of a path in the shared folder, whatever store that is."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if re.match(r"[a-z][a-z0-9+.-]*:/", path) else f"file://{path}")


def _header(lines) -> bytes:
    """Header lines; line breaks and other controls in a value are written as %XX."""
    clean = lambda v: re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(v))
    return "".join(f"{name}: {clean(value)}\r\n" for name, value in lines if value is not None).encode()


def _record(page_id, url, payload: bytes, digest: str, kind: str, refers_to, name: str) -> bytes:
    """One record as a gzip member. A revisit holds headers only."""
    http = b"HTTP/1.1 200 OK\r\n" + _header(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    )
    block = http + b"\r\n" + (b"" if kind == "revisit" else payload)
    original = uuid.uuid5(_NAMES, f"{refers_to} {digest}") if kind == "revisit" else None
    head = _header(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", f"<urn:uuid:{name}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if original else None),
            ("WARC-Refers-To", f"<urn:uuid:{original}>" if original else None),
            ("X-Page-Id", page_id),
            ("X-Refers-To-Page-Id", refers_to if original else None),
            ("X-Payload-Length", len(payload)),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return gzip.compress(b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n", compresslevel=4, mtime=0)


def _parse(member: bytes) -> dict:
    """A record's headers and payload; a payload that does not fit its digest is an error."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload_digest": digest,
        "payload_bytes": number("X-Payload-Length"),
        "payload": None if fields["WARC-Type"] == "revisit" else payload,
    }


def _judged(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with digest, size and, for copies of another page's payload, that page's id."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    rows = rows.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    # The smallest id, or none where no copy has one.
    firsts = (
        rows.filter(F.col("size") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .withColumn("copied", F.lit(True))
    )
    judged = split_join(rows, firsts, "digest", "left")
    copied, itself = F.coalesce("copied", F.lit(False)), F.col("page_id").eqNullSafe(F.col("first"))
    return judged.select(
        "page_id",
        "url",
        "html",
        "digest",
        (copied & itself).alias("original"),
        (copied & ~itself).alias("revisit"),
        F.col("first").alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Write a record per page(page_id, url, html) to archives under `path`; returns their index.

    Of pages with equal payloads of at least `least_bytes` bytes, the one with the smallest
    id is the response and the others revisit it; all smaller ones are responses. Null html
    is an empty payload. A page without id revisits one with an id; where no copy has one, all are
    responses, and so are all pages that share the smallest id, such as rows that are there twice.

    The index has a row per record: (page_id, url, digest, payload_bytes, record_type,
    refers_to, archive, start, length). Every attempt of a task writes archives of its
    own, and only a finished attempt's rows come into the index, so a lost executor leaves
    at most files that nothing names. The index is a table of its own beside the archives.
    """
    spark = prepare(pages.sparkSession)
    base = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(f"{base}/archives")
        store.create_dir(folder, recursive=True)
        archive, out, at = None, None, 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                digest, refers_to = r["digest"], r["refers_to"] if r["revisit"] else None
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    archive, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{folder}/{archive}", compression=None)
                name = uuid.uuid5(_NAMES, f"{r['page_id']} {digest}" if r["original"] else f"{archive} {at}")
                kind = "revisit" if r["revisit"] else "response"
                payload = r["html"].encode()
                member = _record(r["page_id"], r["url"], payload, digest, kind, refers_to, str(name))
                out.write(member)
                rows.append((r["page_id"], r["url"], digest, len(payload), kind, refers_to, archive, at, len(member)))
                at += len(member)
            columns = list(zip(*rows, strict=True)) or [[]] * len(_INDEX_TYPES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _INDEX_TYPES.values(), strict=True)], names=list(_INDEX_TYPES)
            )
        if out is not None:
            out.close()

    _judged(pages, least_bytes).mapInArrow(write, INDEX).write.parquet(f"{base}/index")
    return spark.read.schema(INDEX).parquet(f"{base}/index")


_INDEX_TYPES = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "digest": pa.string(),
    "payload_bytes": pa.int64(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "archive": pa.string(),
    "start": pa.int64(),
    "length": pa.int64(),
}
_RECORD_TYPES = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "payload_digest": pa.string(),
    "payload_bytes": pa.int64(),
    "payload": pa.binary(),
}


def read_index(spark, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")


def coalesce_ranges(records, gap: int = GAP_BYTES, most: int = RANGE_BYTES):
    """Group (start, length) records, sorted by start, into ranges read at once."""
    group, begin, end = [], 0, 0
    for start, length in records:
        if group and (start - end > gap or start + length - begin > most):
            yield begin, end, group
            group = []
        if not group:
            begin, end = start, start
        group.append((start, length))
        end = max(end, start + length)
    if group:
        yield begin, end, group


def read_records(selected: DataFrame, path: str, payloads: bool = True) -> DataFrame:
    """The records that rows of the index name, from the archives alone.

    Rows are dealt to tasks by archive and range, sorted by offset, and records that lie
    close together come in with one read. A revisit has a null payload; `payload_digest`
    and `payload_bytes` are those of the full payload in either case. A damaged record
    raises an error. An empty selection gives no rows.
    """
    spark = prepare(selected.sparkSession)
    base = path.rstrip("/")
    dealt = (
        selected.select("archive", "start", "length")
        .withColumn("range", F.floor(F.col("start") / RANGE_BYTES))
        .repartition(parallelism(spark), "archive", "range")
        .sortWithinPartitions("archive", "start")
        .drop("range")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(f"{base}/archives")
        name, source = None, None
        for batch in batches:
            wanted: dict[str, list] = {}
            for r in batch.to_pylist():
                wanted.setdefault(r["archive"], []).append((r["start"], r["length"]))
            for archive, spans in wanted.items():
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, store.open_input_file(f"{folder}/{archive}")
                for begin, end, group in coalesce_ranges(spans):
                    data = memoryview(source.read_at(end - begin, begin))
                    rows = [_parse(data[s - begin : s - begin + n]) for s, n in group]
                    if not payloads:
                        rows = [r | {"payload": None} for r in rows]
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_RECORD_TYPES.items()))
        if source is not None:
            source.close()

    return dealt.mapInArrow(read, RECORD)


def archive_round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write the pages to fresh archives in the shared folder and read all records back."""
    path = new_table_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, path), path, payloads)
