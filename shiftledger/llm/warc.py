"""WARC archives: write them, normalise monolithic gzip files, read by offset.

``write_archives`` writes one gzip stream per archive, as many crawlers do.  Such
a file can only be read from its start.  ``normalise`` inflates each file once,
as a stream, and rewrites every record as a gzip member of its own beside an
index of offsets, so that ``read_records`` can go to any record.

A task holds one record and one window of the stream; archives are rolled by
size.  Records of equal payload: the one with the smallest id is a response,
the others are revisits with an empty block that refer to it.

Defined cases: a null payload is empty; a null url or id is left out of the
header and read as null; rows that repeat the smallest id are all responses; if
all ids of a payload are null, all are responses; no rows give no archives and
an empty result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import files
from shiftledger.llm.common import shared_folder, written

GZIP = 31
DATE = "2024-01-01T00:00:00Z"
#: Bytes of records in an archive before the next one is begun.
ARCHIVE_BYTES = 256 << 20
#: Bytes in a batch of records read back.
BATCH_BYTES = 8 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "archive string, index string, records long"
_RECORDS = (
    "record_id string, uri string, record_type string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _record(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers.items() if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(key: str | None) -> str | None:
    return None if key is None else f"<urn:page:{quote(key, safe='')}>"


def _key(urn: str | None) -> str | None:
    return None if urn is None else unquote(urn.removeprefix("<urn:page:").removesuffix(">"))


def page_records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = 0,
) -> DataFrame:
    """One row per record: id, uri, payload, its SHA-1, and the id it refers to.

    Payloads meet only the digests that occur more than once; a digest that
    holds many pages is counted before the shuffle and split by adaptive
    execution in the join.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").alias("record_id"),
        F.col(f"`{url}`").cast("string").alias("uri"),
        F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    shared = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("record_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and first_id is not null")
        .select("sha1", "first_id")
    )
    shared = written(shared, "digests")
    refers = F.when(~F.col("record_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    return rows.join(shared, "sha1", "left").select(
        F.col("record_id").cast("string").alias("record_id"),
        "uri",
        "payload",
        "sha1",
        refers.cast("string").alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write monolithic archives below ``folder``; returns archive and records of each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = out = name = None
        size = count = number = 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = files.attempt_name("crawl", number, ".warc.gz")
                    out, stream = files.output(folder, name), zlib.compressobj(6, zlib.DEFLATED, GZIP)
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                revisit = row["refers_to"] is not None
                headers = {
                    "WARC-Type": "revisit" if revisit else "response",
                    "WARC-Record-ID": _urn(row["record_id"]),
                    "WARC-Date": DATE,
                    "WARC-Target-URI": None if row["uri"] is None else quote(row["uri"], safe="%/:?#[]@!$&'()*+,;=~"),
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "X-Payload-Length": str(len(row["payload"])),
                    "WARC-Refers-To": _urn(row["refers_to"]),
                    "WARC-Profile": _PROFILE if revisit else None,
                    "Content-Type": "text/html",
                }
                raw = _record(headers, b"" if revisit else row["payload"])
                out.write(stream.compress(raw))
                size, count = size + len(raw), count + 1
                if size >= archive_bytes:
                    out.write(stream.flush())
                    out.close()
                    yield _manifest(f"{folder}/{name}", None, count)
                    out, size, count, number = None, 0, 0, number + 1
        if out is not None:
            out.write(stream.flush())
            out.close()
            yield _manifest(f"{folder}/{name}", None, count)

    return written(records.mapInArrow(write, _MANIFEST), "archives")


def _manifest(archive: str, index: str | None, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([archive]), pa.array([index], pa.string()), pa.array([records], pa.int64())],
        names=["archive", "index", "records"],
    )


def _inflated(raw, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The content of a gzip file of one member or many, ``chunk`` bytes at most at a time."""
    inflater, begun = zlib.decompressobj(GZIP), False
    while data := raw.read(chunk):
        more = False
        while data or more:
            if inflater.eof:
                inflater, begun = zlib.decompressobj(GZIP), False
            piece = inflater.decompress(data, chunk)
            yield piece
            begun = True
            # a full piece may leave content behind that needs no further input
            more = len(piece) == chunk and not inflater.eof
            data = inflater.unconsumed_tail or inflater.unused_data
    if begun and not inflater.eof:
        raise ValueError("the archive ends within a gzip member")


def _records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, each with its closing line ends; holds one record."""
    held = bytearray()

    def fill(size: int) -> bool:
        while len(held) < size:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        searched = 0
        while (end := held.find(b"\r\n\r\n", max(0, searched - 3))) < 0:
            searched = len(held)
            if not fill(searched + 1):
                if held.strip():
                    raise ValueError("the archive ends within a header")
                return
        size = end + 4 + int(_headers(bytes(held[:end]))["content-length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends within a record")
        yield bytes(held[:size])
        del held[:size]


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    pairs = (line.split(":", 1) for line in lines[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def _spread(manifest: DataFrame) -> DataFrame:
    """One archive per task, as far as possible."""
    return manifest.repartition(max(1, manifest.count()))


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives (column ``archive``) with a member per record and an index.

    The index file has one JSON line per record: offset, length, id, type.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                name = files.attempt_name("records", number, ".warc.gz")
                number, count, offset = number + 1, 0, 0
                with (
                    files.input_stream(archive) as raw,
                    files.output(folder, name) as out,
                    files.output(folder, f"{name}.idx") as index,
                ):
                    for record in _records(_inflated(raw)):
                        member = zlib.compress(record, 6, GZIP)
                        headers = _headers(record[: record.index(b"\r\n\r\n")])
                        out.write(member)
                        line = {"offset": offset, "length": len(member), "id": headers.get("warc-record-id"), "type": headers.get("warc-type")}
                        index.write(json.dumps(line).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield _manifest(f"{folder}/{name}", f"{folder}/{name}.idx", count)

    return written(_spread(archives.select("archive")).mapInArrow(rewrite, _MANIFEST), "normalised")


def _parsed(member: bytes) -> dict:
    record = zlib.decompress(member, GZIP)
    end = record.index(b"\r\n\r\n")
    headers, block = _headers(record[:end]), record[end + 4 : -4]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
        raise ValueError(f"digest of {headers.get('warc-record-id')} does not match its payload")
    uri = headers.get("warc-target-uri")
    return {
        "record_id": _key(headers.get("warc-record-id")),
        "uri": uri,
        "record_type": kind,
        "refers_to": _key(headers.get("warc-refers-to")),
        "payload_bytes": int(headers["x-payload-length"]),
        "payload_digest": digest,
        "payload": None if kind == "revisit" else block,
    }


def read_records(normalised: DataFrame) -> DataFrame:
    """Every record by its index; the digest of each response is checked."""
    names = [column.split()[0] for column in _RECORDS.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        arrays = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows, size = [], 0
                with files.input_stream(row["index"]) as index, files.input_file(row["archive"]) as raw:
                    for line in _lines(index):
                        at = json.loads(line)
                        raw.seek(at["offset"])
                        rows.append(_parsed(raw.read(at["length"])))
                        size += rows[-1]["payload_bytes"]
                        if size >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return _spread(normalised).mapInArrow(read, _RECORDS)


def _lines(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(chunk):
        *lines, rest = (rest + data).split(b"\n")
        yield from lines
    if rest:
        yield rest


def archived_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write pages to archives, normalise them and read every record back."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    crawled = write_archives(page_records(pages, **options), f"{folder}/crawl")
    return read_records(normalise(crawled, f"{folder}/records"))
