"""Convert legacy ARC archives to WARC and read WARC archives back.

ARC files carry a version block and then records: one header line, whose fields depend on the version, and as many
bytes as its last field declares.

* version 1: URL, IP address, date, content type, length
* version 2: URL, IP address, date, content type, result code, checksum, location, offset, file name, length

The converter walks an archive by these declared lengths, so what a payload contains does not matter, and gives every
record its WARC equivalent: a record id derived from URL, date, digest and the number in the archive (so reruns
agree), the 14-digit date as ISO time, a type, and SHA-1 digests. Of records with equal payloads the first is kept as
`response`, the others become `revisit` records that refer to it. WARC files are plain WARC/1.0, gzipped, written
through Spark's writer, and read back by the same walk over declared lengths.

Digests are compared, not payloads: the payloads themselves are shuffled once, to the files they are written to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import scratch_path

ARC_V1, ARC_V2 = 1, 2
CRLF = b"\r\n"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
RECORDS_PER_FILE = 4000
NO_DATE = "19700101000000"
V1_FIELDS = b"URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


@dataclass
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    payload: bytes


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _token(value: str | None) -> str:
    """One header field: ARC separates by single spaces, so spaces and line ends inside are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 else c for c in value or "") or "-"


def write_arc(records: list[ArcRecord], version: int = ARC_V2, name: str = "archive.arc") -> bytes:
    """An ARC file of the given version."""
    body = f"{version} 0 archive".encode() + b"\n" + (V1_FIELDS if version == ARC_V1 else V2_FIELDS) + b"\n"
    head = f"filedesc://{name} 0.0.0.0 {NO_DATE} text/plain"
    head += f" {len(body)}" if version == ARC_V1 else f" 200 - - 0 {name} {len(body)}"
    out, size = [head.encode(), b"\n", body, b"\n"], len(head) + len(body) + 2
    for r in records:
        line = f"{_token(r.url)} {_token(r.ip)} {r.date} {_token(r.content_type)}"
        if version == ARC_V1:
            line += f" {len(r.payload)}"
        else:
            line += f" 200 {payload_digest(r.payload)} - {size} {name} {len(r.payload)}"
        raw = line.encode("utf-8", "surrogatepass")
        out += [raw, b"\n", r.payload, b"\n"]
        size += len(raw) + len(r.payload) + 2
    return b"".join(out)


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file; the version block tells how header lines are read.

    A header line of another form, or a length beyond the end of the data, is an error: nothing after it can be trusted.
    """
    at, version = 0, ARC_V1
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header line at byte {at} does not end")
        fields = data[at:end].decode("utf-8", "surrogatepass").split(" ")
        if fields[0].startswith("filedesc://"):
            body = data[end + 1 : end + 1 + int(fields[-1])]
            version = int(body.split(b" ", 1)[0])
            if version not in (ARC_V1, ARC_V2):
                raise ValueError(f"ARC version {version} is unknown")
        elif len(fields) != (5 if version == ARC_V1 else 10):
            raise ValueError(f"ARC header line at byte {at} has {len(fields)} fields in version {version}")
        size = int(fields[-1])
        stop = end + 1 + size
        if size < 0 or stop > len(data):
            raise ValueError(f"ARC record at byte {at} declares {size} bytes, more than there are")
        if not fields[0].startswith("filedesc://"):
            yield ArcRecord(fields[0], fields[1], fields[2], fields[3], data[end + 1 : stop])
        at = stop
        while data[at : at + 1] == b"\n":  # records are parted by one line end, some writers add more
            at += 1


def iso_date(date: str) -> str:
    """14-digit (or shorter) ARC date as the ISO form of WARC."""
    d = (date + NO_DATE[len(date) :])[:14] if date.isdigit() else NO_DATE
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str, *more: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, ' '.join(map(str, (url, date, digest, *more))))}>"


def _text(record: tuple[list[tuple[str, str]], bytes]) -> str:
    """A record as text for Spark's writer. A block that is no UTF-8 is written as base64 and says so."""
    head, block = record
    try:
        body = block.decode()
    except UnicodeDecodeError:
        body = base64.b64encode(block).decode()
        head = [*head, ("Content-Transfer-Encoding", "base64")]
    head = [*head, ("Content-Length", str(len(body.encode())))]
    return "\r\n".join(["WARC/1.0", *[f"{k}: {v}" for k, v in head], "", body])


def warc_record(url: str, date: str, content_type: str, payload: bytes, digest: str, rid: str, refers: tuple[str, str] | None, number: str | None) -> str:
    """One WARC/1.0 record without its closing line ends; a revisit has no block and names what it refers to."""
    head = [("WARC-Type", "revisit" if refers else "response"), ("WARC-Record-ID", rid), ("WARC-Date", iso_date(date)), ("WARC-Target-URI", url)]
    if refers:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("WARC-Refers-To", refers[0])]
        head += [("X-Refers-To-Number", refers[1]), ("X-Payload-Length", str(len(payload)))]
    block = b"" if refers else payload
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"), ("Content-Type", content_type)]
    return _text((head + ([] if number is None else [("X-Archive-Number", number)]), block))


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, by declared lengths."""
    at = 0
    while at < len(data):
        stop = data.find(CRLF + CRLF, at)
        if not data.startswith(b"WARC/", at) or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:stop].split(CRLF)[1:]
        head = dict(x.decode("utf-8", "surrogatepass").split(": ", 1) for x in lines)
        size = int(head["Content-Length"])
        end = stop + 4 + size
        if data[end : end + 4] != CRLF + CRLF:
            raise ValueError(f"WARC record at byte {at} does not end after {size} bytes")
        block = data[stop + 4 : end]
        yield head, base64.b64decode(block) if head.get("Content-Transfer-Encoding") == "base64" else block
        at = end + 4


def arcs_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", version: Column | None = None) -> DataFrame:
    """Legacy archives of a page table, as (ids, data): a few pages each, both versions unless `version` says which.

    The ids stand beside the archive, since ARC records have none; null payloads are empty, null URLs are `-`.
    """
    v = F.when(F.pmod(F.xxhash64(id_col, url_col), F.lit(2)) == 0, ARC_V1).otherwise(ARC_V2) if version is None else version
    taken = pages.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"), v.alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for low in range(0, len(rows), 64):
                for version_ in (ARC_V1, ARC_V2):
                    mine = [r for r in rows[low : low + 64] if r[3] == version_]
                    if mine:
                        records = [ArcRecord(u or "", "0.0.0.0", NO_DATE, "text/html", (h or "").encode()) for _, u, h, _ in mine]
                        yield pa.RecordBatch.from_pydict({"ids": [[r[0] for r in mine]], "data": [write_arc(records, version_)]}, schema=schema)

    schema = pa.schema([("ids", pa.list_(pa.string())), ("data", pa.binary())])
    return taken.mapInArrow(run, "ids array<string>, data binary")


def convert(archives: DataFrame, path: str, least_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of `archives` (ids, data) as WARC files below `path`.

    Of records with equal payloads of at least `least_bytes` bytes that with the smallest id (as a number, then as
    text; null last) is the response, the others are revisits; smaller ones are all responses.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32  # tells repeated rows apart
        for batch in batches:
            for ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = []
                for i, r in zip(ids, read_arc(data), strict=True):
                    found.append((i, r.url, r.date, r.content_type, r.payload, len(r.payload), payload_digest(r.payload), number))
                    number += 1
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], names=names)

    names = ["id", "url", "date", "content_type", "payload", "bytes", "digest", "number"]
    types = [pa.string()] * 4 + [pa.binary(), pa.int64(), pa.string(), pa.int64()]
    records = archives.mapInArrow(parse, "id string, url string, date string, content_type string, payload binary, bytes long, digest string, number long")
    rank = F.struct(F.col("id").isNull().alias("none"), F.expr("try_cast(id as decimal(38,0))").alias("n"), F.col("id"), F.col("url"), F.col("date"), F.col("number"))
    narrow = records.select("bytes", "digest", rank.alias("rank"))
    groups = narrow.where(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = records.join(groups.select(F.col("digest").alias("d"), "first"), (F.col("digest") == F.col("d")) & (F.col("bytes") >= least_bytes), "left")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, url, date, kind, payload, digest, number, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                refers = None
                if first is not None and first["number"] != number:
                    refers = (record_id(first["url"], first["date"], digest, first["id"]), first["id"] or "")
                rid = record_id(url, date, digest, i, *([number] if refers or first is None else []))
                out.append(warc_record(url, date, kind, payload, digest, rid, refers, i))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    text = joined.select("id", "url", "date", "content_type", "payload", "digest", "number", "first").mapInArrow(render, "value string")
    # the writer ends each row with what ends a WARC record
    text.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files below `path`: number, url, date, record_type, record_id, refers_to, bytes, digest, payload.

    The digest is that of the full payload, checked against the block for responses.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = ["number", "url", "date", "record_type", "record_id", "refers_to", "refers_to_number", "bytes", "digest", "payload"]
    types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                rows, held = [], 0
                for head, block in read_warc(gzip.decompress(raw.as_py())):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if head["WARC-Type"] == "response" and payload_digest(block) != digest:
                        raise ValueError(f"{head['WARC-Record-ID']}: block and digest differ")
                    rows.append(
                        (head.get("X-Archive-Number"), head["WARC-Target-URI"], head["WARC-Date"], head["WARC-Type"], head["WARC-Record-ID"],
                         head.get("WARC-Refers-To"), head.get("X-Refers-To-Number"), int(head.get("X-Payload-Length", len(block))), digest, block)
                    )
                    held += len(block)
                    if held > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = "number string, url string, date string, record_type string, record_id string, refers_to string, refers_to_number string, bytes long, digest string, payload binary"
    return files.mapInArrow(run, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Pages as ARC archives, converted to WARC files, read back: one row per page.

    Columns: id, payload_bytes, payload_digest, record_type, refers_to (the id of the response, null for responses),
    record_id, url and warc_date. A null page is an empty payload, a null URL `-`. Of repeated rows with equal id one
    is the response. Pages of an empty table give no rows; other columns are not read.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    convert(arcs_of(pages, id_col, url_col, html_col), path, least_bytes)
    kind = pages.schema[id_col].dataType
    back = read_archives(spark, path)
    return back.select(
        F.col("number").cast(kind).alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", F.col("refers_to_number").cast(kind).alias("refers_to"), "record_id", "url", F.col("date").alias("warc_date"),
    )
