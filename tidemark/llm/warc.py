"""WARC: a converter of legacy ARC archives, with a writer and readers for both formats.

``pages_to_arc`` writes pages as ARC files (version 1 and 2 by turns),
``read_arc`` parses them by each version's own header line and the declared
lengths, ``arc_to_warc`` synthesises equivalent WARC records (identifier,
timestamp, type, digests) and writes them, and ``read_warc`` reads those back
by their Content-Length.

Each archive is one file of about ``ARCHIVE_BYTES``, with every record a gzip
member of its own. Files are written by Spark's text writer, one archive a
file, so they go to any file system that Spark reaches and only whole files of
successful tasks appear; they are read back with the binaryFile source.

A payload never leaves its task: which records revisit others is decided from
(page id, digest) rows alone, aggregated by digest before they are shuffled, and
brought to the records as a small table (broadcast up to ``MOST_BROADCAST``
rows, else joined by page id).

Defined results: a null html is an empty payload; a null url is ``-``; a null
page id stays null. Rows that repeat a page id and its payload are each a record
of the same type; of equal payloads the largest page id is the response, so there are
no ties. A very long page is one record and may make an archive of its own. Extra
columns are not returned; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import calendar
import hashlib
import re
import time
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import delete_path, drop, new_path, table, written

ARCHIVE_BYTES = 8 << 20
MOST_BROADCAST = 500_000
#: Pages carry no crawl time; records are dated by their page id from here on.
EPOCH = 1_704_067_200
ARC_FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF = b"\r\n"
RECORD = "page_id bigint, url string, ip string, date string, mime string, status int, headers binary, payload binary, payload_digest string"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes, window: int = 1 << 15) -> Iterator[bytes]:
    """The contents of the gzip members of a file, one by one, fed in windows: what follows a member is never copied whole."""
    view, at = memoryview(data), 0
    while at < len(view) and any(view[at : at + 2]):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at : at + window]
            if not piece:
                raise ValueError("a gzip member is cut off")
            out.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        yield b"".join(out)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def write_archives(df: DataFrame, path: str) -> None:
    """Write rows (archive binary) as files. The last byte of a gzip member under 16 MB is zero; it is written as the line separator."""
    df.select(F.col("archive").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def sealed(parts: list[bytes], closing: bytes) -> bytes:
    """An archive without its last byte; ``closing`` is a small record, so that byte is zero."""
    return (b"".join(parts) + member(closing))[:-1]


# --- ARC ------------------------------------------------------------------------


def http_response(page_id: int | None, payload: bytes) -> bytes:
    """The network document of a page; its id travels as an HTTP header."""
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n"
    return head.encode() + payload


def arc_url(url: str | None) -> str:
    """A url without characters that would end a header field."""
    return re.sub(r"[\x00-\x20\x7f-\xa0  %]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()) if m[0] != "%" else "%", url or "") or "-"


def arc_record(version: int, url: str | None, date: str, body: bytes, offset: int, name: str) -> bytes:
    fields = [arc_url(url), "0.0.0.0", date, "text/html"]
    if version == 2:
        fields += ["200", hashlib.sha1(body).hexdigest(), "-", str(offset), name]
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def version_block(version: int, name: str, date: str) -> bytes:
    """The first record of an ARC file: it names the version and the fields of the header lines."""
    body = f"{version} 0 tidemark\n".encode() + ARC_FIELDS[version] + b"\n"
    fields = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"] + (["200", "-", "-", "0", name] if version == 2 else [])
    return " ".join([*fields, str(len(body))]).encode() + b"\n" + body + b"\n"


def arc_archives(batches: Iterator[pa.RecordBatch], most: int = ARCHIVE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches (page_id, url, html) as rows of one ARC file each."""
    parts: list[bytes] = []
    size = number = 0
    seed = uuid.uuid4().hex[:12]
    done = lambda: pa.RecordBatch.from_arrays([pa.array([sealed(parts, version_record)], pa.binary())], ["archive"])
    version_record = b""
    for whole in batches:
        for first in range(0, whole.num_rows, 200):
            for row in whole.slice(first, 200).to_pylist():
                if not parts:
                    version = number % 2 + 1
                    name = f"{seed}-{number}.arc"
                    parts = [member(version_block(version, name, "20240101000000"))]
                    version_record = version_block(version, name, "20240101000000")
                    size, number = 0, number + 1
                page = row["page_id"]
                date = time.strftime("%Y%m%d%H%M%S", time.gmtime(EPOCH + (page or 0) % 10_000_000))
                body = http_response(page, (row["html"] or "").encode())
                parts.append(member(arc_record(version, row["url"], date, body, size, name)))
                size += len(body)
                if size >= most:
                    yield done()
                    parts = []
    if parts:
        yield done()


def pages_to_arc(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most: int = ARCHIVE_BYTES) -> None:
    rows = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    write_archives(rows.mapInArrow(lambda it: arc_archives(it, most), "archive binary"), path)


def parse_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, body) of the records of an ARC file, by the version that its blocks declare. Raises ValueError where a length doesn't hold."""
    fields = None
    for content in members(data):
        at = 0
        while at < len(content):
            if content[at : at + 1] == b"\n":
                at += 1
                continue
            end = content.find(b"\n", at)
            line = content[at : end if end >= 0 else len(content)].decode().split(" ")
            body = content[end + 1 : end + 1 + int(line[-1])]
            if end < 0 or len(body) != int(line[-1]):
                raise ValueError(f"an ARC record of {line[0]} is shorter than it declares")
            at = end + 1 + len(body)
            if line[0].startswith("filedesc:"):
                version = int(body.split(b" ", 1)[0])
                if version not in ARC_FIELDS:
                    raise ValueError(f"unknown ARC version {version}")
                fields = body.split(b"\n")[1].decode().split(" ")
                continue
            if fields is None or len(line) != len(fields):
                raise ValueError(f"an ARC header line doesn't have the fields of its version: {' '.join(line)[:200]}")
            yield dict(zip(fields, line, strict=True)), body


def parse_http(body: bytes) -> tuple[int | None, int, bytes, bytes]:
    """(page id, status, header block with its blank line, payload) of a network document."""
    head, mark, payload = body.partition(b"\r\n\r\n")
    page = re.search(rb"^X-Page-Id: (-?\d+)\r?$", head, re.M)
    status = re.match(rb"HTTP/\S+ (\d+)", head)
    return int(page[1]) if page else None, int(status[1]) if status else 200, head + mark, payload


def read_arc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """A row of RECORD for each record of the ARC files under ``path`` (headers and payload null unless asked for)."""
    names = [f.split()[0] for f in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows: list[tuple] = []
                for head, body in parse_arc(data.as_py()):
                    page, status, headers, payload = parse_http(body)
                    rows.append((page, head["URL"], head["IP-address"], head["Archive-date"], head["Content-type"], status, headers if with_payload else None, payload if with_payload else None, sha1(payload)))
                    if len(rows) == 200:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.string()]
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    return archives(spark, path).mapInArrow(run, RECORD)


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path).select("content")


# --- WARC -----------------------------------------------------------------------


def record_id(page: int | None, digest: str, date: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {date}')}>"


def warc_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


def converted(row: dict) -> bytes:
    """The WARC record of an ARC record; ``refers_to`` is the page that it revisits."""
    iso = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.strptime(row["date"], "%Y%m%d%H%M%S"))
    revisit = row["refers_to"] is not None
    block = row["headers"] if revisit else row["headers"] + row["payload"]
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], row["payload_digest"], row["date"])),
        ("WARC-Date", iso),
        ("WARC-Target-URI", row["url"]),
        ("WARC-IP-Address", row["ip"]),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("X-Payload-Length", str(len(row["payload"]))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        at = time.strftime("%Y%m%d%H%M%S", time.gmtime(EPOCH + row["refers_to"] % 10_000_000))
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(row["refers_to"], row["payload_digest"], at)),
            ("X-Refers-To-Page", str(row["refers_to"])),
        ]
    return warc_record(headers, block)


def warc_archives(batches: Iterator[pa.RecordBatch], most: int = ARCHIVE_BYTES) -> Iterator[pa.RecordBatch]:
    about = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    info = lambda: warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())), ("Content-Type", "application/warc-fields")], about)
    parts: list[bytes] = []
    size = 0
    done = lambda: pa.RecordBatch.from_arrays([pa.array([sealed(parts, info())], pa.binary())], ["archive"])
    for whole in batches:
        for first in range(0, whole.num_rows, 200):
            for row in whole.slice(first, 200).to_pylist():
                if not parts:
                    parts, size = [member(info())], 0
                record = converted(row)
                parts.append(member(record))
                size += len(record)
                if size >= most:
                    yield done()
                    parts = []
    if parts:
        yield done()


def revisits(records: DataFrame, least_bytes: int = 0, sizes: str | None = None) -> DataFrame:
    """(page_id, payload_digest, refers_to): the records that revisit the one of the largest page id with their payload.

    Payloads of under ``least_bytes`` bytes (column ``sizes``) are all responses.
    """
    if sizes:
        records = records.where(F.col(sizes) >= least_bytes)
    leading = records.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    return records.join(leading, "payload_digest").where("page_id is null or page_id < refers_to").select("page_id", "payload_digest", "refers_to").distinct()


def arc_to_warc(spark: SparkSession, arc: str, warc: str, most: int = ARCHIVE_BYTES, most_broadcast: int = MOST_BROADCAST) -> None:
    """Convert the ARC files under ``arc`` to WARC files under ``warc``."""
    digests = written(read_arc(spark, arc, with_payload=False).select("page_id", "payload_digest"), "digests")
    known = written(revisits(digests), "revisits")
    drop(digests)
    small = known.count() <= most_broadcast
    rows = read_arc(spark, arc)
    key = known.select(F.col("page_id").alias("k_page"), F.col("payload_digest").alias("k_digest"), "refers_to")
    joined = rows.join(F.broadcast(key) if small else key, rows.page_id.eqNullSafe(key.k_page) & (rows.payload_digest == key.k_digest), "left")
    write_archives(joined.select(*rows.columns, "refers_to").mapInArrow(lambda it: warc_archives(it, most), "archive binary"), warc)
    drop(known)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of the records of a WARC file. Raises ValueError where a length or digest doesn't hold."""
    for content in members(data):
        at = 0
        while at < len(content):
            end = content.find(b"\r\n\r\n", at)
            lines = content[at:end].decode().split("\r\n")
            if end < 0 or not lines[0].startswith("WARC/"):
                raise ValueError("no WARC record where one has to begin")
            headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
            size = int(headers["content-length"])
            block = content[end + 4 : end + 4 + size]
            if len(block) != size:
                raise ValueError(f"record {headers.get('warc-record-id')} is shorter than it declares")
            at = end + 8 + size
            yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url, date) of the response and revisit records under ``path``."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for h, block in parse_warc(data.as_py()):
                    kind = h["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    page, _, _, payload = parse_http(block)
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    size = int(h["x-payload-length"])
                    if f"sha1:{sha1(block)}" != h["warc-block-digest"] or kind == "response" and (sha1(payload), len(payload)) != (digest, size):
                        raise ValueError(f"the digest of record {h['warc-record-id']} doesn't hold")
                    refers = h.get("x-refers-to-page")
                    rows.append((page, size, digest, kind, None if refers is None else int(refers), h["warc-record-id"], h["warc-target-uri"], h["warc-date"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return archives(spark, path).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, url string, date string")


def convert_pages(df: DataFrame, most: int = ARCHIVE_BYTES, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Pages to ARC, ARC to WARC, and what the WARC records say when they are read back. The archives are deleted as soon as they have been read."""
    spark = df.sparkSession
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    pages_to_arc(df, arc, most=most)
    arc_to_warc(spark, arc, warc, most, most_broadcast)
    delete_path(spark, arc)
    found = written(read_warc(spark, warc), "records")
    delete_path(spark, warc)
    return found


def op6_warc_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op6_warc_conversion": op6_warc_conversion}
#: SHA-1 in base32 can't be expressed in DuckDB SQL; tests/llm compares with a brute-force version.
ORACLES: dict[str, str] = {}
