"""Conversion of legacy ARC archives to WARC, and reading WARC back.

An ARC file starts with a version block that names the fields of the header lines that follow; a header line ends with
the length of its record. Records become WARC records with identifiers, dates, types and digests made from what ARC
gives. Archives are gzip files in the shared folder, written and read by Spark's own sources.

Header lines are matched by the kind of each field, so addresses, content types and locations may hold spaces. A date may
be cut after the year, month, day, hour or minute; one that is missing or no date is replaced by that of the archive. A
record whose header line fits no record, and the rest of an archive that ends too early, become rows with an ``error``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm.common import lean
from zonalis.sources.session import staged

REVISIT_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
FIRST_DATE = datetime(2000, 1, 1, tzinfo=UTC)
OUT_BYTES = 8 << 20
ARCHIVE_RECORDS = 2000  # a new archive starts after so many, since a task reads an archive as one value
GZIP_LEVEL = "BEST_SPEED"

# The version blocks of the ARC format.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}

# What the fields of a header line look like; all others are single words.
KINDS = {"URL": r".+?", "IP-address": r"\d+\.\d+\.\d+\.\d+|[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*|-", "Archive-date": r"\d{0,16}|-",
         "Content-type": r".*?", "Result-code": r"\d+|-", "Location": r".*?", "Offset": r"\d+|-",
         "Archive-length": r"\d+"}

CONVERTED = ("page_id long, record_id string, uri string, date string, ip string, record_type string, "
             "payload_bytes long, payload_digest string, head binary, payload binary, error string")
FACTS = ("file string, no int, page_id long, record_id string, record_type string, payload_bytes long, "
         "payload_digest string, error string")


def arc_header(version: int) -> bytes:
    """The version block that opens an ARC file."""
    body = f"{version} 0 InternetArchive\n{FIELDS[version]}\n".encode()
    date = FIRST_DATE.strftime("%Y%m%d%H%M%S")
    line = {1: f"filedesc://pages.arc 0.0.0.0 {date} text/plain {len(body)}",
            2: f"filedesc://pages.arc 0.0.0.0 {date} text/plain 200 - - 0 pages.arc {len(body)}"}[version]
    return line.encode() + b"\n" + body


def arc_record(page_id: int | None, url: str | None, html: str | None, version: int) -> bytes:
    """A page as an ARC record; its id travels in a header of the response."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    named = b"" if page_id is None else b"X-Page-Id: %d\r\n" % page_id
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + named
             + b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    uri = "".join((url or "about:blank").split()) or "about:blank"
    date = (FIRST_DATE + timedelta(seconds=(page_id or 0) % 500_000_000)).strftime("%Y%m%d%H%M%S")
    line = {1: f"{uri} 0.0.0.0 {date} text/html {len(block)}",
            2: f"{uri} 0.0.0.0 {date} text/html 200 - - 0 pages.arc {len(block)}"}[version]
    return line.encode("utf-8", "surrogatepass") + b"\n" + block


def line_pattern(fields: list[str]) -> re.Pattern[str]:
    """The header line of an archive whose version block names these fields."""
    return re.compile(" ".join(f"({KINDS.get(f, chr(92) + 'S+')})" for f in fields), re.DOTALL)


def read_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """Records of an ARC file, the version block included; header lines are read by the fields it names.

    A line that fits no record, but ends with a length, gives ``error`` and its block; without a length, or with too
    short a block, nothing after it can be read.
    """
    fields = FIELDS[1].split()
    pattern, opened = line_pattern(fields), None
    while line := stream.readline():
        if not line.strip():
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        last = text.rpartition(" ")[2]
        if not (last.isascii() and last.isdigit()):
            raise ValueError(f"an ARC header line without a length: {text[:200]!r}")
        block = stream.read(int(last))
        if len(block) != int(last):
            raise ValueError("an ARC record is shorter than its header says")
        if text.startswith("filedesc://"):
            values = text.split(" ")
            opened = values[2] if len(values) > 2 else None
            yield {"URL": values[0], "Archive-date": opened, "block": block}
            lines = block.decode("utf-8", "replace").splitlines()
            named = lines[1].split() if len(lines) > 1 else []
            if named and named[-1] == "Archive-length":
                fields, pattern = named, line_pattern(named)
            continue
        if found := pattern.fullmatch(text):
            yield dict(zip(fields, found.groups(), strict=True)) | {"opened": opened, "block": block}
        else:
            yield {"error": f"an ARC header line that fits no record: {text[:200]!r}", "block": block}


def arc_date(*stated: str | None) -> datetime:
    """The first of these that is a date, cut after any of its parts; else the first second of 1970."""
    for text in stated:
        digits = (text or "")[:14]
        if len(digits) >= 4 and len(digits) % 2 == 0 and digits.isascii() and digits.isdigit():
            try:
                return datetime.strptime(digits + "00000101000000"[len(digits):], "%Y%m%d%H%M%S")
            except ValueError:
                continue
    return datetime(1970, 1, 1)


def converted(record: dict) -> dict:
    """What a WARC record of an ARC record needs. The version block is a warcinfo, a DNS answer a resource."""
    if "error" in record:
        return {"error": record["error"]}
    block, uri = record["block"], record["URL"]
    cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
    cut = cut if cut >= 4 else 0
    head, payload = block[:cut], block[cut:]
    digest = hashlib.sha1(payload).hexdigest()
    date = arc_date(record.get("Archive-date"), record.get("opened"))
    kind = "warcinfo" if uri.startswith("filedesc://") else "response" if head else "resource"
    page = _whole(head, b"X-Page-Id")
    name = f"{uri} {record.get('Archive-date')} {page} {digest}"
    ip = record.get("IP-address", "0.0.0.0")
    return {"page_id": page, "record_id": str(uuid.uuid5(uuid.NAMESPACE_URL, name)),
            "uri": uri, "date": date.strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0"), "ip": "0.0.0.0" if ip == "-" else ip,
            "record_type": kind, "payload_bytes": len(payload), "payload_digest": digest, "head": head,
            "payload": payload}


def records_of(content: bytes) -> Iterator[dict]:
    """Converted records of one archive without its version block; what cannot be read is a row with ``error``."""
    try:
        with gzip.open(io.BytesIO(content)) as stream:
            for record in map(converted, read_arc(stream)):
                if record.get("record_type") != "warcinfo":
                    yield record
    except (ValueError, EOFError, OSError, zlib.error) as e:
        yield {"error": f"the rest of the archive cannot be read: {e}"}


def _header(head: bytes, name: bytes) -> str | None:
    for line in head.split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.lower():
            return value.strip().decode("utf-8", "replace")
    return None


def _whole(head: bytes, name: bytes) -> int | None:
    """A header that holds a 64-bit number; null for anything else."""
    text = _header(head, name)
    number = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -1 << 63 <= number < 1 << 63 else None


def warc_record(row: dict) -> bytes:
    """A WARC record; a revisit keeps the head of its response and names the record it refers to."""
    revisit = row["record_type"] == "revisit"
    block = row["head"] if revisit else row["head"] + row["payload"]
    base32 = lambda digest: base64.b32encode(digest).decode()
    lines = [
        "WARC/1.0",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{row['record_id']}>",
        f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {row['uri']}",
        f"WARC-IP-Address: {row['ip']}",
        f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['payload_digest']))}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:uuid:{row['refers_to_record']}>"]
    lines += ["Content-Type: application/http; msgtype=response" if row["head"] else "Content-Type: text/plain",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record starts with its version")
        headers = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "surrogatepass").partition(":")
            headers[key.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a WARC record is shorter than its header says")
        yield headers, block


def _write(records: DataFrame, path: str, rows: int) -> None:
    """Gzip files of ``rows`` rows; the text sink adds the line end that closes a record."""
    (records.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip")
     .option("zlib.compress.level", GZIP_LEVEL)
     .option("maxRecordsPerFile", rows).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(F.col("path").alias("file"), "content"))


def _batches(rows: Iterator[dict], schema: pa.Schema, size: str) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row.get(size) or b"")
        if total >= OUT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


RECORD = pa.schema([("record", pa.binary())])


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> None:
    """Pages as ARC files, versions 1 and 2 by turns. A null page is empty, a null address ``about:blank``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version = 1 + TaskContext.get().partitionId() % 2

        def rows() -> Iterator[dict]:
            yield {"record": arc_header(version)}
            n = 0
            for batch in batches:
                for page, url, html in zip(*batch.columns, strict=True):
                    if n and n % ARCHIVE_RECORDS == 0:
                        yield {"record": arc_header(version)}
                    n += 1
                    yield {"record": arc_record(page.as_py(), url.as_py(), html.as_py(), version)}

        yield from _batches(rows(), RECORD, "record")

    _write(pages.select(F.col(id_col).cast("long"), url_col, html_col).mapInArrow(lean(run), "record binary"), path,
           ARCHIVE_RECORDS + 1)


CONVERTED_ROWS = pa.schema([
    ("page_id", pa.int64()), *((c, pa.string()) for c in ("record_id", "uri", "date", "ip", "record_type")),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("head", pa.binary()), ("payload", pa.binary()),
    ("error", pa.string())])


def convert_arc(spark: SparkSession, path: str) -> DataFrame:
    """Converted records of all ARC files below a folder, without the version blocks; unreadable ones have ``error``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((record for batch in batches for content in batch.column(0)
                             for record in records_of(content.as_py())), CONVERTED_ROWS, "payload")

    return _files(spark, path).select("content").mapInArrow(lean(run), CONVERTED)


def arc_facts(spark: SparkSession, path: str) -> DataFrame:
    """What decides on revisits, without the contents: one row per record with its file and place in it."""
    schema = pa.schema([("file", pa.string()), ("no", pa.int32()),
                        *(f for f in CONVERTED_ROWS if f.name not in ("uri", "date", "ip", "head", "payload"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(*batch.columns, strict=True):
                rows = []
                for no, record in enumerate(records_of(content.as_py())):
                    rows.append({f.name: record.get(f.name) for f in schema} | {"file": file.as_py(), "no": no})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _files(spark, path).select("file", "content").mapInArrow(lean(run), FACTS)


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Write the records of all ARC files as WARC files with revisits; returns (file, no, error) of what was left out.

    Revisits are decided on digests, sizes and ids. What is decided travels to the archives as one list per archive:
    payloads are not shuffled, and an archive is compressed when it meets its list.
    """
    facts = staged(arc_facts(spark, arc_path), "arc-facts")
    revisits = (mark_revisits(facts.filter("error IS NULL"), least).filter("refers_to_record IS NOT NULL")
                .groupBy("file").agg(F.collect_list("no").alias("places"),
                                     F.collect_list("refers_to_record").alias("targets")))
    archives = _files(spark, arc_path).join(revisits, "file", "left").select("content", "places", "targets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for content, places, targets in zip(*batch.columns, strict=True):
                    again = dict(zip(places.as_py() or (), targets.as_py() or (), strict=True))
                    for no, record in enumerate(records_of(content.as_py())):
                        if "error" in record:
                            continue
                        if no in again:
                            record |= {"record_type": "revisit", "refers_to_record": again[no]}
                        yield {"record": warc_record(record)[:-1]}

        yield from _batches(rows(), RECORD, "record")

    _write(archives.mapInArrow(lean(run), "record binary"), warc_path, ARCHIVE_RECORDS)
    return facts.filter("error IS NOT NULL").select("file", "no", "error")


def mark_revisits(records: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Of equal payloads of at least ``least`` bytes the largest page id stays a response; others revisit it.

    Adds ``refers_to_record``; a column ``payload``, if there is one, is emptied for revisits. Pages without an id are
    never the one referred to; if no page of a payload has an id, all stay responses, as do repeated rows of the one that
    stays. Keeping the largest combines before the shuffle, and only payloads met twice are joined.
    """
    keepers = (records.filter((F.col("payload_bytes") >= least) & (F.col("record_type") == "response"))
               .groupBy("payload_digest", "payload_bytes")
               .agg(F.max("page_id").alias("keeper"), F.max_by("record_id", "page_id").alias("kept_record"),
                    F.count("*").alias("copies"))
               .filter("copies > 1 AND keeper IS NOT NULL").drop("copies"))
    joined = records.join(keepers, ["payload_digest", "payload_bytes"], "left")
    again = (F.col("record_type") == "response") & F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id"))
    new = {"record_type": F.when(again, "revisit").otherwise(F.col("record_type")),
           "payload": F.when(~again, F.col("payload")) if "payload" in records.columns else None}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in records.columns),
                         F.when(again, F.col("kept_record")).alias("refers_to_record"))


def write_warc(records: DataFrame, path: str) -> None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield {"record": warc_record(batch.slice(i, 1).to_pylist()[0])[:-1]}

        yield from _batches(rows(), RECORD, "record")

    _write(records.filter("error IS NULL").mapInArrow(lean(run), "record binary"), path, ARCHIVE_RECORDS)


def load_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_id, record_type, uri, date, payload_bytes, payload_digest, refers_to_record) of WARC files.

    Digests of blocks and of payloads that are present are computed again and must agree.
    """
    names = ["page_id", "record_id", "record_type", "uri", "date", "payload_bytes", "payload_digest", "refers_to_record"]
    whole = {"page_id", "payload_bytes"}
    schema = pa.schema([(c, pa.int64() if c in whole else pa.string()) for c in names])
    bare = lambda name: name and name.strip("<>").removeprefix("urn:uuid:")

    def row(headers: dict[str, str], block: bytes) -> dict:
        digest = lambda name: base64.b32decode(headers[name].removeprefix("sha1:"))
        cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
        head, payload = block[:cut], block[cut:]
        stated = digest("warc-payload-digest")
        revisit = headers["warc-type"] == "revisit"
        if hashlib.sha1(block).digest() != digest("warc-block-digest") or (
                not revisit and hashlib.sha1(payload).digest() != stated):
            raise ValueError("a WARC digest does not fit its record")
        return {"page_id": _whole(head, b"X-Page-Id"), "record_id": bare(headers["warc-record-id"]),
                "record_type": headers["warc-type"], "uri": headers.get("warc-target-uri"),
                "date": headers["warc-date"], "payload_bytes": _whole(head, b"Content-Length") if revisit else len(payload),
                "payload_digest": stated.hex(), "refers_to_record": bare(headers.get("warc-refers-to")), "size": b""}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    rows = [row(*r) for r in read_warc(stream)]
                yield pa.RecordBatch.from_pylist(rows, schema)

    types = ", ".join(f"{c} {'long' if c in whole else 'string'}" for c in names)
    return _files(spark, path).select("content").mapInArrow(lean(run), types)
