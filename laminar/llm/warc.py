"""Legacy archives (ARC, versions 1 and 2) to WARC.

An ARC file opens with a version block: a ``filedesc`` record whose two lines give the
version and the fields of the header lines. Each record is one header line, split from its
right end by those fields (old urls may hold spaces), and as many bytes as the line
declares. From that the converter makes up what WARC asks for and ARC lacks: an identifier
(a UUID of archive and offset), a timestamp from the 14 digits, a type (warcinfo for the
version block, response where the block opens like an HTTP answer, else resource) and
digests of block and payload. Of records with equal payloads the first in the caller's
order is kept, the others become revisits of it.

Archives are written and read by Spark: rows are joined in each task to archives of about
``ARCHIVE_BYTES``, one per file, so that reads can be dealt out by file, and the text
writer's commit protocol keeps half-written files of lost tasks away. Reading streams through an
archive, a record at a time. Bytes of any kind survive.

Scale: equal payloads are found on (identifier, digest) rows alone, and a digest or target
that very many records share is split over tasks (``operators/skew.py``). Archives meet the
verdicts on their records as stored, shuffled once by name; payloads unpacked are not
shuffled. A list of verdicts is short beside its archive: at most one entry per record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminar.llm.common import pinned, small_batches, unused, workers_import_package
from laminar.operators.skew import split_hot_key_join

ARCHIVE_BYTES = 16 << 20  # an archive ends with the record that reaches this
BATCH_BYTES = 4 << 20  # blocks handed on at a time
GZIP_LEVEL = "FOUR"  # as Hadoop names them: a quarter of the default's time, 4 % more bytes
MIN_PAYLOAD = 100  # shorter payloads are never revisits

# Header fields of the ARC versions, the profile of revisits.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum",
        "Location", "Offset", "Filename", "Archive-length",
    ),
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "19700101000000"

ARC_SCHEMA = (
    "archive string, offset long, version int, url string, ip string, archive_date string, "
    "content_type string, result_code string, checksum string, location string, "
    "damage string, head_bytes int, block binary"
)
WARC_SCHEMA = (
    "archive string, offset long, type string, record_id string, date string, url string, "
    "ip string, content_type string, payload_digest string, payload_bytes long, "
    "block_digest string, refers_to string, truncated string, head_bytes int, block binary"
)


# --------------------------------------------------------------------------- bytes of archives

def _field(value, default: str = "-") -> str:
    """A value of a header line: no white space, no control characters."""
    if value is None or value == "":
        return default
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", str(value))


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 laminar\n{' '.join(ARC_FIELDS[version])}\n".encode()
    more = "200 - - 0 " + _field(name) + " " if version == 2 else ""
    return f"filedesc://{_field(name)} 0.0.0.0 {date} text/plain {more}{len(body)}\n".encode() + body + b"\n"


def arc_record(version: int, offset: int, name: str, url, ip, date, content_type, result, location, block: bytes) -> bytes:
    known = {
        "URL": _field(url),
        "IP-address": _field(ip, "0.0.0.0"),
        "Archive-date": _field(date, NO_DATE),
        "Content-type": _field(content_type, "no-type"),
        "Result-code": _field(result, "200"),
        "Checksum": hashlib.md5(block).hexdigest() if version == 2 else "-",
        "Location": _field(location),
        "Offset": str(offset),
        "Filename": _field(name),
        "Archive-length": str(len(block)),
    }
    line = " ".join(known[f] for f in ARC_FIELDS[version])
    return line.encode() + b"\n" + block + b"\n"


def _stream(content: bytes) -> io.BufferedIOBase:
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def _head_bytes(block: bytes) -> int:
    """Length of the HTTP headers with the blank line that ends them; 0 if there are none."""
    if not block.startswith(b"HTTP/"):
        return 0
    blank = re.search(rb"\r?\n\r?\n", block)
    return blank.end() if blank else len(block)


def _next_line(f) -> tuple[int, bytes]:
    """(offset, line) of the next line that is not empty; (offset, b"") at the end."""
    while True:
        at = f.tell()
        line = f.readline()
        if line not in (b"\n", b"\r\n"):
            return at, line


def parse_arc(content: bytes, archive: str) -> Iterator[tuple]:
    """Rows of ``ARC_SCHEMA``, the version block first. A block that ends early is kept as
    far as it goes (damage: truncated); from a header line that does not fit the version on,
    the rest of the archive is one row (damage: header)."""
    f = _stream(content)
    version, fields = 1, [x.lower() for x in ARC_FIELDS[1]]
    while True:
        at, line = _next_line(f)
        if not line:
            return
        values = line.rstrip(b"\r\n").decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        opening = line.startswith(b"filedesc:")
        if opening:  # its own fields are those of the version that it is about to name
            values = line.rstrip(b"\r\n").decode("utf-8", "replace").split(" ")
            values = [*values[:4], values[-1]]
        named = dict(zip([x.lower() for x in ARC_FIELDS[1]] if opening else fields, values))
        length = named.get("archive-length", "")
        if len(values) < (5 if opening else len(fields)) or not re.fullmatch("[0-9]+", length):
            yield (archive, at, version, None, None, None, None, None, None, None, "header", 0, line + f.read())
            return
        block = f.read(int(length))
        if opening:
            told = block.split(b"\n")
            version = int(told[0].split(b".")[0].split(b" ")[0] or 1) if told[0][:1].isdigit() else 1
            if len(told) > 1 and told[1].strip():
                fields = told[1].decode("ascii", "replace").lower().split()
        get = lambda k: None if named.get(k, "-") == "-" else named[k]  # noqa: B023, E731
        yield (
            archive, at, version, get("url"), get("ip-address"), get("archive-date"),
            get("content-type"), get("result-code"), get("checksum"), get("location"),
            "truncated" if len(block) < int(length) else None, _head_bytes(block), block,
        )


def warc_record(headers: Iterable[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in headers if v is not None]
    return "".join(["WARC/1.1\r\n", *lines, f"Content-Length: {len(block)}\r\n\r\n"]).encode() + block + b"\r\n\r\n"


def parse_warc(content: bytes, archive: str) -> Iterator[tuple]:
    """Rows of ``WARC_SCHEMA`` by declared lengths. What is no record is an error."""
    f = _stream(content)
    while True:
        at, line = _next_line(f)
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {at} of {archive}")
        headers = {}
        for line in iter(f.readline, b""):
            if line in (b"\r\n", b"\n"):
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers.get("content-length", -1))
        block = f.read(length) if length >= 0 else b""
        if len(block) != length:
            raise ValueError(f"record at {at} of {archive} is not whole")
        get = headers.get
        size = get("payload-length")
        yield (
            archive, at, get("warc-type"), get("warc-record-id"), get("warc-date"),
            get("warc-target-uri"), get("warc-ip-address"), get("content-type"),
            get("warc-payload-digest"), None if size is None else int(size),
            get("warc-block-digest"), get("warc-refers-to"), get("warc-truncated"),
            _head_bytes(block), block,
        )


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose last value is a block, in batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 500
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


class _Archive:
    """Records joined to one archive after another."""

    def __init__(self, opening, limit: int):
        self.opening, self.limit, self.count = opening, limit, 0
        self.parts: list[bytes] = []
        self.size = 0

    def name(self) -> str:
        return f"{TaskContext.get().partitionId():06d}-{self.count:05d}"

    def add(self, record) -> bytes | None:
        """Append ``record(offset)``; the archive if that completes it."""
        if not self.parts:
            self._put(self.opening(self.name()))
        self._put(record(self.size))
        return self.closed() if self.size >= self.limit else None

    def _put(self, part: bytes) -> None:
        self.parts.append(part)
        self.size += len(part)

    def closed(self) -> bytes | None:
        whole = b"".join(self.parts) if self.parts else None
        self.parts, self.size = [], 0
        self.count += 1
        return whole


def _one(archive: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([archive], pa.binary())], ["archive"])


# --------------------------------------------------------------------------- writing and reading

def _write(archives: DataFrame, path: str, end: str) -> None:
    """One file per row, as it is (``end``, which the format allows there, comes last)."""
    text = archives.select(F.col("archive").cast("string").alias("value"))
    writer = text.write.option("lineSep", end).option("maxRecordsPerFile", 1)
    writer.option("compression", "gzip").option("zlib.compress.level", GZIP_LEVEL).text(path)


def write_arc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """ARC files of ``records``: version (1 or 2), url, ip, archive_date (14 digits),
    content_type, result_code, location (strings or null) and block (binary)."""
    workers_import_package()
    small_batches(records.sparkSession)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = {
            v: _Archive(lambda name, v=v: arc_version_block(v, f"{name}-v{v}.arc", NO_DATE), archive_bytes)
            for v in ARC_FIELDS
        }
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                version, block = row[0], row[-1] or b""
                into = open_[version]
                make = lambda at: arc_record(version, at, into.name(), *row[1:-1], block)  # noqa: B023, E731
                if (whole := into.add(make)) is not None:
                    yield _one(whole)
        for into in open_.values():
            if (whole := into.closed()) is not None:
                yield _one(whole)

    columns = ["version", "url", "ip", "archive_date", "content_type", "result_code", "location", "block"]
    _write(records.select(*columns).mapInArrow(archives, "archive binary"), path, "\n")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content): the name of each file and its bytes as stored."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content")


def _read(files: DataFrame, parse, schema: str) -> DataFrame:
    """The records of archive files. With a column ``told``, (offset, refers_to) of some
    records each, a column refers_to comes before the block."""
    spark = files.sparkSession
    workers_import_package()
    small_batches(spark)
    judged = "told" in files.columns
    if judged:
        schema = schema.removesuffix("block binary") + "refers_to string, block binary"
    empty = spark.createDataFrame([], schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(empty.schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parsed() -> Iterator[tuple]:
            for batch in batches:
                for name, content, *told in zip(*batch.columns):
                    found = parse(content.as_py(), name.as_py())
                    if judged:
                        refers = {t["offset"]: t["refers_to"] for t in told[0].as_py() or ()}
                        found = ((*r[:-1], refers.get(r[1]), r[-1]) for r in found)
                    yield from found

        yield from _batches(parsed(), arrow)

    return files.mapInArrow(rows, schema)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of ARC files (gzipped or not, each below 2 GB as stored), version blocks
    included. See ``parse_arc`` for damaged files."""
    return _read(_files(spark, path), parse_arc, ARC_SCHEMA)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files (gzipped or not, each below 2 GB as stored)."""
    return _read(_files(spark, path), parse_warc, WARC_SCHEMA)


# --------------------------------------------------------------------------- what WARC asks for

def head() -> Column:
    """The HTTP headers of a record read, with their blank line, as bytes; empty if none."""
    return F.substring("block", F.lit(1), F.col("head_bytes"))


def payload() -> Column:
    """What follows the HTTP headers of a record read, as bytes."""
    return F.substr("block", F.col("head_bytes") + 1)


def record_id(archive: Column, offset: Column) -> Column:
    """A UUID (version 8) of the place of a record, as WARC writes it."""
    h = F.sha2(F.concat_ws("/", archive, offset.cast("string")), 256)
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(
        F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3),
        F.lit("-9"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"),
    )


def warc_date(archive_date: Column) -> Column:
    """14 digits (or the first 4 to 13 of them) as an ISO time; what is none: 1970-01-01."""
    digits = F.when(archive_date.rlike("^([0-9]{4}|[0-9]{6}|[0-9]{8}|[0-9]{10}|[0-9]{12}|[0-9]{14})$"), archive_date)
    padded = F.concat(digits, F.substr(F.lit("00000101000000"), F.length(digits) + 1))
    time = F.try_to_timestamp(F.coalesce(padded, F.lit(NO_DATE)), F.lit("yyyyMMddHHmmss"))
    return F.coalesce(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z"))


def converted(records: DataFrame) -> DataFrame:
    """The records of ``read_arc`` with what WARC asks for: record_id, type, date,
    payload_digest, payload_bytes, block_digest, truncated."""
    body = payload()
    kind = F.when(F.col("url").startswith("filedesc:"), "warcinfo").when(F.col("head_bytes") > 0, "response")
    return records.withColumns(
        {
            "record_id": record_id(F.col("archive"), F.col("offset")),
            "type": kind.otherwise("resource"),
            "date": warc_date(F.col("archive_date")),
            "payload_digest": F.sha2(body, 256),
            "payload_bytes": F.length(body).cast("long"),
            "block_digest": F.sha2("block", 256),
            "truncated": F.when(F.col("damage").isNotNull(), "unspecified"),
        }
    )


def revisits(
    records: DataFrame, order: list[str], min_payload: int = MIN_PAYLOAD, place: tuple = ()
) -> DataFrame:
    """(record_id, refers_to): responses whose payload of ``min_payload`` bytes or more an
    earlier one has, in the order of the columns ``order`` (nulls last, then by record_id).
    ``records`` has record_id, payload_digest, payload_bytes, type and those columns; its
    columns ``place`` are returned too."""
    long = records.where((F.col("type") == "response") & (F.col("payload_bytes") >= min_payload))
    long = long.select("record_id", "payload_digest", *order, *place)
    ranks = [x for c in order for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))]
    first = F.min(F.struct(*ranks, "record_id"))["record_id"]
    kept = long.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("copies"), first.alias("refers_to"))
    kept = kept.where("copies > 1")
    pairs = split_hot_key_join(
        long.select("record_id", "payload_digest", *place), kept, "payload_digest", "copies", F.col("record_id")
    )
    return pairs.where("record_id != refers_to").select("record_id", "refers_to", *place)


def write_warc(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """WARC files of converted ``records`` with a column refers_to (null: not a revisit).
    Each opens with a warcinfo record of its own; a revisit keeps only the HTTP headers."""
    workers_import_package()
    small_batches(records.sparkSession)
    block = F.when(F.col("refers_to").isNotNull(), head()).otherwise(F.col("block"))
    columns = [
        "type", "record_id", "date", "url", "ip", "content_type", "payload_digest",
        "payload_bytes", "block_digest", "refers_to", "truncated",
    ]

    def opening(name: str) -> bytes:
        opened = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
        head = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", opened), ("WARC-Date", "1970-01-01T00:00:00Z")]
        fields = b"format: WARC File Format 1.1\r\nsoftware: laminar\r\n"
        return warc_record([*head, ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], fields)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = _Archive(opening, archive_bytes)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                kind, key, date, url, ip, content, digest, size, whole_digest, refers, cut, data = row
                seen = refers is not None
                http = kind == "response"
                headers = [
                    ("WARC-Type", "revisit" if seen else kind),
                    ("WARC-Record-ID", key),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", None if url is None else _field(url)),
                    ("WARC-IP-Address", None if ip in (None, "0.0.0.0") else _field(ip)),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("Payload-Length", size),
                    ("WARC-Block-Digest", None if seen else f"sha256:{whole_digest}"),
                    ("WARC-Profile", SAME_PAYLOAD if seen else None),
                    ("WARC-Refers-To", refers),
                    ("WARC-Truncated", "length" if seen else cut),
                    ("Content-Type", "application/http; msgtype=response" if http else _field(content, "application/octet-stream")),
                ]
                if (whole := into.add(lambda _: warc_record(headers, data or b""))) is not None:  # noqa: B023
                    yield _one(whole)
        if (whole := into.closed()) is not None:
            yield _one(whole)

    _write(records.select(*columns, block.alias("block")).mapInArrow(archives, "archive binary"), path, "\r\n\r\n")


def convert(spark: SparkSession, arc_path: str, warc_path: str, order=None, min_payload: int = MIN_PAYLOAD) -> None:
    """The ARC files under ``arc_path`` as WARC files under ``warc_path``. ``order`` maps
    names to columns over a converted record (its block included) by which the first of
    equal payloads is chosen; without it the record_id decides. Version blocks are not
    copied: a WARC file has a warcinfo record of its own. Every archive, as stored, is a row
    of a shuffle."""
    order = order or {}
    records = converted(read_arc(spark, arc_path)).where("type != 'warcinfo'")
    (place,) = unused(records.withColumns(order), "place")
    facts = ["record_id", "type", "payload_digest", "payload_bytes", place]
    placed = records.withColumn(place, F.struct("archive", "offset"))
    narrow = pinned(placed.withColumns(order).select(*facts, *order))
    seen = revisits(narrow, list(order), min_payload, (place,)).select(f"{place}.*", "refers_to")
    told = pinned(seen.groupBy("archive").agg(F.collect_list(F.struct("offset", "refers_to")).alias("told")))
    files = _files(spark, arc_path).join(told, "archive", "left").select("archive", "content", "told")
    write_warc(converted(_read(files, parse_arc, ARC_SCHEMA)).where("type != 'warcinfo'"), warc_path)


# --------------------------------------------------------------------------- pages

def http_records(pages: DataFrame, key: str, url: str, html: str, version: Column) -> DataFrame:
    """The pages as records for ``write_arc``: an HTTP answer each, whose headers carry the
    key of the page; payload the html in UTF-8 (null: empty)."""
    body = F.coalesce(pages[html], F.lit("")).cast("binary")
    named = F.coalesce(F.concat(F.lit("X-Page-Id: "), pages[key].cast("string"), F.lit("\r\n")), F.lit(""))
    top = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.length(body).cast("string"), F.lit("\r\n"), named, F.lit("\r\n"),
    )
    null = F.lit(None).cast("string")
    return pages.select(
        version.cast("int").alias("version"),
        pages[url].alias("url"),
        null.alias("ip"),
        null.alias("archive_date"),
        F.lit("text/html").alias("content_type"),
        F.lit("200").alias("result_code"),
        null.alias("location"),
        F.concat(top.cast("binary"), body).alias("block"),
    )


def page_key() -> Column:
    """The key that ``http_records`` put into the headers (long, null: none)."""
    told = F.regexp_extract(head().cast("string"), "(?m)^X-Page-Id: (-?[0-9]+)$", 1)
    return told.try_cast("long")


def archived_pages(spark: SparkSession, warc_path: str) -> DataFrame:
    """What WARC files say of pages, a row each: page_id, payload_bytes, payload_digest (hex
    SHA-256), record_type and refers_to (the page that a revisit refers to). Digest and size
    of a response are taken from the payload read, those of a revisit from its headers."""
    whole = F.col("type") == "response"
    read = pinned(
        read_warc(spark, warc_path)
        .where("type in ('response', 'revisit')")
        .select(
            "record_id",
            F.col("type").alias("record_type"),
            page_key().alias("page_id"),
            F.when(whole, F.length(payload()).cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
            F.when(whole, F.sha2(payload(), 256)).otherwise(F.substr("payload_digest", F.lit(8))).alias("payload_digest"),
            F.col("refers_to").alias("target"),
        )
    )
    facts = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    told = read.where("record_type = 'revisit'").select(*facts, "target")
    targets = told.groupBy("target").agg(F.count(F.lit(1)).alias("revisits"))
    found = read.where("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("refers_to")
    )
    back = split_hot_key_join(
        told, targets.join(found, "target", "left"), "target", "revisits", F.xxhash64("page_id")
    )
    first = read.where("record_type = 'response'").select(*facts, F.lit(None).cast("long").alias("refers_to"))
    return first.unionByName(back.select(*facts, "refers_to"))


def archive_pages(
    pages: DataFrame, root: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write ``pages`` as ARC files of both versions (by the last bit of the key; null: 1)
    under ``root``/arc, convert them to ``root``/warc, and read those: see ``archived_pages``.

    Null html is an empty payload, a null url none. Of equal payloads the smallest key is
    kept; repeated rows are records of their own, all but one of them revisits of their own
    page. Pages without a key come last and read back without one. Pages of any length are
    whole (a page must fit in a row). Other columns are not read; an empty table gives an
    empty result.
    """
    spark = pages.sparkSession
    version = F.when(pages[key].cast("long") % 2 == 0, 2).otherwise(1)
    write_arc(http_records(pages, key, url, html, version), f"{root}/arc")
    convert(spark, f"{root}/arc", f"{root}/warc", {"page_key": page_key()})
    return archived_pages(spark, f"{root}/warc")


ORACLE_SQL = """WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f"""
