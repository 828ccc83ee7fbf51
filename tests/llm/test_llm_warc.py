"""ARC to WARC (13) against brute force, DuckDB SQL and hand-written archives."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from laminar import checks
from laminar.llm import queries, warc
from laminar.session import fresh_dir

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def brute(rows):
    """Rows of the contract; of equal keys and payloads one is the response."""
    out, first = [], {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for key, _, html in order:
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        if len(data) >= 100 and digest in first:
            out.append((key, len(data), digest, "revisit", first[digest]))
        else:
            first.setdefault(digest, key)
            out.append((key, len(data), digest, "response", None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_query_against_sql(spark, duck01):
    res = checks.compare(queries.QUERIES["op13_warc"](spark, SF), duck01, queries.ORACLE["op13_warc"])
    assert res["values_match"] and res["types_match"], res


def test_edge_pages(spark):
    copy = "<p>\r\n\r\nWARC/1.1\r\nX-Page-Id: 5\r\nhttp://x 1.1.1.1 19990101000000 text/html 3\n</p>" + "ä" * 60
    rows = [
        (1, "http://a.example/x y\n\tz", "x" * 99), (2, None, "x" * 99), (3, "", "x" * 100), (4, "u", "x" * 100),
        (9, "http://ü.example/", copy), (6, "u", copy), (6, "u", copy), (7, "u", copy),
        (None, "u", copy), (None, None, None), (None, "u", "only one " * 50), (10, "u", None), (11, "u", ""),
        (-3, "http://neg.example", "z" * 300), (12, "v", "z" * 300), (13, "long", cases.LONG * 4), (14, "long", cases.LONG * 4),
        (15, "u", "HTTP/1.1 200 OK\r\n\r\n" + "y" * 200), (16, "u", "\n\n\n"), (17, "u", "\x1f\x8b\x00" * 50),
    ]
    pages = cases.with_clashes(spark.createDataFrame(rows, SCHEMA))
    assert got(warc.archive_pages(pages, fresh_dir(spark, "t"))) == brute(rows)
    none = spark.createDataFrame([], SCHEMA)
    assert warc.archive_pages(none, fresh_dir(spark, "t")).count() == 0


def test_one_payload_on_most_pages(spark):
    rows = [(i, "u", "hot " * 50 if i % 3 else f"own {i} " * 30) for i in range(6000)]
    found = got(warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(7), fresh_dir(spark, "t")))
    assert found == brute(rows)
    assert Counter(r[3] for r in found) == {"revisit": 3999, "response": 2001}


def raw_archives(spark, tmp_path, **files):
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    return str(tmp_path)


FIELDS1 = b"1 0 Alexa\nURL IP-address Archive-date Content-type Archive-length\n\n"
FIELDS2 = (
    b"2 0 Org\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename"
    b" Archive-length\n\n"
)
BLOCK = b"HTTP/1.0 200 OK\nServer: x\n\n\xff\xfe\x00raw"
RAW1 = (
    b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain %d\n%s" % (len(FIELDS1), FIELDS1)
    + b"\nhttp://a.example/with space 10.0.0.1 19961104142103 text/html %d\n" % len(BLOCK) + BLOCK
    + b"\n\n\ndns:a.example 10.0.0.2 199611 text/dns 5\nhello\n"
    + b"http://b.example/ 10.0.0.3 bad text/html 99\ncut short"
)
RAW2 = (
    b"filedesc://new.arc 0.0.0.0 19990101000000 text/plain 200 - - 0 new.arc %d\n%s" % (len(FIELDS2), FIELDS2)
    + b"http://c.example/ 10.0.0.4 19990203040506 text/html 302 0f0f http://d.example/ 197 new.arc 8\nHTTP/1.1\n"
    + b"this is no header\nrest\n"
)


def test_hand_written_archives(spark, tmp_path):
    path = raw_archives(spark, tmp_path, **{"old.arc": RAW1, "new.arc.gz": gzip.compress(RAW2[:100]) + gzip.compress(RAW2[100:])})
    rows = warc.converted(warc.read_arc(spark, path)).orderBy("archive", "offset").collect()
    seen = [(r["archive"], r["version"], r["type"], r["date"], r["url"], r["damage"], bytes(r["block"])) for r in rows]
    assert [s[:6] for s in seen] == [
        ("new.arc.gz", 2, "warcinfo", "1999-01-01T00:00:00Z", "filedesc://new.arc", None),
        ("new.arc.gz", 2, "response", "1999-02-03T04:05:06Z", "http://c.example/", None),
        ("new.arc.gz", 2, "resource", "1970-01-01T00:00:00Z", None, "header"),
        ("old.arc", 1, "warcinfo", "1996-09-23T14:21:03Z", "filedesc://old.arc", None),
        ("old.arc", 1, "response", "1996-11-04T14:21:03Z", "http://a.example/with space", None),
        ("old.arc", 1, "resource", "1996-11-01T00:00:00Z", "dns:a.example", None),
        ("old.arc", 1, "resource", "1970-01-01T00:00:00Z", "http://b.example/", "truncated"),
    ]
    assert seen[4][6] == BLOCK and seen[5][6] == b"hello" and seen[6][6] == b"cut short"
    assert seen[2][6] == b"this is no header\nrest\n"
    c = rows[1]
    assert (c["result_code"], c["checksum"], c["location"]) == ("302", "0f0f", "http://d.example/")
    out = fresh_dir(spark, "t")
    warc.convert(spark, path, out)
    back = {r["url"]: r for r in warc.read_warc(spark, out).where("type != 'warcinfo'").collect()}
    assert len(back) == 5
    a = back["http://a.example/with%20space"]
    assert bytes(a["block"]) == BLOCK and a["type"] == "response" and a["ip"] == "10.0.0.1"
    assert a["payload_digest"] == "sha256:" + hashlib.sha256(b"\xff\xfe\x00raw").hexdigest()
    assert a["block_digest"] == "sha256:" + hashlib.sha256(BLOCK).hexdigest() and a["payload_bytes"] == 6
    assert back["http://b.example/"]["truncated"] == "unspecified" and back["dns:a.example"]["content_type"] == "text/dns"
    assert len({r["record_id"] for r in back.values()}) == 5


def test_archives_are_many_and_standard(spark):
    """Small archives: every file opens with its own record, offsets and lengths are true."""
    rng = random.Random(3)
    rows = [(i, f"http://h{i}.example/", "<p>" + "".join(rng.choices("ab\r\n ü", k=rng.randrange(400))) + "</p>") for i in range(300)]
    root = fresh_dir(spark, "t")
    records = warc.http_records(spark.createDataFrame(rows, SCHEMA), "page_id", "url", "html", F.col("page_id") % 2 + 1)
    warc.write_arc(records, f"{root}/arc", archive_bytes=5000)
    files = spark.read.format("binaryFile").load(f"{root}/arc").select("content").collect()
    assert len(files) > 10
    for f in files:
        data = gzip.decompress(f["content"])
        parsed = list(warc.parse_arc(data, "x"))
        assert parsed[0][3].startswith("filedesc://") and all(r[10] is None for r in parsed)
        for r in parsed[1:]:
            assert data[r[1] :].startswith(r[3].encode()) and bytes(r[-1]) in data
    warc.convert(spark, f"{root}/arc", f"{root}/warc", {"page_key": warc.page_key()})
    assert got(warc.archived_pages(spark, f"{root}/warc")) == brute(rows)
    for f in spark.read.format("binaryFile").load(f"{root}/warc").select("content").collect():
        data = gzip.decompress(f["content"])
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and data.endswith(b"\r\n\r\n")


def test_archives_are_packed_fast_and_shuffled_as_stored(spark, monkeypatch):
    """No exchange carries blocks, and gzip does not run at its default level; an order may
    have the name of a column that says where a record is."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(3000)]
    rows = [(i, "u", " ".join(rng.choices(words, k=200))) for i in range(300)]
    rows += [(300 + i, "u", rows[i][2]) for i in range(0, 300, 3)]
    root, seen, write = fresh_dir(spark, "t"), [], warc.write_warc
    records = warc.http_records(spark.createDataFrame(rows, SCHEMA), "page_id", "url", "html", F.col("page_id") % 2 + 1)
    warc.write_arc(records, f"{root}/arc", archive_bytes=50_000)
    monkeypatch.setattr(warc, "write_warc", lambda df, path: (seen.append(df), write(df, path)))
    warc.convert(spark, f"{root}/arc", f"{root}/warc", {"offset": warc.page_key()})
    assert got(warc.archived_pages(spark, f"{root}/warc")) == brute(rows)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = seen[0]._jdf.queryExecution().explainString(mode)
    sent = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan)
    assert any("content#" in c for c in sent) and not any("block#" in c for c in sent), sent
    for part in ("arc", "warc"):
        stored = [f["content"] for f in spark.read.format("binaryFile").load(f"{root}/{part}").select("content").collect()]
        default = sum(len(gzip.compress(zlib.decompress(c, 31), 6)) for c in stored)
        assert sum(map(len, stored)) > 1.01 * default


def test_what_is_no_warc(spark):
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"hello\r\n", "x"))
    with pytest.raises(ValueError):
        list(warc.parse_warc(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc", "x"))
