import gzip
import hashlib
import io
import os

import pytest

from zonalis.llm import warc as W
from zonalis.sources.session import shared_folder


def run(spark, df, name):
    place = f"{shared_folder(spark)}/{name}"
    W.write_arc(df, f"{place}/arc")
    W.write_warc(W.mark_revisits(W.convert_arc(spark, f"{place}/arc")), f"{place}/warc")
    return W.load_warc(spark, f"{place}/warc")


def run_archives(spark, df, name):
    place = f"{shared_folder(spark)}/{name}"
    W.write_arc(df, f"{place}/arc")
    assert W.convert_archives(spark, f"{place}/arc", f"{place}/warc").count() == 0
    return W.load_warc(spark, f"{place}/warc")


@pytest.mark.parametrize("plain", [True, False])
def test_round_trip(spark, monkeypatch, plain):
    monkeypatch.setattr(W, "ARCHIVE_RECORDS", 3)
    big, huge = "é" * 500, "<p>x</p>\r\n\r\nWARC/1.0\n" * 100_000
    rows = [(1, "http://a/1", big), (9, "http://a/9", big), (5, None, big), (2, "http://a b/2", "small"),
            (3, "http://a/3", "small"), (4, "http://a/4", None), (6, "http://a/6", ""), (7, "http://a/7", huge),
            (9, "http://a/9", big), (None, "http://a/n", big), (8, "http://ü/8", huge), (10, "http://a/10", "é" * 499 + "x")]
    df = spark.createDataFrame([(*r, "h", "t") for r in rows],
                               "page_id long, url string, html string, head string, record_type string")
    got = (run if plain else run_archives)(spark, df.repartition(3), f"round-trip-{plain}").collect()
    ids = {r.record_id: r.page_id for r in got if r.record_type == "response"}
    seen = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type,
                    ids.get(r.refers_to_record)) for r in got), key=repr)
    keeper = {big: 9, huge: 8}
    want = sorted(((p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                    "revisit" if keeper.get(h, p) != p else "response",
                    keeper[h] if keeper.get(h, p) != p else None) for p, _, h in rows), key=repr)
    assert seen == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert run(spark, df, "empty").count() == 0
    assert run_archives(spark, df, "empty-archives").count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_of_both_versions(version):
    data = W.arc_header(version) + b"\n" + W.arc_record(7, "http://x/y", "<b>", version) + b"\n"
    first, page = W.read_arc(io.BytesIO(data))
    assert page["URL"] == "http://x/y" and page["Content-type"] == "text/html"
    made = W.converted(page)
    assert (made["page_id"], made["payload"], made["record_type"]) == (7, b"<b>", "response")
    assert W.converted(first)["record_type"] == "warcinfo"
    assert W.converted({"URL": "dns:x", "Archive-date": "20010203040506", "block": b"1.2.3.4"}) | {
        "record_id": ""} == {"page_id": None, "record_id": "", "uri": "dns:x", "date": "2001-02-03T04:05:06Z",
                             "ip": "0.0.0.0", "record_type": "resource", "payload_bytes": 7,
                             "payload_digest": hashlib.sha1(b"1.2.3.4").hexdigest(), "head": b"", "payload": b"1.2.3.4"}


def test_short_record_is_refused():
    data = W.arc_header(1) + b"\n" + W.arc_record(7, "http://x/y", "<b>", 1)[:-2]
    with pytest.raises(ValueError):
        list(W.read_arc(io.BytesIO(data)))


def archive(version, *lines):
    body = W.arc_header(version) + b"\n"
    for line, block in lines:
        body += f"{line} {len(block)}".encode() + b"\n" + block + b"\n"
    return body


def test_lines_with_spaces_and_short_dates():
    one = archive(1, ("http://x/a b c 1.2.3.4 20010203040506 text/html; charset=utf-8", b"x"), ("http://x/ 1.2.3.4 2001 text/html", b"y"),
                  ("http://x/ ::1 - text/html", b"z"), ("http://x/ - 20011399 no-type", b""))
    got = [W.converted(r) for r in W.read_arc(io.BytesIO(one))][1:]
    assert [(g["uri"], g["ip"], g["date"], g["payload"]) for g in got] == [
        ("http://x/a b c", "1.2.3.4", "2001-02-03T04:05:06Z", b"x"), ("http://x/", "1.2.3.4", "2001-01-01T00:00:00Z", b"y"),
        ("http://x/", "::1", "2000-01-01T00:00:00Z", b"z"), ("http://x/", "0.0.0.0", "2000-01-01T00:00:00Z", b"")]
    two = archive(2, ("http://x/a b 1.2.3.4 20010203 text/html; charset=utf-8 200 abc http://y/a b 77 f.arc", b"x"))
    page = list(W.read_arc(io.BytesIO(two)))[1]
    assert {k: page[k] for k in ("URL", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename")} == {
        "URL": "http://x/a b", "Content-type": "text/html; charset=utf-8", "Result-code": "200", "Checksum": "abc",
        "Location": "http://y/a b", "Offset": "77", "Filename": "f.arc"}


def test_bad_records_are_rows(spark):
    place = f"{shared_folder(spark)}/bad"
    os.makedirs(f"{place}/arc")
    good = ("http://x/ 1.2.3.4 2001 text/html", b"HTTP/1.1 200 OK\r\nX-Page-Id: what\r\n\r\nbody")
    whole = archive(1, good, ("lacks fields", b"abc"), good)
    for k, data in enumerate((whole, whole[:-5], whole + b"no length at all\n" + whole, b"\xff\xfe")):
        with gzip.open(f"{place}/arc/part-{k}.gz", "wb") as f:
            f.write(data)
    with open(f"{place}/arc/part-9.gz", "wb") as f:
        f.write(b"not compressed")
    left = W.convert_archives(spark, f"{place}/arc", f"{place}/warc").collect()
    assert sorted((r.file[-4], r.no) for r in left) == [("0", 1), ("1", 1), ("1", 2), ("2", 1), ("2", 3), ("3", 0), ("9", 0)]
    got = W.load_warc(spark, f"{place}/warc").collect()
    assert [(r.page_id, r.payload_bytes, r.record_type) for r in got] == [(None, 4, "response")] * 5
    assert W.convert_arc(spark, f"{place}/arc").filter("error IS NULL").count() == 5
