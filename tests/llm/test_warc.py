import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from creditloom.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def round_trip(spark, pages, folder, **sizes):
    records = warc.record_texts(pages, **sizes)
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(str(folder))
    return [r.asDict() for r in warc.read_archive(spark, str(folder)).collect()]


@pytest.mark.parametrize("sizes", [{}, {"chunk": 7, "segment": 50}])
def test_round_trip(spark, tmp_path, sizes):
    long = "ab\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nü€𝄞" * 30
    rows = [
        (3, "http://a/3", "x" * 100), (1, "http://a/1", "x" * 100), (2, None, "x" * 100),
        (4, "http://a/4", "x" * 99), (5, "http://a/5", "x" * 99), (6, "u", None), (7, "u", ""),
        (8, "u\r\nWARC-Type: fake", long), (None, "u", "x" * 100), (None, "v", "short"), (9, "u", "0\r\n\r\n"),
        (10, "u", "y" * 150), (10, "w", "y" * 150), (11, "u", "z" * 150), (11, "u", "z" * 150),
    ]
    pages = pages_of(spark, rows).withColumn("digest", F.lit("x")).withColumn("salt", F.lit(0))
    found = round_trip(spark, pages, tmp_path / "w", **sizes)
    assert len(found) == len(rows) and not any(r["error"] for r in found)
    for page_id, _, html in rows:
        data = (html or "").encode()
        own = [r for r in found if r["page_id"] == page_id]
        assert any(r["digest"] == hashlib.sha256(data).hexdigest() for r in own)
        assert any(r["payload_bytes"] == len(data) for r in own)
    kinds = {
        (r["page_id"], r["url"], r["type"], r["refers_to"]) for r in found if r["page_id"] != 11
    }
    assert {k for k in kinds if k[2] == "revisit"} == {
        (2, "", "revisit", 1), (3, "http://a/3", "revisit", 1), (10, "w", "revisit", 10),
    }
    stored = [r for r in found if r["type"] == "response"]
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["digest"] for r in stored)
    assert next(r for r in stored if r["page_id"] == 8)["payload"].decode() == long
    assert [r["type"] for r in found if r["page_id"] == 11] == ["response"] * 2


def test_empty_table(spark, tmp_path):
    warc.write_archive(pages_of(spark, []), str(tmp_path / "w"))
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 0


def test_very_long_page(spark, tmp_path):
    html = "<p>" + "word ü " * 400_000
    found = round_trip(spark, pages_of(spark, [(1, "u", html)]), tmp_path / "w")
    assert found[0]["payload"].decode() == html and found[0]["error"] is None


def record(kind, name, block, **headers):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items()]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    (tmp_path / "plain.warc").write_bytes(
        record("warcinfo", "i", b"software: x")
        + record("response", "a", http + b"whole body")
        + record("response", "b", http + b"one ", WARC_Segment_Number=1)
    )
    # A record per gzip member, the segments in another file and out of order.
    members = [
        record("continuation", "b3", b"three", WARC_Segment_Number=3, WARC_Segment_Origin_ID="<b>",
               WARC_Segment_Total_Length=len(http) + 13),
        record("continuation", "b2", b"two ", WARC_Segment_Number=2, WARC_Segment_Origin_ID="<b>"),
        record("response", "c", http + b"half", WARC_Segment_Number=1),
        record("continuation", "c3", b"end", WARC_Segment_Number=3, WARC_Segment_Origin_ID="<c>",
               WARC_Segment_Total_Length=99),
        record("response", "d", http + b"x", WARC_Segment_Number=1),
        record("continuation", "d2", b"y", WARC_Segment_Number=2, WARC_Segment_Origin_ID="<d>",
               WARC_Segment_Total_Length=99),
        record("response", "e", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz\r\n"),
        record("response", "f", http + b"text", WARC_Payload_Digest="sha256:00"),
    ]
    (tmp_path / "more.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in members))
    (tmp_path / "broken.warc").write_bytes(b"WARC/1.0\r\nContent-Length: 50\r\n\r\nshort")
    found = {r["record_id"]: r for r in warc.read_archive(spark, str(tmp_path)).collect()}
    assert found["<a>"]["payload"] == b"whole body"
    assert found["<b>"]["payload"] == b"one two three" and found["<b>"]["error"] is None
    errors = {name: r["error"] for name, r in found.items() if r["error"]}
    assert errors == {
        "<c>": "segments", "<d>": "total length", "<f>": "digest", None: "bad length",
        "<e>": "bad chunk size",
    }
    assert found["<i>"]["type"] == "warcinfo"


def errors_of(spark, folder):
    rows = warc.read_archive(spark, str(folder)).collect()
    return {r["record_id"]: r["error"] for r in rows}


def test_headers_that_are_no_numbers(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\n\r\nbody"
    bad = [
        record("response", "a", http, X_Page_ID="abc"),
        record("revisit", "b", http, X_Refers_To_Page="x"),
        record("response", "c", http, X_Payload_Length="1k"),
        record("response", "d", http, WARC_Segment_Number="one"),
        record("response", "e", http, WARC_Segment_Number="0"),
        record("response", "f", http, X_Page_ID="9" * 30),
        record("response", "g", http, X_Page_ID="\u00b2"),
        record("response", "h", http, WARC_Segment_Number=1, WARC_Segment_Total_Length="x"),
        record("response", "i", http, error="not from this reader"),
        record("response", "j", http, X_Page_ID="-7"),
    ]
    (tmp_path / "bad.warc").write_bytes(b"".join(bad))
    assert errors_of(spark, tmp_path) == {
        "<a>": "bad x-page-id", "<b>": "bad x-refers-to-page", "<c>": "bad x-payload-length",
        "<d>": "bad warc-segment-number", "<e>": "bad warc-segment-number", "<f>": "bad x-page-id",
        "<g>": "bad x-page-id", "<h>": "total length", "<i>": None, "<j>": None,
    }


def test_chunks_that_go_back(spark, tmp_path):
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    for number, body in enumerate([b"-5\r\nabc\r\n", b"1_0\r\nx\r\n", b"\r\n\r\n", b"f" * 40 + b"\r\n", b"5\r\nab"]):
        (tmp_path / f"{number}.warc").write_bytes(record("response", f"{number}", chunked + body))
    found = errors_of(spark, tmp_path)
    assert set(found.values()) == {"bad chunk size", "no chunk end"} and len(found) == 5


def test_files_that_break_off(spark, tmp_path):
    whole = record("response", "a", b"HTTP/1.1 200 OK\r\n\r\nbody")
    packed = gzip.compress(whole)
    later = gzip.compress(record("response", "b", b"HTTP/1.1 200 OK\r\n\r\n" + bytes(range(256)) * 20))
    (tmp_path / "1.warc.gz").write_bytes(packed + later[: len(later) // 2])
    (tmp_path / "2.warc.gz").write_bytes(packed + later[:5])
    (tmp_path / "3.warc.gz").write_bytes(packed + b"no gzip at all")
    (tmp_path / "4.warc.gz").write_bytes(packed + bytes(64))
    (tmp_path / "5.warc").write_bytes(whole + b"WARC/1.0\r\nhalf a header")
    (tmp_path / "6.warc").write_bytes(b"")
    (tmp_path / "7.warc").write_bytes(whole + b"garbage\r\n\r\n")
    rows = warc.read_archive(spark, str(tmp_path)).collect()
    assert sum(r["record_id"] == "<a>" and r["error"] is None for r in rows) == 6
    assert sorted(r["error"] for r in rows if r["error"]) == [
        "cut off", "cut off", "damaged", "unreadable", "unreadable",
    ]


def test_inflated_by_windows():
    data = bytes(range(256)) * 5000
    packed = gzip.compress(data[:700_000]) + gzip.compress(b"") + gzip.compress(data[700_000:])
    for window in (1, 100, 1 << 16):
        if window > 1:
            pieces = list(warc.inflated(packed, window))
            assert b"".join(pieces) == data and max(map(len, pieces)) <= window
    assert b"".join(warc.inflated(data, 999)) == data


def test_records_are_found_across_windows(monkeypatch):
    whole = b"".join(record("response", f"{i}", b"x" * i) for i in range(60))
    monkeypatch.setattr(warc.inflated, "__defaults__", (7,))
    for content in (whole, gzip.compress(whole)):
        found = list(warc.file_records(content))
        assert [(h["warc-record-id"], len(b)) for h, b in found] == [(f"<{i}>", i) for i in range(60)]
