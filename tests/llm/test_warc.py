from __future__ import annotations

import base64
import glob
import gzip
import hashlib
from collections import Counter

import compare
from railfeed.llm import warc as W

SCHEMA = "page_id BIGINT, url STRING, html STRING, record_id STRING"


def _brute(rows):
    top: dict = {}
    for i, _, html, _ in rows:
        if i is not None:
            top[html or ""] = max(top.get(html or "", i), i)
    out = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        first = top.get(html or "")
        kind = "response" if i == first else "revisit"
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, None if kind == "response" else first))
    return Counter(out)


def _query(spark, frame, path):
    W.write_archive(frame, path)
    page = lambda c: W.F.element_at(W.F.col(f"{c}.fields"), "page-id").cast("long")
    rows = W.transactions(W.read_archive(spark, path, payloads=False)).select(page("metadata"), "response", page("refers")).collect()
    return [(r[0], r.response.payload_bytes, r.response.payload_digest, r.response.kind, r[2]) for r in rows]


def test_query_equals_its_sql(spark, sf_dir, duck):
    assert not compare.differences(W.op5_warc(spark, sf_dir), duck, W.OP5_SQL)


def test_equal_payloads_and_odd_pages(spark, tmp_path):
    trap = "WARC/1.1\r\nContent-Length: 3\r\n\r\nx\r\n\r\nWARC/1.1\r\n\r\n"
    rows = [(i, f"http://a.net/{i}", "copy é中", "x") for i in range(300)]
    rows += [(400, None, None, None), (401, "no scheme", "", "x"), (402, "http://b.org/x\r\nEvil: 1", trap, "x"), (403, "http://c.org?q", trap + " ", "x")]
    rows += [(404, "http://d.org", "\r\n\r\n", "x"), (405, "u", "z" * 3_000_000, "x"), (406, "u", "\x00\x1f line\r\n", "x"), (None, "n", "no id", "x")]
    rows += rows[-4:] + rows[:5] + [rows[299]] * 2 + [(299, "other url", "copy é中", "x"), (None, "m", "z" * 3_000_000, "x")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert Counter(_query(spark, frame, str(tmp_path / "w"))) == _brute(rows)


def test_archives_are_plain_warc_files(spark, tmp_path):
    frame = spark.createDataFrame([(1, "http://a.net/p?q=1", "<p>é</p>", "x"), (2, "http://a.net/2", "<p>é</p>", "x")], SCHEMA)
    W.write_archive(frame, str(tmp_path / "w"))
    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(str(tmp_path / "w" / "part-*"))))
    records = list(W.parse_records(raw))
    assert sorted(h["warc-type"] for h, _ in records) == ["metadata", "metadata", "request", "request", "response", "revisit"]
    answer = next(b for h, b in records if h["warc-type"] == "response")
    assert answer.partition(b"\r\n\r\n")[2] == "<p>é</p>".encode()
    revisit, response = (next(h for h, _ in records if h["warc-type"] == k) for k in ("revisit", "response"))
    assert revisit["warc-refers-to"] == response["warc-record-id"]
    asked = [b for h, b in records if h["warc-type"] == "request"]
    assert any(b.startswith(b"GET /p?q=1 HTTP/1.1\r\nHost: a.net\r\n") for b in asked)


def test_nested_rows_hold_the_payload(spark, tmp_path):
    frame = spark.createDataFrame([(1, "http://a.net/", "<p>x</p>", "x")], SCHEMA)
    W.write_archive(frame, str(tmp_path / "w"))
    row = W.transactions(W.read_archive(spark, str(tmp_path / "w"))).first()
    assert bytes(row.response.payload) == b"<p>x</p>" and row.response.status == 200
    assert row.request.fields["host"] == "a.net" and row.metadata.fields["page-id"] == "1" and row.refers is None


def test_several_gzip_members_and_empty_tables(spark, tmp_path):
    record = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    assert len(list(W.parse_records(gzip.compress(record) * 3))) == 3
    empty = spark.createDataFrame([], SCHEMA)
    assert _query(spark, empty, str(tmp_path / "w")) == []


def _warc(kind, name, block, *more):
    head = "".join(f"{k}: {v}\r\n" for k, v in (("WARC-Type", kind), ("WARC-Record-ID", name), *more, ("Content-Length", len(block))))
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def test_transactions_with_several_and_missing_partners(spark, tmp_path):
    answer = b"HTTP/1.1 200 OK\r\n\r\nbody"
    to = lambda *names: [("WARC-Concurrent-To", n) for n in names]
    records = [
        _warc("response", "a", answer, *to("q2")),  # names its request itself
        _warc("request", "q1", b"GET /1 HTTP/1.1\r\n\r\n", *to("a", "b")),  # sent once for two captures
        _warc("request", "q2", b"GET /2 HTTP/1.1\r\n\r\n"),
        _warc("metadata", "m2", b"page-id: 12\r\n", *to("a")),
        _warc("metadata", "m1", b"page-id: 11\r\n", *to("a")),
        _warc("metadata", "m1", b"page-id: 11\r\n", *to("a")),
        _warc("revisit", "b", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\n", ("WARC-Refers-To", "a")),
        _warc("response", "alone", answer),
        _warc("request", "lost", b"GET /3 HTTP/1.1\r\n\r\n", *to("nowhere")),
        _warc("revisit", "c", b"HTTP/1.1 200 OK\r\n\r\n", ("WARC-Refers-To", "nowhere")),
    ]
    (tmp_path / "x.warc").write_bytes(b"".join(records))
    rows = {r.record_id: r for r in W.transactions(W.read_archive(spark, str(tmp_path / "x.warc"))).collect()}
    assert sorted(rows) == ["a", "alone", "b", "c"]
    ids = lambda part: [p.id for p in part]
    assert ids(rows["a"].requests) == ["q1", "q2"] and rows["a"].request.fields["request-line"] == "GET /1 HTTP/1.1"
    assert ids(rows["a"].metadata_records) == ["m1", "m2"] and rows["a"].metadata.fields["page-id"] == "11"
    assert ids(rows["b"].requests) == ["q1"] and rows["b"].metadata is None and rows["b"].refers.id == "m1"
    assert rows["alone"].requests == [] and rows["alone"].request is None and bytes(rows["alone"].response.payload) == b"body"
    assert rows["c"].refers is None and rows["c"].refers_to == "nowhere"


def test_files_of_long_pages_are_cut_by_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 1 << 20)
    frame = spark.createDataFrame([(i, f"http://a.net/{i}", f"{i} " + "x" * 200_000, "x") for i in range(30)], SCHEMA).coalesce(1)
    W.write_archive(frame, str(tmp_path / "w"))
    sizes = [len(gzip.open(f).read()) for f in glob.glob(str(tmp_path / "w" / "part-*"))]
    assert len(sizes) >= 5 and max(sizes) < 2 << 20
    assert len(_query(spark, frame, str(tmp_path / "w2"))) == 30
