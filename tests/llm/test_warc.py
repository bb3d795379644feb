"""The archive against its own records: exact round trip, digests, and rows that are null, empty, equal or repeated."""

from __future__ import annotations

import base64
import hashlib

import pytest

from quarterdeck.llm import warc

SCHEMA = "page_id long, url string, html string, sha256 string, records long, header string, last long"
LONG = "<p>é</p>" * 200_000
ROWS = [
    (3, "http://a/x", "same"),
    (9, "http://a/y", "same"),
    (4, None, "same"),
    (1, "http://a\r\nWARC-Type: other\r\n/", "own"),
    (2, "u", None),
    (5, "u", ""),
    (6, "u", LONG),
    (7, "u", LONG),
    (8, "u", "twin"),
    (8, "u", "twin"),
    (10, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: revisit\r\n"),
    (None, "u", "same"),
    (None, "u", "nobody's"),
    (None, "u", "nobody's"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "s", 7, "h", 8) for r in rows], SCHEMA)


def expected(rows, least=0):
    last = {}
    for i, _, p in rows:
        if i is not None:
            last[p or ""] = max(last.get(p or "", i), i)
    out = []
    for i, _, p in rows:
        raw = (p or "").encode()
        first = last.get(p or "", i)
        refers = first if first != i and len(raw) >= least else None
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_what_is_read_back(spark, folder, least):
    warc.write_archive(pages(spark).repartition(4), folder, least_bytes=least)
    assert sorted((tuple(r) for r in warc.read_archive(spark, folder).collect()), key=str) == expected(ROWS, least)


def test_records_come_back_byte_for_byte(spark, folder):
    warc.write_archive(pages(spark), folder, date="2020-02-02T00:00:00Z")
    assert spark.read.parquet(f"{folder}/payloads").count() == len({p or "" for _, _, p in ROWS})
    said = {(r[0], r[1], r[2]): (r[3], r[4]) for r in expected(ROWS)}
    for r in warc.restore(spark, folder).collect():
        record, payload = bytes(r["record"]), bytes(r["payload"])
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        kind, refers = said[r["id"], len(payload), digest]
        head, block = record.split(b"\r\n\r\n", 1)
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        assert lines[0] == "WARC/1.1" and len(fields) == len(lines) - 1
        assert block.endswith(b"\r\n\r\n") and int(fields["Content-Length"]) == len(block) - 4
        assert (fields["WARC-Type"], fields["WARC-Payload-Digest"], fields["WARC-Date"]) == (kind, f"sha1:{digest}", "2020-02-02T00:00:00Z")
        http, body = block[:-4].split(b"\r\n\r\n", 1)
        assert body == (payload if kind == "response" else b"") and http.endswith(f"Content-Length: {len(payload)}".encode())
        assert fields.get("WARC-Refers-To") == (None if refers is None else f"<urn:page:{refers}>")
    assert sorted(str(r["id"]) for r in warc.restore(spark, folder).collect()) == sorted(str(i) for i, _, _ in ROWS)


def test_a_spoilt_payload_is_noticed(spark, folder):
    warc.write_archive(pages(spark, ROWS[:3]), f"{folder}/a")
    spark.read.parquet(f"{folder}/a/headers").write.parquet(f"{folder}/b/headers")
    spark.read.parquet(f"{folder}/a/payloads").selectExpr("sha256", "last", "records", "cast('other' as binary) as payload").write.parquet(f"{folder}/b/payloads")
    with pytest.raises(Exception, match="not what its digest says"):
        warc.read_archive(spark, f"{folder}/b").collect()


def test_empty_table_and_text_ids(spark, folder):
    warc.write_archive(pages(spark, []), f"{folder}/none")
    assert warc.read_archive(spark, f"{folder}/none").count() == 0 and warc.restore(spark, f"{folder}/none").count() == 0
    named = spark.createDataFrame([("a", "u", "x"), ("b", "u", "x")], "page_id string, url string, html string")
    warc.write_archive(named, f"{folder}/text")
    assert {(r["page_id"], r["refers_to"]) for r in warc.read_archive(spark, f"{folder}/text", "string").collect()} == {("a", "b"), ("b", None)}
