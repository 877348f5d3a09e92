"""Archives: exact round trips, framing, broken segments."""

import base64
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardstar.llm import warc
from wardstar.session import fresh_path


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 50))
def test_chunks(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload


@pytest.mark.parametrize("body", [b"", b"5\r\nab\r\n0\r\n\r\n", b"zz\r\n", b"2\r\nab"])
def test_broken_chunks(body):
    with pytest.raises(ValueError):
        warc.unchunked(body)


def test_segments():
    payload = bytes(range(256)) * 40 + b"\r\n\r\nWARC/1.1\r\n"
    records = warc.response_records(7, "http://a b\n/", payload, segment=1000)
    data = b"".join(r + warc.END.encode() for r in records)
    parsed = list(warc.parse_records(data))
    assert len(parsed) == len(records) > 10
    assert parsed[0][0]["warc-target-uri"] == "http://a%20b%20/"
    parts = []
    for headers, block in parsed:
        total = headers.get("warc-segment-total-length")
        parts.append((int(headers["warc-segment-number"]), int(total) if total else None, block))
    random.Random(0).shuffle(parts)
    assert warc.payload_of(warc.reassembled(parts)) == payload
    assert warc.payload_of(warc.reassembled(parts + parts[:3])) == payload
    for number in (1, 2, len(parts)):
        with pytest.raises(ValueError):
            warc.reassembled([p for p in parts if p[0] != number])
    with pytest.raises(ValueError):
        warc.reassembled([(n, None if t is None else t + 1, b) for n, t, b in parts])
    with pytest.raises(ValueError):
        list(warc.parse_records(data[:-3]))


SCHEMA = "page_id bigint, url string, html string, digest string, refers int, page int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "d", 1, 2) for r in rows], SCHEMA)


def test_round_trip(spark):
    draw = random.Random(1)
    long = "".join(draw.choice("ab é\r\n<>") for _ in range(70_000))
    rows = [(9, "u", long), (3, None, long), (4, "u", None), (2, "u", ""), (5, "u", "x"), (6, "v", "\r\n\r\n"), (7, "u", "x")]
    rows += [(100 + i, "u", "same page") for i in range(300)] + [(-8, "u", "WARC/1.1\r\n\r\n"), (None, "u", "x")]
    found = {r["page_id"]: r for r in warc.round_trip(table(spark, rows).repartition(4)).collect()}
    named = [r for r in rows if r[0] is not None]
    assert len(found) == len(named)
    first = {}
    for page, _, html in sorted(named):
        first.setdefault(html or "", page)
    for page, _, html in named:
        data = (html or "").encode()
        r = found[page]
        revisit = first[html or ""] != page
        assert r["problem"] is None and r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("revisit", first[html or ""]) if revisit else ("response", None))
    assert warc.round_trip(table(spark, [])).collect() == []


def test_texts_come_back(spark):
    rows = [(1, "u", "é" * 40_000), (2, "u", "small"), (3, "u", "small")]
    folder = fresh_path(spark, "warc-test")
    warc.write_archives(table(spark, rows), folder, least=6)
    read = {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}
    assert {p: bytes(r["payload"]).decode() for p, r in read.items()} == {p: h for p, _, h in rows}
    assert {r["record_type"] for r in read.values()} == {"response"}


def test_rows_that_share_a_page_id(spark):
    """A row each, also for large payloads: none is lost or mixed up."""
    long, other = "x" * 40_000, "y" * 50_000 + "é"
    rows = [(1, "u", long), (1, "u", long), (2, "u", "s"), (2, "v", "s"), (3, "u", long), (3, "u", other), (3, "u", other)]
    rows += [(4, "u", other)] + [(5, "u", "a"), (5, "u", "b"), (6, "u", "b")]
    found = warc.round_trip(table(spark, rows).repartition(5)).collect()
    first = {}
    for page, _, html in sorted(rows):
        first.setdefault(html, page)
    expected = [
        (page, len(html.encode()), warc.digest_of(html.encode()), *(("response", None) if first[html] == page else ("revisit", first[html])), None)
        for page, _, html in rows
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
