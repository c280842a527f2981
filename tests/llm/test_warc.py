import base64
import gzip
import hashlib
import io

import pytest

from docspark.llm import warc

PAGES = [
    (1, "http://a.example/x y?é=1", "<p>one</p>"),
    (5, "http://b.example/", "<p>one</p>"),
    (3, None, "<p>one</p>"),
    (4, "http://c.example/\r\nX: 1", "é\U0001f600\r\n\r\nWARC/1.1\r\n" * 9),
    (6, "u", None),
    (7, "u", ""),
    (None, "u", ""),
    (8, "u", "x" * 200_000),
    (8, "u", "other"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def brute(rows):
    out = []
    for page_id, _, html in rows:
        ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = max(ids, default=None)
        own = page_id == first
        out.append((page_id, len((html or "").encode()), digest(html), "response" if own else "revisit", None if own else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [7, warc.CHUNK])
def test_round_trip(spark, size):
    df = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id long, url string, html string, sha1 string")
    assert sorted(map(tuple, warc.round_trip(df, size=size).collect()), key=str) == brute(PAGES)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_small_payloads_can_be_kept_whole(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    kinds = {(r["page_id"], r["payload_bytes"]): r["record_type"] for r in warc.round_trip(df, least=20).collect()}
    assert set(kinds.values()) == {"response"}


def record(kind, body, http=b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"):
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Type: application/http; msgtype=response\r\n"
    return head.encode() + b"Content-Length: %d\r\n\r\n" % (len(http) + len(body)) + http + body + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_chunks_carry_running_digests(packed, monkeypatch):
    monkeypatch.setattr(warc, "READ", 64)
    body = bytes(range(256)) * 5
    raw = record("response", body) + record("response", b"")
    raw = gzip.compress(raw[:700]) + gzip.compress(raw[700:]) if packed else raw
    chunks = list(warc.chunks_of(io.BytesIO(raw), 100))
    first = [c for c in chunks[:13]]
    assert b"".join(c[2] for c in first) == body and [c[1] for c in first] == list(range(13))
    for k, c in enumerate(first):
        so_far = body[: 100 * (k + 1)]
        assert c[3] == len(so_far) and c[4] == base64.b32encode(hashlib.sha1(so_far).digest()).decode() and c[5] == (k == 12)
    assert chunks[13][1:4] == (0, b"", 0) and chunks[13][5] and len(chunks) == 14


def test_held_memory_is_bounded(monkeypatch):
    body = b"\0" * (32 << 20)
    raw = gzip.compress(record("response", body))
    most = 0
    source = warc.Bytes.some

    def some(self, n):
        nonlocal most
        most = max(most, len(self.held))
        return source(self, n)

    monkeypatch.setattr(warc.Bytes, "some", some)
    assert sum(len(c[2]) for c in warc.chunks_of(io.BytesIO(raw))) == len(body)
    assert most <= 4 * warc.READ


@pytest.mark.parametrize("raw", [b"HTTP/1.1 200 OK\r\n\r\n", record("response", b"abcdef")[:-8], b"x" * 3_000_000])
def test_broken_files_fail(raw):
    with pytest.raises(ValueError):
        list(warc.chunks_of(io.BytesIO(raw)))
