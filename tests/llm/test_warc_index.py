import base64
import gzip
import hashlib
import io

import pytest

from landweave.llm import warc, warc_index

PAGE = b"<p>\xff\x00 WARC/1.0\r\n\r\nWARC-Type: response\r\n\r\n" + b"x" * 3000
SHA = hashlib.sha1(PAGE).digest()


def rec(block, *lines, version="WARC/1.1"):
    return "\r\n".join([version, *lines, f"Content-Length: {len(block)}"]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http(body, more=""):
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html{more}\r\n\r\n".encode() + body


BARE = b"HTTP/1.1 200 OK\r\nno blank line"
RECORDS = [
    (rec(b"software: some other tool\r\n", "WARC-Type: warcinfo", "WARC-Record-ID: <urn:uuid:0>", "Content-Type: application/warc-fields"), ("warcinfo", "<urn:uuid:0>", None, 27, hashlib.sha1(b"software: some other tool\r\n").hexdigest())),
    (rec(b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "WARC-Type: request", "WARC-Target-URI: http://a/", "Content-Type: application/http;msgtype=request"), ("request", None, "http://a/", 0, hashlib.sha1(b"").hexdigest())),
    (rec(http(PAGE), "warc-type:response", "warc-target-uri: <http://a/>", "Content-Type: Application/HTTP; msgtype=response", "WARC-Payload-Digest: sha1:" + base64.b32encode(SHA).decode()), ("response", None, "http://a/", len(PAGE), SHA.hex())),
    (rec(http(b""), "WARC-Type: revisit", "WARC-Target-URI: http://b/\r\n ?folded", "Content-Type: application/http", "WARC-Payload-Digest: SHA1:" + base64.b32encode(SHA).decode()), ("revisit", None, "http://b/ ?folded", 0, SHA.hex())),
    (rec(b"", "WARC-Type: resource", "WARC-Target-URI: file:///x", version="WARC/1.0"), ("resource", None, "file:///x", 0, hashlib.sha1(b"").hexdigest())),
    (rec(BARE, "WARC-Type: response", "Content-Type: application/http"), ("response", None, None, len(BARE), hashlib.sha1(BARE).hexdigest())),
]


def archive(packed=False):
    """The bytes of an archive and the (offset, length) of each record."""
    out, places = b"", []
    for data, _ in RECORDS:
        data = gzip.compress(data) if packed else data
        places.append((len(out), len(data)))
        out += data
    return out, places


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("chunk", [1, 7, 1000, 1 << 20])
def test_scan_in_chunks(packed, chunk):
    data, places = archive(packed)
    got = list(warc_index.scan(io.BytesIO(data), chunk))
    assert [g[:2] for g in got] == places
    assert [g[2] for g in got] == [want for _, want in RECORDS]
    for at, length, (kind, _, _, size, digest) in got:
        said, payload = warc_index.payload_of(data[at : at + length])
        assert said["warc-type"] == kind and (kind == "revisit" or (size, digest) == (len(payload), hashlib.sha1(payload).hexdigest()))


def test_damaged_archives():
    plain, packed = archive()[0], archive(True)[0]
    for data in (plain[:-3], plain[: len(plain) // 2], packed[:-9], b"hello", b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", gzip.compress(plain), plain.replace(b"Content-Length: 0", b"Content-Length: 1")):
        with pytest.raises((ValueError, warc_index.zlib.error)):
            list(warc_index.scan(io.BytesIO(data), 64))
    assert list(warc_index.scan(io.BytesIO(b""))) == []
    assert len(list(warc_index.scan(io.BytesIO(plain + b"\r\n\r\n" + plain), 64))) == 2 * len(RECORDS)


def test_index_and_reads(spark, tmp_path):
    for name, packed in (("a.warc", False), ("b/c.warc.gz", True)):
        at = tmp_path / name
        at.parent.mkdir(exist_ok=True)
        at.write_bytes(archive(packed)[0])
    (tmp_path / "empty.warc").write_bytes(b"")
    (tmp_path / "other.txt").write_bytes(b"not an archive")
    index = warc_index.index_archives(spark, str(tmp_path), chunk=50)
    rows = index.collect()
    for suffix, packed in (("a.warc", False), ("c.warc.gz", True)):
        mine = sorted((r.offset, r.length) for r in rows if r.path.endswith(suffix))
        assert mine == archive(packed)[1]
    assert len(rows) == 2 * len(RECORDS) and {r.payload_digest for r in rows if r.record_type == "revisit"} == {SHA.hex()}
    pages = index.filter("url = 'http://a/' AND record_type = 'response' OR record_type = 'revisit'")
    for gap, most in ((0, 1), (1 << 20, 1 << 20)):
        got = warc_index.read_payloads(pages, gap, most).collect()
        assert sorted((r.record_type, None if r.payload is None else bytes(r.payload)) for r in got) == [("response", PAGE)] * 2 + [("revisit", None)] * 2
    assert warc_index.read_payloads(index).count() == len(rows)
    (tmp_path / "none").mkdir()
    assert warc_index.index_archives(spark, str(tmp_path / "none")).count() == 0


def test_agrees_with_the_writers_index(spark, tmp_path):
    rows = [(i, f"http://a/{i % 5}", None if i % 7 == 0 else "é\r\n\r\nWARC/1.0\r\n" * (i * 40)) for i in range(30)] + [(40, "x", "same" * 500), (41, None, "same" * 500), (None, "n", "same" * 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    own = warc.write_archives(pages, str(tmp_path / "archives"), archive_bytes=50_000)
    found = warc_index.index_archives(spark, str(tmp_path / "archives"), "*.txt")
    tell = lambda df: sorted((r.path.replace("file:///", "file:/"), r.offset, r.length, r.record_type, r.url, r.payload_digest) for r in df.collect())
    assert tell(found) == tell(own)
