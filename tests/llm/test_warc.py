import hashlib

from landweave.llm import warc

SCHEMA = "page_id long, url string, html string, archive int, record_type string, packed int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x", 2) for i, u, h in rows], SCHEMA)


LONG, OTHER = "é" * 700, "<p>" + "b" * 1200 + "\r\n\r\nWARC/1.0\r\n\r\n</p>"
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2\r\nX: y", LONG), (3, None, LONG), (3, None, LONG), (4, "http://b/", OTHER), (5, "http://b/5", OTHER)]
ROWS += [(6, "u", "short"), (7, "u", "short"), (8, "u", ""), (9, "u", None), (10, "u", "y" * 200_000), (None, "n", LONG), (11, "http://z/", "a\nb\rc\r\n")]


def brute(rows, least=warc.LEAST_REVISIT):
    keep = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= least and i is not None:
            keep[h] = max(keep.get(h, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = keep.get(h) if len(data) >= least and i != keep.get(h) else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_round_trip(spark):
    index = warc.write_archives(table(spark, ROWS), archive_bytes=50_000)
    got = warc.read_records(index).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(ROWS)
    by_digest = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in ROWS}
    assert all(r.payload == (by_digest[r.payload_digest] if r.record_type == "response" else None) for r in got)
    assert {r.url for r in got if r.page_id == 2} == {"http://a/2  X: y"} and {r.url for r in got if r.page_id == 3} == {""}


def test_selected_records_only(spark):
    index = warc.write_archives(table(spark, ROWS))
    got = warc.read_records(index.filter("page_id IN (5, 10)"), payloads=False, most=1).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload) for r in got) == [(5, len(OTHER), None), (10, 200_000, None)]


def test_empty_table(spark):
    assert warc.read_records(warc.write_archives(table(spark, []))).collect() == []
