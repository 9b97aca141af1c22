import json

import pytest

from landweave.sources import landing


def put(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(dict(zip(("dataset", "page", "objectid"), r, strict=True))) for r in rows))


def test_replayed_batch_is_stored_once(spark, tmp_path):
    land, table, state = tmp_path / "land", str(tmp_path / "table"), tmp_path / "state"
    put(land, "a.json", [("x", 0, 1), ("x", 0, 2), ("x", 0, 2)])
    landing.ingest_stream(spark, str(land), table, str(state))
    put(land, "b.json", [("x", 1, 3), ("y", 0, 1)])
    landing.ingest_stream(spark, str(land), table, str(state))
    want = [("x", 0, 1), ("x", 0, 2), ("x", 1, 3), ("y", 0, 1)]
    assert sorted(tuple(r) for r in landing.ingested(spark, table).collect()) == want
    # a crash after the second batch was stored and before it was noted: it runs again
    for file in (state / "commits").iterdir():
        if file.name in ("1", ".1.crc"):
            file.unlink()
    landing.ingest_stream(spark, str(land), table, str(state))
    assert sorted(tuple(r) for r in spark.read.parquet(table).select("dataset", "page", "objectid").collect()) == want
    told = lambda **n: spark.createDataFrame(list(n.items()), "dataset string, expected long")
    got = landing.ingested(spark, table)
    assert {r.dataset: r.state for r in landing.close_load(got, told(x=3)).collect()} == {"x": "closed", "y": "closed"}
    with pytest.raises(landing.PartialLoadError, match="y: expected 2, got 1; z: expected 4, got 0"):
        landing.close_load(got, told(x=3, y=2, z=4))


def test_other_tiles_stay(spark, tmp_path):
    path, book = str(tmp_path / "tiles"), str(tmp_path / "ledger")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "tile_id string, v int")
    tiles = lambda *t: spark.createDataFrame([(x,) for x in t], "tile_id string")
    run = lambda rows, *t: landing.write_tiles(rows, tiles(*t), path, book, "pond", "opportunity", "2024-01-01")
    run(df, "a", "b", "c")
    files = {p.name for p in tmp_path.rglob("tile_id=b/*")}
    run(df.filter("v = 2"), "a")
    assert {p.name for p in tmp_path.rglob("tile_id=b/*")} == files
    read = lambda: sorted((r.tile_id, r.v) for r in landing.read_tiles(spark, path, df.schema).collect())
    assert read() == [("a", 2), ("b", 3)]
    run(df.limit(0), "b")
    assert read() == [("a", 2)]
    assert sorted((r.tile_id, r.status) for r in spark.read.parquet(book).collect()) == [("a", "ok:1"), ("a", "ok:2"), ("b", "empty"), ("b", "ok:1"), ("c", "empty")]


def test_gml_pages_that_share_a_file(spark, tmp_path):
    member = lambda i, at: f'<wfs:member><ms:feature gml:id="f{i}"><ms:objectid>{i}</ms:objectid>\n<ms:dataset>a &amp; b</ms:dataset>{at}</ms:feature></wfs:member>'
    page = lambda *members: '<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0">' + "\n".join(members) + "</wfs:FeatureCollection>\n"
    place = "<gml:posList>1 2 3 4</gml:posList>"
    (tmp_path / "one.xml").write_text(page(member(1, place), member(2, "")) + "<ows:ExceptionReport>busy</ows:ExceptionReport>\n" + page() + page(member(3, place)))
    (tmp_path / "two.xml").write_text("<html>wfs:member</html>\n")
    got = sorted((r.gml_id, r.objectid, r.dataset, [tuple(v) for v in r.vertices]) for r in landing.gml_features(spark, str(tmp_path)).collect())
    assert got == [("f1", 1, "a & b", [(1.0, 2.0), (3.0, 4.0)]), ("f2", 2, "a & b", []), ("f3", 3, "a & b", [(1.0, 2.0), (3.0, 4.0)])]
