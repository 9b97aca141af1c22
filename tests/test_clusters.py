import random

from pyspark.sql import functions as F

from landweave.functions import geometry as G
from landweave.operators import cells, graph, overlay, touch

SCHEMA = "fid long, geom struct<kind: string, parts: array<array<array<struct<x: double, y: double>>>>>"


def layer(spark, shapes):
    return G.with_bounds(spark.createDataFrame([(i, ("polygon", [[[(float(x), float(y)) for x, y in [*r, r[0]]] for r in shape]])) for i, shape in shapes], SCHEMA))


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def test_clusters_are_those_of_all_pairs(spark, monkeypatch):
    """Shapes of several sizes, with holes, slanted sides and copies, some in dense heaps, whose pairs are not looked for."""
    rng, shapes = random.Random(8), []
    for _ in range(400):
        x, y, s = rng.randrange(0, 6000, 10), rng.randrange(0, 6000, 10), rng.choice([5, 20, 60, 100, 200, 600])
        kind = rng.randrange(4)
        shapes.append([[square(x, y, s)], [[(x, y), (x + s, y), (x, y + s)]], [square(x, y, s), square(x + s / 4, y + s / 4, s / 2)], [[(x + s / 2, y), (x + s, y + s / 2), (x + s / 2, y + s), (x, y + s / 2)]]][kind])
    shapes += [[square(7000 + rng.randrange(0, 60, 5), 7000 + rng.randrange(0, 60, 5), 70)] for _ in range(200)]
    shapes += [[square(8000, 8000, 400), square(8010, 8010, 380)], [square(8100, 8100, 30)], *[[square(8200, 8200, 0.5)]] * 40]  # in a hole; copies
    rng.shuffle(shapes)
    polygons = layer(spark, enumerate(shapes))
    looked, write = {}, touch.written

    def kept(df, name):
        looked[name] = write(df, name)
        return looked[name]

    monkeypatch.setattr(touch, "written", kept)
    got = {r.node: r.root for r in touch.clusters(polygons).collect()}
    monkeypatch.undo()
    pairs = touch.touching_polygons(polygons)
    want = dict.fromkeys(range(len(shapes))) | {r.node: r.root for r in graph.connected_components(pairs).collect()}
    assert got == {k: k if v is None else v for k, v in want.items()}
    assert looked["cluster-near"].count() < pairs.count() / 10


def test_sides_and_corners_join_clusters(spark):
    rows = [(1, [square(0, 0, 31.25)]), (2, [square(31.25, 31.25, 31.25)]), (3, [square(62.5, 0, 31.25)]), (4, [[(62.5, 62.5), (80, 80), (62.5, 80)]]), (9, [square(200, 200, 1)])]
    assert {r.node: r.root for r in touch.clusters(layer(spark, rows)).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 9: 9}
    assert touch.clusters(layer(spark, rows).filter(F.lit(False))).count() == 0


def test_pairs_of_blocks_are_those_of_edges(spark, monkeypatch):
    """L-shapes, frames and boxes, some large, one with a spike: pairs by blocks are the pairs by edges and sweeps, and only the spiked one's are written."""
    rng, shapes = random.Random(3), []
    for _ in range(120):
        x, y, s = rng.randrange(0, 900, 10), rng.randrange(0, 900, 10), rng.choice([20, 60, 100, 2000])
        h = s / 2
        shapes.append([[square(x, y, s)], [square(x, y, s), square(x + s / 4, y + s / 4, h)], [[(x, y), (x + s, y), (x + s, y + h), (x + h, y + h), (x + h, y + s), (x, y + s)]]][rng.randrange(3)])
    shapes.append([[(5, 5), (15, 5), (15, 905), (15, 15), (5, 15)]])
    polygons, looked, write = layer(spark, enumerate(shapes)), {}, touch.written

    def kept(df, name):
        looked[name] = write(df, name)
        return looked[name]

    monkeypatch.setattr(touch, "written", kept)
    by_blocks = sorted(map(tuple, touch.touching_polygons(polygons).collect())), {(r.a, r.b): round(r.area, 6) for r in overlay.overlaps(polygons).collect()}
    assert 0 < looked["near-pairs"].count() <= 120
    monkeypatch.setattr(cells, "MOST_EDGES", 0)
    assert by_blocks == (sorted(map(tuple, touch.touching_polygons(polygons).collect())), {(r.a, r.b): round(r.area, 6) for r in overlay.overlaps(polygons).collect()})
