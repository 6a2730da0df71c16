"""Reprojection, dateline, spatial references and cells."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geoloom import filter_shape, finished_bins, nested_bins, normalize_shapes, parent_bins, reproject, unwrap_dateline, wrap_longitudes
from geoloom.functions.cells import hex_axis, hex_cell, hex_edge, hex_polygon, morton
from geoloom.functions.decode import parse_esri_json, parse_geojson
from geoloom.functions.distance import distance_to
from geoloom.functions.geometry import point, with_bounds
from geoloom.functions.decode import parse_wkt
from geoloom.functions.nested import nested_cell, nested_parent, nested_polygon
from workload.tables import positions

GRID = 1 / 64


def island(rng, lon, lat, reach, n=7):
    """A closed ring all around a centre, in longitudes that go on beyond 180; no vertex lies on the dateline."""
    turns = [(k + rng.uniform(0, 0.5)) * 2 * math.pi / n for k in range(n)]
    ring = [[round((lon + reach * math.cos(t)) / GRID) * GRID + GRID / 2, round((lat + reach * math.sin(t)) / GRID) * GRID] for t in turns]
    return [*ring, ring[0]]


def as_stored(ring):
    return [[(x + 180) % 360 - 180, y] for x, y in ring]


def as_drawn(part):
    """A part over the dateline goes on beyond 180, any other stays as it is stored."""
    across = len({x > 180 for x, _ in part[0]}) == 2
    return [ring if across else as_stored(ring) for ring in part]


def world(seed, n=60):
    """Random shapes of every kind with parts on either side of the dateline and across it: (kind, parts)."""
    rng, shapes = random.Random(seed), []
    for k in range(n):
        parts = []
        for _ in range(1 if k % 4 in (0, 2) else rng.randint(2, 4)):
            lon, lat, reach = rng.choice([rng.uniform(178, 182), rng.uniform(100, 260)]), rng.uniform(-60, 60), rng.uniform(3, 20)
            shell = island(rng, lon, lat, reach)
            parts.append([shell, island(rng, lon, lat, reach / 3)] if k % 4 < 2 else [shell])
        shapes.append((("Polygon", "MultiPolygon", "LineString", "MultiLineString")[k % 4], parts))
    return shapes


def geojson(kind, parts):
    nested = parts if kind == "MultiPolygon" else [p[0] for p in parts] if kind == "MultiLineString" else parts[0] if kind == "Polygon" else parts[0][0]
    return json.dumps({"type": kind, "coordinates": nested})


def decoded(spark, texts, srid=4326):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", parse_geojson(F.col("t"), srid).alias("g"))


def plain(g):
    return [[[[v.x, v.y] for v in ring] for ring in part] for part in g.parts]


def same_rings(got, want):
    """Equal whatever the vertex a ring starts with and its direction."""
    def key(ring):
        return sorted(map(tuple, ring[:-1])), ring[0] == ring[-1]
    return [[key(r) for r in part] for part in got] == [[key(r) for r in part] for part in want]


def test_shapes_over_the_dateline_are_drawn_in_one_piece(spark):
    shapes = world(1)
    df = decoded(spark, [geojson(kind, [[as_stored(r) for r in p] for p in parts]) for kind, parts in shapes])
    rows = df.select("i", unwrap_dateline(F.col("g")).alias("u"), "g", wrap_longitudes(unwrap_dateline(F.col("g"))).alias("back")).collect()
    moved = 0
    for row in rows:
        kind, parts = shapes[row.i]
        drawn = plain(row.u)
        assert row.u.type == kind and same_rings(drawn, [as_drawn(p) for p in parts])
        assert all(max(x for x, _ in ring) - min(x for x, _ in ring) < 180 for part in drawn for ring in part)
        assert plain(row.back) == plain(row.g)
        moved += drawn != plain(row.g)
    assert 10 < moved < len(shapes)


def test_other_shapes_are_drawn_as_stored(spark):
    """Points, metres, shapes near a pole, and shapes that are wide in small steps."""
    rng = random.Random(2)
    across = [as_stored(island(rng, 180, 10, 9))]
    steps = [[x + rng.random(), -40.0] for x in range(-170, 170, 30)]
    band = [[*steps, *([x, 40.0] for x, _ in reversed(steps)), steps[0]]]
    polar = [[[x, 85.5 + rng.random()] for x, _ in across[0][:-1]]]
    polar[0].append(polar[0][0])
    dots = [[rng.uniform(-180, 180), rng.uniform(-90, 90)] for _ in range(8)]
    degrees = [geojson("Polygon", [band]), geojson("Polygon", [polar]), geojson("LineString", [[steps]]),
               json.dumps({"type": "MultiPoint", "coordinates": dots}), json.dumps({"type": "Point", "coordinates": dots[0]})]
    for srid, texts in ((4326, degrees), (3857, [geojson("Polygon", [across])])):
        rows = decoded(spark, texts, srid).select("g", unwrap_dateline(F.col("g")).alias("u")).collect()
        assert len(rows) == len(texts) and all(r.g == r.u for r in rows)


def test_longitudes_are_wrapped_before_saving(spark):
    """Whatever turn a client draws a vertex in, the stored longitude is the same; metres stay."""
    rng = random.Random(3)
    ring = island(rng, 180, 0, 30)
    texts = [json.dumps({"rings": [[[x + turn, y] for x, y in ring]]}) for turn in (0, -360)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = sorted(map(tuple, as_stored(ring)))
    for row in df.select(wrap_longitudes(parse_esri_json(F.col("t"))).alias("g")).collect():
        assert sorted((v.x, v.y) for v in row.g.parts[0][0]) == want
    metres = df.select(parse_esri_json(F.col("t"), 3857).alias("g")).select("g", wrap_longitudes(F.col("g")).alias("w")).collect()
    assert all(r.g == r.w for r in metres)


def test_reproject(spark):
    df = spark.createDataFrame([("POINT(10 20)",)], "t string").select(parse_wkt(F.col("t")).alias("g"))
    v = df.select(reproject(F.col("g"), 102100).alias("g")).first().g
    assert v.srid == 3857
    assert (v.parts[0][0][0].x, v.parts[0][0][0].y) == (pytest.approx(1113194.9079), pytest.approx(2273030.9270))
    with pytest.raises(Exception, match="No transform from SRID 4326 to 2263"):
        df.select(reproject(F.col("g"), 2263)).collect()
    pole = spark.createDataFrame([("POINT(0 90)",)], "t string").select(reproject(parse_wkt(F.col("t")), 3857).alias("g"))
    assert pole.first().g is None


METRES = {"xmin": 1000000.5, "ymin": -3000000.25, "xmax": 2500000.75, "ymax": -1000000.5}
REFERENCES = [
    ("-10,-20,30,40", None), ("[-10, -20, 30, 40]", None), ("1,2", None), ('{"x":1,"y":2}', None),
    ('{"xmin":-180,"ymin":-90,"xmax":180,"ymax":90,"spatialReference":{"wkid":4326}}', None),
    (json.dumps({**METRES, "spatialReference": {"wkid": 3857}}), None), (json.dumps({**METRES, "spatialReference": {"wkid": 102100, "latestWkid": 3857}}), None),
    (json.dumps(METRES), None), (json.dumps(METRES), '{"latestWkid":3857,"wkid":102100}'),
    (json.dumps(METRES), '{"spatialReference":{"wkid":3857}}'), (json.dumps(METRES), "3857"), (json.dumps(METRES), "102113"),
    ('{"xmin":-180,"ymin":-90,"xmax":180,"ymax":90,"spatialReference":{"wkid":4326}}', "".join(random.Random(3).choices("pqz()[]; ", k=9))),
    ('{"rings":[[[0,0],[0,4],[4,4],[4,0],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]],[[9,9],[9,10],[10,10],[9,9]]]}', None),
    ('{"paths":[[[0,0],[1,1]],[[2,2],[3,3]]]}', "4326"), ('{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}', None), ("1000000,-3000000,2500000,-1000000", None),
]


@pytest.mark.parametrize("text,in_sr", REFERENCES)
def test_single_shape_equals_the_table_form(spark, text, in_sr):
    one = filter_shape(text, 4326, in_sr)
    df = spark.createDataFrame([(text, in_sr)], "shape string, sr string")
    row = normalize_shapes(df, "shape", 4326, "sr").first()
    table = [(v.x, v.y) for part in row.geom.parts for ring in part for v in ring]
    assert (one.kind, one.srid, [len(p) for p in one.parts]) == (row.geom.type, row.geom.srid, [len(p) for p in row.geom.parts])
    assert [c for v in one.vertices for c in v] == pytest.approx([c for v in table for c in v], abs=1e-9)
    assert one.bounds == pytest.approx((row._xmin, row._ymin, row._xmax, row._ymax), abs=1e-9)


def test_unreadable_shapes(spark):
    bad = ["abc", "1,2,3", "", "{}", '{"x":1}', '{"rings":[]}', '{"rings":[[[0,0],[1,1]]]}', "1,a", '{"type":"Point","coordinates":["a",2]}']
    for text in bad:
        with pytest.raises(ValueError):
            filter_shape(text, 4326)
    rows = normalize_shapes(spark.createDataFrame([(t,) for t in bad], "shape string"), "shape").collect()
    assert [t for t, r in zip(bad, rows) if r.geom is not None and r.geom.parts] == []
    with pytest.raises(ValueError, match="WKT"):
        filter_shape('{"x":1,"y":2,"spatialReference":{"wkt":"GEOGCS[]"}}', 4326)
    with pytest.raises(ValueError, match="No transform"):
        filter_shape("1,2", 4326, 2263)


def test_hexagons_contain_their_points(spark):
    rng = random.Random(3)
    points = [(rng.uniform(-180, 180), rng.uniform(-84, 84)) for _ in range(400)]
    for resolution in (0, 3, 7, 15):
        df = spark.createDataFrame(points, "x double, y double").withColumn("cell", hex_cell(F.col("x"), F.col("y"), resolution))
        q, r = hex_axis(F.col("cell"))
        rows = df.select("x", "y", q.alias("q"), r.alias("r"), hex_polygon(F.col("cell"), resolution).alias("g")).collect()
        edge = hex_edge(resolution)
        for row in rows:
            mx = math.radians(row.x) * 6378137.0
            my = math.asinh(math.tan(math.radians(row.y))) * 6378137.0
            cx, cy = edge * math.sqrt(3) * (row.q + row.r / 2), edge * 1.5 * row.r
            assert math.hypot(mx - cx, my - cy) <= edge * (1 + 1e-6)
            ring = row.g.parts[0][0]
            assert len(ring) == 7 and ring[0] == ring[-1]
            assert min(v.x for v in ring) - 1e-9 <= row.x <= max(v.x for v in ring) + 1e-9
            assert min(v.y for v in ring) - 1e-9 <= row.y <= max(v.y for v in ring) + 1e-9
    with pytest.raises(ValueError):
        hex_edge(16)


def test_nested_cells_have_one_parent_and_seven_children(spark):
    rng = random.Random(8)
    points = [(rng.uniform(-170, 170), rng.uniform(-80, 80)) for _ in range(300)]
    df = spark.createDataFrame(points, "x double, y double")
    for resolution in (1, 4, 9):
        at = df.select("x", "y", nested_cell(F.col("x"), F.col("y"), resolution).alias("cell"))
        outlines = at.select("*", nested_polygon(F.col("cell"), resolution).alias("g"), hex_cell(F.col("x"), F.col("y"), resolution).alias("flat")).collect()
        for row in outlines:
            ring = [(math.radians(v.x), math.asinh(math.tan(math.radians(v.y)))) for v in row.g.parts[0][0]]
            px, py = math.radians(row.x), math.asinh(math.tan(math.radians(row.y)))
            turns = [(bx - ax) * (py - ay) - (by - ay) * (px - ax) for (ax, ay), (bx, by) in zip(ring, ring[1:])]
            assert len(turns) == 6 and min(turns) > -1e-12 and (resolution % 2 or row.cell == row.flat)
    # Cells around one place, told by their whole numbers: those of a full parent are seven, and steps can be taken at once.
    side = 60
    patch = spark.range(side * side).select(F.expr(f"5L * {1 << 58} + (id % {side} + {1 << 28}) * {1 << 29} + (id div {side} + {1 << 28})").alias("cell"))
    family = patch.select("cell", nested_parent(F.col("cell"), 5, 4).alias("up"), nested_parent(F.col("cell"), 5, 2).alias("top"))
    sizes = Counter(r.up for r in family.collect())
    assert max(sizes.values()) == 7 and sum(n == 7 for n in sizes.values()) > side * side / 7 * 0.8
    assert family.filter(nested_parent(F.col("up"), 4, 2) != F.col("top")).count() == 0
    assert patch.filter(nested_parent(F.col("cell"), 5, 5) != F.col("cell")).count() == 0
    missing = spark.sql("SELECT CAST(NULL AS DOUBLE) AS x, 1.0D AS y").select(nested_cell(F.col("x"), F.col("y"), 3).alias("c"))
    assert missing.select("c", nested_parent(F.col("c"), 3, 1).alias("p")).first() == (None, None)
    with pytest.raises(ValueError):
        nested_parent(F.col("cell"), 3, 4)


def test_merged_bins_are_bins_by_the_parent(spark, sf_dir):
    near = positions(spark, sf_dir).withColumns({"lon": F.col("lon") / 20, "lat": F.col("lat") / 20})
    merged = finished_bins(parent_bins(nested_bins(near, "lon", "lat", 5, "entity", "speed", "ts"), 5, 2), 2)
    cells = near.withColumn("cell", nested_parent(nested_cell(F.col("lon"), F.col("lat"), 5), 5, 2))
    direct = {r.cell: r for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.avg("speed").alias("mean"), F.count_distinct("entity").alias("e"), F.min("ts").alias("t")).collect()}
    rows = merged.collect()
    assert len(rows) == len(direct) > 1
    for row in rows:
        want = direct[row.cell]
        assert (row.total_positions, row.earliest) == (want.n, want.t) and row.avg_speed == pytest.approx(want.mean)
        assert abs(row.unique_entities - want.e) <= 0.05 * want.e
    assert nested_bins(near.limit(0), "lon", "lat", 5, "entity", "speed", "ts").count() == 0


def test_morton_interleaves_bits(spark):
    rng = random.Random(4)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(200)] + [(-180.0, -90.0), (180.0, 90.0), (500.0, -500.0)]
    rows = spark.createDataFrame(points, "x double, y double").select("x", "y", morton(F.col("x"), F.col("y")).alias("m")).collect()
    for row in rows:
        x = min(max(math.floor((row.x + 180) / 360 * 2 ** 31), 0), 2 ** 31 - 1)
        y = min(max(math.floor((row.y + 90) / 180 * 2 ** 31), 0), 2 ** 31 - 1)
        assert row.m == sum(((x >> i) & 1) << (2 * i) | ((y >> i) & 1) << (2 * i + 1) for i in range(31))


def test_distances_match_the_library(spark, jts):
    texts = ["POINT(3 4)", "MULTIPOINT(9 9, 1 1)", "LINESTRING(5 5, 5 -5)", "POLYGON((1 1, 4 1, 4 4, 1 4, 1 1))", "POLYGON((-1 -1, 4 -1, 4 4, -1 4, -1 -1))",
             "POLYGON((-9 -9, 9 -9, 9 9, -9 9, -9 -9), (-2 -2, -2 3, 3 3, 3 -2, -2 -2))", "MULTILINESTRING((9 9, 8 8), (0 2, 7 2))",
             "MULTIPOLYGON(((7 7, 8 7, 8 8, 7 7)), ((2 0, 3 1, 3 -1, 2 0)))", "LINESTRING(2 3, 4 3)"]
    df = with_bounds(spark.createDataFrame([(t,) for t in texts], "t string").withColumn("geom", parse_wkt(F.col("t"))))
    for row in df.select("t", distance_to(F.col("geom"), 0.25, -0.5).alias("d")).collect():
        assert row.d == pytest.approx(jts(row.t).distance(jts("POINT(0.25 -0.5)"))), row.t


def test_utm_against_the_meridian_and_conformality(spark):
    """On the meridian the northing is the arc of the ellipsoid; off it, small steps east and north stay at right angles and of one scale."""
    a, f = 6378137.0, 1 / 298.257223563
    e2 = f * (2 - f)

    def arc(latitude: float) -> float:
        steps = 20_000
        h = math.radians(latitude) / steps
        return sum(a * (1 - e2) * (1 - e2 * math.sin((i + 0.5) * h) ** 2) ** -1.5 * h for i in range(steps))

    places, step = [(15.0, 0.0), (15.0, 45.0), (15.0, 84.0), (21.0, 60.0), (9.5, 33.0)], 1e-5
    rows = [(k, d, lon + (step if d == 1 else 0), lat + (step if d == 2 else 0)) for k, (lon, lat) in enumerate(places) for d in (0, 1, 2)]
    df = spark.createDataFrame(rows, "k int, d int, x double, y double").select("k", "d", "y", point(F.col("x"), F.col("y")).alias("g"))
    got = {(r.k, r.d): (r.g.parts[0][0][0].x, r.g.parts[0][0][0].y) for r in df.select("k", "d", reproject(F.col("g"), 32633).alias("g")).collect()}
    for k, (lon, lat) in enumerate(places):
        x, y = got[k, 0]
        if lon == 15.0:
            assert abs(x - 500_000) < 1e-6 and abs(y - 0.9996 * arc(lat)) < 1e-3
        narrow = math.sqrt(1 - e2 * math.sin(math.radians(lat)) ** 2)
        east = [(p - q) / (a / narrow * math.cos(math.radians(lat)) * math.radians(step)) for p, q in zip(got[k, 1], got[k, 0])]
        north = [(p - q) / (a * (1 - e2) / narrow ** 3 * math.radians(step)) for p, q in zip(got[k, 2], got[k, 0])]
        assert abs(east[0] - north[1]) < 1e-5 and abs(east[1] + north[0]) < 1e-5
    south = df.filter("d = 0").select(reproject(reproject(reproject(F.col("g"), 32733), 3857), 32633).alias("g"), "k").collect()
    assert all(abs(r.g.parts[0][0][0].x - got[r.k, 0][0]) < 1e-3 and abs(r.g.parts[0][0][0].y - got[r.k, 0][1]) < 1e-3 for r in south)
    far = spark.range(1).select(point(F.lit(-170.0), F.lit(10.0)).alias("g")).select(reproject(F.col("g"), 32633).alias("g"), reproject(F.col("g"), 32601).alias("h")).first()
    assert far.g is None and far.h.srid == 32601
