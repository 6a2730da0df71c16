"""Decoders against the JVM geometry library and fixed cases."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from geoloom import ingest_geometry, profile_geometry
from geoloom.functions.decode import _decode_wkb, decode, parse_esri_json, parse_geojson, parse_wkb, parse_wkt
from geoloom.functions.geometry import as_ewkt, as_geojson, as_wkt, vertices
from geoloom.sources.ingest import resolve_format, scan_table, with_geometry

GOOD = [
    "POINT(-58.25 6.125)", " point ( 1   2 ) ", "POINT Z (1 2 3)", "POINT(1e2 -.5)", "MULTIPOINT((1 2), (3 4))", "MULTIPOINT(1 2, 3 4)",
    "LINESTRING(0 0, 1 1, 2 0)", "LINESTRING Z (0 0 1, 1 1 2)", "MULTILINESTRING((0 0,1 1),(2 2,3 3,4 4))",
    "POLYGON((30 10, 40 40, 20 40, 10 20, 30 10))", "POLYGON ( ( 0 0 , 10 0 , 10 10 , 0 10 , 0 0 ) , ( 1 1, 1 2, 2 2, 2 1, 1 1 ) )",
    "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,9 5,9 9,5 9,5 5),(6 6,6 7,7 7,7 6,6 6)))", "POLYGON((0 0,\n1 0,\n1 1,\n0 0))",
]
BAD = [
    "", "POINT(1", "POINT(1 2", "POINT(a b)", "POINT(1)", "POINT(1 2 3 4 5)", "POINT 1 2", "LINESTRING(0 0)", "LINESTRING((0 0, 1 1))",
    "POLYGON((0 0, 1 0, 1 1))", "POLYGON((0 0, 1 0, 1 1, 0 1))", "POLYGON(0 0, 1 0, 1 1, 0 0)", "POLYGON((0 0, 1 0, 0 0))", "MULTIPOLYGON((0 0,1 0,1 1,0 0))",
    "GEOMETRYCOLLECTION(POINT(1 2))", "CIRCLE(0 0, 1)", "POINT(1 2) x", "POINT(NaN 1)", "POINT(1e999 1)", "hello",
]


def shapes(spark, texts, parse, ddl="i int, t string"):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ddl).select("i", parse(F.col("t")).alias("g")).orderBy("i").collect()
    return [r.g for r in rows]


def flat(g):
    return [(v.x, v.y) for part in g.parts for ring in part for v in ring]


def test_wkt_matches_the_library(spark, jts):
    for text, g in zip(GOOD, shapes(spark, GOOD, parse_wkt)):
        want = jts(text)
        assert g.type == want.getGeometryType() and g.srid == 4326, text
        assert flat(g) == [(c.getX(), c.getY()) for c in want.getCoordinates()], text
        assert len(g.parts) == want.getNumGeometries(), text


def test_wkt_bad_rows_are_null(spark):
    assert shapes(spark, BAD + [None], parse_wkt) == [None] * (len(BAD) + 1)


def test_wkt_empty_and_ewkt(spark):
    empty, own = shapes(spark, ["POLYGON EMPTY", "SRID=3857;POINT(1 2)"], parse_wkt)
    assert (empty.type, empty.parts) == ("Polygon", []) and (own.srid, flat(own)) == (3857, [(1.0, 2.0)])


def test_wkt_round_trip(spark):
    df = spark.createDataFrame([(t,) for t in GOOD], "t string").select(parse_wkt(F.col("t")).alias("g"))
    again = df.select("g", parse_wkt(as_wkt(F.col("g"))).alias("h"), parse_geojson(as_geojson(F.col("g"))).alias("j")).collect()
    assert all(r.g == r.h == r.j for r in again)
    assert df.select(as_ewkt(F.col("g")).alias("e")).first().e == "SRID=4326;POINT(-58.25 6.125)"


def test_wkb_matches_the_library(spark, jts):
    writer = spark._jvm.org.locationtech.jts.io.WKBWriter
    texts = [t for t in GOOD if "Z" not in t]
    values = [bytes(writer(2, order).write(jts(t))) for t in texts for order in (1, 2)]
    expected = [t for t in texts for _ in (1, 2)]
    for text, g in zip(expected, shapes(spark, values, lambda c: parse_wkb(c, 26910), "i int, t binary")):
        want = jts(text)
        assert g.type == want.getGeometryType() and g.srid == 26910
        assert flat(g) == [(c.getX(), c.getY()) for c in want.getCoordinates()]


def test_wkb_dimensions_and_srid(spark):
    ewkb = struct.pack("<BIIdd", 1, 1 | 0x20000000, 3857, 1.0, 2.0)
    flagged = struct.pack("<BIddd", 1, 1 | 0x80000000, 1.0, 2.0, 9.0)
    iso = struct.pack("<BIIdddddd", 1, 1002, 2, 0.0, 0.0, 9.0, 1.0, 1.0, 9.0)
    a, b, c = shapes(spark, [ewkb, flagged, iso], parse_wkb, "i int, t binary")
    assert (a.srid, flat(a)) == (3857, [(1.0, 2.0)]) and flat(b) == [(1.0, 2.0)] and flat(c) == [(0.0, 0.0), (1.0, 1.0)]


def test_wkb_bad_rows_are_null(spark):
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    bad = [None, b"", b"\x07" + point[1:], point[:-1], point + b"\x00", struct.pack("<BIdd", 1, 99, 1, 2), struct.pack("<BIdd", 1, 1, float("nan"), 2),
           struct.pack("<BII", 1, 2, 4_000_000_000), struct.pack("<BIII4d", 1, 3, 1, 2, 0, 0, 1, 1)]
    assert shapes(spark, bad, parse_wkb, "i int, t binary") == [None] * len(bad)


def random_wkb(draw: random.Random) -> bytes | None:
    """Values of few lengths and many layouts, some of them cut off or with unclosed rings."""

    def head(order: str, code: int, *numbers: int) -> bytes:
        return bytes([order == "<"]) + struct.pack(f"{order}{1 + len(numbers)}I", code, *numbers)

    def place(order: str) -> bytes:
        flag, srid = draw.choice([0, 0x80000000]), draw.choice([(), (3857,), (26910,)])
        axes = [draw.choice([1.5, 2.25, float("inf")]) for _ in range(3 if flag else 2)]
        return head(order, 1 | flag | (0x20000000 if srid else 0), *srid) + struct.pack(f"{order}{len(axes)}d", *axes)

    def area(order: str) -> bytes:
        sizes = draw.choice([[5], [4, 4], [5, 4], [4, 5], []])
        value = head(order, 3, len(sizes))
        for n in sizes:
            ring = [(draw.random(), draw.random()) for _ in range(n - 1)]
            ring.append(ring[0] if draw.random() < 0.9 else (9.0, 9.0))
            value += struct.pack(order + "I", n) + struct.pack(f"{order}{2 * n}d", *[v for xy in ring for v in xy])
        return value

    order, kind = draw.choice("<>"), draw.choice(["none", "cut", "point", "area", "points", "areas"])
    if kind in ("points", "areas"):
        member = place if kind == "points" else area
        members = [member(draw.choice("<>")) for _ in range(draw.randrange(3))]
        return head(order, 4 if kind == "points" else 6, len(members)) + b"".join(members)
    value = (area if kind == "area" else place)(order)
    return None if kind == "none" else value[:draw.randrange(len(value))] if kind == "cut" else value


@pytest.mark.parametrize("seed", [1, 2])
def test_wkb_read_together_is_wkb_read_one_by_one(seed):
    draw = random.Random(seed)
    values = pa.array([random_wkb(draw) for _ in range(4000)], pa.binary())
    for part in (values, values.slice(1234, 900), values.slice(0, 0), pa.array([None, None, b""], pa.binary())):
        together = _decode_wkb(part, 4326).to_pylist()
        assert together == [None if v is None else _decode_wkb(pa.array([v], pa.binary()), 4326)[0].as_py() for v in part.to_pylist()]


def test_geojson(spark):
    texts = ['{"type":"Point","coordinates":[13.5,-4]}', '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}',
             '{"type":"Point","coordinates":[1,2,3]}']
    a, b, c = shapes(spark, texts, lambda t: decode(t, "geojson", 3857))
    assert (a.srid, flat(a)) == (4326, [(13.5, -4.0)]) and len(b.parts) == 2 and flat(c) == [(1.0, 2.0)]
    bad = ['{"type":"Point","coordinates":[1]}', '{"type":"Point"}', '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1]]]}', '{"type":"Point","coordinates":["a",1]}',
           "[1,2]", "", "null", '{"type":"GeometryCollection","geometries":[]}', '{"type":"Point","coordinates":[1,2', '{"type":"LineString","coordinates":[[0,0],null]}']
    assert shapes(spark, bad, parse_geojson) == [None] * len(bad)


def test_esri_json(spark):
    texts = ['{"x":1,"y":2}', '{"paths":[[[0,0],[1,1]]]}', '{"paths":[[[0,0],[1,1]],[[2,2],[3,3]]]}', '{"type":"Point","coordinates":[7,8]}']
    got = shapes(spark, texts, lambda t: parse_esri_json(t, 3857))
    assert [(g.type, g.srid) for g in got] == [("Point", 3857), ("LineString", 3857), ("MultiLineString", 3857), ("Point", 3857)]
    bad = ['{"x":"a","y":2}', '{"x":1}', "{}", '{"rings":[[[0,0],[1,1]]]}', '{"paths":[[[0,0]]]}', '{"points":[[1,2]]}', "x", '{"x":NaN,"y":1}']
    assert shapes(spark, bad, parse_esri_json) == [None] * len(bad)


def test_many_random_rings_group_like_a_loop(spark):
    rng = random.Random(5)
    def ring():
        x, y = rng.randint(0, 50), rng.randint(0, 50)
        pts = [[x, y], [x, y + 2], [x + 2, y + 2], [x + 2, y], [x, y]]
        return pts if rng.random() < 0.5 else pts[::-1]
    cases = [[ring() for _ in range(rng.randint(1, 9))] for _ in range(50)]
    expected = []
    for rings in cases:
        layout = []
        for r in rings:
            area = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:]))
            if area < 0 or not layout:
                layout.append(1)
            else:
                layout[-1] += 1
        expected.append(layout)
    got = shapes(spark, [f'{{"rings":{rings}}}' for rings in cases], parse_esri_json)
    assert [[len(p) for p in g.parts] for g in got] == expected
    assert [g.type for g in got] == ["Polygon" if len(layout) == 1 else "MultiPolygon" for layout in expected] and any(len(layout) == 1 for layout in expected)


def test_format_choice(spark):
    df = spark.createDataFrame([("POINT(1 2)", b"x", 1)], "shape string, blob binary, n int").withColumn("geom_wkt", F.lit(b"x"))
    assert [resolve_format(df, *a) for a in (("shape",), ("blob",), ("n",), ("geom_wkt",), ("shape", "GeoJSON"))] == ["WKT", "WKB", "GEOMETRY", "WKT", "GEOJSON"]
    with pytest.raises(ValueError):
        resolve_format(df, "shape", "KML")


def test_native_geometry_column(spark):
    """Spark's own geometry type, where the session has it switched on."""
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    try:
        df = spark.createDataFrame([(struct.pack("<BIdd", 1, 1, 1.5, 2.5),)], "b binary").select(F.st_geomfromwkb("b").alias("shape"))
        row = with_geometry(df, "shape").select("geom.type", "_xmin", "_ymax").first()
        assert tuple(row) == ("Point", 1.5, 2.5)
    finally:
        spark.conf.unset("spark.sql.geospatial.enabled")


def test_quarantine_keeps_rows(spark):
    df = spark.createDataFrame([(1, "POINT(1 2)"), (2, "POINT(1"), (3, None), (4, "")], "id int, shape string")
    rows, bad = ingest_geometry(df, "shape")
    assert rows.count() == 4 and sorted(r.id for r in bad.collect()) == [2, 4]
    assert rows.filter("_xmin IS NULL").count() == 3


def test_profile_counts_rows_without_srid(spark):
    df = spark.createDataFrame([("POINT(1 2)",), ("SRID=0;POINT(1 2)",), (None,), ("x",)], "shape string")
    got = {(r.type, r.srid, r.state): r.n_rows for r in profile_geometry(df, "shape").collect()}
    assert got == {("Point", 4326, "ok"): 1, ("Point", 0, "no srid"): 1, (None, None, "missing"): 1, (None, None, "unreadable"): 1}


def test_text_is_decoded_once_under_filters(spark):
    df = spark.createDataFrame([(1, "POINT(1 2)")], "id int, shape string")
    kept = with_geometry(df, "shape").filter("_xmin > 0 AND _ymax < 9 AND geom.type = 'Point'")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract(shape") == 5 and "Generate" in plan and kept.count() == 1


def test_table_names(spark):
    for bad in ("a.b.c.d", "a-b", "a b", "", "x;drop"):
        with pytest.raises(ValueError):
            scan_table(spark, bad)


def test_vertices_are_flat(spark):
    (g,) = shapes(spark, [GOOD[-2]], lambda t: vertices(parse_wkt(t)))
    assert len(g) == 14
