"""The relation function against the JVM geometry library, entry by entry."""

import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions.decode import parse_wkt
from geoloom.functions.geometry import with_bounds, with_column_once
from geoloom.functions.predicates import RELATIONS, matches, matches_column
from geoloom.functions.relate import MATRIX, relation, relation_to
from geoloom.functions.shapes import FilterShape

FIXED = [
    "POINT(0 0)", "POINT(2 2)", "POINT(5 0)", "POINT(3 3)", "MULTIPOINT(0 0, 5 5)", "MULTIPOINT(2 2, 20 20)",
    "LINESTRING(0 0, 10 0)", "LINESTRING(0 0, 10 10)", "LINESTRING(0 10, 10 0)", "LINESTRING(5 5, 15 5)",
    "LINESTRING(2 2, 8 2, 8 8)", "LINESTRING(-5 5, 15 5)", "LINESTRING(0 0, 10 0, 10 10, 0 10, 0 0)",
    "LINESTRING(3 3, 4 4)", "LINESTRING(10 10, 20 20)", "LINESTRING(5 0, 5 10)", "LINESTRING(0 0, 5 0, 10 0)",
    "MULTILINESTRING((0 0, 5 5), (5 5, 10 0))", "MULTILINESTRING((0 0, 5 5), (5 5, 10 0), (5 5, 5 9))",
    "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))", "POLYGON((0 0, 0 10, 10 10, 10 0, 0 0))",
    "POLYGON((10 0, 20 0, 20 10, 10 10, 10 0))", "POLYGON((2 2, 4 2, 4 4, 2 4, 2 2))",
    "POLYGON((5 5, 15 5, 15 15, 5 15, 5 5))", "POLYGON((10 10, 20 10, 20 20, 10 20, 10 10))",
    "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))",
    "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (1 1, 9 1, 9 9, 1 9, 1 1))", "POLYGON((0 0, 5 0, 5 5, 0 5, 0 0))",
    "POLYGON((0 5, 5 0, 10 5, 5 10, 0 5))", "POLYGON((0 0, 10 0, 5 10, 0 0))",
    "MULTIPOLYGON(((0 0, 2 0, 2 2, 0 2, 0 0)), ((4 4, 8 4, 8 8, 4 8, 4 4)))",
    "MULTIPOLYGON(((2 2, 4 2, 4 4, 2 4, 2 2)), ((10 10, 12 10, 12 12, 10 12, 10 10)))",
]


def matrix_of(text):
    return {"F": -1, "0": 0, "1": 1, "2": 2}[text]


def expected(jts, a, b):
    text = jts(a).relate(jts(b)).toString()
    return tuple(matrix_of(c) for c in text[:8])


def decoded(df):
    """Texts a and b as geometries g and h."""
    return with_column_once(with_column_once(df, "g", parse_wkt(F.col("a"))), "h", parse_wkt(F.col("b")))


def found(spark, pairs):
    df = decoded(spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string").repartition(4))
    out = df.select("i", relation(F.col("g"), F.col("h")).alias("m")).select("i", "m.*").collect()
    by_row = {r.i: tuple(r[c] for c in MATRIX) for r in out}
    return [by_row[i] for i in range(len(pairs))]


def compare(spark, jts, pairs):
    wrong = [(a, b, want, got) for (a, b), got in zip(pairs, found(spark, pairs)) if got != (want := expected(jts, a, b))]
    assert not wrong, f"{len(wrong)} of {len(pairs)} differ, first: {wrong[:3]}"


def test_fixed_pairs(spark, jts):
    compare(spark, jts, [(a, b) for a in FIXED for b in FIXED])


def _random_shape(rng, jts, scale):
    """Shapes on a coarse lattice, so that they often touch; scale None gives positions without any pattern."""
    def number(lo, hi):
        return rng.uniform(lo, hi) if scale is None else rng.randint(lo, hi) * scale

    def at():
        return f"{number(0, 8)!r} {number(0, 8)!r}"

    while True:
        kind = rng.choice(["point", "points", "line", "lines", "box", "triangle", "hole"])
        x, y, w, h = number(0, 6), number(0, 6), rng.randint(3, 6) * (scale or 1.1), rng.randint(3, 6) * (scale or 1.3)
        if kind == "point":
            text = f"POINT({at()})"
        elif kind == "points":
            text = f"MULTIPOINT({at()}, {at()}, {at()})"
        elif kind == "line":
            text = f"LINESTRING({', '.join(at() for _ in range(rng.randint(2, 4)))})"
        elif kind == "lines":
            text = f"MULTILINESTRING(({at()}, {at()}), ({at()}, {at()}))"
        else:
            def corner(i, j):
                return f"{x + i!r} {y + j!r}"
            if kind == "triangle":
                a, b, c = at(), at(), at()
                text = f"POLYGON(({a}, {b}, {c}, {a}))"
            else:
                ring = f"({corner(0, 0)}, {corner(w, 0)}, {corner(w, h)}, {corner(0, h)}, {corner(0, 0)})"
                u = scale or 1
                inner = f"({corner(u, u)}, {corner(2 * u, u)}, {corner(2 * u, 2 * u)}, {corner(u, 2 * u)}, {corner(u, u)})"
                text = f"POLYGON({ring})" if kind == "box" else f"POLYGON({ring}, {inner})"
        shape = jts(text)
        if shape.isValid() and shape.isSimple() and shape.getLength() + shape.getNumPoints() > 0 and not (
                "LINE" in text and shape.getLength() == 0):
            return text


@pytest.mark.parametrize("seed,scale", [(1, 1), (2, 1), (3, 0.25), (4, None)])
def test_random_pairs(spark, jts, seed, scale):
    rng = random.Random(seed)
    shapes = [_random_shape(rng, jts, scale) for _ in range(60)]
    compare(spark, jts, [(rng.choice(shapes), rng.choice(shapes)) for _ in range(800)])


def _filter_shape(geom):
    return FilterShape(geom.type, geom.srid, [[[(v.x, v.y) for v in ring] for ring in part] for part in geom.parts])


@pytest.mark.parametrize("name", sorted(RELATIONS.values()))
def test_predicates_agree_with_the_library(spark, jts, name):
    """Filter against a fixed shape (point, box and general paths) and the column form, on all fixed pairs."""
    df = with_bounds(spark.createDataFrame([(i, a) for i, a in enumerate(FIXED)], "i int, a string")
                     .withColumn("geom", parse_wkt(F.col("a")))).cache()
    shapes = {r.a: r.geom for r in df.collect()}
    for b in FIXED[::4] + FIXED[19:25:2]:
        got = {r.i for r in df.filter(matches(F.col("geom"), _filter_shape(shapes[b]), name, strict=True)).collect()}
        want = {i for i, a in enumerate(FIXED) if getattr(jts(a), name)(jts(b))}
        if name == "crosses":
            # The rewrite also counts pairs the standard leaves undefined; compare where the standard answers.
            want = {i for i, a in enumerate(FIXED) if _crosses_rewrite(jts, a, b)}
        assert got == want, (name, b, sorted(got ^ want))


def _crosses_rewrite(jts, a, b):
    p, q = jts(a), jts(b)
    if not p.intersects(q) or p.touches(q) or p.contains(q) or p.within(q):
        return False
    return p.intersection(q).getDimension() < max(p.getDimension(), q.getDimension())


def test_overlaps_default_keeps_the_wider_meaning(spark):
    """Two lines that cross in one point: overlap by the default rule, not by the strict one."""
    df = decoded(spark.createDataFrame([("LINESTRING(0 0, 10 10)", "LINESTRING(0 10, 10 0)")], "a string, b string"))
    a, b = F.col("g"), F.col("h")
    row = df.select(matches_column(a, b, "overlaps").alias("wide"), matches_column(a, b, "overlaps", True).alias("strict")).first()
    assert (row.wide, row.strict) == (True, False)


def test_missing_geometry_gives_no_relation(spark):
    df = decoded(spark.createDataFrame([("POINT(1 1)", None), ("POINT EMPTY", "POINT(1 1)")], "a string, b string"))
    rows = df.select(relation(F.col("g"), F.col("h")).alias("m")).collect()
    assert [r.m for r in rows] == [None, None]


def test_long_outlines_go_through_in_blocks(spark, jts):
    """Two rings of 3000 vertices each: far more segment pairs than one block holds."""
    import math

    def ring(cx, n=3000):
        pts = [f"{cx + 10 * math.cos(2 * math.pi * k / n)!r} {10 * math.sin(2 * math.pi * k / n)!r}" for k in range(n)]
        return f"POLYGON(({', '.join(pts + pts[:1])}))"

    compare(spark, jts, [(ring(0), ring(5)), (ring(0), ring(0)), (ring(0), ring(30))])


def test_fixed_shape_and_column_agree(spark):
    df = decoded(spark.createDataFrame([(a, FIXED[25]) for a in FIXED], "a string, b string"))
    shape = _filter_shape(df.first().h)
    rows = df.select(relation_to(F.col("g"), (shape.kind, shape.parts)).alias("x"), relation(F.col("g"), F.col("h")).alias("y")).collect()
    assert all(r.x == r.y for r in rows)
