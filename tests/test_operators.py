"""Joins, ranking, summaries, catalog and clustered files against brute force."""

import math
import os
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geoloom import (
    Layer, assign_ids, cell_bins, cut_tracks, daily_tracks, discover_columns, export_features, id_audit, ingest_geometry, latest_per_entity, layer_extent, minimum_scale,
    points_in_polygons, refresh_catalog, spatial_join, stored_profile, table_profile, time_extent, with_point, write_clustered, write_clustered_table, write_profile,
)
from geoloom.functions.decode import parse_wkt
from geoloom.functions.geometry import with_bounds
from geoloom.operators.catalog import field_type, world_extent, zoom_scale
from geoloom.operators.quadtree import LEAF, Quadtree
from geoloom.operators.ranking import with_position
from geoloom.operators.sketches import distinct_error, merged_profile, profile_sketches
from workload.tables import position_layer, positions


def shaped(spark, texts):
    return with_bounds(spark.createDataFrame(list(enumerate(texts)), "id int, t string").withColumn("geom", parse_wkt(F.col("t"))))


def random_polygons(rng, n):
    out = []
    for _ in range(n):
        size = 10 ** rng.uniform(-2, 2)
        x, y, k = rng.uniform(-100, 100), rng.uniform(-50, 50), rng.randint(3, 9)
        ring = [f"{x + size * math.cos(2 * math.pi * i / k)!r} {y + size * math.sin(2 * math.pi * i / k)!r}" for i in range(k)]
        out.append(f"POLYGON(({', '.join(ring + ring[:1])}))")
    return out


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_points_in_polygons_of_all_sizes(spark, jts, limit):
    rng = random.Random(11)
    polygons = random_polygons(rng, 60)
    points = [(i, rng.uniform(-110, 110), rng.uniform(-60, 60)) for i in range(400)] + [(1000 + i, 3.25, 4.5) for i in range(300)]
    left = with_point(spark.createDataFrame(points, "pid int, x double, y double"), "x", "y")
    got = Counter((r.pid, r.id) for r in points_in_polygons(left, shaped(spark, polygons), broadcast_bytes=limit).select("pid", "id").collect())
    shapes = [jts(p) for p in polygons]
    want = Counter((pid, i) for pid, x, y in points for i, s in enumerate(shapes) if s.contains(jts(f"POINT({x!r} {y!r})")))
    assert got == want and max(got.values()) == 1


def test_join_on_the_boundary(spark):
    left = with_point(spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 1.0), (4, 5.0, 5.0)], "pid int, x double, y double"), "x", "y")
    zone = shaped(spark, ["POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))"])
    found = {rel: sorted(r.pid for r in points_in_polygons(left, zone, rel).collect()) for rel in ("within", "touches", "intersects")}
    assert found == {"within": [2], "touches": [1, 3], "intersects": [1, 2, 3]}
    with pytest.raises(ValueError):
        points_in_polygons(left, zone, "crosses")


def test_join_without_zones(spark):
    left = with_point(spark.createDataFrame([(1, 0.0, 0.0)], "pid int, x double, y double"), "x", "y")
    assert points_in_polygons(left, shaped(spark, ["LINESTRING(0 0, 1 1)"])).count() == 0


@pytest.mark.parametrize("limit", [64 << 20, 0])
@pytest.mark.parametrize("relation", ["intersects", "contains", "touches"])
def test_join_of_shapes(spark, jts, relation, limit):
    rng = random.Random(12)
    a = random_polygons(rng, 40) + [f"POINT({rng.uniform(-100, 100)} {rng.uniform(-50, 50)})" for _ in range(20)] + ["POLYGON((0 0, 8 0, 8 8, 0 8, 0 0))"]
    b = random_polygons(rng, 40) + ["LINESTRING(-100 -50, 100 50)", "POLYGON((8 0, 16 0, 16 8, 8 8, 8 0))", "POINT(1 1)"]
    right = shaped(spark, b)
    got = Counter((r.id, r.right_id) for r in spatial_join(shaped(spark, a), right, relation, broadcast_bytes=limit).select("id", "right_id").collect())
    left_shapes, right_shapes = [jts(t) for t in a], [jts(t) for t in b]
    want = Counter((i, j) for i, p in enumerate(left_shapes) for j, q in enumerate(right_shapes) if getattr(p, relation)(q))
    assert got == want


def test_full_squares_are_split(spark):
    """A third of the points in one place: the shuffled join salts that square."""
    points = spark.range(9000).select(F.col("id").alias("pid"), F.when(F.col("id") % 3 == 0, 1.5).otherwise(F.col("id") % 170).cast("double").alias("x"),
                                      F.lit(1.5).alias("y"))
    zone = shaped(spark, ["POLYGON((1 1, 2 1, 2 2, 1 2, 1 1))"])
    pairs = points_in_polygons(with_point(points, "x", "y"), zone, broadcast_bytes=0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and pairs.count() == 3000


def test_positions_number_every_row(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id"))
    rows = with_position(df, [F.col("k"), F.col("id")]).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((i % 3, i) for i in range(5000))


def test_ids_without_a_single_task_window(spark):
    out = assign_ids(spark.range(1000).select((1000 - F.col("id")).alias("v")), ["v"], start=7)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1 and "Aggregate [_slice" in plan
    assert sorted((r.objectid, r.v) for r in out.collect()) == [(i + 7, i + 1) for i in range(1000)]
    assert assign_ids(spark.range(0), ["id"]).count() == 0


def test_latest(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 9, "c"), (2, None, "d"), (3, 1, "e")], "e int, t int, tie string")
    assert sorted(map(tuple, latest_per_entity(df, "e", "t", "tie").collect())) == [(1, 9, "c"), (3, 1, "e")]
    plan = latest_per_entity(df, "e", "t", "tie")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_tracks_keep_every_position(spark):
    """Cut lines together run through the same stops as the whole one."""
    rows = [(1, i, float(i % 7), float(i % 5)) for i in range(103)] + [(2, i, 1.0, 2.0) for i in range(3)] + [(3, 0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "e int, i int, x double, y double").withColumn("ts", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, i, 0)"))
    whole = {r.entity: r for r in daily_tracks(df, "e", "ts", "x", "y", tie="i").collect()}
    cut = cut_tracks(df, "e", "ts", "x", "y", 10, tie="i").orderBy("entity", "part").collect()
    sliced = daily_tracks(df, "e", "ts", "x", "y", tie="i", slice_minutes=10).orderBy("entity", "part").collect()
    for rows in (cut, sliced):
        joined = {}
        for r in rows:
            path = [(v.x, v.y) for v in r.geom.parts[0][0]]
            before = joined.setdefault(r.entity, [])
            if before:
                assert before[-1] == path[0]
                path = path[1:]
            before += path
        assert joined == {e: [(v.x, v.y) for v in r.geom.parts[0][0]] for e, r in whole.items()}
        assert [r.part for r in rows if r.entity == 1] == list(range(11))
    assert all((r.position_count, r.start_time, r.end_time) == (whole[r.entity].position_count, whole[r.entity].start_time, whole[r.entity].end_time) for r in cut)
    assert [r.position_count for r in sliced if r.entity == 1] == [10] * 10 + [3]
    with pytest.raises(ValueError, match="divide the day"):
        daily_tracks(df, "e", "ts", "x", "y", slice_minutes=7)
    assert whole[3].geom.type == "Point" and whole[1].geom.type == "LineString"


def test_bins_need_no_whole_cell_in_one_task(spark, sf_dir):
    plan = cell_bins(positions(spark, sf_dir), "lon", "lat", 0, "entity", "speed", "event_type", "ts")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cell#" in plan and plan.count("partial_count(1)") == 1 and ", entity#" in plan[plan.index("Exchange"):]


def test_empty_summaries(spark, sf_dir):
    none = position_layer(spark, sf_dir).df.limit(0)
    assert tuple(layer_extent(none).first()) == (None,) * 5
    assert tuple(time_extent(none, "ts").first()) == (None, None)
    nulls = spark.sql("SELECT CAST(NULL AS timestamp) AS t")
    assert tuple(time_extent(nulls, "t").first()) == (None, None)
    audit = id_audit(none, "oid").first()
    assert (audit.id_class, audit.null_ids, audit.duplicate_ids) == (None, 0, 0)


@pytest.mark.parametrize("ids,kind", [([1, 2], "ok"), ([0, 5], "low"), ([-3, 4], "low"), ([1, None], "low"), ([1, 2147483648], "over32"),
                                      ([0, 2147483648], "low"), ([1, 9007199254740992], "over53"), ([-9007199254740992, 0], "over53")])
def test_id_classes(spark, ids, kind):
    assert id_audit(spark.createDataFrame([(i,) for i in ids], "id long"), "id").first().id_class == kind


def test_catalog_is_stored(spark, sf_dir, tmp_path):
    path = str(tmp_path / "catalog")
    layers = {"points": position_layer(spark, sf_dir), "broken": lambda: Layer.table(spark, "nowhere")}
    rows = {r.name: r for r in refresh_catalog(spark, layers, path).collect()}
    assert rows["positions"].row_count == 1000 and rows["positions"].extent_known and rows["broken"].xmin == -180.0
    assert spark.read.parquet(path).count() == 2
    empty = Layer(position_layer(spark, sf_dir).df.limit(0), "oid", name="empty")
    only = refresh_catalog(spark, {"empty": empty}).first()
    assert (only.row_count, only.xmin, only.extent_known, only.geometry_type) == (0, None, True, "Point")


def test_world_and_field_types(spark):
    assert world_extent(4326) == (-180.0, -90.0, 180.0, 90.0) and world_extent(102100)[2] == 20037508.342789244 and world_extent(2263) is None
    schema = spark.sql("SELECT 1 AS i, 1L AS l, true AS b, 1.5 AS d, 1e0 AS f, current_date() AS day, current_timestamp() AS t, 'x' AS s, array(1) AS a").schema
    assert [field_type(f.dataType)[13:] for f in schema] == ["Integer", "Integer", "Integer", "Double", "Double", "Date", "Date", "String", "String"]


def test_scales(spark):
    zooms = spark.createDataFrame([(0,), (8,), (10,), (11,), (12,)], "z int").select(zoom_scale(F.col("z")).alias("s")).collect()
    assert [r.s for r in zooms] == [591657528, 2311162, 577791, 288895, 144448]
    df = spark.createDataFrame([(9_999_999,), (10_000_000,), (1_000_000_000,), (1_000_000_001,)], "row_count long")
    assert [(r.zoom_from, r.zoom_to) for r in minimum_scale(df).collect()] == [(None, None), (8, 8), (8, 8), (11, 12)]
    assert [(r.zoom_from, r.zoom_to) for r in minimum_scale(df, windowed=True).collect()][-1] == (8, 10)


def test_discovery_prefers_names_then_checks_data(spark):
    df = spark.sql("SELECT id AS n, id + 1 AS objectid, id % 3 + 1 AS kind_id, CAST(NULL AS timestamp) AS seen_time, current_date() AS day FROM range(50)")
    rows = discover_columns(df).collect()
    assert [(r.role, r.name) for r in rows] == [("id", "objectid"), ("id", "kind_id"), ("id", "n"), ("time", "seen_time"), ("time", "day")]
    assert [r.name for r in rows if r.chosen] == ["objectid", "day"]
    repeated = discover_columns(df.select(F.lit(7).alias("objectid"), (F.col("n") + 1).alias("n"))).collect()
    assert [(r.name, r.is_unique, r.chosen) for r in repeated] == [("objectid", False, False), ("n", True, True)]


def test_discovery_counts_exactly_what_a_sketch_cannot_tell(spark):
    """One repeat in three thousand rows is seen by the exact count, wide values that repeat ten times by the sketch."""
    df = spark.range(3000).select((F.col("id") % 2999 + 1).alias("objectid"), (F.col("id") % 300 * 1_000_003 + 1).alias("spread_id"), (F.col("id") * 7 + 1).alias("n"))
    rows = {r.name: r for r in discover_columns(df).collect()}
    assert {k: (r.is_unique, r.chosen) for k, r in rows.items()} == {"objectid": (False, False), "spread_id": (False, False), "n": (True, True)}


PROFILED = "day date, entity bigint, ts timestamp, lon double, lat double"


def test_merged_profile_is_the_profile_of_all_days(spark, tmp_path):
    df = spark.range(30_000).select(
        F.expr("date_add(DATE'2024-05-01', CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 9 END AS INT))").alias("day"), (F.col("id") * 31 % 7000).alias("entity"),
        F.timestamp_millis(F.col("id") * 977 + 1_714_521_600_000).alias("ts"), (F.col("id") * 7919 % 30011 / 100.0 - 150).alias("lon"),
        F.when(F.col("id") % 10 > 0, F.col("id") * 104729 % 16001 / 100.0 - 80).alias("lat"))
    path, names = str(tmp_path / "profile"), ("day", "entity", "ts", "lon", "lat")
    write_profile(df.withColumn("entity", F.lit(1).cast("long")), path, *names)
    untouched = {f for f in os.listdir(path) if f.startswith("day=")}
    for day in sorted(untouched):
        write_profile(df.filter(F.col("day") == F.lit(day.removeprefix("day=")).cast("date")), path, *names)
    assert {f for f in os.listdir(path) if f.startswith("day=")} == untouched
    quantiles = (0.0, 0.1, 0.5, 0.9, 1.0)
    got, want = stored_profile(spark, path, quantiles).first(), table_profile(df, "entity", "ts", "lon", "lat").first()
    assert [got[c] for c in want.asDict() if c != "unique_entities"] == [want[c] for c in want.asDict() if c != "unique_entities"]
    assert abs(got.unique_entities - want.unique_entities) <= distinct_error() * want.unique_entities
    for axis in ("lon", "lat"):
        values = sorted(r[0] for r in df.select(axis).filter(f"{axis} IS NOT NULL").collect())
        for q, value in zip(quantiles, got[f"{axis}_quantiles"]):
            below, to = sum(v < value for v in values) / len(values), sum(v <= value for v in values) / len(values)
            assert below - 0.01 <= q <= to + 0.01


def test_profile_of_nothing_and_of_nulls(spark):
    none = merged_profile(profile_sketches(spark.createDataFrame([], PROFILED), "day", "entity", "ts", "lon", "lat")).first()
    assert (none.total_rows, none.unique_entities, none.earliest_ms, none.min_lat, none.lat_quantiles) == (0, 0, None, None, None)
    rows = [(None, None, None, None, None), (None, 5, None, 1.0, float("nan")), (None, 5, None, -0.0, None)]
    one = merged_profile(profile_sketches(spark.createDataFrame(rows, PROFILED), "day", "entity", "ts", "lon", "lat")).first()
    assert (one.total_rows, one.unique_entities, one.min_lon, one.max_lon, one.lat_quantiles) == (3, 1, 0.0, 1.0, None)


def test_clustered_files_skip(spark, sf_dir, tmp_path):
    """A small box on one day touches few files; the rows are the same."""
    path = str(tmp_path / "clustered")
    df = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    wide = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).withColumn("event_date", F.lit("2024-01-01").cast("date"))
    write_clustered(wide, path, "event_date", "oid", partitions=16)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    hit = 0
    for f in files:
        meta = pq.ParquetFile(f)
        group = meta.metadata.row_group(0)
        box = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        hit += box["_xmin"].min <= -100 and box["_xmax"].max >= -110 and box["_ymin"].min <= -40 and box["_ymax"].max >= -50
    assert len(files) >= 14 and hit <= len(files) // 3
    back = spark.read.parquet(path)
    assert back.count() == wide.count() and back.select("oid", "n").distinct().count() == wide.count()


def test_clustered_table_has_statistics(spark, sf_dir):
    spark.sql("DROP TABLE IF EXISTS clustered_points")
    write_clustered_table(position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts")), "clustered_points", "event_date", "oid")
    details = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED clustered_points").collect()}
    assert "1000 rows" in details["Statistics"]
    spark.sql("DROP TABLE clustered_points")


def test_export_of_bad_geometry(spark, tmp_path):
    df = spark.createDataFrame([("7", "POINT(1 2)", None), ("8", "POINT(1", "b")], "id string, t string, name string").withColumn("geom", parse_wkt(F.col("t")))
    path = str(tmp_path / "out")
    export_features(df.drop("t"), path, id_field="id")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ['{"type":"Feature","properties":{"id":7,"name":null},"geometry":{"type":"Point","coordinates":[1.0,2.0]}}',
                     '{"type":"Feature","properties":{"id":8,"name":"b"},"geometry":null}']
    with pytest.raises(ValueError):
        export_features(df, path, "kml")


def test_quadtree_joins_dense_places_on_either_side(spark):
    """Many points in one place, many zones in another, few of both elsewhere: every pair once, whatever the size of a square."""
    rng = random.Random(4)
    points = [(i, 5.0, 5.0) if i % 3 == 0 else (i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(600)] + [(900, None, None), (901, 1e9, 1e9)]
    zones = [(k, -20.0 - k % 2, 30.0, 4.0) if k < 150 else (k, rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([0.5, 3.0, 60.0])) for k in range(200)]
    text = [f"POLYGON(({cx - h} {cy - h}, {cx + h} {cy - h}, {cx + h} {cy + h}, {cx - h} {cy + h}, {cx - h} {cy - h}))" for _, cx, cy, h in zones]
    areas = ingest_geometry(spark.createDataFrame([(z[0], t) for z, t in zip(zones, text)], "id int, wkt string"), "wkt")[0].withColumn("fine", F.lit("x"))
    left = with_point(spark.createDataFrame(points, "id int, x double, y double"), "x", "y")
    want = sorted((p, k) for p, x, y in points if x is not None for k, cx, cy, h in zones if abs(x - cx) < h and abs(y - cy) < h)
    for rows in (7, 1000):
        got = points_in_polygons(left, areas, broadcast_bytes=0, square_rows=rows)
        assert sorted((r.id, r.right_id) for r in got.select("id", "right_id").collect()) == want
    assert "fine" in got.columns and len(want) > 5000


def test_quadtree_leaves_hold_few_rows_where_places_differ(spark):
    points = spark.range(20_000).select(F.rand(1).alias("x"), F.rand(2).alias("y"))
    boxes = spark.range(10).select((F.col("id") / 10).alias("a"), (F.col("id") / 10).alias("b"), (F.col("id") / 10 + 0.1).alias("c"), (F.col("id") / 10 + 0.1).alias("d"))
    tree = Quadtree((0.0, 0.0, 1.0, 1.0), points, (F.col("x"), F.col("y")), boxes, [F.col(c) for c in "abcd"], square_rows=500)
    sizes = [r["count"] for r in tree.of_points(points, F.col("x"), F.col("y")).groupBy(*LEAF).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 500 and len(sizes) < 300
    scan = tree.of_boxes(boxes, [F.col(c) for c in "abcd"])
    assert scan.groupBy("a").count().agg(F.min("count")).first()[0] >= 1 and scan.select(*LEAF, "a").distinct().count() == scan.count()
