"""Layers and feature queries: precedence, paging, ceilings, plans."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from geoloom import FeatureQuery, Layer, daily_tracks, feature_page, ingest_geometry, points_in_polygons, time_extent, write_clustered
from geoloom.operators.filters import distance_filter, id_filter, time_filter
from geoloom.operators.paging import TooManyRows, page, page_size, sort_columns
from geoloom.operators.projection import project, selected_fields
from workload.geometry import stored_count
from workload.tables import boxes, position_layer, positions


@pytest.fixture(scope="module")
def layer(spark, sf_dir):
    return position_layer(spark, sf_dir)


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The point layer as ingested files: box columns on disk, clustered by day and place."""
    path = str(tmp_path_factory.mktemp("layer") / "points")
    dated = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    write_clustered(dated, path, "event_date", "oid")
    return Layer.path(spark, path, "geom", id_field="oid", time_field="ts", date_field="event_date", geometry_type="Point")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layer_checks(spark, layer):
    with pytest.raises(ValueError, match="no column"):
        Layer(layer.df, "missing")
    with pytest.raises(ValueError, match="Invalid identifier"):
        Layer(layer.df, "oid; drop")
    with pytest.raises(ValueError, match="no column"):
        Layer(layer.df, "oid", time_field="when")


def test_catalog_table_layer(spark, sf_dir):
    text = positions(spark, sf_dir).withColumn("shape", F.concat(F.lit("POINT("), "lon", F.lit(" "), "lat", F.lit(")")))
    text.createOrReplaceTempView("stored_points")
    got = Layer.table(spark, "stored_points", "shape", id_field="oid").query(geometry="-60,-30,60,30", return_count_only=True).first()[0]
    assert got == text.filter("lon BETWEEN -60 AND 60 AND lat BETWEEN -30 AND 30").count()


def test_text_is_not_decoded_when_no_geometry_is_needed(spark, sf_dir):
    text = positions(spark, sf_dir).withColumn("shape", F.concat(F.lit("POINT("), "lon", F.lit(" "), "lat", F.lit(")")))
    layer = Layer.frame(text, "shape", id_field="oid")
    for q in (dict(return_count_only=True, where="speed > 1"), dict(return_ids_only=True), dict(out_fields="*", return_geometry=False),
              dict(return_distinct_values=True, out_fields="event_type", return_geometry=False)):
        assert "Generate" not in plan_of(layer.query(**q)), q
    assert "Generate" in plan_of(layer.query(out_fields="oid")) and "shape" not in layer.query(out_fields="*", return_geometry=False).columns
    assert layer.query(return_count_only=True, where="shape IS NOT NULL").first()[0] == 1000


def test_precedence(layer):
    everything = dict(return_count_only=True, return_ids_only=True, return_distinct_values=True, out_fields="event_type", return_geometry=False)
    assert layer.query(**everything).columns == ["count"]
    everything["return_count_only"] = False
    assert layer.query(**everything).columns == ["oid"]
    everything["return_ids_only"] = False
    assert layer.query(**everything).columns == ["event_type"]
    everything["return_distinct_values"] = False
    assert layer.query(**everything).columns == ["event_type", "oid"]
    assert layer.query(out_fields="*").columns[-1] == "geom"


def test_count_ignores_paging_and_distinct(layer):
    base = layer.query(return_count_only=True).first()[0]
    assert layer.query(return_count_only=True, result_offset=10, order_by_fields="ts", return_distinct_values=True).first()[0] == base


def test_field_lists(layer):
    assert selected_fields(layer.df, "ENTITY, geom ,*", "oid", "geom")[:2] == ["entity", "oid"]
    for bad in ("a b", "x;y", "nothing"):
        with pytest.raises(ValueError):
            project(layer.df, bad, "oid")


def test_page_sizes():
    assert [page_size(r, 2000) for r in (None, 0, -5, 10, 9999)] == [2000, 2000, 2000, 10, 2000]


def test_pages_cover_the_table_once(layer):
    seen, offset = [], 0
    while True:
        cut = feature_page(layer, FeatureQuery(order_by_fields="event_type DESC", result_offset=offset, result_record_count=300, out_fields="oid"))
        seen += [r.oid for r in cut.rows.collect()]
        offset += 300
        if not cut.exceeded.first()[0]:
            break
    assert len(seen) == len(set(seen)) == layer.df.count()


@pytest.mark.parametrize("offset,size", [(0, 7), (990, 20), (500, 100), (2000, 5)])
def test_far_pages_equal_near_ones(layer, offset, size):
    keys = sort_columns(layer.df, "event_type DESC, speed", "oid")
    near = [r.oid for r in page(layer.df, keys, size, offset).rows.collect()]
    far = [r.oid for r in page(layer.df.select("oid", "event_type", "speed"), keys, size, offset, top_rows=0).rows.collect()]
    assert near == far


def test_bad_offset_reads_as_zero(layer):
    assert layer.query({"resultOffset": "abc", "resultRecordCount": "3", "outFields": "oid"}).count() == 3
    assert layer.query({"resultOffset": "-4", "resultRecordCount": "3", "outFields": "oid"}).count() == 3


def test_ceilings(layer):
    small = Layer(layer.df, "oid", max_ids=10, max_distinct=3)
    with pytest.raises(TooManyRows):
        small.query(return_ids_only=True)
    with pytest.raises(TooManyRows):
        small.query(return_distinct_values=True, out_fields="event_type", return_geometry=False)
    assert small.query(return_ids_only=True, where="oid <= 10").count() == 10
    assert Layer(layer.df, "oid", max_ids=0).query(return_ids_only=True).count() == layer.df.count()


def test_empty_answers_keep_their_schema(layer):
    none = layer.query(object_ids="abc", out_fields="oid,speed")
    assert none.columns == ["oid", "speed", "geom"] and none.count() == 0


def test_unknown_sort_field_is_an_error(layer):
    with pytest.raises(ValueError, match="Unknown sort field"):
        layer.query(order_by_fields="nothing")


def test_id_lists(spark, layer):
    many = list(range(1, 3001))
    assert id_filter(layer.df, "oid", many).count() == 1000
    assert id_filter(layer.df, "oid", spark.createDataFrame([(5,), (5,), (None,), (6,)], "x int")).count() == 2
    assert id_filter(layer.df, "oid", []).count() == 0


def test_time_forms(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:00Z', date'2024-01-01', '2024-01-01T00:00:00.000Z', 1),"
                   "(timestamp_ntz'2024-01-02 10:00:00', timestamp'2024-01-02 10:00:00Z', date'2024-01-02', '2024-01-02T10:00:00.000Z', 2) AS t(n, z, d, s, i)")
    first, second = 1704067200000, 1704189600000
    for column in ("n", "z", "s"):
        def ids(time):
            return sorted(r.i for r in time_filter(df, column, time).collect())
        assert ids(str(first)) == [1] and ids(f"{first},{second}") == [1, 2] and ids(f"null,{first}") == [1] and ids(f"{second},null") == [2]
        assert ids("null,null") == [1, 2] and ids(f"{first + 1},{second - 1}") == [] and ids("null") == [1, 2]
    assert sorted(r.i for r in time_filter(df, "d", f"{second},{second}").collect()) == [2]
    for bad in ("1,2,3", "abc", "1,x", "9e15"):
        with pytest.raises(ValueError, match="Invalid time"):
            time_filter(df, "n", bad)
    assert time_filter(df, None, "1,2").count() == 2
    assert time_filter(df, "n", "-8640000000000000,8640000000000000").count() == 2


def test_time_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 00:30:00.1239' AS t, timestamp'2024-07-01 00:30:00.1239Z' AS z, date'2024-07-01' AS d, 5L AS i, 1e0 AS x, 2e0 AS y")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for column in ("t", "z"):
            assert time_filter(df, column, "1719793800123,1719793800124").count() == 1
            assert tuple(time_extent(df, column).first()) == (1719793800123, 1719793800123)
            assert str(daily_tracks(df, "i", column, "x", "y").first().track_date) == "2024-07-01"
        assert time_extent(df, "d").first().t0 == 1719792000000
        early = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.9995' AS t")
        assert time_extent(early, "t").first().t0 == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_filters_reach_the_scan(stored):
    df = stored.query(time="1704844800000,1705708800000", geometry="-60,-30,60,30", where="event_type = 'view'", out_fields="oid", return_geometry=False)
    plan = plan_of(df)
    pushed = plan[plan.index("PushedFilters"):]
    for name in ("GreaterThanOrEqual(ts", "LessThanOrEqual(ts", "LessThanOrEqual(_xmin,60.0)", "GreaterThanOrEqual(_xmax,-60.0)", "EqualTo(event_type,view)"):
        assert name in pushed, name
    partition = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "event_date" in partition and "ArrowEvalPython" not in plan
    assert "geom" not in plan[plan.index("ReadSchema"):]


def test_geometry_is_pruned_when_not_asked_for(stored):
    assert "geom" not in plan_of(stored.query(out_fields="oid", return_geometry=False))
    assert "geom" in plan_of(stored.query(out_fields="oid"))


def test_tile_pages_do_not_sort(stored):
    tile = plan_of(stored.query(result_type="tile", order_by_fields="oid", geometry="-60,-30,60,30"))
    assert "Sort" not in tile and "TakeOrdered" not in tile and "CollectLimit" in tile
    paged = plan_of(stored.query(order_by_fields="speed", result_record_count=10, result_offset=20))
    assert "TakeOrderedAndProject" in paged and "Exchange" not in paged


def test_sorted_pages_keep_only_their_best_rows(stored):
    """Also when costly columns follow, the page is cut by a top-n and not by a sort of all rows."""
    from geoloom.functions.geometry import as_geojson, as_wkt
    rows = stored.query(order_by_fields="speed", result_record_count=10)
    plan = plan_of(rows.select("oid", as_geojson(F.col("geom")).alias("g"), as_wkt(F.col("geom")).alias("w")))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_far_pages_carry_only_what_they_show(stored, monkeypatch):
    import geoloom.plans.feature_query as fq
    import geoloom.operators.paging as paging
    expected = [r.oid for r in stored.query(order_by_fields="speed DESC", result_offset=500, result_record_count=20, out_fields="oid", return_geometry=False).collect()]
    monkeypatch.setattr(fq, "TOP_ROWS", 0)
    monkeypatch.setattr(paging.page, "__defaults__", (0, 0))
    far = stored.query(order_by_fields="speed DESC", result_offset=500, result_record_count=20, out_fields="oid", return_geometry=False)
    assert [r.oid for r in far.collect()] == expected and "geom" not in plan_of(far)


def test_only_undecided_shapes_leave_the_jvm(spark, sf_dir):
    from geoloom.operators.filters import spatial_filter
    plan = plan_of(spatial_filter(boxes(spark, sf_dir), "-60,-30,60,30").select("oid"))
    assert plan.count("ArrowEvalPython") == 1 and "CASE WHEN" in plan[plan.index("ArrowEvalPython"):]


def test_shapes_across_the_dateline_are_unwrapped_on_output_only(spark):
    df = spark.createDataFrame([(1, "LINESTRING(179 0, -179 0)")], "id int, shape string")
    lines = Layer.frame(df, "shape")
    row = lines.query(geometry="-180,-1,-170,1").first()
    assert [v.x for v in row["shape"].parts[0][0]] == [179.0, 181.0]


def test_unsupported_relation_and_unreadable_filter(layer):
    with pytest.raises(ValueError, match="Unsupported spatial relation"):
        layer.query(geometry="0,0,1,1", spatial_rel="esriSpatialRelRelation")
    with pytest.raises(ValueError, match="cannot be read"):
        layer.query(geometry="somewhere")


@pytest.mark.parametrize("corners", [3, 40, 300])
def test_point_tests_match_the_library(spark, jts, layer, corners):
    """Unrolled edges and the array form, for points within and meeting a star."""
    import math
    ring = []
    for k in range(corners):
        r, a = (100 if k % 2 else 60), 2 * math.pi * k / corners
        ring.append([round(r * math.cos(a), 3), round(0.6 * r * math.sin(a), 3)])
    ring.append(ring[0])
    polygon = jts("POLYGON((" + ", ".join(f"{x} {y}" for x, y in ring) + "))")
    rows = layer.df.select("oid", "lon", "lat").collect()
    within = {r.oid for r in rows if polygon.contains(jts(f"POINT({r.lon!r} {r.lat!r})"))}
    got = {r.oid for r in layer.query(geometry={"rings": [ring]}, spatial_rel="esriSpatialRelWithin", out_fields="oid").collect()}
    assert got == within


def test_lines_and_points_as_filters(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 2.0), (4, 1.0, 0.0)], "id int, x double, y double")
    dots = Layer.points(df, "x", "y")
    def ids(shape, rel):
        return sorted(r.id for r in dots.query(geometry=shape, spatial_rel=rel, out_fields="id").collect())
    line = {"paths": [[[0, 0], [2, 2]]]}
    assert ids(line, "esriSpatialRelIntersects") == [1, 2, 3] and ids(line, "esriSpatialRelWithin") == [2] and ids(line, "esriSpatialRelTouches") == [1, 3]
    assert ids("1,1", "esriSpatialRelContains") == [2] and ids("1,1", "esriSpatialRelIntersects") == [2] and ids("1,1", "esriSpatialRelOverlaps") == []
    assert ids("0,0,1,1", "esriSpatialRelTouches") == [1, 2, 4] and ids("0,0,1,1", "esriSpatialRelCrosses") == []


def test_distance_is_open_and_sorted_by_the_caller(layer):
    rows = distance_filter(layer.df, 0, 0, 30, geometry_type="Point").orderBy("distance").collect()
    assert rows and all(r.distance < 30 for r in rows) and [r.distance for r in rows] == sorted(r.distance for r in rows)


def test_quarantine_holds_the_raw_value_under_the_same_name(spark):
    rows, bad = ingest_geometry(spark.createDataFrame([(1, "POINT(1 2)"), (2, "POINT(oops")], "id int, geom string"), "geom", "WKT")
    assert rows.count() == 2 and [(r.id, r.geom) for r in bad.collect()] == [(2, "POINT(oops")]


def test_native_geometry_keeps_its_srid(spark):
    spark.conf.set("spark.sql.geospatial.enabled", "true")
    native = spark.range(1).select(F.expr("st_setsrid(st_geomfromwkb(X'0101000000000000000000F03F0000000000000040'), 3857)").alias("shape"))
    rows, bad = ingest_geometry(native, "shape")
    assert [r.geom.srid for r in rows.select("geom").collect()] == [3857] and bad.count() == 0


def test_points_join_other_zones_and_other_rows_join_as_they_are(spark):
    def frame(*shapes):
        return ingest_geometry(spark.createDataFrame(list(enumerate(shapes)), "id int, wkt string"), "wkt", "WKT")[0].drop("wkt")

    zones = frame("POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))", "LINESTRING(0 0, 10 10)").withColumnRenamed("id", "zone")
    rows = frame("POLYGON((0 0, 10 0, 10 10, 0 10, 0 0))", "POINT(1 1)", "POINT(5 5)")
    pairs = lambda rel: sorted((r.id, r.zone) for r in points_in_polygons(rows, zones, rel).collect())
    assert pairs("intersects") == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 1)]
    assert (0, 0) not in pairs("within") and (1, 0) in pairs("within")


def test_an_answer_carries_its_flag(layer, monkeypatch):
    """A page tells that more rows follow; without a limit the answer is the whole table, from any offset."""
    n = layer.df.count()
    for request, more in (({}, True), ({"order_by_fields": "speed"}, True), ({"result_type": "tile"}, True), ({"result_offset": n - 5}, False)):
        small = replace(layer, max_record_count=10)
        rows = small.query(with_exceeded=True, out_fields="oid", return_geometry=False, **request).collect()
        assert len(rows) == (10 if more else 5) and {r.exceeded_transfer_limit for r in rows} == {more}
        paged = small.page(out_fields="oid", return_geometry=False, **request)
        assert paged.rows.count() == len(rows) and paged.exceeded.first()[0] is more
    whole = replace(layer, max_record_count=0)
    monkeypatch.setattr("geoloom.operators.paging.TOP_ROWS", 5)
    for offset, size, more in ((3, 40, True), (n - 5, 5, False), (n - 5, 4, True), (n + 5, 3, False)):
        rows = whole.query(with_exceeded=True, out_fields="oid", return_geometry=False, order_by_fields="oid", result_offset=offset, result_record_count=size).collect()
        assert [r.oid for r in rows] == list(range(offset + 1, min(offset + size, n) + 1)) and {r.exceeded_transfer_limit for r in rows} <= {more}
    monkeypatch.undo()
    assert whole.query(out_fields="oid").count() == n and not whole.page(out_fields="oid").exceeded.first()[0]
    assert [r.oid for r in whole.query(out_fields="oid", result_offset=n - 3, with_exceeded=True).collect()] == [n - 2, n - 1, n]


def test_stored_layers_push_their_filters_down(spark, sf_dir):
    plan = plan_of(stored_count(spark, sf_dir))
    for name in ("LessThanOrEqual(_xmin,60.0)", "GreaterThanOrEqual(_xmax,-60.0)", "LessThanOrEqual(ts"):
        assert name in plan[plan.index("PushedFilters"):]
    assert "event_date" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]


def test_far_pages_carry_keys_and_locator_only(spark, stored, monkeypatch, tmp_path):
    """The rows that are ordered and fixed are thin, and the page is read back from its files."""
    from geoloom.operators import paging

    carried, fix = [], paging.with_position
    monkeypatch.setattr(paging, "with_position", lambda df, *rest: carried.append(df.columns) or fix(df, *rest))
    keys = paging.sort_columns(stored.df, "speed DESC", "oid")
    far = paging.page(stored.df, keys, 40, 900, top_rows=10, names=["oid", "speed"]).rows
    want = [r.oid for r in sorted(stored.df.select("oid", "speed").collect(), key=lambda r: (-r.speed, r.oid))][900:940]
    assert [r.oid for r in far.collect()] == want and far.columns == stored.df.columns
    assert carried == [["oid", "speed", "_file", "_row"]]
    made = spark.range(100).withColumn("speed", F.col("id") * 2)
    assert [r.id for r in paging.page(made, [F.col("id").desc()], 3, 50, top_rows=1, names=["id"]).rows.collect()] == [49, 48, 47] and carried[-1] == ["id", "speed"]
