"""Stored layers: which files an edit reads and writes, statistics from footers, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from geoloom import Layer, StoredLayer, apply_edits, compact, edit_stored, requests_from, with_time_ms
from geoloom.operators.stored_edits import hit_files
from geoloom.sources.stored import day_files, write_stored


@pytest.fixture
def boats(spark):
    """400 boats on four piers, ten days."""
    df = spark.range(400).select(
        F.col("id"), F.concat(F.lit("boat "), F.col("id").cast("string")).alias("name"), (F.col("id") % 7).cast("double").alias("draught"),
        F.element_at(F.array(*map(F.lit, ["east", "far west", "a=b", "50%"])), (F.floor(F.col("id") / 100) + 1).cast("int")).alias("pier"),
        F.expr("timestamp_ntz'2024-03-01 10:00:00' + make_interval(0, 0, 0, cast(id % 10 as int))").alias("seen"),
        (F.col("id") % 20 - 10.0).alias("x"), (F.floor(F.col("id") / 20) * 2.0).alias("y"))
    return with_time_ms(Layer.points(df, "x", "y").df.drop("x", "y"), "seen")


@pytest.fixture
def stored(spark, boats, tmp_path):
    write_stored(boats, str(tmp_path / "boats"), "pier", "id", partitions=8)
    return StoredLayer.open(spark, str(tmp_path / "boats"), "pier", time_field="seen", name="boats")


def facts(df):
    return sorted((r.id, r.name, r.draught, r.pier, str(r.seen), r._xmin, r._time_ms) for r in df.collect())


def test_files_hold_the_rows(stored, boats):
    assert facts(stored.rows()) == facts(boats) and len(stored.files) >= 4
    assert stored.only(stored.files[:2]).rows().count() < 400 and stored.only([]).rows().count() == 0


def test_updates_read_and_write_only_hit_files(spark, stored, boats, tmp_path):
    updates = requests_from(spark, [{"attributes": {"ID": 103, "name": "Ada"}}, {"attributes": {"id": 104, "draught": None, "seen": 0}}, {"attributes": {"id": 9999, "name": "x"}}])
    files_before = {f: os.stat(f.removeprefix("file:").replace("///", "/")).st_mtime_ns for f in stored.files}
    edit = edit_stored(stored, str(tmp_path / "next"), updates=updates)
    kept = set(edit.stored.files) & set(stored.files)
    assert edit.replaced and set(edit.replaced) | kept == set(stored.files) and not set(edit.replaced) & kept
    assert all("far west" in f for f in edit.replaced) and all("/next/" in f for f in edit.written)
    assert {f: os.stat(f.removeprefix("file:").replace("///", "/")).st_mtime_ns for f in stored.files} == files_before
    expected = apply_edits(Layer(boats, "id", time_field="seen"), updates=updates)
    want = [(i, n, d, p, s, x, 0 if i == 104 else ms) for i, n, d, p, s, x, ms in facts(expected.rows)]
    assert facts(edit.stored.rows()) == want
    assert sorted((r.pos, r.success, r.code) for r in edit.results.collect()) == [(0, True, None), (1, True, None), (2, False, 1019)]
    # The search for hits reads the id column alone, and only row groups in range.
    plan = hit_files(stored, spark.createDataFrame([(103,), (104,)], "_key long"))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "ReadSchema: struct<id:bigint>" in scan and "GreaterThanOrEqual(id,103)" in scan


def test_deletes_adds_and_rollback(spark, stored, boats, tmp_path):
    deletes = spark.createDataFrame([(0, "1"), (1, "399"), (2, "x")], "pos long, id string")
    gone = edit_stored(stored, str(tmp_path / "a"), deletes=deletes)
    assert {r[0] for r in facts(gone.stored.rows())} == set(range(400)) - {1, 399} and {os.path.dirname(f) for f in gone.replaced} == {os.path.dirname(f) for f in stored.files if "east" in f or "50%" in f}
    added = edit_stored(gone.stored, str(tmp_path / "b"), adds=requests_from(spark, [{"attributes": {"name": "new", "pier": "far west", "seen": 1000}, "geometry": {"x": 200, "y": 3}}]))
    rows = {r[0]: r for r in facts(added.stored.rows())}
    assert not added.replaced and set(gone.stored.files) < set(added.stored.files) and rows[399][1:] == ("new", None, "far west", "1970-01-01 00:00:01", -160.0, 1000)
    undone = edit_stored(added.stored, str(tmp_path / "c"), deletes=deletes, rollback=True)
    assert undone.stored is added.stored and not os.path.exists(tmp_path / "c") and undone.results.filter("code = 1003").count() == 1
    nothing = edit_stored(added.stored, str(tmp_path / "d"), deletes=spark.createDataFrame([(0, "777")], "pos long, id string"))
    assert nothing.stored is added.stored and [r.code for r in nothing.results.collect()] == [1018] and not os.path.exists(tmp_path / "d")
    more = edit_stored(added.stored, str(tmp_path / "e"), updates=requests_from(spark, [{"attributes": {"id": 399, "name": "newer"}}]))
    assert len(more.replaced) == 1 and "/b/" in more.replaced[0] and {r[0]: r[1] for r in facts(more.stored.rows())}[399] == "newer"


def test_statistics_come_from_footers(spark, stored, boats):
    row = stored.statistics().first()
    assert row.asDict() == {"n": 400, "xmin": -10.0, "ymin": 0.0, "xmax": 9.0, "ymax": 38.0, "wkid": 4326, "min_id": 0, "max_id": 399, "t0": 1709287200000, "t1": 1710064800000}
    plan = stored.footer_statistics()._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation" in plan.replace("PushedAggregates", "PushedAggregation") and "MIN(_xmin)" in plan and "COUNT(*)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert stored.only([]).statistics().first().asDict() == {**dict.fromkeys(row.asDict()), "n": 0}


def test_statistics_of_empty_columns_and_other_orders(spark, boats, tmp_path):
    empty = boats.withColumns({c: F.lit(None).cast("double") for c in ("_xmin", "_ymin", "_xmax", "_ymax")})
    write_stored(empty, str(tmp_path / "empty"), "pier", "id", partitions=3)
    row = StoredLayer.open(spark, str(tmp_path / "empty"), "pier").statistics().first()
    assert (row.n, row.xmin, row.wkid, row.max_id) == (400, None, None, 399)
    boats.select("geom", *[c for c in boats.columns if c != "geom"]).write.partitionBy("pier").parquet(str(tmp_path / "other"))
    other = StoredLayer.open(spark, str(tmp_path / "other"), "pier")
    assert not other.has_statistics and other.statistics().first().ymax == 38.0


def test_compaction_leaves_other_days_alone(spark, boats, tmp_path):
    path = str(tmp_path / "parts")
    boats.filter("pier = 'east'").coalesce(1).write.partitionBy("pier").parquet(path)
    for part in range(4):
        boats.filter((F.col("pier") != "east") & (F.col("id") % 4 == part)).repartition(3, "id").write.mode("append").partitionBy("pier").parquet(path)
    nameless = boats.limit(5).withColumns({"pier": F.lit(None).cast("string"), "id": F.col("id") + 1000})
    for _ in range(4):
        nameless.repartition(2).write.mode("append").partitionBy("pier").parquet(path)
    before, want = {r.value: r.files for r in day_files(spark, path, "pier").collect()}, facts(spark.read.parquet(path))
    east = {f: os.stat(os.path.join(path, "pier=east", f)).st_mtime_ns for f in os.listdir(os.path.join(path, "pier=east"))}
    done = {r.value: (r.files, r.wanted) for r in compact(spark, path, "pier", "id").collect()}
    assert set(done) == {"far west", "a=b", "50%", None} and {v[1] for v in done.values()} == {1}
    after = {r.value: r.files for r in day_files(spark, path, "pier").collect()}
    assert facts(spark.read.parquet(path)) == want and sum(after.values()) * 3 < sum(before.values())
    assert {f: os.stat(os.path.join(path, "pier=east", f)).st_mtime_ns for f in os.listdir(os.path.join(path, "pier=east"))} == east

    small = compact(spark, path, "pier", "id", file_bytes=1 << 40)
    assert small.count() == 0
