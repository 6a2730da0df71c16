"""Edit batches: results, order, rollback, value handling."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoloom import Layer, apply_edits, deletes_from, requests_from
from geoloom.functions.times import MAX_EPOCH_MS, coerce_time


@pytest.fixture
def towers(spark):
    df = spark.sql("SELECT * FROM VALUES (1L, 'one', 1.5, timestamp_ntz'2024-01-01', 10.0D, 20.0D), (2L, 'two', 2.5, NULL, 11.0D, 21.0D),"
                   "(5L, 'five', NULL, NULL, 12.0D, 22.0D) AS t(id, name, height, seen, x, y)")
    base = Layer.points(df, "x", "y")
    return Layer(base.df.drop("x", "y"), "id", time_field="seen", name="towers")


def outcome(edit):
    return {(r.op, r.pos): (r.success, r.code, None if r.object_id is None else int(r.object_id)) for r in edit.results.collect()}


def state(edit):
    return {r.id: r for r in edit.rows.collect()}


def test_adds(spark, towers):
    adds = requests_from(spark, [
        {"attributes": {"ID": 99, "Name": "new", "height": "7.5", "seen": 1688169600000}, "geometry": {"x": 190, "y": 5}},
        {"attributes": {}}, {"attributes": {"nothing": 1}}, {"attributes": {"height": "tall"}}, {"geometry": {"x": 1, "y": 2}},
        {"properties": {"name": "late", "seen": "2023-07-01T12:00:00Z"}},
    ])
    edit = apply_edits(towers, adds=adds)
    assert outcome(edit) == {("add", 0): (True, None, 6), ("add", 1): (False, 1017, None), ("add", 2): (False, 1017, None),
                             ("add", 3): (False, 1017, None), ("add", 4): (True, None, 10), ("add", 5): (True, None, 11)}
    rows = state(edit)
    assert set(rows) == {1, 2, 5, 6, 10, 11}
    assert (rows[6].name, float(rows[6].height), str(rows[6].seen), rows[6].geom.parts[0][0][0].x, rows[6]._xmin, rows[6].geom.srid) == (
        "new", 7.5, "2023-07-01 00:00:00", -170.0, -170.0, 4326)
    assert rows[10].name is None and str(rows[11].seen) == "2023-07-01 12:00:00" and rows[11].geom is None


def test_new_ids_stop_at_the_safe_limit(spark, towers):
    full = towers.over(towers.df.withColumn("id", F.when(F.col("id") == 5, 9007199254740990).otherwise(F.col("id"))))
    edit = apply_edits(full, adds=requests_from(spark, [{"attributes": {"name": "a"}}, {"attributes": {"name": "b"}}]))
    assert outcome(edit) == {("add", 0): (True, None, 9007199254740991), ("add", 1): (False, 1017, None)}
    assert edit.rows.count() == 4


def test_updates(spark, towers):
    updates = requests_from(spark, [
        {"attributes": {"id": 1, "name": "first", "height": None}}, {"attributes": {"id": 1, "name": "last"}},
        {"attributes": {"id": "2", "seen": 0}, "geometry": {"x": -190, "y": 1}}, {"attributes": {"id": 3, "name": "x"}},
        {"attributes": {"id": 1.5, "name": "x"}}, {"attributes": {"name": "x"}}, {"attributes": {"id": 9007199254740993, "name": "x"}},
        {"attributes": {"id": 5}}, {"attributes": {"id": 5, "bogus": 1}}, {"attributes": {"id": 5, "height": "tall"}}, {"attributes": {"ID": 5.0, "NAME": "V"}, "geometry": None},
    ])
    edit = apply_edits(towers, updates=updates)
    got = outcome(edit)
    assert {k[1]: v[:2] for k, v in got.items()} == {0: (True, None), 1: (True, None), 2: (True, None), 3: (False, 1019), 4: (False, 1019), 5: (False, 1019),
                                                     6: (False, 1019), 7: (False, 1019), 8: (False, 1019), 9: (False, 1019), 10: (True, None)}
    assert got["update", 3][2] == 3 and got["update", 4][2] is None and got["update", 6][2] == 9007199254740993
    rows = state(edit)
    assert (rows[1].name, rows[1].height, str(rows[1].seen)) == ("last", None, "2024-01-01 00:00:00")
    assert (str(rows[2].seen), rows[2]._xmin, rows[2].name) == ("1970-01-01 00:00:00", 170.0, "two")
    assert (rows[5].name, rows[5]._xmin) == ("V", 12.0)
    texts = {r.pos: r.description for r in edit.results.collect()}
    assert texts[3] == "no row has id 3" and "whole number" in texts[4] and "2^53" in texts[6] and texts[7] == "nothing to write" and "bogus" in texts[8] and "height" in texts[9]


def test_deletes(spark, towers):
    edit = apply_edits(towers, deletes=deletes_from(spark, ["1", 1, " 5 ", "abc", "1.5", "9007199254740993", 42, "", None, "2.0"]))
    got = {p: (ok, code) for (_, p), (ok, code, _) in outcome(edit).items()}
    assert got == {0: (True, None), 1: (True, None), 2: (True, None), 3: (False, 1018), 4: (False, 1018), 5: (False, 1018), 6: (False, 1018), 7: (True, None)}
    assert edit.rows.count() == 0


def test_delete_parameter_forms(spark):
    """A list of ids and its texts, with any blanks in between, name the same rows in the same places."""
    rng = random.Random(8)
    for n in (0, 1, 4):
        ids = [str(rng.randrange(10 ** 6)) for _ in range(n)]
        texts = [",".join(ids), " , ".join([*ids, ""]), json.dumps(ids), json.dumps([int(i) for i in ids], indent=1), ",,".join(ids)]
        for raw in (ids, [None, *map(int, ids), "  "], *texts, *([None] if n == 0 else []), *(map(int, ids) if n == 1 else [])):
            assert [(r.pos, r.id) for r in deletes_from(spark, raw).orderBy("pos").collect()] == list(enumerate(ids))


def test_later_steps_see_earlier_ones(spark, towers):
    edit = apply_edits(
        towers, requests_from(spark, [{"attributes": {"name": "a"}}]), requests_from(spark, [{"attributes": {"id": 6, "name": "b"}}, {"attributes": {"id": 1, "name": "z"}}]),
        deletes_from(spark, "1,6"))
    assert all(ok for ok, *_ in outcome(edit).values()) and set(state(edit)) == {2, 5}


def test_rollback(spark, towers):
    adds, strangers = requests_from(spark, [{"attributes": {"name": "fresh"}, "geometry": {"x": 4, "y": 51}}]), requests_from(spark, [{"attributes": {"id": 77, "name": "nobody"}}])
    undone = apply_edits(towers, adds, strangers, rollback=True)
    assert {k: v[:2] for k, v in outcome(undone).items()} == {("add", 0): (False, 1003), ("update", 0): (False, 1019)}
    assert set(state(undone)) == {1, 2, 5}
    kept = apply_edits(towers, adds, strangers)
    assert {k: v[:2] for k, v in outcome(kept).items()} == {("add", 0): (True, None), ("update", 0): (False, 1019)} and len(state(kept)) == 4
    done = apply_edits(towers, adds, rollback=True)
    assert outcome(done)["add", 0] == (True, None, 6)


def test_no_edits_and_read_only(spark, towers):
    nothing = apply_edits(towers)
    assert nothing.results.count() == 0 and nothing.rows.count() == 3
    with pytest.raises(PermissionError):
        apply_edits(Layer(towers.df, "id", editable=False))


def test_hot_id_in_a_batch(spark, towers):
    """Thousands of updates of one id end in one row with the last values."""
    updates = spark.range(5000).select(F.col("id").alias("pos"), F.format_string('{"id":1,"name":"n%s"}', F.col("id").cast("string")).alias("attributes"),
                                       F.lit(None).cast("string").alias("geometry"))
    edit = apply_edits(towers, updates=updates)
    assert edit.results.filter("success").count() == 5000 and state(edit)[1].name == "n4999" and edit.rows.count() == 3


def test_time_values(spark):
    """Random instants as numbers and as ISO text come back as that instant, words and numbers out of range as nothing."""
    rng = random.Random(6)
    instants = [rng.randrange(-4 * 10 ** 12, 4 * 10 ** 12) for _ in range(40)]
    rows = []
    for i, ms in enumerate(instants):
        moment = datetime(1970, 1, 1) + timedelta(milliseconds=ms)
        rows.append((i, f"  {ms}" if i % 2 else moment.isoformat(timespec="milliseconds") + "Z", moment.strftime("%Y-%m-%d %H:%M:%S")))
    rows += [(99, text, None) for text in (None, "", "next week", "9e30", str(MAX_EPOCH_MS + 1), "2024-13-01")]
    df = spark.createDataFrame(rows, "i int, v string, want string")
    for kind in ("timestamp_ntz", "timestamp", "date"):
        data_type = spark.sql(f"SELECT CAST(NULL AS {kind}) AS c").schema["c"].dataType
        got = df.select("want", coerce_time(F.col("v"), data_type).cast("string").alias("v")).collect()
        assert [r.v and r.v[:19] for r in got] == [r.want and (r.want[:10] if kind == "date" else r.want) for r in got]


def test_rows_without_an_id_stay_and_join_nothing(spark, towers):
    """No edit can name them; neither they nor requests without a key take part in a join."""
    loose = towers.over(towers.df.withColumn("id", F.when(F.col("id") != 2, F.col("id"))))
    sent = requests_from(spark, [{"attributes": {"id": 1, "name": "new"}}, {"attributes": {"name": "nobody"}}])
    edit = apply_edits(loose, updates=sent, deletes=deletes_from(spark, "5,x"))
    assert sorted((r.id or 0, r.name) for r in edit.rows.collect()) == [(0, "two"), (1, "new")]
    assert {k: v[0] for k, v in outcome(edit).items()} == {("update", 0): True, ("update", 1): False, ("delete", 0): True, ("delete", 1): False}
