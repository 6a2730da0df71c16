"""Edit batches on orders: adds from customers, updates from events, deletes from parts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from geoloom import Layer, apply_edits
from geoloom.functions.times import coerce_time, epoch_ms
from workload.registry import case
from workload.tables import read

BASE = """
base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
                ((o_orderkey * 7919) % 36000) / 1e2 - 180e0 AS x, ((o_orderkey * 104729) % 17000) / 1e2 - 85e0 AS y FROM orders),
top AS (SELECT max(o_orderkey) AS k FROM orders)
"""


def order_layer(spark, sf_dir, **options) -> Layer:
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").withColumns({
        "lon": ((k * 7919) % 36000) / F.lit(100.0) - 180, "lat": ((k * 104729) % 17000) / F.lit(100.0) - 85})
    base = Layer.points(rows, "lon", "lat", id_field="o_orderkey", time_field="o_orderdate", name="orders")
    return Layer(base.df.drop("lon", "lat"), "o_orderkey", time_field="o_orderdate", name="orders", **options)


def adds(spark, sf_dir):
    """One add per customer; those of one segment are empty, those of another carry a date that is none."""
    c = read(spark, sf_dir, "customer")
    key, seg = F.col("c_custkey"), F.col("c_mktsegment")
    full = F.format_string('{"O_ORDERKEY":%s,"O_CustKey":%s,"o_orderstatus":"N","o_totalprice":%s,"o_orderdate":%s}', key.cast("string"),
                           key.cast("string"), F.col("c_acctbal").cast("string"), (key * 86400000 + 850000000000).cast("string"))
    text = F.when(seg == "BUILDING", "{}").when(seg == "MACHINERY", '{"o_orderdate":"no date"}').otherwise(full)
    shape = F.when(~seg.isin("BUILDING"), F.format_string('{"x":%s,"y":%s}', (key % 400).cast("string"), (key % 80).cast("string")))
    return c.select(key.alias("pos"), text.alias("attributes"), shape.alias("geometry"))


def updates(spark, sf_dir):
    """One update per event; every order is named twice and many names miss. One kind carries a broken id."""
    e = read(spark, sf_dir, "events")
    key = (F.floor(F.col("event_id") / 2) + 12000).cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "view", F.format_string('{"o_orderkey":%s,"o_orderstatus":"V"}', key))
        .when(kind == "click", F.format_string('{"o_orderkey":"%s","O_TOTALPRICE":%s}', key, F.col("value").cast("string")))
        .when(kind == "purchase", F.format_string('{"o_orderkey":%s,"o_totalprice":null,"o_orderpriority":"P"}', key))
        .when(kind == "signup", F.format_string('{"o_orderkey":%s,"o_orderdate":%s}', key, (F.col("event_id") * 1000 + 900000000000).cast("string")))
        .otherwise(F.concat(F.lit('{"o_orderkey":1.5,"o_orderstatus":"E"}'))))
    shape = F.when(kind == "view", F.format_string('{"x":%s,"y":1}', (F.col("event_id") % 100).cast("string")))
    return e.select(F.col("event_id").alias("pos"), text.alias("attributes"), shape.alias("geometry"))


def deletes(spark, sf_dir):
    """One delete per part: ids that exist, ids above 2^53 - 1, words and ids that miss."""
    p = read(spark, sf_dir, "part")
    key, kind = F.col("p_partkey"), F.col("p_type")
    text = (F.when(kind == "PROMO", F.lit("9007199254740993")).when(kind == "SMALL", F.concat(F.lit("x"), key.cast("string")))
            .when(kind == "LARGE", (key + 900000000).cast("string")).otherwise((key * 2).cast("string")))
    return p.select(key.alias("pos"), text.alias("id"))


def _rows(df):
    kind = df.schema["o_orderdate"].dataType
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"), "o_orderpriority",
                     epoch_ms(F.col("o_orderdate"), kind).alias("ms"), F.round("_xmin", 2).alias("x"), F.round("_ymin", 2).alias("y"))


def _results(df):
    return df.select("op", "pos", F.col("object_id").cast("long").alias("object_id"), F.when(F.col("success"), 1).otherwise(0).alias("success"), "code")


ROWS = "round(o_totalprice, 2) AS price, o_orderpriority, epoch_ms(o_orderdate) AS ms, round(x, 2) AS x, round(y, 2) AS y"

ADDED = """
added AS (
  SELECT k + 1 + c_custkey AS o_orderkey, c_custkey AS o_custkey, 'N' AS o_orderstatus, c_acctbal AS o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority,
         make_timestamp((850000000000 + c_custkey * 86400000) * 1000) AS o_orderdate,
         CASE WHEN c_custkey % 400 > 180 THEN c_custkey % 400 - 360 ELSE c_custkey % 400 END::DOUBLE AS x, (c_custkey % 80)::DOUBLE AS y
  FROM customer, top WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))
"""


@case("f1_adds", f"WITH {BASE}, {ADDED} SELECT o_orderkey, o_custkey, o_orderstatus, {ROWS} FROM (SELECT * FROM base UNION ALL SELECT * FROM added)")
def added_rows(spark, sf_dir):
    return _rows(apply_edits(order_layer(spark, sf_dir), adds=adds(spark, sf_dir)).rows)


ADD_RESULTS = """
SELECT 'add' AS op, c_custkey AS pos, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN k + 1 + c_custkey END AS object_id,
       CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS success,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1017 END AS code FROM customer, top
"""


@case("f1_add_results", f"WITH {BASE} {ADD_RESULTS}")
def add_results(spark, sf_dir):
    return _results(apply_edits(order_layer(spark, sf_dir), adds=adds(spark, sf_dir)).results)


CHANGE = """
sent AS (SELECT event_id // 2 + 12000 AS k, * FROM events),
change AS (
  SELECT k, bool_or(event_type = 'view') AS viewed, bool_or(event_type = 'purchase') AS bought,
         bool_or(event_type IN ('click', 'purchase')) AS priced, bool_or(event_type = 'signup') AS dated,
         last(CASE WHEN event_type = 'click' THEN value END ORDER BY event_id) FILTER (event_type IN ('click', 'purchase')) AS price,
         max(event_id) FILTER (event_type = 'signup') AS signup, max(event_id) FILTER (event_type = 'view') AS view
  FROM sent WHERE event_type <> 'error' GROUP BY k)
"""

UPDATED = """
SELECT o_orderkey, o_custkey, CASE WHEN viewed THEN 'V' ELSE o_orderstatus END AS o_orderstatus,
       round(CASE WHEN priced THEN price ELSE o_totalprice END, 2) AS price, CASE WHEN bought THEN 'P' ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN dated THEN 900000000000 + signup * 1000 ELSE epoch_ms(o_orderdate) END AS ms,
       round(CASE WHEN viewed THEN (view % 100)::DOUBLE ELSE x END, 2) AS x, round(CASE WHEN viewed THEN 1e0 ELSE y END, 2) AS y
"""


@case("f2_updates", f"WITH {BASE}, {CHANGE} {UPDATED} FROM base LEFT JOIN change ON o_orderkey = k")
def updated_rows(spark, sf_dir):
    return _rows(apply_edits(order_layer(spark, sf_dir), updates=updates(spark, sf_dir)).rows)


UPDATE_RESULTS = """
SELECT 'update' AS op, event_id AS pos, CASE WHEN event_type <> 'error' THEN event_id // 2 + 12000 END AS object_id,
       CASE WHEN event_type <> 'error' AND event_id // 2 + 12000 IN (SELECT o_orderkey FROM base) THEN 1 ELSE 0 END AS success,
       CASE WHEN event_type <> 'error' AND event_id // 2 + 12000 IN (SELECT o_orderkey FROM base) THEN NULL ELSE 1019 END AS code FROM events
"""


@case("d2_edit_key_join", f"WITH {BASE} {UPDATE_RESULTS}")
def update_results(spark, sf_dir):
    return _results(apply_edits(order_layer(spark, sf_dir), updates=updates(spark, sf_dir)).results)


DELETED = "(SELECT p_partkey * 2 FROM part WHERE p_type NOT IN ('PROMO', 'SMALL', 'LARGE'))"


@case("f3_deletes", f"WITH {BASE} SELECT o_orderkey, o_custkey, o_orderstatus, {ROWS} FROM base WHERE o_orderkey NOT IN {DELETED}")
def remaining_rows(spark, sf_dir):
    return _rows(apply_edits(order_layer(spark, sf_dir), deletes=deletes(spark, sf_dir)).rows)


DELETE_RESULTS = """
SELECT 'delete' AS op, p_partkey AS pos,
       CASE p_type WHEN 'PROMO' THEN 9007199254740993 WHEN 'SMALL' THEN NULL WHEN 'LARGE' THEN p_partkey + 900000000 ELSE p_partkey * 2 END AS object_id,
       CASE WHEN p_type NOT IN ('PROMO', 'SMALL', 'LARGE') AND p_partkey * 2 IN (SELECT o_orderkey FROM orders) THEN 1 ELSE 0 END AS success,
       CASE WHEN p_type NOT IN ('PROMO', 'SMALL', 'LARGE') AND p_partkey * 2 IN (SELECT o_orderkey FROM orders) THEN NULL ELSE 1018 END AS code FROM part
"""


@case("f3_delete_results", DELETE_RESULTS)
def delete_results(spark, sf_dir):
    return _results(apply_edits(order_layer(spark, sf_dir), deletes=deletes(spark, sf_dir)).results)


@case("f4_rollback", f"""
WITH {BASE}, outcome AS ({ADD_RESULTS} UNION ALL {DELETE_RESULTS})
SELECT op, pos, object_id, 0 AS success, coalesce(code, 1003) AS code FROM outcome
""")
def rolled_back(spark, sf_dir):
    edit = apply_edits(order_layer(spark, sf_dir), adds=adds(spark, sf_dir), deletes=deletes(spark, sf_dir), rollback=True)
    return _results(edit.results)


@case("f4_rollback_rows", f"WITH {BASE} SELECT o_orderkey, o_custkey, o_orderstatus, {ROWS} FROM base")
def rolled_back_rows(spark, sf_dir):
    edit = apply_edits(order_layer(spark, sf_dir), adds=adds(spark, sf_dir), deletes=deletes(spark, sf_dir), rollback=True)
    return _rows(edit.rows)


@case("f5_date_coercion", """
SELECT event_id, CASE event_type WHEN 'view' THEN epoch_us(ts) // 1000 WHEN 'click' THEN 1705485600000 END AS ms,
       CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d') WHEN 'click' THEN '2024-01-17' END AS day FROM events
""")
def coerced(spark, sf_dir):
    """Numbers, ISO text, a number out of range and a word, as a timestamp and as a date."""
    df = read(spark, sf_dir, "events")
    kind, ms = F.col("event_type"), epoch_ms(F.col("ts"), df.schema["ts"].dataType)
    text = (F.when(kind == "view", ms.cast("string")).when(kind == "click", "2024-01-17T10:00:00Z")
            .when(kind == "purchase", "8640000000000001").when(kind == "signup", "soon"))
    return df.select("event_id", epoch_ms(coerce_time(text, TimestampNTZType()), TimestampNTZType()).alias("ms"),
                     coerce_time(text, DateType()).cast("string").alias("day"))


@case("f_edit_sequence", f"""
WITH {BASE}, {ADDED}, {CHANGE}, everything AS (SELECT * FROM base UNION ALL SELECT * FROM added)
{UPDATED} FROM everything LEFT JOIN change ON o_orderkey = k WHERE o_orderkey NOT IN {DELETED}
""")
def edit_sequence(spark, sf_dir):
    """Adds, updates and deletes of one batch, each on the outcome of the step before."""
    return _rows(apply_edits(order_layer(spark, sf_dir), adds(spark, sf_dir), updates(spark, sf_dir), deletes(spark, sf_dir)).rows)
