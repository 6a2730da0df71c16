"""Stored layers: edits by file, statistics from footers, compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom import StoredLayer, compact, edit_stored, with_time_ms
from geoloom.runtime import scratch_path
from geoloom.sources.stored import day_files, write_stored
from workload.edits import ADDED, BASE, CHANGE, DELETED, ROWS, UPDATED, _rows, adds, deletes, order_layer, updates
from workload.registry import case
from workload.tables import WITH, position_layer, read


def stored_orders(spark, sf_dir) -> StoredLayer:
    """Orders in folders per year."""
    path = scratch_path(spark, "orders")
    rows = order_layer(spark, sf_dir).df.withColumn("o_year", F.year("o_orderdate"))
    write_stored(rows, path, "o_year", "o_orderkey")
    return StoredLayer.open(spark, path, "o_year", id_field="o_orderkey", time_field="o_orderdate", name="orders")


def stored_positions(spark, sf_dir) -> StoredLayer:
    """Positions in folders per day, with their milliseconds."""
    path = scratch_path(spark, "positions")
    dated = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    write_stored(with_time_ms(dated, "ts"), path, "event_date", "oid")
    return StoredLayer.open(spark, path, "event_date", id_field="oid", time_field="ts", date_field="event_date", geometry_type="Point")


def _with_origin(edit, year: int):
    """Rows of the new version; `as_promised` tells that those of other years are still read from the files they were in."""
    rows = edit.stored.rows(F.regexp_replace(F.col("_metadata.file_path"), ":///", ":/").alias("_file"))
    new = F.col("_file").isin([f.replace(":///", ":/") for f in edit.written])
    return rows.withColumn("as_promised", F.when((F.year("o_orderdate") == year) | ~new, 1).otherwise(0))


@case("f2_stored_updates", """
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 AND o_orderpriority = '1-URGENT' THEN 'S' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN year(o_orderdate) = 1995 AND o_orderpriority = '1-URGENT' THEN NULL ELSE round(o_totalprice, 2) END AS price, 1 AS as_promised FROM orders
""")
def stored_updates(spark, sf_dir):
    """Urgent orders of one year get a status and lose their price: the other years' files stay."""
    urgent = read(spark, sf_dir, "orders").filter((F.year("o_orderdate") == 1995) & (F.col("o_orderpriority") == "1-URGENT"))
    requests = urgent.select(F.col("o_orderkey").alias("pos"), F.format_string('{"o_orderkey":%s,"o_orderstatus":"S","o_totalprice":null}', F.col("o_orderkey").cast("string")).alias("attributes"),
                             F.lit(None).cast("string").alias("geometry"))
    edit = edit_stored(stored_orders(spark, sf_dir), scratch_path(spark, "updated"), updates=requests)
    return _with_origin(edit, 1995).select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"), "as_promised")


@case("f3_stored_deletes", """
SELECT o_orderkey, round(o_totalprice, 2) AS price, 1 AS as_promised FROM orders WHERE NOT (year(o_orderdate) = 1996 AND o_orderpriority = '5-LOW')
""")
def stored_deletes(spark, sf_dir):
    """Deletes of one year's orders of low priority."""
    low = read(spark, sf_dir, "orders").filter((F.year("o_orderdate") == 1996) & (F.col("o_orderpriority") == "5-LOW"))
    requests = low.select(F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("id"))
    edit = edit_stored(stored_orders(spark, sf_dir), scratch_path(spark, "deleted"), deletes=requests)
    return _with_origin(edit, 1996).select("o_orderkey", F.round("o_totalprice", 2).alias("price"), "as_promised")


@case("f_stored_sequence", f"""
WITH {BASE}, {ADDED}, {CHANGE}, everything AS (SELECT * FROM base UNION ALL SELECT * FROM added)
{UPDATED} FROM everything LEFT JOIN change ON o_orderkey = k WHERE o_orderkey NOT IN {DELETED}
""")
def stored_sequence(spark, sf_dir):
    """Adds, updates and deletes of one batch on stored files."""
    edit = edit_stored(stored_orders(spark, sf_dir), scratch_path(spark, "edited"), adds(spark, sf_dir), updates(spark, sf_dir), deletes(spark, sf_dir))
    return _rows(edit.stored.rows())


@case("f4_stored_rollback", f"WITH {BASE} SELECT o_orderkey, o_custkey, o_orderstatus, {ROWS} FROM base")
def stored_rollback(spark, sf_dir):
    """A batch with a failure leaves the version as it was."""
    stored = stored_orders(spark, sf_dir)
    edit = edit_stored(stored, scratch_path(spark, "undone"), adds(spark, sf_dir), deletes=deletes(spark, sf_dir), rollback=True)
    return _rows(edit.stored.rows())


@case("e1_stored_count_all", "SELECT count(*) AS count FROM events")
def stored_count_all(spark, sf_dir):
    return stored_positions(spark, sf_dir).count()


@case("e2_stored_extent", WITH + "SELECT min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax, 4326 AS wkid FROM positions")
def stored_extent(spark, sf_dir):
    return stored_positions(spark, sf_dir).extent()


@case("e3_stored_times", WITH + "SELECT epoch_us(min(ts)) // 1000 AS t0, epoch_us(max(ts)) // 1000 AS t1 FROM positions")
def stored_times(spark, sf_dir):
    return stored_positions(spark, sf_dir).times()


@case("a11_compacted", WITH + """
SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n, CAST(sum(oid) AS BIGINT) AS oids, round(sum(lon), 4) AS lons, 1 AS fewer_files FROM positions GROUP BY 1
""")
def compacted(spark, sf_dir):
    """Positions written in three parts, then compacted day by day."""
    path = scratch_path(spark, "parts")
    dated = position_layer(spark, sf_dir).df.withColumn("event_date", F.to_date("ts"))
    for kinds in (["view"], ["click", "purchase"], ["signup", "error"]):
        dated.filter(F.col("event_type").isin(kinds)).repartition(4, "oid").write.mode("append").partitionBy("event_date").parquet(path)
    before = day_files(spark, path, "event_date").agg(F.sum("files")).first()[0]
    compact(spark, path, "event_date", "oid")
    after = day_files(spark, path, "event_date").agg(F.sum("files")).first()[0]
    return spark.read.parquet(path).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("oid").alias("oids"), F.round(F.sum("lon"), 4).alias("lons")).withColumn("fewer_files", F.lit(1 if 2 * after < before else 0))
