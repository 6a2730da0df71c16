"""Batch edits: adds, updates and deletes with a result per request row.

Requests are tables with a position and JSON text, as a feature service receives
them:

    adds     pos, attributes (JSON object), geometry (Esri JSON or GeoJSON, or NULL)
    updates  pos, attributes (with the id), geometry
    deletes  pos, id (text)

Nothing is written here. The caller gets the edited rows and the results and
writes the rows to a new path.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructField

from geoloom.functions.crs import wrap_longitudes
from geoloom.functions.decode import parse_esri_json
from geoloom.functions.geometry import BBOX, HIDDEN, bounds, vertices
from geoloom.functions.times import coerce_time, is_time
from geoloom.operators.projection import is_geometry
from geoloom.plans.guard import MAX_SAFE_INTEGER
from geoloom.plans.layer import Layer
from geoloom.runtime import broadcast_if_small, checkpoint, fits

# Error codes of edit results.
ROLLED_BACK, ADD_FAILED, DELETE_FAILED, UPDATE_FAILED = 1003, 1017, 1018, 1019

REQUEST_DDL = "pos long, attributes string, geometry string"
DELETE_DDL = "pos long, id string"
_INTEGER = r"^\s*[-+]?\d+(?:\.0*)?\s*$"
VALUES_DDL = "map<string,string>"
_RESULT = ["op", "pos", "object_id", "success", "code", "description"]


@dataclass(frozen=True)
class EditResult:
    """The edited table and one result row per request row."""

    rows: DataFrame
    results: DataFrame


def requests_from(spark: SparkSession, features: list[dict]) -> DataFrame:
    """Adds or updates of one request body as a table."""
    def text(value):
        return None if value is None else json.dumps(value)
    rows = [(i, text(f.get("attributes") or f.get("properties") or {}), text(f.get("geometry"))) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, REQUEST_DDL)


def deletes_from(spark: SparkSession, raw) -> DataFrame:
    """Deletes of one request parameter: a list of ids, one id, or text with ids between commas, brackets and quotes; blanks are left out."""
    if isinstance(raw, (list, tuple)):
        sent, ids = [None if v is None else str(v) for v in raw], F.col("sent")
        request = spark.createDataFrame([(sent,)], "sent array<string>")
    else:
        ids = F.split("sent", r"[\[\]\",]")
        request = spark.createDataFrame([(None if raw is None else str(raw),)], "sent string")
    trimmed = F.transform(ids, lambda v: F.regexp_replace(v, r"^\s+|\s+$", ""))
    return request.select(F.posexplode(F.filter(trimmed, lambda v: v != "")).alias("pos", "id")).select(F.col("pos").cast("long"), "id")


def request_number(text: Column) -> Column:
    """Integer that request text stands for; NULL for fractions, words and missing values."""
    return F.when(text.rlike(_INTEGER), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("decimal(38,0)"))


def _unsafe(number: Column) -> Column:
    return F.abs(number) > F.lit(MAX_SAFE_INTEGER)


def safe_key(number: Column) -> Column:
    """A number of a request as an id; NULL for one that no id can be."""
    return F.when(~_unsafe(number), number).cast("long")


def _typed(text: Column, kind: DataType) -> Column:
    """Request text as a value of the column; NULL when it does not fit."""
    if is_time(kind):
        return coerce_time(text, kind)
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, BooleanType):
        return F.lower(F.trim(text)).try_cast("boolean")
    return F.trim(text).try_cast(kind)


def _attribute_fields(layer: Layer) -> list[StructField]:
    out = {layer.id_field.lower(), layer.geometry.lower(), *HIDDEN}
    return [f for f in layer.df.schema if f.name.lower() not in out and not is_geometry(f.dataType)]


def _read(layer: Layer, requests: DataFrame) -> DataFrame:
    """Requests with lower-case attribute names, the id apart, the geometry decoded and wrapped.

    Callers checkpoint the outcome: it feeds the rows, the results and the size
    checks, and is parsed once for all of them.
    """
    lowered = F.transform_keys(F.coalesce(F.from_json("attributes", VALUES_DDL), F.create_map().cast(VALUES_DDL)),
                               lambda k, _: F.lower(k))
    shape = F.when(F.col("geometry").isNotNull(), wrap_longitudes(parse_esri_json(F.col("geometry"), layer.srid)))
    known = [f.name.lower() for f in _attribute_fields(layer)]
    staged = requests.select("pos", "geometry", lowered.alias("_all"), shape.alias("_shape"))
    sent = F.col("geometry").isNotNull() & (F.lower(F.trim("geometry")) != "null")
    return staged.select(
        "pos", "_shape", (sent & F.col("_shape").isNull()).alias("_unreadable"),
        F.try_element_at("_all", F.lit(layer.id_field.lower())).alias("_id"),
        F.map_filter("_all", lambda k, _: k != layer.id_field.lower()).alias("_sent"),
    ).withColumns({
        "_unknown": F.filter(F.map_keys("_sent"), lambda k: ~k.isin(*known) if known else F.lit(True)),
        "_bad": F.filter(F.array(*[
            F.when(_sent(f).isNotNull() & _typed(_sent(f), f.dataType).isNull(), f.name) for f in _attribute_fields(layer)
        ]).cast("array<string>"), lambda n: n.isNotNull()),
    })


def _sent(field: StructField) -> Column:
    return F.try_element_at(F.col("_sent"), F.lit(field.name.lower()))


def _is_sent(field: StructField) -> Column:
    return F.map_contains_key(F.col("_sent"), field.name.lower())


def _fault(layer: Layer) -> Column:
    """Why a request row cannot run, or NULL."""
    return (
        F.when(F.size("_unknown") > 0, F.concat(F.lit("unknown columns: "), F.array_join("_unknown", ", ")))
        .when(F.size("_bad") > 0, F.concat(F.lit("unfit values for: "), F.array_join("_bad", ", ")))
        .when(F.col("_unreadable"), "geometry cannot be read")
        .when((F.size("_sent") == 0) & F.col("_shape").isNull(), "nothing to write")
    )


def _result(op: str, code: int) -> list[Column]:
    failed = F.col("_fault").isNotNull()
    return [
        F.lit(op).alias("op"), F.col("pos").cast("long").alias("pos"), F.col("object_id").cast("decimal(38,0)").alias("object_id"),
        (~failed).alias("success"), F.when(failed, code).alias("code"), F.col("_fault").alias("description"),
    ]


def _unsafe_text(layer: Layer, number: Column) -> Column:
    return F.concat(F.lit(f"{layer.id_field} "), number.cast("string"), F.lit(" exceeds 2^53 - 1"))


def _no_integer(layer: Layer, sent: Column) -> Column:
    return F.concat(F.lit(f"{layer.id_field} must be a whole number, not "), F.coalesce(sent, F.lit("null")))


def _answered(requests: DataFrame, present: DataFrame, id_field: str) -> DataFrame:
    """Requests with a fault where the table lacks the id. Those without a key are no part of the join, so they gather nowhere."""
    absent = F.when(F.col("_present").isNull(), F.concat(F.lit(f"no row has {id_field} "), F.col("_key").cast("string")))
    named = requests.filter("_key IS NOT NULL").join(present, "_key", "left").withColumn("_fault", F.coalesce("_fault", absent))
    return named.drop("_present").unionByName(requests.filter("_key IS NULL"))


def _split_by_id(base: DataFrame, id_field: str) -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and those without, which no edit can name and no join should gather."""
    return base.filter(F.col(id_field).isNotNull()), base.filter(F.col(id_field).isNull())


def _found(base: DataFrame, id_field: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The named ids without repeats, and those of them that the table has; both broadcast if they are few."""
    keys = keys.distinct()
    few = fits(keys)
    keys = F.broadcast(keys) if few else keys
    ids = base.select(F.col(id_field).cast("long").alias("_key")).join(keys, "_key", "left_semi").distinct()
    present = ids.withColumn("_present", F.lit(True))
    return keys, F.broadcast(present) if few else present


def run_adds(layer: Layer, adds: DataFrame, top: int | None = None) -> tuple[DataFrame, DataFrame]:
    """New rows and results. Ids go on from the largest one (`top`, if it is known) in request order; a sent id is ignored."""
    id_kind = layer.df.schema[layer.id_field].dataType
    if top is None:
        top = layer.df.agg(F.coalesce(F.max(layer.id_field).cast("decimal(38,0)"), F.lit(0)).alias("top")).first().top
    new_id = F.lit(int(top)).cast("decimal(38,0)") + F.col("pos") + 1
    staged = _read(layer, adds).withColumn("_new", new_id)
    fault = F.coalesce(_fault(layer), F.when(_unsafe(F.col("_new")), _unsafe_text(layer, F.col("_new"))))
    staged = checkpoint(staged.withColumn("_fault", fault))
    values = [_typed(_sent(f), f.dataType).cast(f.dataType).alias(f.name) for f in _attribute_fields(layer)]
    rows = staged.filter("_fault IS NULL").select(
        F.col("_new").cast(id_kind).alias(layer.id_field), *values, F.col("_shape").alias(layer.geometry))
    rows = rows.withColumns(bounds(F.col(layer.geometry)))
    results = staged.withColumn("object_id", F.when(F.col("_fault").isNull(), F.col("_new"))).select(*_result("add", ADD_FAILED))
    return layer.df.unionByName(rows, allowMissingColumns=True), results


def run_updates(layer: Layer, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Changed rows and results. Only sent columns change; an explicit null is a value, a null geometry is not.

    Several updates of one id are merged column by column, the last one in
    request order winning, before the table is touched: one narrow row per id
    and column is shuffled, and the table is joined once.
    """
    base, id_field, geom = layer.df, layer.id_field, layer.geometry
    number = request_number(F.col("_id"))
    staged = _read(layer, updates).withColumn("_key", number)
    fault = (
        F.when(F.col("_key").isNull(), _no_integer(layer, F.col("_id")))
        .when(_unsafe(F.col("_key")), _unsafe_text(layer, F.col("_key")))
        .otherwise(_fault(layer))
    )
    staged = checkpoint(staged.withColumn("_fault", fault))
    runnable = staged.filter("_fault IS NULL").withColumn("_key", F.col("_key").cast("long"))
    named = runnable.select("_key", "pos", F.explode("_sent").alias("name", "value"))
    last = named.groupBy("_key", "name").agg(F.max_by(F.struct("value"), "pos").alias("last"))
    merged = last.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("name", "last.value"))).alias("_sent"))
    shapes = runnable.filter("_shape IS NOT NULL").groupBy("_key").agg(F.max_by("_shape", "pos").alias("_shape"))
    change = merged.join(shapes, "_key", "full").withColumn("_sent", F.coalesce("_sent", F.create_map().cast(VALUES_DDL)))
    # Values are read once per request, not once per row and column of the table.
    fields = [f for f in base.schema if f.name != geom and f.name.lower() not in (id_field.lower(), *HIDDEN) and not is_geometry(f.dataType)]
    weight = F.length(F.concat_ws("", F.map_values("_sent"))) + F.coalesce(F.size(vertices(F.col("_shape"))), F.lit(0)) * 16 + 16 * len(fields) + 100
    flags = [_is_sent(f).alias(f"_is{i}") for i, f in enumerate(fields)]
    values = [F.when(_is_sent(f), _typed(_sent(f), f.dataType)).alias(f"_to{i}") for i, f in enumerate(fields)]
    place = {f.name: i for i, f in enumerate(fields)}
    change = change.select("_key", "_shape", *flags, *values, weight.alias("_weight"))
    change = broadcast_if_small(change, F.col("_weight")).drop("_weight")

    named, nameless = _split_by_id(base, id_field)
    found = named.join(change, F.col(id_field).cast("long") == F.col("_key"), "left")
    columns = []
    for f in base.schema:
        old = F.col(f.name)
        if f.name == geom:
            columns.append(F.coalesce("_shape", old).alias(f.name))
        elif f.name in BBOX:
            columns.append(F.when(F.col("_shape").isNotNull(), bounds(F.col("_shape"))[f.name]).otherwise(old).alias(f.name))
        elif f.name in place:
            columns.append(F.when(F.col(f"_is{place[f.name]}"), F.col(f"_to{place[f.name]}")).otherwise(old).alias(f.name))
        else:
            columns.append(old)

    _, present = _found(base, id_field, runnable.select("_key"))
    keyed = staged.withColumn("_key", F.when(~_unsafe(F.col("_key")), F.col("_key")).cast("long"))
    results = _answered(keyed, present, id_field).withColumn("object_id", number).select(*_result("update", UPDATE_FAILED))
    return found.select(*columns).unionByName(nameless), results


def run_deletes(layer: Layer, deletes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Remaining rows and results at the request positions; a repeated id succeeds each time it is named."""
    base, id_field = layer.df, layer.id_field
    named = deletes.filter(F.col("id").isNotNull() & (F.trim("id") != "")).withColumn("_number", request_number(F.col("id")))
    named = named.withColumn("_fault", F.when(
        F.col("_number").isNull(), _no_integer(layer, F.col("id"))).when(_unsafe(F.col("_number")), _unsafe_text(layer, F.col("_number"))))
    named = named.withColumn("_key", F.when(F.col("_fault").isNull(), F.col("_number")).cast("long"))
    wanted, present = _found(base, id_field, named.filter("_key IS NOT NULL").select("_key"))
    results = _answered(named, present, id_field).withColumn("object_id", F.col("_number")).select(*_result("delete", DELETE_FAILED))
    keyed, nameless = _split_by_id(base, id_field)
    return keyed.join(wanted, F.col(id_field).cast("long") == F.col("_key"), "left_anti").unionByName(nameless), results


def apply_edits(layer: Layer, adds: DataFrame | None = None, updates: DataFrame | None = None,
                deletes: DataFrame | None = None, rollback: bool = False, top: int | None = None) -> EditResult:
    """Adds, then updates, then deletes, each on the outcome of the step before.

    `top` is the largest id of the table, where `layer` holds only the rows that the edits name.

    With `rollback` a single failure leaves the table as it was: rows that had
    worked are reported as rolled back, the others keep their own error.
    """
    if not layer.editable:
        raise PermissionError(f"Editing is not enabled for layer {layer.name}")
    rows, results = layer.df, []
    for requests, step in ((adds, run_adds), (updates, run_updates), (deletes, run_deletes)):
        if requests is not None:
            known = {"top": top} if step is run_adds else {}
            rows, outcome = step(layer.over(rows), requests, **known)
            results.append(outcome)
    if not results:
        return EditResult(rows, layer.df.sparkSession.createDataFrame(
            [], "op string, pos long, object_id decimal(38,0), success boolean, code int, description string"))
    outcome = results[0]
    for more in results[1:]:
        outcome = outcome.unionByName(more)
    if rollback:
        # Asked for failures and returned: fixed once for both.
        outcome = checkpoint(outcome)
    if rollback and not outcome.filter(~F.col("success")).isEmpty():
        undone = F.col("success")
        outcome = outcome.select(
            "op", "pos", "object_id", F.lit(False).alias("success"), F.when(undone, ROLLED_BACK).otherwise(F.col("code")).alias("code"),
            F.when(undone, "undone, since another edit failed").otherwise(F.col("description")).alias("description"))
        rows = layer.df
    return EditResult(rows, outcome.select(*_RESULT))
