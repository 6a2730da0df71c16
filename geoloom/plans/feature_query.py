"""Feature query: request parameters to one DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from geoloom.operators.filters import drop_unusable_ids, id_filter, spatial_filter, time_filter, where_filter
from geoloom.operators.paging import EXCEEDED, TOP_ROWS, Page, count_rows, distinct_values, flagged_page, ids_only, page, page_size, sample_page, sort_columns
from geoloom.operators.projection import display_geometry, normalize_columns, project, selected_fields
from geoloom.plans.guard import parse_integer
from geoloom.plans.layer import Layer

#: Rows of a tile, which is a sample, where neither the request nor the layer names a number.
TILE_ROWS = 2000


@dataclass(frozen=True)
class FeatureQuery:
    """Parameters of one request, all optional."""

    where: str | None = None
    object_ids: str | list[int] | DataFrame | None = None
    geometry: str | dict | list | None = None
    in_sr: str | int | dict | None = None
    spatial_rel: str = "esriSpatialRelIntersects"
    time: str | None = None
    out_fields: str = "*"
    return_geometry: bool = True
    order_by_fields: str | None = None
    result_offset: int = 0
    result_record_count: int | None = None
    return_count_only: bool = False
    return_ids_only: bool = False
    return_distinct_values: bool = False
    result_type: str | None = None
    count_distinct: bool = False
    drop_unusable_ids: bool = False
    strict: bool = False
    with_exceeded: bool = False

    @staticmethod
    def from_params(params: dict) -> "FeatureQuery":
        """From request parameters as clients send them (camelCase names, text values)."""
        known = {f.name: f for f in fields(FeatureQuery)}
        values = {}
        for key, value in params.items():
            name = re.sub(r"(?<=[a-z])([A-Z]+)", lambda m: "_" + m.group(1).lower(), key)
            if name not in known or value is None or value == "":
                continue
            if isinstance(known[name].default, bool):
                value = str(value).lower() == "true"
            elif name in ("result_offset", "result_record_count"):
                value = parse_integer(value)
            values[name] = value
        return FeatureQuery(**values)

    @property
    def tile(self) -> bool:
        return (self.result_type or "").lower() == "tile" and not self.result_offset


def _needs_geometry(layer: Layer, q: FeatureQuery) -> bool:
    shown = q.return_geometry and not q.return_ids_only and (not q.return_count_only or q.count_distinct)
    return bool(q.geometry) or shown or layer.geometry.lower() in (q.where or "").lower()


def filtered(layer: Layer, q: FeatureQuery) -> DataFrame:
    """All filters of a request, ANDed. None of them decodes or moves anything by itself."""
    df = layer.df if layer.plain is None or _needs_geometry(layer, q) else layer.plain
    if q.where:
        df = where_filter(df, q.where)
    df = time_filter(df, layer.time_field, q.time, layer.date_field)
    if q.geometry:
        df = spatial_filter(df, q.geometry, q.spatial_rel, layer.geometry, layer.srid, q.in_sr, q.strict, layer.geometry_type)
    if q.object_ids is not None and not (isinstance(q.object_ids, str) and not q.object_ids.strip()):
        df = id_filter(df, layer.id_field, q.object_ids)
    return df


def feature_page(layer: Layer, q: FeatureQuery) -> Page:
    """One page of features: cut first, then drop unusable ids, then shape the output.

    `with_exceeded` puts the flag on every row, out of the same run.
    """
    df = filtered(layer, q)
    size = page_size(q.result_record_count, layer.max_record_count)
    if q.tile:
        size, keys = size or TILE_ROWS, []
        cut = Page(flagged_page(df, [], size) if q.with_exceeded else sample_page(df, size), page(df, [], size).exceeded)
    else:
        paged = q.result_offset > 0 or q.result_record_count is not None or q.order_by_fields
        keys = sort_columns(df, q.order_by_fields, layer.id_field) if paged else []
        if q.result_offset + size > TOP_ROWS:
            df = df.select(*_read_fields(layer, q))
        names = _key_names(layer, q) if keys else None
        cut = page(df, keys, size, q.result_offset, names=names)
        if q.with_exceeded:
            cut = Page(flagged_page(df, keys, size, q.result_offset, names), cut.exceeded)
    rows = drop_unusable_ids(cut.rows, layer.id_field) if q.drop_unusable_ids else cut.rows
    shown = display_geometry(rows, layer.geometry, after_sort=bool(keys)) if q.return_geometry else rows
    flag = (EXCEEDED,) if q.with_exceeded else ()
    answer = project(shown, q.out_fields, layer.id_field, layer.geometry, q.return_geometry, flag)
    return Page(normalize_columns(answer, layer.geometry), cut.exceeded)


def _read_fields(layer: Layer, q: FeatureQuery) -> list[str]:
    """Columns a far page has to carry: what is shown, what it is sorted by, and the id."""
    shown = selected_fields(layer.df, q.out_fields, layer.id_field, layer.geometry)
    sorted_by = {word.split()[0].lower() for word in (q.order_by_fields or "").split(",") if word.split()}
    keys = [c for c in layer.df.columns if c.lower() in sorted_by and c not in shown]
    return [*shown, *keys, *([layer.geometry] if q.return_geometry else [])]


def _key_names(layer: Layer, q: FeatureQuery) -> list[str]:
    """Columns that a page is sorted by."""
    sorted_by = {re.sub(r"[^A-Za-z0-9_]", "", word.split()[0]).lower() for word in (q.order_by_fields or "").split(",") if word.split()}
    return [c for c in layer.df.columns if c.lower() in sorted_by | {layer.id_field.lower()}]


def _distinct_fields(layer: Layer, q: FeatureQuery) -> list[str]:
    names = selected_fields(layer.df, q.out_fields, layer.id_field, layer.geometry, add_id=False)
    return [*names, layer.geometry] if q.return_geometry else names


def parse(request: FeatureQuery | dict | None = None, **parameters) -> FeatureQuery:
    """A request as it came to a FeatureQuery."""
    if isinstance(request, dict):
        return FeatureQuery.from_params({**request, **parameters})
    return request or FeatureQuery(**parameters)


def run(layer: Layer, request: FeatureQuery | dict | None = None, **parameters) -> DataFrame:
    """Answer a request; count comes before ids, ids before distinct values, those before features."""
    q = parse(request, **parameters)
    if q.return_count_only:
        df = filtered(layer, q)
        return count_rows(df.select(*_distinct_fields(layer, q)).distinct() if q.count_distinct else df)
    if q.return_ids_only:
        return ids_only(filtered(layer, q), layer.id_field, layer.max_ids)
    if q.return_distinct_values:
        return distinct_values(filtered(layer, q), _distinct_fields(layer, q), layer.max_distinct)
    return feature_page(layer, q).rows
