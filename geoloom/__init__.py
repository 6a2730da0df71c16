"""geoloom: feature layers over Spark tables.

A table with a geometry column becomes a layer that answers feature queries
(attributes, ids, time, space, paging, distinct values, counts), gets summarised,
joined and edited, all as lazy DataFrames.
"""

from geoloom.functions.crs import reproject, unwrap_dateline, wrap_longitudes
from geoloom.functions.predicates import st_contains, st_crosses, st_intersects, st_overlaps, st_touches, st_within
from geoloom.functions.shapes import filter_shape, normalize_shapes
from geoloom.operators.aggregates import (
    cell_bins, cut_tracks, daily_tracks, id_audit, layer_extent, roll_up, table_profile, time_extent,
)
from geoloom.operators.catalog import discover_columns, minimum_scale, refresh_catalog
from geoloom.operators.edits import apply_edits, deletes_from, requests_from
from geoloom.operators.joins import points_in_polygons, spatial_join
from geoloom.operators.nested_bins import finished_bins, nested_bins, parent_bins
from geoloom.operators.sketches import stored_profile, write_profile
from geoloom.operators.stored_edits import edit_stored
from geoloom.operators.ranking import assign_ids, latest_per_entity
from geoloom.plans.feature_query import FeatureQuery, feature_page
from geoloom.plans.layer import Layer
from geoloom.sources.clustered import write_clustered, write_clustered_table
from geoloom.sources.export import export_features
from geoloom.sources.ingest import ingest_geometry, profile_geometry, with_point
from geoloom.sources.stored import StoredLayer, compact, with_time_ms

__all__ = [
    "FeatureQuery", "Layer", "StoredLayer", "apply_edits", "assign_ids", "cell_bins", "compact", "cut_tracks", "daily_tracks", "deletes_from",
    "discover_columns", "edit_stored", "export_features", "feature_page", "filter_shape", "finished_bins", "id_audit", "ingest_geometry", "latest_per_entity", "layer_extent",
    "minimum_scale", "nested_bins", "normalize_shapes", "parent_bins", "points_in_polygons", "profile_geometry", "refresh_catalog", "reproject",
    "requests_from", "roll_up", "spatial_join", "st_contains", "st_crosses", "st_intersects",
    "st_overlaps", "st_touches", "st_within", "stored_profile", "table_profile", "time_extent", "unwrap_dateline", "with_point",
    "with_time_ms", "wrap_longitudes", "write_clustered", "write_clustered_table", "write_profile",
]
