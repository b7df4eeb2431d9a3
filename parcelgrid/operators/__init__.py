"""Operators: functions from DataFrames to a DataFrame, without input or output."""

from parcelgrid.operators.counts import count_points_per_polygon, roadcalls_per_tract
from parcelgrid.operators.enrich import enrich, ensure_point_id, summary
from parcelgrid.operators.join import spatial_join
from parcelgrid.operators.lookup import spatial_lookup
from parcelgrid.operators.points import add_point_geometry, with_coordinates, within_last_year

__all__ = [
    "add_point_geometry",
    "count_points_per_polygon",
    "enrich",
    "ensure_point_id",
    "roadcalls_per_tract",
    "spatial_join",
    "spatial_lookup",
    "summary",
    "with_coordinates",
    "within_last_year",
]
