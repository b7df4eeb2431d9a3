"""Sources: CSV, catalog tables, WKT tables, shapefiles."""

from parcelgrid.sources.shapefile import ShapefileDataSource
from parcelgrid.sources.tables import (
    list_tables,
    read_points_csv,
    read_points_table,
    read_tracts_shapefile,
    read_tracts_wkt,
    tracts_from_wkt,
)

__all__ = [
    "ShapefileDataSource",
    "list_tables",
    "read_points_csv",
    "read_points_table",
    "read_tracts_shapefile",
    "read_tracts_wkt",
    "tracts_from_wkt",
]
