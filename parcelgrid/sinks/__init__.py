"""Sinks: GeoParquet, catalog tables, CSV, Parquet."""

from parcelgrid.sinks.geoparquet import GeoParquetDataSource
from parcelgrid.sinks.tables import write_csv, write_geoparquet, write_parquet, write_table

__all__ = ["GeoParquetDataSource", "write_csv", "write_geoparquet", "write_parquet", "write_table"]
