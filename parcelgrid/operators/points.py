"""Row operators on the point side."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.geometry import st_point
from parcelgrid.types import WGS84


def add_point_geometry(
    df: DataFrame, lon_col: str = "longitude", lat_col: str = "latitude", srid: int = WGS84
) -> DataFrame:
    """Add, or replace, ``geometry``: a point with x = longitude and y = latitude."""
    return df.withColumn("geometry", st_point(lon_col, lat_col, srid))


def with_coordinates(
    df: DataFrame, lon_col: str = "longitude", lat_col: str = "latitude"
) -> DataFrame:
    """Rows in which both coordinates are present."""
    return df.where(F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull())


def within_last_year(
    df: DataFrame, time_col: str = "roadcall_call_dt", as_of: datetime | Column | None = None
) -> DataFrame:
    """Rows not older than one year before ``as_of`` (default: now), the limit included."""
    if as_of is None:
        now = F.current_timestamp()
    else:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return df.where(F.col(time_col) >= now - F.make_interval(F.lit(1)))
