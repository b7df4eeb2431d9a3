"""Road calls per census tract, from raw call rows and a tract table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelgrid.operators import add_point_geometry, roadcalls_per_tract
from parcelgrid.types import TRACT_COLS, WGS84


def hotspots(
    calls: DataFrame,
    tracts: DataFrame,
    tract_cols: list[str] | None = None,
    call_id_col: str = "call_num",
    lon_col: str = "longitude",
    lat_col: str = "latitude",
    srid: int = WGS84,
) -> DataFrame:
    """Calls become points, are joined to the tract they fall in, and are counted."""
    points = add_point_geometry(calls, lon_col, lat_col, srid)
    columns = TRACT_COLS if tract_cols is None else tract_cols
    return roadcalls_per_tract(points, tracts, columns, call_id_col)
