"""Column functions: geometry, well-known text, SQL names, parcel classifier."""

from parcelgrid.functions.classify import classify_parcel
from parcelgrid.functions.geometry import (
    make_point,
    st_astext,
    st_distance,
    st_geomfromtext,
    st_intersects,
    st_point,
    st_setsrid,
    st_srid,
)
from parcelgrid.functions.sql import register_sql_functions

__all__ = [
    "classify_parcel",
    "make_point",
    "register_sql_functions",
    "st_astext",
    "st_distance",
    "st_geomfromtext",
    "st_intersects",
    "st_point",
    "st_setsrid",
    "st_srid",
]
