"""Schemas and fixed constants shared by the library.

A geometry is one struct for every kind. A point keeps its coordinates in ``bbox``
only and has NULL ``parts``: the spatial join then reads two doubles per point and
never builds an array.  A polygon keeps ``parts``: polygon > ring > vertex, the first
ring of a polygon being its shell.
"""

from __future__ import annotations

from pyspark.sql import types as T

POINT = "POINT"
POLYGON = "POLYGON"
MULTIPOLYGON = "MULTIPOLYGON"

WGS84 = 4326

VERTEX_TYPE = T.StructType(
    [T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]
)
PARTS_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX_TYPE)))
BBOX_TYPE = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in ("xmin", "ymin", "xmax", "ymax")]
)
GEOMETRY_TYPE = T.StructType(
    [
        T.StructField("srid", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("parts", PARTS_TYPE),
        T.StructField("bbox", BBOX_TYPE),
    ]
)

# Tract attributes carried through the hotspot count by default.
TRACT_COLS = [
    "STATE_ABBR",
    "STATE_FIPS",
    "COUNTY_FIP",
    "STCOFIPS",
    "TRACT_FIPS",
    "FIPS",
    "POPULATION",
    "POP_SQMI",
    "POPULATI_1",
    "POP20_SQMI",
]

# Parcel attributes the enrichment reads.
PARCEL_ATTRS = [
    "address",
    "owner",
    "struct",
    "zoning_type",
    "zoning_subtype",
    "lbcs_activity",
    "lbcs_function",
    "county",
    "state2",
]

CLASSIFICATION_TYPE = T.StructType(
    [
        T.StructField("truck_flag", T.BooleanType()),
        T.StructField("confidence", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
    ]
)
