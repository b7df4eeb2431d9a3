"""The spatial functions under SQL names.

They are SQL functions, so Catalyst inlines their bodies: no Python runs per row. The
getter is named ``geo_srid`` because ``st_srid`` is a Spark built-in of another type
and a SQL function may not replace it.
"""

from __future__ import annotations

from weakref import WeakSet

from pyspark.sql import SparkSession

from parcelgrid.functions import expressions as X

_FUNCTIONS = [
    ("st_point", "px DOUBLE, py DOUBLE", X.GEOMETRY, X.MAKE_POINT),
    ("st_geomfromtext", "wkt STRING, srid INT DEFAULT 0", X.GEOMETRY, X.FROM_TEXT),
    ("st_astext", f"g {X.GEOMETRY}", "STRING", X.AS_TEXT),
    ("geo_srid", f"g {X.GEOMETRY}", "INT", "g.srid"),
    ("geo_setsrid", f"g {X.GEOMETRY}, srid INT", X.GEOMETRY, X.SET_SRID),
    ("st_intersects", f"a {X.GEOMETRY}, b {X.GEOMETRY}", "BOOLEAN", X.INTERSECTS),
    ("st_distance", f"a {X.GEOMETRY}, b {X.GEOMETRY}", "DOUBLE", X.DISTANCE),
]

_registered: WeakSet[SparkSession] = WeakSet()


def register_sql_functions(spark: SparkSession) -> None:
    """Register the SQL names in this session; later calls do nothing."""
    if spark in _registered:
        return
    for name, arguments, result, body in _FUNCTIONS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) "
            f"RETURNS {result} RETURN {body}"
        )
    _registered.add(spark)
