"""The spatial functions on columns: native expressions, no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions.sql import register_sql_functions
from parcelgrid.types import PARTS_TYPE, POINT


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _srid(srid: Column | int) -> Column:
    return (srid if isinstance(srid, Column) else F.lit(srid)).cast("int")


def _call(name: str, *arguments: Column) -> Column:
    register_sql_functions(SparkSession.active())
    return F.call_function(name, *arguments)


def record(**fields: Column) -> Column:
    """A struct whose names are literals: names given by alias get lost in a lambda."""
    return F.named_struct(*(c for name, value in fields.items() for c in (F.lit(name), value)))


def once(value: Column) -> Column:
    """Evaluate a column once per row, however often later steps refer to it.

    The optimizer copies plain projections into later filters and projections, which
    multiplies the work of a costly expression. A generator's output is not copied.
    """
    return F.explode(F.array(value))


def st_point(x: Column | str, y: Column | str, srid: Column | int = 0) -> Column:
    """Point from two columns; numbers in text are read as numbers.

    NULL, NaN, infinite or non-numeric input gives a NULL geometry.
    """
    px, py = (_column(value).try_cast("double") for value in (x, y))
    # Adding 0.0 turns -0.0 into 0.0, so that equal points are one value everywhere.
    zero, infinity = F.lit(0.0), F.lit(float("inf"))
    point = record(
        srid=_srid(srid),
        kind=F.lit(POINT),
        parts=F.lit(None).cast(PARTS_TYPE),
        bbox=record(xmin=px + zero, ymin=py + zero, xmax=px + zero, ymax=py + zero),
    )
    return F.when((F.abs(px) < infinity) & (F.abs(py) < infinity), point)


make_point = st_point


def st_geomfromtext(wkt: Column | str, srid: Column | int = 0) -> Column:
    """POINT, POLYGON or MULTIPOLYGON text to geometry.

    NULL and EMPTY give NULL. Malformed text, an unclosed ring or another kind raises. A
    MULTIPOLYGON of one part is the same value as the POLYGON.
    """
    return _call("st_geomfromtext", _column(wkt), _srid(srid))


def st_astext(geometry: Column | str) -> Column:
    """Geometry to WKT, coordinates in Spark's text form of a double."""
    return _call("st_astext", _column(geometry))


def st_setsrid(geometry: Column | str, srid: Column | int) -> Column:
    """Tag a geometry with an SRID. Coordinates are not reprojected."""
    return _call("geo_setsrid", _column(geometry), _srid(srid))


def st_srid(geometry: Column | str, srid: Column | int | None = None) -> Column:
    """The SRID of a geometry; with ``srid`` given, the geometry tagged with it."""
    if srid is not None:
        return st_setsrid(geometry, srid)
    return _column(geometry)["srid"]


def st_distance(a: Column | str, b: Column | str) -> Column:
    """Planar distance of two points."""
    return _call("st_distance", _column(a), _column(b))


def st_intersects(a: Column | str, b: Column | str) -> Column:
    """True when two geometries share a point. At least one must be a point.

    NULL input gives NULL; different SRIDs raise; polygon with polygon raises.
    For joins use ``operators.join.spatial_join``, which turns the predicate into an
    equi-join.
    """
    return _call("st_intersects", _column(a), _column(b))
