"""Geometry functions, by column and by SQL name."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelgrid.functions import (
    st_astext,
    st_distance,
    st_geomfromtext,
    st_intersects,
    st_point,
    st_setsrid,
    st_srid,
)


def _one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_distance(spark):
    a, b = st_point(F.lit(0), F.lit(0)), st_point(F.lit(3), F.lit(4))
    assert _one(spark, st_distance(a, b))[0] == 5.0
    assert spark.sql("SELECT ST_Distance(ST_Point(0, 0), ST_Point(3, 4)) AS d").first()["d"] == 5.0


def test_srid_is_a_tag(spark):
    point = st_srid(st_point(F.lit(1), F.lit(2)), 3857)
    row = _one(spark, st_srid(point).alias("srid"), st_astext(point).alias("text"))
    assert (row["srid"], row["text"]) == (3857, "POINT (1.0 2.0)")


@pytest.mark.parametrize(
    ("text", "printed"),
    [
        ("POLYGON((0 0, 2 0, 2 2, 0 0))", "POLYGON ((0.0 0.0, 2.0 0.0, 2.0 2.0, 0.0 0.0))"),
        (" polygon  ( ( 0 0,2 0 , 2 2,0 0 ) ) ", "POLYGON ((0.0 0.0, 2.0 0.0, 2.0 2.0, 0.0 0.0))"),
        (
            "POLYGON((0 0,9 0,9 9,0 0),(5 1,6 1,6 2,5 1))",
            "POLYGON ((0.0 0.0, 9.0 0.0, 9.0 9.0, 0.0 0.0), (5.0 1.0, 6.0 1.0, 6.0 2.0, 5.0 1.0))",
        ),
        (
            "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))",
            "MULTIPOLYGON (((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0, 5.0 5.0)))",
        ),
        ("POINT(-1.5e1 +.25)", "POINT (-15.0 0.25)"),
        ("POINT(-0 0)", "POINT (0.0 0.0)"),
        ("POLYGON EMPTY", None),
        (None, None),
    ],
)
def test_wkt(spark, text, printed):
    frame = spark.createDataFrame([(text,)], "t string")
    by_column = frame.select(st_astext(st_geomfromtext("t", 4326))).first()[0]
    by_name = frame.selectExpr("st_astext(ST_GeomFromText(t, 4326))").first()[0]
    assert by_column == by_name == printed


@pytest.mark.parametrize(
    ("text", "message"),
    [
        ("LINESTRING(0 0, 1 1)", "unsupported WKT"),
        ("circle", "unsupported WKT"),
        ("", "unsupported WKT"),
        ("POLYGON((0 0, 1 0, 1 1, 5 5))", "unclosed ring"),
        ("POLYGON((0 0, 1 1, 0 0))", "unclosed ring"),
        ("POLYGON((0 0, 1 x, 1 1, 0 0))", "bad coordinates"),
        ("POLYGON((0 0, 1 NaN, 1 1, 0 0))", "bad coordinates"),
        ("POLYGON((0 0, 1 1e999, 1 1, 0 0))", "bad coordinates"),
        ("POLYGON((0 0, 1 2 3, 1 1, 0 0))", "bad coordinates"),
        ("POLYGON((0 0, 1 0, 1 1, 0 0)", "bad coordinates"),
        ("POINT(1)", "bad coordinates"),
    ],
)
def test_bad_wkt_raises(spark, text, message):
    with pytest.raises(Exception, match=message):
        spark.createDataFrame([(text,)], "t string").select(st_geomfromtext("t")).collect()


def test_many_vertices(spark):
    """No pattern repeats over vertices, so long texts do not exhaust the stack."""
    ring = ", ".join(f"{i} {i % 7}" for i in range(30_000))
    frame = spark.createDataFrame([(f"POLYGON(({ring}, 0 0))",)], "t string")
    vertices = frame.select(F.size(F.flatten(F.flatten(st_geomfromtext("t")["parts"])))).first()[0]
    assert vertices == 30_001


def test_intersects(spark):
    shapes = {"p": "POINT(1 1)", "q": "POINT(9 9)", "s": "POLYGON((0 0, 2 0, 2 2, 0 2, 0 0))"}
    g = {k: st_geomfromtext(F.lit(v), 0) for k, v in shapes.items()}
    pairs = ["pp", "pq", "ps", "sp", "qs", "sq"]
    row = _one(spark, *(st_intersects(g[a], g[b]).alias(a + b) for a, b in pairs))
    assert row.asDict() == {"pp": True, "pq": False, "ps": True, "sp": True, "qs": False, "sq": False}
    nothing = st_geomfromtext(F.lit(None).cast("string"))
    assert _one(spark, st_intersects(nothing, g["p"]))[0] is None
    with pytest.raises(Exception, match="two polygons"):
        _one(spark, st_intersects(g["s"], g["s"]))
    with pytest.raises(Exception, match="SRID mismatch"):
        _one(spark, st_intersects(st_setsrid(g["p"], 1), g["s"]))


def test_sql_join_on_predicate(spark, points, tracts):
    points.createOrReplaceTempView("t_points")
    tracts.createOrReplaceTempView("t_tracts")
    rows = spark.sql(
        """SELECT FIPS, count(*) AS n FROM t_tracts A JOIN t_points B
           ON ST_Intersects(A.geometry, B.geometry) GROUP BY FIPS"""
    ).collect()
    assert sorted(r["n"] for r in rows) == [2, 3]
