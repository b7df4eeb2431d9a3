"""Counts per tract on the sample files, and the edge rules of the count."""

from __future__ import annotations

import pytest

from parcelgrid.operators import add_point_geometry, count_points_per_polygon, roadcalls_per_tract
from parcelgrid.sources import tracts_from_wkt
from parcelgrid.types import TRACT_COLS

SQUARE = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"


def test_point_geometry_has_srid(points):
    assert points.selectExpr("geo_srid(geometry) AS srid").first()["srid"] == 4326


def test_counts_per_tract(points, tracts):
    counts = roadcalls_per_tract(points, tracts, TRACT_COLS)
    assert counts.columns == [*TRACT_COLS, "roadcall_count", "geometry"]
    found = {r["FIPS"]: r["roadcall_count"] for r in counts.collect()}
    assert found == {"29189000300": 3, "29095000400": 2}


def test_no_null_geometry(points, tracts):
    assert roadcalls_per_tract(points, tracts, TRACT_COLS).filter("geometry IS NULL").count() == 0


def test_two_calls_in_one_session_do_not_mix(points, tracts):
    first = roadcalls_per_tract(points, tracts, ["FIPS"])
    second = roadcalls_per_tract(points.limit(0), tracts, ["FIPS"])
    assert second.count() == 0
    assert first.count() == 2


@pytest.mark.parametrize("broadcast", [True, False])
def test_count_rules(spark, broadcast):
    calls = spark.createDataFrame(
        [("a", 1.0, 1.0), ("a", 1.0, 1.0), (None, 2.0, 2.0), (None, 11.0, 1.0), ("b", None, 1.0)],
        "call_num string, longitude double, latitude double",
    )
    tracts = tracts_from_wkt(
        spark.createDataFrame(
            [
                ("one", None, SQUARE),
                ("two", "x", "POLYGON((10 0, 12 0, 12 2, 10 2, 10 0))"),
                ("twin", "x", SQUARE),
                ("twin", "x", SQUARE),
                ("none", "x", "POLYGON((50 50, 51 50, 51 51, 50 50))"),
                ("null", "x", None),
            ],
            "name string, tag string, wkt string",
        )
    )
    counts = roadcalls_per_tract(add_point_geometry(calls), tracts, ["name", "tag"], broadcast=broadcast)
    found = {(r["name"], r["tag"]): r["roadcall_count"] for r in counts.collect()}
    # Ids are not distinct, NULL ids do not count, twins count each call twice.
    assert found == {("one", None): 2, ("two", "x"): 0, ("twin", "x"): 4}


def test_no_tract_columns(points, tracts):
    counts = roadcalls_per_tract(points, tracts, [])
    assert sorted(r["roadcall_count"] for r in counts.collect()) == [2, 3]


def test_no_polygons(points, tracts):
    assert roadcalls_per_tract(points, tracts.limit(0), ["FIPS"]).count() == 0


def test_nulls_in_different_columns_are_different_groups(spark, points):
    tracts = tracts_from_wkt(
        spark.createDataFrame(
            [("a", None, SQUARE), (None, "a", SQUARE)], "p string, q string, wkt string"
        )
    )
    calls = add_point_geometry(
        spark.createDataFrame([(1, 1.0, 1.0)], "n int, longitude double, latitude double")
    )
    counts = count_points_per_polygon(calls, tracts, ["p", "q"], "n", "calls")
    assert {(r["p"], r["q"], r["calls"]) for r in counts.collect()} == {("a", None, 1), (None, "a", 1)}


def test_plan_is_compiled_joins_without_python(points, tracts):
    plan = roadcalls_per_tract(points, tracts, ["FIPS"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_shuffle_plan(points, tracts):
    counts = roadcalls_per_tract(points, tracts, ["FIPS"], broadcast=False)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_join_stage_fits_the_jit_limit(spark, points, tracts):
    """Methods over 8000 bytes of bytecode stay interpreted, many times slower."""
    from parcelgrid.operators import spatial_join

    pairs = spatial_join(points, tracts, ["FIPS", "POPULATION"], ["call_num"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = pairs._jdf.queryExecution().debug().codegenToSeq()
        sizes = {
            stages.apply(i)._1(): stages.apply(i)._3().maxMethodCodeSize()
            for i in range(stages.size())
        }
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = [size for plan, size in sizes.items() if "BroadcastHashJoin" in plan]
    assert joins and max(joins) < 8000
