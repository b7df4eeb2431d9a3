"""Totals and lookups by grid cells give what all pairs would give, without making them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parcelgrid.operators import cells as C
from parcelgrid.operators import grid, roadcalls_per_tract, spatial_join, spatial_lookup
from parcelgrid.operators.join import located, plan_join
from parcelgrid.operators.points import add_point_geometry
from parcelgrid.sources import tracts_from_wkt


def _ring(*corners):
    return "(" + ", ".join(f"{x} {y}" for x, y in (*corners, corners[0])) + ")"


def _square(x, y, side):
    return _ring((x, y), (x + side, y), (x + side, y + side), (x, y + side))


def _text(rng):
    x, y, side = rng.randrange(-640, 640) / 64, rng.randrange(-640, 640) / 64, rng.choice([0.25, 1.5, 6.0, 12.0])
    third = side / 4
    return rng.choice(
        [
            f"POLYGON({_square(x, y, side)})",
            f"POLYGON({_square(x, y, side)}, {_square(x + third, y + third, third)})",
            f"POLYGON({_ring((x, y), (x + side, y + third), (x + third, y + side))})",
            f"MULTIPOLYGON(({_square(x, y, third)}), ({_square(x + 2 * third, y, third)}))",
        ]
    )


@pytest.fixture(scope="module")
def shapes(spark):
    rng = random.Random(5)
    rows = [(i // 2 if i < 20 else i, _text(rng)) for i in range(120)]
    rows += [(500, None), (None, f"POLYGON({_square(-9, -9, 15)})"), (501, f"POLYGON({_square(900, 900, 1)})")]
    return tracts_from_wkt(spark.createDataFrame(rows, "pid long, wkt string")).drop("wkt").localCheckpoint()


@pytest.fixture(scope="module")
def spots(spark):
    rng = random.Random(6)
    rows = [
        (i if i % 9 else None, rng.randrange(-64, 64) / 4, rng.randrange(-640, 640) / 64) for i in range(2500)
    ] + [(9000 + i, 0.125, 0.125) for i in range(300)] + [(1, None, 1.0), (2, 5000.0, 1.0)]
    points = spark.createDataFrame(rows, "call_num long, longitude double, latitude double")
    return add_point_geometry(points).drop("longitude", "latitude").localCheckpoint()


@pytest.fixture
def always(monkeypatch):
    monkeypatch.setattr(grid, "FEW", -1)
    monkeypatch.setattr(grid, "TESTS", -1)
    monkeypatch.setattr(grid, "SPOTS", 8)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1 << 40, 0])
def test_totals_are_those_of_all_pairs(shapes, spots, always, limit):
    pairs = spatial_join(spots, shapes, ["pid"], ["call_num"])
    expected = pairs.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.sum("call_num").alias("total"))
    spots.sparkSession.conf.set("spark.parcelgrid.broadcastLimit", str(limit))
    try:
        found = spatial_join(spots, shapes, ["pid"], ["call_num"], totals={"n": None, "total": "call_num"})
        assert found.columns == ["pid", "n", "total"] and found.dtypes == expected.dtypes
        assert _rows(found) == _rows(expected)
    finally:
        spots.sparkSession.conf.unset("spark.parcelgrid.broadcastLimit")


def test_totals_without_the_grid(shapes, spots):
    pairs = spatial_join(spots, shapes, ["pid"], ["call_num"])
    expected = pairs.groupBy("pid").agg(F.sum("call_num").alias("total"))
    assert _rows(spatial_join(spots, shapes, ["pid"], ["call_num"], totals={"total": "call_num"})) == _rows(expected)


@pytest.mark.parametrize("large", [10_000, 5])
def test_counts_by_grid(shapes, spots, large, monkeypatch):
    polygons = shapes.unionAll(shapes.where("pid < 30"))
    expected = _rows(roadcalls_per_tract(spots, polygons, ["pid"]).drop("geometry"))
    for name, value in (("FEW", -1), ("TESTS", -1), ("SPOTS", 8)):
        monkeypatch.setattr(grid, name, value)
    monkeypatch.setattr(C, "LARGE", large)
    monkeypatch.setattr(C, "HEAVY", 2)  # cells finer than the grid
    assert _rows(roadcalls_per_tract(spots, polygons, ["pid"]).drop("geometry")) == expected


def test_no_points_near(shapes, spots, always):
    far = shapes.where("pid = 501")
    assert spatial_join(spots, far, ["pid"], ["call_num"], totals={"n": None}).collect() == []
    assert roadcalls_per_tract(spots, far, ["pid"]).collect() == []


def test_lookup_by_grid(shapes, spots, monkeypatch):
    parcels = shapes.where("pid IS NOT NULL").withColumnRenamed("pid", "parcel_id")
    expected = _rows(spatial_lookup(spots, parcels, ["parcel_id"]).drop("geometry"))
    for name, value in (("FEW", -1), ("TESTS", -1), ("SPOTS", 8)):
        monkeypatch.setattr(grid, name, value)
    assert _rows(spatial_lookup(spots, parcels, ["parcel_id"]).drop("geometry")) == expected
    far = parcels.where("parcel_id = 501")
    assert not any(r.parcel_matched for r in spatial_lookup(spots, far, ["parcel_id"]).collect())


def test_only_borders_meet_points(spark, spots, always):
    """Of polygons that hold nearly all points, few points are looked at one by one."""
    rows = [(i, f"POLYGON({_square(-15.6, -9.9, 25.0 + i / 64)})") for i in range(200)]
    polygons = tracts_from_wkt(spark.createDataFrame(rows, "pid long, wkt string")).drop("wkt")
    stats = plan_join(spots, polygons, ["pid"]).stats
    near = located(spots, stats.srid, [F.col("call_num")])
    cells, level = grid.counted(near, stats, [])
    held, plain, tested = grid._cut_down(polygons, ["pid"], stats, 0, cells, level, ["__n"], 1 << 28, True)
    pairs = spatial_join(spots, polygons, ["pid"], []).count()
    looked_at = sum(rows.agg(F.sum("__n")).first()[0] or 0 for rows in (*plain, *tested))
    assert pairs > 300_000 and looked_at < pairs / 4
