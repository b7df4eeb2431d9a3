"""Crowded cells of the lookup: lists stay short and answers stay the lowest id."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from parcelgrid.operators import add_point_geometry, spatial_lookup
from parcelgrid.operators import cells as C
from parcelgrid.operators import lookup as L
from parcelgrid.operators.join import BROADCAST_LIMIT_CONF, broadcast_limit, indexed, plan_join
from parcelgrid.sources import tracts_from_wkt


def _box(x0, y0, x1, y1):
    return f"(({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"


def _parcels(spark, boxes):
    rows = [(i, "POLYGON" + _box(*box)) for i, box in boxes]
    return tracts_from_wkt(spark.createDataFrame(rows, "parcel_id long, wkt string")).drop("wkt")


def _points(spark, spots):
    frame = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(spots)], "id int, longitude double, latitude double")
    return add_point_geometry(frame)


def _longest(points, parcels):
    plan = plan_join(points, parcels, ["parcel_id"])
    shapes = L._lowest_per_shape(parcels, ["parcel_id"])
    rows, _ = L.arranged(indexed(shapes, ["parcel_id"], plan)[0], ["parcel_id"], broadcast_limit(points))
    before = C.polygon_cells(shapes, ["parcel_id"], plan.shift, 0)
    longest = [df.groupBy(C.KEY).count().agg(F.max("count")).first()[0] for df in (before, rows)]
    return (*longest, rows.count())


def _check(spark, boxes, spots):
    points, parcels = _points(spark, spots), _parcels(spark, boxes)
    found = {r.id: r.parcel_id for r in spatial_lookup(points, parcels, ["parcel_id"]).collect()}
    for i, (x, y) in enumerate(spots):
        held = [p for p, (x0, y0, x1, y1) in boxes if x0 <= x <= x1 and y0 <= y <= y1]
        assert found[i] == min(held, default=None)
    return points, parcels


@pytest.fixture
def room(spark):
    spark.conf.set(BROADCAST_LIMIT_CONF, str(1 << 30))
    yield
    spark.conf.unset(BROADCAST_LIMIT_CONF)


@pytest.mark.parametrize("order", ["outwards", "inwards", "mixed"])
def test_a_thousand_nested_parcels(spark, order, room):
    rng = random.Random(5)
    ids = list(range(1000))
    if order == "inwards":
        ids.reverse()
    elif order == "mixed":
        rng.shuffle(ids)
    boxes = [(ids[k], (-(k + 1) / 64, -(k + 1) / 64, (k + 1) / 64, (k + 1) / 64)) for k in range(1000)]
    spots = [(rng.randrange(-1100, 1100) / 64, rng.randrange(-1100, 1100) / 64) for _ in range(1500)]
    points, parcels = _check(spark, boxes, spots)
    before, after, rows = _longest(points, parcels)
    assert before > 400 and after <= L.CROWD
    assert rows < 500_000


def test_parcels_that_share_a_border(spark):
    """Strips with one common side: no division parts them there, but one of them is enough."""
    boxes = [(i, (0, 0, 16, 1 + (i * 7 % 300) / 64)) for i in range(300)]
    rng = random.Random(6)
    spots = [(rng.randrange(-8, 17 * 8) / 8, rng.randrange(-8, 7 * 64) / 64) for _ in range(800)] + [(0.0, 0.0), (16.0, 0.0)]
    _check(spark, boxes, spots)


def test_parcels_through_one_corner_stop_dividing(spark, monkeypatch):
    """More parcels than a list should hold meet at one point: still right, and the work ends."""
    boxes = [(i, (0, 0, 1 + i / 16, 1 + (80 - i) / 16)) for i in range(80)]
    spots = [(x / 16, y / 16) for x in range(-1, 60, 3) for y in range(-1, 60, 3)]
    _check(spark, boxes, spots)
    monkeypatch.setattr(C, "GROWTH", 1 << 40)  # no room to divide: lists stay, answers too
    points, parcels = _check(spark, boxes, spots)
    assert _longest(points, parcels)[1] > L.CROWD


def test_divided_cells_give_the_same_answers(spark, monkeypatch):
    """All cells divided several times, whatever they hold, for shapes of all kinds."""
    monkeypatch.setattr(L, "CROWD", 0)
    monkeypatch.setattr(L, "ROUNDS", 2)
    rng = random.Random(7)
    rows = []
    for i in range(25):
        x, y, r = rng.randrange(-160, 160) / 8, rng.randrange(-160, 160) / 8, rng.choice([0.5, 3, 11])
        rows.append((i, f"POLYGON(({x} {y - r}, {x + r} {y}, {x} {y + r}, {x - r} {y}, {x} {y - r}), ({x} {y - r / 4}, {x + r / 4} {y}, {x} {y + r / 4}, {x} {y - r / 4}))"))
    parcels = tracts_from_wkt(spark.createDataFrame(rows, "parcel_id long, wkt string")).drop("wkt")
    points = _points(spark, [(rng.randrange(-300, 300) / 16, rng.randrange(-300, 300) / 16) for _ in range(1500)])
    divided = spatial_lookup(points, parcels, ["parcel_id"])
    plain = spatial_lookup(points, parcels, ["parcel_id"], broadcast=False)
    assert sorted(map(str, divided.select("id", "parcel_id").collect())) == sorted(map(str, plain.select("id", "parcel_id").collect()))
