"""The cell join against brute force, under every strategy."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelgrid.functions import st_intersects
from parcelgrid.operators import add_point_geometry, spatial_join, spatial_lookup
from parcelgrid.operators import cells as C
from parcelgrid.operators import join as J
from parcelgrid.operators.skew import split_join, watched
from parcelgrid.sources import tracts_from_wkt

STRATEGIES = ["broadcast_polygons", "broadcast_points", "shuffle"]


@pytest.fixture
def strategy(request, monkeypatch):
    """Make the measured size of the index fit the wanted strategy."""
    if request.param == "broadcast_points":
        monkeypatch.setattr(C.PolygonStats, "index_bytes", lambda self, shift: 1 << 60)
    return request.param


def _ring(rnd: random.Random, x: float, y: float, radius: float, n: int) -> str:
    """A ring around a centre, often concave, at multiples of 1/8."""
    corners = []
    for i in range(n):
        angle, r = 2 * math.pi * i / n, radius * rnd.uniform(0.4, 1)
        corners.append((round((x + r * math.cos(angle)) * 8) / 8, round((y + r * math.sin(angle)) * 8) / 8))
    return "(" + ", ".join(f"{a} {b}" for a, b in (*corners, corners[0])) + ")"


@pytest.fixture(scope="module")
def random_polygons(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(40):
        x, y = rnd.uniform(-40, 40), rnd.uniform(-40, 40)
        radius, n = rnd.choice([0.5, 2, 6, 20, 45]), rnd.choice([3, 4, 9, 40, 250])
        rings = [_ring(rnd, x, y, radius, n)]
        if i % 3 == 0:
            rings.append(_ring(rnd, x, y, radius * 0.3, 6))
        part = "(" + ",".join(rings) + ")"
        if i % 5 == 0:
            other = "(" + _ring(rnd, x + 2 * radius, y, radius / 2, 7) + ")"
            rows.append((i, f"MULTIPOLYGON({part},{other})"))
        else:
            rows.append((i, f"POLYGON{part}"))
    rows.append(rows[0])
    return tracts_from_wkt(spark.createDataFrame(rows, "pid int, wkt string")).drop("wkt").cache()


@pytest.fixture(scope="module")
def random_points(spark):
    rnd = random.Random(12)
    rows = [(i, rnd.randint(-440, 440) / 8, rnd.randint(-440, 440) / 8) for i in range(2500)]
    # A third of all points are copies at one spot.
    rows += [(10_000 + i, 0.125, 0.25) for i in range(1200)]
    frame = spark.createDataFrame(rows, "id int, longitude double, latitude double")
    return add_point_geometry(frame).cache()


@pytest.fixture(scope="module")
def expected(random_points, random_polygons):
    polygons = random_polygons.withColumnRenamed("geometry", "shape")
    pairs = random_points.join(polygons, st_intersects("shape", "geometry"))
    return sorted((r["id"], r["pid"]) for r in pairs.select("id", "pid").collect())


@pytest.mark.parametrize("strategy", STRATEGIES, indirect=True)
def test_pairs_equal_brute_force(strategy, random_points, random_polygons, expected):
    broadcast = strategy != "shuffle"
    plan = J.plan_join(random_points, random_polygons, ["pid"], broadcast)
    assert plan.strategy == strategy
    assert len(plan.levels) >= 3
    pairs = spatial_join(random_points, random_polygons, ["pid"], ["id"], broadcast)
    assert sorted((r["id"], r["pid"]) for r in pairs.collect()) == expected


@pytest.mark.parametrize("strategy", STRATEGIES, indirect=True)
def test_lookup_takes_lowest_id_and_keeps_rows(
    strategy, random_points, random_polygons, expected
):
    best: dict[int, int] = {}
    for point, polygon in expected:
        best[point] = min(polygon, best.get(point, polygon))
    twice = random_points.unionAll(random_points)
    found = spatial_lookup(twice, random_polygons, ["pid"], "pid", strategy != "shuffle")
    rows = found.select("id", "pid", "parcel_matched").collect()
    assert len(rows) == 2 * random_points.count()
    assert all(r["pid"] == best.get(r["id"]) for r in rows)
    assert all(r["parcel_matched"] == (r["id"] in best) for r in rows)


def test_coarser_cells_give_the_same_pairs(
    monkeypatch, random_points, random_polygons, expected
):
    real = C.PolygonStats.index_bytes
    monkeypatch.setattr(
        C.PolygonStats, "index_bytes", lambda self, s: 1 << 60 if s < 4 else real(self, s)
    )
    assert J.plan_join(random_points, random_polygons, ["pid"]).shift == 4
    pairs = spatial_join(random_points, random_polygons, ["pid"], ["id"])
    assert sorted((r["id"], r["pid"]) for r in pairs.collect()) == expected


def test_bound_holds_for_the_real_index(random_polygons):
    stats = C.polygon_stats(random_polygons, ["pid"])
    for shift in C.SHIFTS:
        index = C.polygon_cells(random_polygons, ["pid"], shift, 0)
        rows, edges = index.agg(F.count(F.lit(1)), F.sum(F.size(C.EDGES))).first()
        assert rows <= stats.index_cells(shift)
        assert C.ROW_BYTES * rows + 32 * edges <= stats.index_bytes(shift)


def test_spread_index_is_the_same(random_polygons):
    def rows(partitions: int):
        index = C.polygon_cells(random_polygons, ["pid"], 0, partitions)
        return sorted(map(str, index.collect()))

    assert rows(0) == rows(7)


def test_edges_as_rows_give_the_same_index(spark, monkeypatch, random_polygons):
    """Every cell has the same edges, whether a polygon is worked on as a list or as rows."""

    def rows(large: bool):
        index = C.polygon_cells(random_polygons, ["pid"], 0, 0, large)
        return sorted((r["pid"], r[C.KEY], sorted(map(tuple, r[C.EDGES]))) for r in index.collect())

    by_list = rows(False)
    for edges in (0, 40):
        monkeypatch.setattr(C, "LARGE", edges)
        assert rows(True) == by_list


@pytest.mark.parametrize("strategy", ["broadcast_points"], indirect=True)
def test_wide_columns_are_not_broadcast(spark, capsys, strategy, random_points, random_polygons, expected):
    notes = F.repeat(F.col("id").cast("string"), 2_000)
    wide = random_points.select("id", notes.alias("notes"), "geometry")
    plan = J.plan_join(wide, random_polygons, ["pid"])
    assert plan.strategy == strategy
    pairs = spatial_join(wide, random_polygons, ["pid"], ["id", "notes"])
    assert sorted((r["id"], r["pid"]) for r in pairs.select("id", "pid").collect()) == expected
    assert pairs.where(F.col("notes") != notes).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs.explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sent = re.findall(r"\(\d+\) BroadcastExchange\nInput \[\d+\]: (.*)", capsys.readouterr().out)
    assert sent and not any("notes" in columns for columns in sent)


@pytest.mark.parametrize("strategy", STRATEGIES, indirect=True)
def test_pairs_of_large_polygons(strategy, monkeypatch, random_points, random_polygons, expected):
    monkeypatch.setattr(C, "LARGE", 20)
    monkeypatch.setattr(C, "HEAVY", 2)
    pairs = spatial_join(random_points, random_polygons, ["pid"], ["id"], strategy != "shuffle")
    assert sorted((r["id"], r["pid"]) for r in pairs.collect()) == expected


@pytest.mark.parametrize("broadcast", [True, False])
def test_boundary_points_count_for_each_polygon(spark, broadcast):
    fields = [
        (0, "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"),
        (1, "POLYGON((4 0, 8 0, 8 4, 4 4, 4 0))"),
        (2, "POLYGON((0 4, 4 4, 4 8, 0 8, 0 4))"),
        (3, "POLYGON((10 0, 20 0, 20 10, 10 10, 10 0), (12 2, 12 8, 18 8, 18 2, 12 2))"),
        (4, "POLYGON((-4 -4, 0 -4, -4 0, -4 -4))"),
    ]
    spots = {
        "corner of three": (4.0, 4.0, [0, 1, 2]),
        "shared edge": (4.0, 2.0, [0, 1]),
        "vertex": (8.0, 0.0, [1]),
        "in the hole": (15.0, 5.0, []),
        "edge of the hole": (12.0, 5.0, [3]),
        "corner of the hole": (18.0, 8.0, [3]),
        "beside the hole": (11.0, 5.0, [3]),
        "slope": (-2.0, -2.0, [4]),
        "negative side": (-3.0, -3.0, [4]),
        "outside": (-1.0, -1.0, []),
        "top edge": (2.0, 8.0, [2]),
    }
    polygons = tracts_from_wkt(spark.createDataFrame(fields, "pid int, wkt string"))
    points = add_point_geometry(
        spark.createDataFrame(
            [(name, x, y) for name, (x, y, _) in spots.items()],
            "name string, longitude double, latitude double",
        )
    )
    found: dict[str, list[int]] = {name: [] for name in spots}
    for r in spatial_join(points, polygons, ["pid"], ["name"], broadcast).collect():
        found[r["name"]].append(r["pid"])
    assert {k: sorted(v) for k, v in found.items()} == {k: v[2] for k, v in spots.items()}


def test_null_geometries_never_match(spark, tracts):
    points = add_point_geometry(
        spark.createDataFrame(
            [("1", None), (None, "1"), ("NaN", "1"), ("x", "1")], "longitude string, latitude string"
        )
    )
    assert points.filter("geometry IS NOT NULL").count() == 0
    assert spatial_join(points, tracts, ["FIPS"], []).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_srid_mismatch_raises_even_far_away(spark, tracts, broadcast):
    points = add_point_geometry(
        spark.createDataFrame([(-1e7, 4e6)], "longitude double, latitude double"), srid=3857
    )
    with pytest.raises(Exception, match="SRID mismatch"):
        spatial_join(points, tracts, ["FIPS"], [], broadcast).collect()


def test_polygons_of_two_srids_raise(points, tracts):
    from parcelgrid.functions import st_setsrid

    other = tracts.withColumn("geometry", st_setsrid("geometry", 3857))
    with pytest.raises(ValueError, match="several SRIDs"):
        spatial_join(points, tracts.unionAll(other), ["FIPS"], ["call_num"])


def test_polygon_on_the_point_side_raises(tracts):
    renamed = tracts.select(F.col("FIPS").alias("id"), "geometry")
    with pytest.raises(Exception, match="point side"):
        spatial_join(renamed, tracts, ["FIPS"], ["id"]).collect()


@pytest.fixture(params=["adaptive", "watched"])
def skew(request, spark):
    """Hot keys split by the shuffle itself, or by a sketch of the written rows."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": str(request.param == "adaptive").lower(),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_few_and_found(spark):
    keys = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 3 = 1 THEN id END AS k", "id")
    written, hot = watched(keys, ["k"])
    assert written.count() == 30_000
    assert len(hot) == 1
    # Half of the rows with a key is cut into half of the pieces there may be.
    assert list(hot.values()) == [8]
    assert watched(keys.limit(0), ["k"])[1] == {}


def test_no_hot_key_escapes_the_sketch(spark):
    """Twelve keys just above the share of a hot one, among as many rare keys as there are rows left."""
    keys = spark.range(64_000).selectExpr("CASE WHEN id % 15 < 12 THEN -(id % 15) - 1 ELSE id END AS k")
    _, hot = watched(keys, ["k"])
    want = {r[0] for r in spark.range(12).select(F.xxhash64(-F.col("id") - 1)).collect()}
    assert set(hot) == want and set(hot.values()) == {2}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_a_plain_join(spark, skew, how):
    left = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 WHEN id % 7 = 0 THEN NULL ELSE id % 500 END AS k", "id")
    copies = "explode(sequence(1, if(id % 501 = 7, 300, 1)))" if how == "inner" else "1"
    right = spark.range(501).selectExpr("id - 1 AS k", "id * 10 AS r", f"{copies} AS c")
    joined = split_join(left, right, ["k"], how, split_right=how == "inner")
    plain = left.join(right, ["k"], how)
    digest = [F.count(F.lit(1)), F.sum(F.xxhash64("k", "id", "r", "c").cast("decimal(38,0)"))]
    assert joined.agg(*digest).first() == plain.agg(*digest).first()
    if skew == "adaptive":
        joined.toPandas()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan


def test_points_are_read_once_by_the_join_and_twice_by_the_lookup(spark, skew, random_points, random_polygons):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept = random_points.select("id", "geometry")
    watched_points = kept.mapInArrow(count, kept.schema)
    n = kept.count()
    pairs = spatial_join(watched_points, random_polygons, ["pid"], ["id"], broadcast=False)
    assert pairs.count() > 0 and seen.value == n
    spatial_lookup(watched_points, random_polygons, ["pid"], "pid", False).write.format("noop").mode("overwrite").save()
    assert seen.value == 3 * n


@pytest.mark.parametrize("side", ["pairs", "lookup"])
def test_shuffled_results_are_the_same_however_hot_keys_are_split(skew, side, random_points, random_polygons, expected):
    if side == "pairs":
        pairs = spatial_join(random_points, random_polygons, ["pid"], ["id"], False)
        assert sorted((r["id"], r["pid"]) for r in pairs.collect()) == expected
    else:
        found = spatial_lookup(random_points, random_polygons, ["pid"], "pid", False).collect()
        best = {}
        for point, polygon in expected:
            best[point] = min(polygon, best.get(point, polygon))
        assert len(found) == random_points.count() and all(r["pid"] == best.get(r["id"]) for r in found)
