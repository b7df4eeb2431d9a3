"""Spatial join of points with polygons, as an equi-join on cells."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelgrid.functions import expressions as E
from parcelgrid.functions.geometry import once, record
from parcelgrid.operators import cells as C
from parcelgrid.operators import grid
from parcelgrid.operators.cells import POINT_X as X
from parcelgrid.operators.cells import POINT_Y as Y
from parcelgrid.operators.skew import split_join
from parcelgrid.session import written

ROW = "__row"

BROADCAST_LIMIT_CONF = "spark.parcelgrid.broadcastLimit"
# Spread polygons over tasks before indexing when at least this many cells come out.
SPREAD_FROM_CELLS = 20_000
# Cells per polygon to aim for where the index is shuffled.
SHUFFLED_CELLS = 8


@dataclass(frozen=True)
class JoinPlan:
    """How a join is run: ``broadcast_polygons``, ``broadcast_points`` or ``shuffle``."""

    strategy: str
    shift: int
    stats: C.PolygonStats

    @property
    def levels(self) -> list[int]:
        return self.stats.levels_at(self.shift)


def broadcast_limit(df: DataFrame) -> int:
    """Largest side in bytes that may be broadcast; 256 MiB unless the session says more."""
    return int(df.sparkSession.conf.get(BROADCAST_LIMIT_CONF, str(256 << 20)))


def plan_join(
    points: DataFrame, polygons: DataFrame, payload: list[str], broadcast: bool = True
) -> JoinPlan:
    """Measure the polygon side, then choose.

    1. The polygon index fits the limit (if need be with coarser cells): broadcast it.
    2. The points fit, that is, their coordinates: broadcast them, and stream over the polygons.
    3. Neither, or ``broadcast=False``: shuffle both on cells, hot cells split.
    """
    stats = C.polygon_stats(polygons, payload)
    limit = broadcast_limit(points)
    if broadcast:
        for shift in C.SHIFTS:
            if stats.index_bytes(shift) <= limit:
                return JoinPlan("broadcast_polygons", shift, stats)
        row_limit = limit // (C.ROW_BYTES * max(1, len(stats.levels)))
        # Counted in tasks, each of which stops where there are too many rows.
        if points.select().limit(row_limit + 1).count() <= row_limit:
            return JoinPlan("broadcast_points", 2, stats)
    # The finest cells that do not repeat polygons too often in the shuffle.
    polygons = sum(level.polygons for level in stats.levels)
    few = (s for s in C.SHIFTS if stats.index_cells(s) <= SHUFFLED_CELLS * polygons)
    return JoinPlan("shuffle", next(few, C.SHIFTS[-1]), stats)


def located(points: DataFrame, srid: int, keep: list[Column]) -> DataFrame:
    """Points that have coordinates, as ``keep`` plus x and y.

    A point of another SRID raises, so that it never looks like an empty result.
    """
    spot = record(x=F.expr(checked(srid, "geometry.bbox.xmin")), y=F.expr("geometry.bbox.ymin"))
    return (
        points.select(*keep, "geometry")
        .select(*(F.col(c) for c in _names(points, keep)), once(spot).alias("__spot"))
        .select(*_names(points, keep), F.expr(f"__spot.x AS {X}"), F.expr(f"__spot.y AS {Y}"))
        .where(f"{X} IS NOT NULL AND {Y} IS NOT NULL")
    )


def _names(points: DataFrame, keep: list[Column]) -> list[str]:
    return points.select(*keep).columns


def checked(srid: int, value: str) -> str:
    """``value`` for a point of the polygons' SRID; any other geometry raises."""
    return (
        f"CASE WHEN geometry.srid <> {srid} THEN CAST(raise_error(concat("
        f"'SRID mismatch: polygons have {srid}, a point has ', geometry.srid)) AS DOUBLE) "
        f"WHEN geometry.kind <> 'POINT' THEN CAST(raise_error("
        f"'the point side holds a polygon') AS DOUBLE) ELSE {value} END"
    )


def indexed(polygons: DataFrame, payload: list[str], plan: JoinPlan) -> tuple[DataFrame, list[int]]:
    """The cell index, and the levels of its keys."""
    cells = plan.stats.index_cells(plan.shift)
    partitions = 0
    if cells >= SPREAD_FROM_CELLS:
        partitions = max(
            polygons.sparkSession.sparkContext.defaultParallelism, cells // SPREAD_FROM_CELLS
        )
    large = plan.stats.most_edges > C.LARGE
    index = C.polygon_cells(
        polygons, payload, plan.shift, partitions, large, broadcast_limit(polygons)
    )
    return index, C.levels_of(index) if large else plan.levels


def _no_pairs(spots: DataFrame, polygons: DataFrame, payload: list[str]) -> DataFrame:
    return spots.join(polygons.select(*payload), F.lit(False)).drop(X, Y)


_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Columns of fixed size that a broadcast point may carry: with its key they fit C.ROW_BYTES.
CARRIED = 8


def _small_rows(spots: DataFrame) -> bool:
    own = [f for f in spots.schema if f.name not in (X, Y)]
    return len(own) <= CARRIED and all(isinstance(f.dataType, _FIXED) for f in own)


def match_pairs(
    spots: DataFrame, polygons: DataFrame, payload: list[str], plan: JoinPlan
) -> DataFrame:
    """Rows of ``spots`` (any columns plus x and y) with the ``payload`` of each polygon hit.

    Where points are broadcast, only coordinates and a row number go, unless the other
    columns are small; the rest is attached to the pairs by that number.
    """
    kept = [*spots.columns, *payload]
    if plan.strategy == "broadcast_points" and not _small_rows(spots):
        numbered = written(spots.select("*", F.monotonically_increasing_id().alias(ROW)), "points")
        pairs = match_pairs(numbered.select(ROW, X, Y), polygons, payload, plan)
        return pairs.drop(X, Y).join(numbered, ROW).select(*kept)

    def probes_at(levels: list[int]) -> DataFrame:
        return spots.select("*", C.point_keys(X, Y, levels)).where(f"{C.KEY} IS NOT NULL")

    if plan.strategy == "broadcast_points" and plan.stats.most_edges <= C.LARGE:
        candidates = C.box_cells(polygons, payload, plan.shift)
        pairs = candidates.join(F.broadcast(probes_at(plan.levels)), C.KEY)
        return pairs.where(E.polygon_hit("g", X, Y)).select(*kept)

    index, levels = indexed(polygons, payload, plan)
    index, probes = C.with_slots(index), probes_at(levels)
    may_hit, hit = C.slots_may_hit(X, Y), C.slots_hit(X, Y)
    if plan.strategy == "broadcast_polygons":
        met = probes.join(F.broadcast(index), C.KEY).where(may_hit)
    elif plan.strategy == "broadcast_points":
        met = index.join(F.broadcast(probes), C.KEY).where(may_hit)
    else:
        met = split_join(probes, index, [C.KEY], condition=may_hit)
    # The second test needs a lambda, which has no generated code. The id, never negative
    # and not deterministic, keeps it out of the join above, which stays compiled whole.
    return met.where(hit | (F.monotonically_increasing_id() < 0)).select(*kept)


def spatial_join(
    points: DataFrame,
    polygons: DataFrame,
    polygon_cols: list[str] | None = None,
    point_cols: list[str] | None = None,
    broadcast: bool = True,
    totals: dict[str, str | None] | None = None,
) -> DataFrame:
    """Inner join of points and polygons on "intersects", boundary included.

    Both sides need a ``geometry`` column of the same SRID. Gives the chosen columns of
    both sides (by default all but ``geometry``); names must not repeat. A point pairs
    with every polygon it touches; rows with a NULL geometry never match.

    With ``totals`` the pairs are grouped by the polygon columns: each name becomes the sum of
    a chosen point column, or with None the number of pairs. Where there are very many pairs,
    points in a cell that a polygon holds whole are then added as one.
    """
    payload = polygon_cols if polygon_cols is not None else _attributes(polygons)
    keep = point_cols if point_cols is not None else _attributes(points)
    repeated = set(payload) & set(keep)
    if repeated:
        raise ValueError(f"columns on both sides of the join: {sorted(repeated)}")
    if totals is not None:
        polygons = written(polygons.select(*payload, "geometry"), "polygons")
    plan = plan_join(points, polygons, payload, broadcast)
    if not plan.stats.levels:
        empty = points.select(*keep, F.lit(0.0).alias(X), F.lit(0.0).alias(Y))
        pairs = _no_pairs(empty, polygons, payload)
        return pairs if totals is None else _grouped(pairs, payload, totals)
    spots = located(points, plan.stats.srid, [F.col(c) for c in keep])
    if totals is not None and grid.pays(points, plan.stats, plan.strategy == "broadcast_polygons"):
        sums = list(dict.fromkeys(c for c in totals.values() if c is not None))
        found = grid.polygon_totals(spots, polygons, payload, sums, _PAIRS, plan.stats, broadcast_limit(points))
        return found.select(*payload, *(F.col(c or _PAIRS).alias(name) for name, c in totals.items()))
    pairs = match_pairs(spots, polygons, payload, plan).drop(X, Y)
    return pairs if totals is None else _grouped(pairs, payload, totals)


_PAIRS = "__pairs"


def _grouped(pairs: DataFrame, payload: list[str], totals: dict[str, str | None]) -> DataFrame:
    sums = (F.count(F.lit(1)) if c is None else F.sum(c) for c in totals.values())
    return pairs.groupBy(*payload).agg(*(total.alias(name) for total, name in zip(sums, totals)))


def _attributes(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "geometry"]
