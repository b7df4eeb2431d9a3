"""Joins on a grid: what polygons that overlap much, or have very many edges, need instead
of one test per point and candidate.

Points are counted per cell of one level, so fine that an average point shares its cell with
about ``SPOTS`` others, and the counts are added up for the coarser levels. Polygons are cut
down to the same cells, coarsest first: a cell without points is dropped, and a cell that a
polygon holds whole gives its totals without a look at its points. Only cells that a border
passes meet their points, so the work follows the borders and not the areas.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, floor, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions import expressions as E
from parcelgrid.operators import cells as C
from parcelgrid.operators.skew import split_join
from parcelgrid.session import written

X, Y = C.POINT_X, C.POINT_Y

# Candidates an average point may have, and all points together, before the grid pays.
FEW = 8
TESTS = 500_000_000
# Points a cell should hold, and how often finer cells are tried where they clump.
SPOTS = 1024
FINER = 4
# Cells to work on in one task, and bytes of one in a broadcast table of cells.
TASK_CELLS = 20_000
CELL_BYTES = 128

_AT = "__at"
_N = "__n"
_STEP = "__step"
_COVERED, _PLAIN, _TESTED, _CUT = range(4)


def pays(points: DataFrame, stats: C.PolygonStats, broadcast: bool) -> bool:
    """Whether points have so many candidates, or polygons so many edges, that one test per
    pair is too much. ``broadcast`` says that an index divided to the limit is broadcast."""
    if stats.most_edges > C.LARGE and not broadcast:
        return True
    overlap = stats.overlap()
    return overlap > FEW and points.select().count() * overlap > TESTS


def _fit(box: tuple[float, float, float, float]) -> int:
    """The finest level at which all cell numbers of the box fit the key."""
    far = max(map(abs, box))
    lowest = max(C.MIN_LEVEL, ceil(log2(far)) - (C.CELL_BITS - 2) if far else C.MIN_LEVEL)
    return C.LEVEL_STEP * ceil(lowest / C.LEVEL_STEP)


def counted(
    spots: DataFrame, stats: C.PolygonStats, sums: list[str], shift: int = 0
) -> tuple[DataFrame, int]:
    """Number of points and ``sums`` per cell, at the level chosen and all coarser ones in
    use, and that level."""
    xmin, ymin, xmax, ymax = stats.box
    lowest, top = _fit(stats.box), max(stats.levels_at(shift))
    inside = spots.where(F.col(X).between(xmin, xmax) & F.col(Y).between(ymin, ymax))
    n = max(1, inside.count())
    side = max((xmax - xmin) * (ymax - ymin), max(xmax - xmin, ymax - ymin) ** 2 / n) * SPOTS / n
    guess = C.LEVEL_STEP * floor(log2(side) / 2 / C.LEVEL_STEP) if side else lowest
    level = max(lowest, min(guess, top))
    for left in range(FINER, -1, -1):
        key = F.expr(f"{C.point_key(X, Y, level)} AS {C.KEY}")
        totals = [F.count(F.lit(1)).alias(_N), *(F.sum(name).alias(name) for name in sums)]
        cells = written(inside.groupBy(key).agg(*totals), "cell-totals")
        crowd = cells.agg(F.sum(F.col(_N).cast("double") * F.col(_N)) / F.sum(_N)).first()[0] or 0
        if not left or crowd <= 4 * SPOTS or level - C.LEVEL_STEP < lowest:
            break
        level -= C.LEVEL_STEP
    levels = ", ".join(str(each) for each in range(level, max(level, top) + 1, C.LEVEL_STEP))
    above = cells.select("*", F.expr(f"explode(array({levels})) AS __up"))
    above = above.select(F.expr(f"{C.ancestor('__up')} AS {_AT}"), _N, *sums)
    above = above.groupBy(_AT).agg(*(F.sum(name).alias(name) for name in (_N, *sums)))
    return written(above, "cell-totals"), level


def _cut_down(
    polygons: DataFrame,
    payload: list[str],
    stats: C.PolygonStats,
    shift: int,
    cells: DataFrame,
    level: int,
    kept: list[str],
    limit: int,
    whole: bool,
    reduced: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Polygon rows by cell: those that hold their cell (if ``whole``), those to be tested with
    few edges and in a cell of ``level``, and the others to be tested.

    Cells coarser than ``level`` are divided, and of finer ones those with many edges. The
    rows carry the ``kept`` columns of their cell, and in ``__at`` the cell whose points they
    meet. ``reduced`` may drop rows of a cell before it is divided.
    """
    parallelism = polygons.sparkSession.sparkContext.defaultParallelism
    if cells.count() * CELL_BYTES <= limit:
        cells = F.broadcast(cells)
    at = F.expr(f"CASE WHEN {C.KEY_LEVEL} < {level} THEN {C.ancestor(str(level))} ELSE {C.KEY} END AS {_AT}")
    covered = f"{whole} AND {C.KEY_LEVEL} >= {level} AND {C.COVERS}"
    heavy = (
        f"size({C.EDGES}) > {C.HEAVY} AND {C.DIVISIBLE}"
        f" AND {C.KEY_LEVEL} > {level - C.DIVISIONS * C.LEVEL_STEP}"
    )
    step = F.expr(
        f"CASE WHEN {covered} THEN {_COVERED} WHEN {C.KEY_LEVEL} > {level} OR ({heavy}) THEN {_CUT}"
        f" WHEN {C.KEY_LEVEL} = {level} AND size({C.EDGES}) <= {C.SLOTS} THEN {_PLAIN} ELSE {_TESTED} END"
    )
    partitions = max(parallelism, stats.index_cells(shift) // TASK_CELLS)
    rows = C.polygon_cells(polygons, payload, shift, partitions, stats.most_edges > C.LARGE)
    kinds: dict[int, list[DataFrame]] = {_COVERED: [], _PLAIN: [], _TESTED: []}
    while True:
        rows = rows.select(*payload, C.KEY, C.EDGES, at)
        rows = rows.join(cells.select(_AT, *kept), _AT)
        if reduced is not None:
            rows = reduced(rows).select("*", at)
        rows = written(rows.select("*", step.alias(_STEP)), "grid-cells")
        counts = {r[0]: r[1] for r in rows.groupBy(_STEP).count().collect()}
        for kind, found in kinds.items():
            found += [rows.where(f"{_STEP} = {kind}")] if kind in counts else []
        if _CUT not in counts:
            return tuple(kinds.values())
        cut = rows.where(f"{_STEP} = {_CUT}").select(*payload, C.KEY, C.EDGES)
        cut = cut.repartition(max(2 * parallelism, counts[_CUT] // TASK_CELLS))
        rows = C.divided(cut, payload)


def _all(parts: list[DataFrame]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _met(
    spots: DataFrame, plain: list[DataFrame], tested: list[DataFrame], payload: list[str], level: int
) -> list[DataFrame]:
    """Points with the ``payload`` of the rows of their cell whose polygon they touch."""
    probes = spots.select("*", F.expr(f"{C.point_key(X, Y, level)} AS {C.KEY}")).where(f"{C.KEY} IS NOT NULL")
    columns = [*spots.columns, *payload]
    found = []
    if plain:
        # No edges are left over, so the first test says it all, and pairs are never rows.
        index = _all(plain).select(*payload, C.EDGES, F.col(_AT).alias(C.KEY))
        index = C.with_slots(index).drop(C.REST)
        found.append(split_join(probes, index, [C.KEY], condition=C.slots_only_hit(X, Y)).select(*columns))
    if tested:
        side = C.side_of(C.KEY_LEVEL)
        finer = f"CASE WHEN {C.KEY_LEVEL} < {level} THEN"
        index = _all(tested).select(
            *payload,
            C.EDGES,
            F.expr(f"{finer} {C.KEY_X} * {side} END AS __x0"),
            F.expr(f"{finer} {C.KEY_Y} * {side} END AS __y0"),
            F.expr(f"{finer} {side} END AS __wide"),
            F.col(_AT).alias(C.KEY),
        )
        # The rows of a cell finer than the grid are right for its own points only; this goes
        # first, so that few pairs become rows with their edges.
        own = F.expr(
            f"__wide IS NULL OR ({X} >= __x0 AND {X} < __x0 + __wide AND {Y} >= __y0 AND {Y} < __y0 + __wide)"
        )
        met = split_join(probes, index, [C.KEY], condition=own)
        # As in a join on cells, the test with a lambda stays out of the join's generated code.
        hit = F.expr(E.is_hit(E.edges_total(C.EDGES, X, Y)))
        met = met.where(hit | (F.monotonically_increasing_id() < 0))
        found.append(met.select(*columns))
    return found


def polygon_totals(
    spots: DataFrame, polygons: DataFrame, payload: list[str], sums: list[str], n: str, stats: C.PolygonStats, limit: int
) -> DataFrame:
    """Per ``payload`` the sums of columns of the points that its polygons hold, and their
    number ``n``, as grouping all pairs would give them; without those that hold none."""
    cells, level = counted(spots, stats, sums)
    held, *tested = _cut_down(polygons, payload, stats, 0, cells, level, [_N, *sums], limit, True)
    parts = [rows.select(*payload, _N, *sums) for rows in held]
    totals = [F.count(F.lit(1)).alias(_N), *(F.sum(name).alias(name) for name in sums)]
    for met in _met(spots.select(X, Y, *sums), *tested, payload, level):
        parts.append(met.groupBy(*payload).agg(*totals))
    if not parts:
        nothing = spots.limit(0).crossJoin(polygons.select(*payload).limit(0))
        parts = [nothing.groupBy(*payload).agg(*totals)]
    kinds = spots.agg(*(F.sum(name).alias(name) for name in sums)).schema if sums else {}
    columns = [F.sum(name).cast(kinds[name].dataType).alias(name) for name in sums]
    return _all(parts).groupBy(*payload).agg(F.sum(_N).alias(n), *columns)


def candidate_pairs(
    spots: DataFrame,
    polygons: DataFrame,
    payload: list[str],
    stats: C.PolygonStats,
    limit: int,
    reduced: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Points with the ``payload`` of polygons that hold them, less those that ``reduced``
    drops from the rows of a cell."""
    shift = C.SHIFTS[1]  # few rows to begin with: what is reduced is never divided
    cells, level = counted(spots, stats, [], shift)
    _, *tested = _cut_down(polygons, payload, stats, shift, cells, level, [], limit, False, reduced)
    met = _met(spots, *tested, payload, level)
    return _all(met) if met else spots.crossJoin(polygons.select(*payload)).limit(0)
