"""The one polygon at each point: attributes of the first parcel that holds it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelgrid.functions import expressions as E
from parcelgrid.functions.geometry import once, record
from parcelgrid.operators import cells as C
from parcelgrid.operators import grid
from parcelgrid.operators.join import (
    X,
    Y,
    JoinPlan,
    broadcast_limit,
    checked,
    indexed,
    match_pairs,
    plan_join,
)
from parcelgrid.operators.keys import ROW_KEY, with_row_key
from parcelgrid.operators.skew import split_join
from parcelgrid.session import written

MATCHED = "parcel_matched"

_SPOT = "__spot"
_BEST = "__best"

# Candidates of one cell from which on it is cut finer, and how often at most.
CROWD = 32
ROUNDS = 8


def spatial_lookup(
    points: DataFrame,
    parcels: DataFrame,
    attrs: list[str],
    id_col: str = "parcel_id",
    broadcast: bool = True,
) -> DataFrame:
    """Every row of ``points`` once, with ``attrs`` and ``parcel_matched``.

    Where several parcels hold a point, the one with the lowest ``id_col`` is taken.
    Points without a geometry, or outside all parcels, have NULL attributes and
    ``parcel_matched`` = false. Full copies of a point row all stay.
    """
    repeated = set(points.columns) & {*attrs, MATCHED}
    if repeated:
        raise ValueError(f"columns on both sides of the lookup: {sorted(repeated)}")
    payload = list(dict.fromkeys([id_col, *attrs]))
    # The parcels are worked on several times: their source is read, and their text parsed, once.
    shapes = written(_lowest_per_shape(parcels, payload), "parcels")
    plan = plan_join(points, shapes, payload, broadcast)
    if not plan.stats.levels:
        nothing = [F.lit(None).cast(parcels.schema[a].dataType).alias(a) for a in attrs]
        return points.select("*", *nothing, F.lit(False).alias(MATCHED))

    spot = record(
        x=F.expr(checked(plan.stats.srid, "geometry.bbox.xmin")), y=F.expr("geometry.bbox.ymin")
    )
    spots = points.select("*", once(spot).alias(_SPOT)).select(
        *points.columns, F.expr(f"{_SPOT}.x AS {X}"), F.expr(f"{_SPOT}.y AS {Y}")
    )
    if grid.pays(points, plan.stats, plan.strategy == "broadcast_polygons"):
        found = _by_spot(spots, shapes, payload, plan, crowded=True)
    elif plan.strategy == "broadcast_polygons":
        found = _probe_cells(spots, shapes, payload, plan)
    else:
        found = _by_spot(spots, shapes, payload, plan)
    return found.select(
        *points.columns,
        *(F.col(f"{_BEST}.{name}").alias(name) for name in attrs),
        F.col(_BEST).isNotNull().alias(MATCHED),
    )


def _lowest_per_shape(parcels: DataFrame, payload: list[str]) -> DataFrame:
    """Of parcels with equal shapes only the lowest id can be the answer: keep that one."""
    shapes = parcels.select(*payload, once(F.col("geometry")).alias("geometry"))
    return (
        with_row_key(shapes.where("geometry IS NOT NULL"), ["geometry"])
        .groupBy(*ROW_KEY)
        .agg(F.min(F.struct(*payload)).alias(_BEST), F.first("geometry").alias("geometry"))
        .select(f"{_BEST}.*", "geometry")
    )


def _undominated(index: DataFrame, payload: list[str]) -> DataFrame:
    """Per cell, the candidates that can be the answer at some point of it.

    A parcel that holds the whole cell ends the list: no higher id is ever taken there. Of
    parcels whose edges are the same within the cell, the lowest id is always taken. The
    index fits the broadcast limit, so the rows of one cell fit a task.
    """
    best = F.struct(*payload)
    top = F.min(F.when(F.expr(C.COVERS), best)).over(Window.partitionBy(C.KEY))
    rows = index.select(C.KEY, best.alias(_BEST), F.array_sort(C.EDGES).alias(C.EDGES), top.alias("__top"))
    rows = rows.where(f"__top IS NULL OR {_BEST} <= __top")
    return rows.groupBy(C.KEY, C.EDGES).agg(F.min(_BEST).alias(_BEST)).select(f"{_BEST}.*", C.KEY, C.EDGES)


def arranged(index: DataFrame, payload: list[str], limit: int) -> tuple[DataFrame, list[int]]:
    """The index with short candidate lists, and the levels of its cells.

    ``payload`` starts with the id. Dominated candidates go, and cells with more than
    ``CROWD`` still are cut into finer ones, in each of which fewer parcels have an edge and
    the lowest that holds it ends the list: so lists do not grow with the overlap. This goes
    on while the index, measured, has room within ``limit`` bytes, for ``ROUNDS`` at most.
    """
    crowds = [CROWD << step for step in range(24)]
    over = [f"__n > {crowd} AND {C.DIVISIBLE}" for crowd in crowds]
    sums = [F.sum(F.expr(f"CASE WHEN {which} THEN __bytes ELSE 0L END")) for which in over]

    def measured(rows: DataFrame) -> tuple[DataFrame, DataFrame, list]:
        rows = written(rows, "arrangement")
        held = rows.groupBy(C.KEY).agg(F.count(F.lit(1)).alias("__n"), F.sum(C.row_bytes(payload)).alias("__bytes"))
        return rows, held, list(held.agg(F.collect_set(F.expr(C.KEY_LEVEL)), F.sum("__bytes"), *sums).first())

    rows, held, (levels, total, *to_cut) = measured(_undominated(index, payload))
    for _ in range(ROUNDS):
        # The most crowded cells come first where there is no room to cut them all.
        fits = [which for which, size in zip(over, to_cut) if size and total + C.GROWTH * size <= limit]
        if not fits:
            break
        cut = held.where(fits[0]).select(C.KEY)
        finer = C.divided(rows.join(cut, C.KEY, "left_semi"), payload)
        rest = rows.join(cut, C.KEY, "left_anti").select(*finer.columns)
        rows, held, (levels, total, *to_cut) = measured(_undominated(rest.union(finer), payload))
    return rows, sorted(levels)


def _probe_cells(
    spots: DataFrame, parcels: DataFrame, payload: list[str], plan: JoinPlan
) -> DataFrame:
    """One candidate list per cell, so each join keeps the rows as they are: no shuffle
    of points, no row number, no grouping.

    The lists are part of an index that is known to fit the broadcast limit, and all
    levels share one broadcast.
    """
    rows, levels = indexed(parcels, payload, plan)
    if C.most_in_a_cell(parcels, plan.shift) > CROWD:
        rows, levels = arranged(rows, payload, broadcast_limit(spots))
    fields = ", ".join(f"'{name}', `{name}`" for name in payload)
    lists = rows.groupBy(C.KEY).agg(
        F.expr(
            f"sort_array(collect_list(named_struct('best', named_struct({fields}), "
            f"'edges', {C.EDGES}))) AS __list"
        )
    )
    found = spots
    picks = [F.lit(None).cast(lists.schema["__list"].dataType.elementType["best"].dataType)]
    for i, level in enumerate(levels):
        key, candidates = f"__key_{i}", f"__list_{i}"
        found = found.select("*", F.expr(f"{C.point_key(X, Y, level)} AS {key}")).join(
            F.broadcast(lists.select(F.col(C.KEY).alias(key), F.col("__list").alias(candidates))),
            key,
            "left",
        )
        hit = E.is_hit(E.edges_total("c.edges", X, Y))
        picks.append(F.expr(f"get(filter({candidates}, c -> {hit}), 0).best"))
    best = F.array_min(F.array_compact(F.array(*picks)))
    return found.select(*spots.columns, once(best).alias(_BEST))


def _by_spot(
    spots: DataFrame, parcels: DataFrame, payload: list[str], plan: JoinPlan, crowded: bool = False
) -> DataFrame:
    """Look up each distinct coordinate pair once, then attach the result to the rows.

    Where parcels are ``crowded``, their cells are divided down to those of a grid, and in
    every one only those that can be the answer are kept.
    """
    distinct = spots.where(f"{X} IS NOT NULL").select(X, Y).distinct()
    if crowded:
        distinct = written(distinct, "spots")
        pairs = grid.candidate_pairs(
            distinct, parcels, payload, plan.stats, broadcast_limit(spots), lambda rows: _undominated(rows, payload)
        )
    else:
        pairs = match_pairs(distinct, parcels, payload, plan)
    best = pairs.groupBy(X, Y).agg(F.min(F.struct(*payload)).alias(_BEST))
    if plan.strategy == "broadcast_points":
        # Few rows, but their attributes may be wide: Spark broadcasts them if they are small.
        return spots.join(best, [X, Y], "left")
    return split_join(spots, best, [X, Y], how="left", split_right=False)
