"""Number of points per polygon."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions.geometry import once
from parcelgrid.operators import grid
from parcelgrid.operators.join import X, Y, broadcast_limit, located, match_pairs, plan_join
from parcelgrid.operators.keys import ROW_KEY, with_row_key
from parcelgrid.session import written

_ID = "__id"
_COPIES = "__copies"


def count_points_per_polygon(
    points: DataFrame,
    polygons: DataFrame,
    polygon_cols: list[str],
    id_col: str = "call_num",
    count_col: str = "roadcall_count",
    broadcast: bool = True,
) -> DataFrame:
    """``polygon_cols``, the count of non-NULL ids among the points hit, ``geometry``.

    Groups by all polygon columns and the geometry. Polygons without a point do not
    appear; one whose points all have NULL ids appears with 0; equal polygon rows form
    one group in which each point counts once per row.

    Polygon attributes and shapes are not shuffled with the points: the count is grouped
    on a hash of the row, and attached afterwards. Equal polygon rows are joined once.
    """
    columns = [*polygon_cols, "geometry"]
    shapes = polygons.select(*polygon_cols, once(F.col("geometry")).alias("geometry"))
    distinct = (
        with_row_key(shapes.where("geometry IS NOT NULL"), columns)
        .groupBy(*ROW_KEY)
        .agg(*(F.first(c).alias(c) for c in columns), F.count(F.lit(1)).alias(_COPIES))
    )
    # Measured, indexed and attached at the end: their source is read, and its text parsed, once.
    distinct = written(distinct, "polygons")
    plan = plan_join(points, distinct, [], broadcast)
    if not plan.stats.levels:
        counts = distinct.limit(0).select(*ROW_KEY, F.lit(0).cast("bigint").alias(count_col))
    elif grid.pays(points, plan.stats, plan.strategy == "broadcast_polygons"):
        one = F.col(id_col).isNotNull().cast("bigint")
        spots = located(points, plan.stats.srid, [one.alias(count_col)])
        counts = grid.polygon_totals(
            spots, distinct, ROW_KEY, [count_col], _ID, plan.stats, broadcast_limit(points)
        ).drop(_ID)
    else:
        spots = located(points, plan.stats.srid, [F.col(id_col).alias(_ID)])
        total = F.count(_ID)
        if plan.strategy == "shuffle":
            # Points at one spot travel as one row with their number.
            spots = spots.groupBy(X, Y).agg(F.count(_ID).alias(_ID))
            total = F.sum(_ID)
        pairs = match_pairs(spots, distinct, ROW_KEY, plan)
        counts = pairs.groupBy(*ROW_KEY).agg(total.alias(count_col))
    return distinct.join(counts, ROW_KEY).select(
        *polygon_cols, (F.col(count_col) * F.col(_COPIES)).alias(count_col), "geometry"
    )


def roadcalls_per_tract(
    points: DataFrame,
    tracts: DataFrame,
    tract_cols: list[str],
    call_id_col: str = "call_num",
    broadcast: bool = True,
) -> DataFrame:
    """Road calls per census tract: tract attributes, ``roadcall_count``, ``geometry``."""
    return count_points_per_polygon(
        points, tracts, tract_cols, call_id_col, "roadcall_count", broadcast
    )
