"""Parcel enrichment of prospect points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from parcelgrid.functions.classify import classify_parcel
from parcelgrid.functions.geometry import once
from parcelgrid.operators.lookup import MATCHED, spatial_lookup
from parcelgrid.operators.points import add_point_geometry
from parcelgrid.session import written
from parcelgrid.types import PARCEL_ATTRS

INVALID_COORDINATES = "invalid coordinates"

# The names and the order of the output columns.
OUTPUT_COLUMNS = [
    "point_id",
    "lat",
    "lon",
    "truck_flag",
    "confidence",
    "reasons",
    "parcel_owner",
    "parcel_address",
    "parcel_zoning_type",
    "parcel_zoning_subtype",
    "county",
    "state",
    "error",
]

_ATTR = "__parcel_"
# Partitions whose counts are summed up together.
GROUP = 1024


def ensure_point_id(points: DataFrame) -> DataFrame:
    """``point_id`` as text; where the column is missing, ``P`` and the row position from 0.

    The position is the row's place in its partition plus the rows of the partitions
    before it. The input runs once: it is written, with partition and place as columns, to
    the shared scratch folder and read from there, so any input keeps every row and each
    position occurs once. Only one count per partition moves; counts are summed up within
    groups of ``GROUP`` partitions, side by side, and then over the groups.
    """
    if "point_id" in points.columns:
        return points.withColumn("point_id", F.col("point_id").cast("string"))
    part, start = "__part", "__start"
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    marked = points.select(
        "*", F.spark_partition_id().alias(part), in_partition.alias("__place")
    )
    marked = written(marked, "numbered")
    counts = marked.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    numbered = marked.join(F.broadcast(partition_starts(counts, part, start)), part, "left")
    known = F.coalesce(start, F.raise_error(F.lit("a partition has no count")).cast("bigint"))
    position = (known + F.col("__place")).cast("string")
    return numbered.select(*points.columns, F.concat(F.lit("P"), position).alias("point_id"))


def partition_starts(counts: DataFrame, part: str, start: str) -> DataFrame:
    """``part`` and ``start``: the rows of all partitions before, from ``__n`` of each."""
    group, before_group = "__group", "__before"
    grouped = counts.select(part, "__n", F.expr(f"{part} div {GROUP}").alias(group))

    def before(window: WindowSpec) -> Column:
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__n").over(earlier), F.lit(0))

    inside = grouped.select(part, group, before(Window.partitionBy(group).orderBy(part)).alias(start))
    totals = grouped.groupBy(group).agg(F.sum("__n").alias("__n"))
    totals = totals.select(group, before(Window.orderBy(group)).alias(before_group))
    return inside.join(totals, group).select(part, (F.col(start) + F.col(before_group)).alias(start))


def coordinate_error(lat: Column, lon: Column) -> Column:
    """Text where the coordinates cannot be looked up, else NULL."""
    usable = lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)
    return F.when(F.coalesce(usable, F.lit(False)), F.lit(None)).otherwise(INVALID_COORDINATES)


def output_columns(attr_prefix: str = "", absent: tuple[str, ...] = ()) -> list[Column]:
    """The 13 output columns, from classified and looked-up rows.

    Attributes are '' where there is no parcel, or where the parcel table lacks the column
    (``absent``); a NULL attribute of a parcel stays NULL.
    """

    def attr(name: str, output: str) -> Column:
        held = F.lit("") if name in absent else F.col(attr_prefix + name)
        return F.when(F.col(MATCHED), held).otherwise(F.lit("")).alias(output)

    return [
        F.col("point_id"),
        F.col("lat"),
        F.col("lon"),
        F.col("classification.truck_flag").alias("truck_flag"),
        F.col("classification.confidence").alias("confidence"),
        F.array_join(F.col("classification.reasons"), ";").alias("reasons"),
        attr("owner", "parcel_owner"),
        attr("address", "parcel_address"),
        attr("zoning_type", "parcel_zoning_type"),
        attr("zoning_subtype", "parcel_zoning_subtype"),
        attr("county", "county"),
        attr("state2", "state"),
        F.coalesce(F.col("error"), F.lit("")).alias("error"),
    ]


def _no_id(parcels: DataFrame) -> Column:
    """Raises for a parcel without an id, which would sort first and win everywhere."""
    kind = parcels.schema["parcel_id"].dataType
    return F.raise_error(F.lit("parcel_id must not be NULL")).cast(kind)


def enrich(
    points: DataFrame,
    parcels: DataFrame,
    limit: int | None = None,
    srid: int = 4326,
    error_col: str | None = None,
    observation: Observation | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """One output row per prospect, with the grade of the parcel that holds it.

    ``points`` has ``lat`` and ``lon`` (numbers, or text) and may have ``point_id``.
    ``parcels`` has ``parcel_id``, ``geometry`` and any of the parcel attributes.
    ``limit`` takes the first rows by ``point_id``. ``error_col`` names a column of
    lookup errors: where it is set and not empty, the row is graded as an error. ``observation``
    receives ``rows`` and ``flagged`` of whatever action runs on the result.
    """
    prospects = ensure_point_id(points)
    if limit is not None:
        # The limit leaves one partition; the rows are spread again for the lookup.
        spread = min(limit, points.sparkSession.sparkContext.defaultParallelism)
        prospects = prospects.orderBy("point_id").limit(limit).repartition(max(1, spread))
    given_error = F.nullif(F.col(error_col), F.lit("")) if error_col else F.lit(None).cast("string")
    prospects = prospects.select(
        "point_id",
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
        given_error.alias("__given"),
    ).select("*", F.coalesce("__given", coordinate_error(F.col("lat"), F.col("lon"))).alias("error"))

    # A row that already has an error is not looked up.
    located = add_point_geometry(prospects, "lon", "lat", srid).withColumn(
        "geometry", F.when(F.col("error").isNull(), F.col("geometry"))
    )
    names = [name for name in PARCEL_ATTRS if name in parcels.columns]
    prefixed = parcels.select(
        F.coalesce("parcel_id", _no_id(parcels)).alias("parcel_id"), "geometry", *(F.col(name).alias(_ATTR + name) for name in names)
    )
    looked_up = spatial_lookup(
        located, prefixed, [_ATTR + name for name in names], broadcast=broadcast
    )
    missing = [name for name in PARCEL_ATTRS if name not in names]
    for name in missing:
        looked_up = looked_up.withColumn(_ATTR + name, F.lit(None).cast("string"))
    attrs = {name: F.col(_ATTR + name) for name in PARCEL_ATTRS}
    graded = classify_parcel(attrs, F.col(MATCHED), F.col("error"))
    result = looked_up.select("*", once(graded).alias("classification")).select(
        *output_columns(_ATTR, tuple(missing))
    )
    if observation is not None:
        result = result.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("truck_flag").alias("flagged"),
        )
    return result


def summary(enriched: DataFrame) -> DataFrame:
    """Rows, flagged rows, rows of high confidence (flagged or not) and errors."""
    return enriched.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("truck_flag").alias("flagged"),
        F.count_if(F.col("confidence") == "high").alias("high_confidence"),
        F.count_if(F.col("error") != "").alias("errors"),
    )
