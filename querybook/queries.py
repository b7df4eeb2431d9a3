"""One function per registered query: (session, table folder) to DataFrame."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions import (
    classify_parcel,
    register_sql_functions,
    st_astext,
    st_distance,
    st_geomfromtext,
    st_intersects,
    st_point,
    st_srid,
)
from parcelgrid.operators import (
    add_point_geometry,
    enrich,
    ensure_point_id,
    roadcalls_per_tract,
    spatial_join,
    spatial_lookup,
    summary,
    with_coordinates,
    within_last_year,
)
from parcelgrid.operators.join import BROADCAST_LIMIT_CONF
from parcelgrid.plans import graded_prospects, hotspots
from parcelgrid.session import scratch_dir
from parcelgrid.sinks import write_csv, write_geoparquet, write_parquet, write_table
from parcelgrid.sources import (
    list_tables,
    read_points_csv,
    read_points_table,
    read_tracts_shapefile,
    read_tracts_wkt,
)
from parcelgrid.types import PARCEL_ATTRS
from querybook import inputs as I
from querybook.shapewriter import write_shapefiles

AS_OF = datetime(2001, 2, 28)
TRACT_COLS = ["n_nationkey", "n_name"]


def point_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points from text columns; what is not a number gives no geometry."""
    text = I.calls(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 50 == 0, "n/a")
        .when(F.col("l_orderkey") % 50 == 1, "NaN")
        .otherwise(F.col("longitude").cast("string"))
        .alias("longitude"),
        "latitude",
    )
    return add_point_geometry(text).select(
        "l_orderkey",
        "l_linenumber",
        F.col("geometry").isNull().alias("no_geometry"),
        F.col("geometry.bbox.xmin").alias("x"),
        F.col("geometry.bbox.ymin").alias("y"),
        st_srid("geometry").alias("srid"),
    )


def srid_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = I.call_points(spark, sf_dir).select(
        st_srid("geometry").alias("srid_before"),
        st_srid(st_srid("geometry", 3857)).alias("srid_after"),
    )
    return points.groupBy("srid_before", "srid_after").agg(F.count(F.lit(1)).alias("points"))


def wkt_polygon_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = F.flatten("geometry.parts")
    return I.shapes(spark, sf_dir).select(
        "s_suppkey",
        F.col("geometry.kind").alias("kind"),
        F.col("geometry.srid").alias("srid"),
        F.size("geometry.parts").cast("bigint").alias("parts"),
        F.size(rings).cast("bigint").alias("rings"),
        F.size(F.flatten(rings)).cast("bigint").alias("vertices"),
        F.col("geometry.bbox.xmin").alias("xmin"),
        F.col("geometry.bbox.ymin").alias("ymin"),
        F.col("geometry.bbox.xmax").alias("xmax"),
        F.col("geometry.bbox.ymax").alias("ymax"),
    )


def wkt_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse, print, parse again: nothing changes."""
    shapes = I.shapes(spark, sf_dir).withColumn("again", st_geomfromtext(st_astext("geometry"), 4326))
    return shapes.select("s_suppkey", (F.col("again") == F.col("geometry")).alias("same"))


def wkt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons as text, vertex by vertex; without an SRID it is 0."""
    register_sql_functions(spark)
    tracts = I.tracts_text(spark, sf_dir).select("n_nationkey", F.expr("st_geomfromtext(wkt) AS geometry"))
    return tracts.select("n_nationkey", st_astext("geometry").alias("text"), st_srid("geometry").alias("srid"))


def distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = st_point(F.lit(3.0), F.lit(4.0))
    return I.calls(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        st_distance(st_point("longitude", "latitude"), corner).alias("distance"),
    )


def intersects_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicate by itself, on a polygon written in the query."""
    frame = st_geomfromtext(
        F.lit("POLYGON((10 10, 90 10, 90 90, 10 90, 10 10), (40 40, 40 60, 60 60, 60 40, 40 40))"),
        4326,
    )
    points = I.call_points(spark, sf_dir).withColumn("frame", frame)
    inside = points.select(
        st_intersects("frame", "geometry").alias("inside"),
        st_intersects("geometry", "frame").alias("inside_turned"),
    )
    return inside.groupBy("inside", "inside_turned").agg(F.count(F.lit(1)).alias("points"))


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same functions under their SQL names."""
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT l_orderkey, l_linenumber, geo_srid(p) AS srid,
               st_distance(p, geo_setsrid(st_point(3, 4), 4326)) AS distance,
               st_intersects(st_geomfromtext('POLYGON((0 0, 50 0, 50 50, 0 50, 0 0))', 4326), p)
                 AS inside
        FROM (SELECT *, geo_setsrid(st_point(longitude, latitude), 4326) AS p FROM {calls})
        """,
        calls=I.calls(spark, sf_dir),
    )


def _pairs(spark: SparkSession, sf_dir: str, broadcast: bool) -> DataFrame:
    return spatial_join(
        I.call_points(spark, sf_dir),
        I.tracts(spark, sf_dir),
        ["n_nationkey"],
        ["l_orderkey", "l_linenumber"],
        broadcast=broadcast,
    )


def spatial_join_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, broadcast=True)


def spatial_join_no_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, broadcast=False)


def spatial_join_wide_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few points with wide columns and a small limit: their coordinates are broadcast."""
    session = spark.newSession()
    session.conf.set(BROADCAST_LIMIT_CONF, str(1 << 20))
    register_sql_functions(session)
    pairs = spatial_join(
        I.depot_points(session, sf_dir), I.parcels(session, sf_dir), ["parcel_id"], ["s_suppkey", "notes"]
    )
    return pairs.select("s_suppkey", "parcel_id", F.md5(F.col("notes").cast("binary")).alias("notes_md5"))


def spatial_join_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on shared edges and corners pair with each tract that touches them."""
    return spatial_join(
        I.lattice_points(spark, sf_dir), I.tracts(spark, sf_dir), ["n_nationkey"], ["call_num"]
    )


def spatial_join_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concave shapes, holes and several parts, in sizes that need several cell levels."""
    return spatial_join(
        I.call_points(spark, sf_dir),
        I.shapes(spark, sf_dir),
        ["s_suppkey"],
        ["l_orderkey"],
        totals={"points": None, "key_sum": "l_orderkey"},
    )


def hotspots_per_tract(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS)
    return counts.select(*TRACT_COLS, "roadcall_count", st_srid("geometry").alias("srid"))


def hotspots_no_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roadcalls_per_tract(
        I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS, broadcast=False
    ).drop("geometry")


def hotspots_duplicate_tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal tract rows fall into one group, in which each call counts per row."""
    tracts = I.tracts(spark, sf_dir)
    return roadcalls_per_tract(
        I.call_points(spark, sf_dir), tracts.unionAll(tracts), TRACT_COLS
    ).drop("geometry")


def hotspots_geometry_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No tract columns: groups by the geometry alone."""
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), [])
    return counts.select(
        F.col("geometry.bbox.xmin").alias("xmin"), F.col("geometry.bbox.ymin").alias("ymin"), "roadcall_count"
    )


def hotspots_timestamp_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tract rows that differ in microseconds only are different tracts."""
    seen = F.explode(F.array(F.lit(1), F.lit(2))).alias("micros")
    tracts = I.tracts(spark, sf_dir).select("*", seen).withColumn(
        "seen", F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("micros"))
    )
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), tracts, ["n_nationkey", "seen"])
    return counts.select("n_nationkey", F.unix_micros("seen").alias("seen_micros"), "roadcall_count")


def hotspots_large_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of very many vertices, indexed edge by edge."""
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.coasts(spark, sf_dir), ["coast"])
    return counts.select("coast", "roadcall_count")


def hotspots_zoned_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where clocks go back, the hour that comes twice is two instants, and two tract rows."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    register_sql_functions(session)
    first = F.lit(1_730_611_800)  # 2024-11-03 01:30 in New York, and again an hour later
    tracts = I.tracts(session, sf_dir).select(
        "*", F.explode(F.array(F.timestamp_seconds(first), F.timestamp_seconds(first + 3600))).alias("seen")
    )
    counts = roadcalls_per_tract(I.call_points(session, sf_dir), tracts, ["n_nationkey", "seen"])
    return counts.select("n_nationkey", F.unix_seconds("seen").alias("seen_seconds"), "roadcall_count")


def hotspot_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS)
    return counts.agg(
        F.sum("roadcall_count").alias("total"),
        F.count(F.lit(1)).alias("tracts"),
        F.count_if(F.col("geometry").isNull()).alias("no_geometry"),
    )


def hotspots_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and tracts written as CSV, read back as text, then counted."""
    folder = scratch_dir(spark, "hotspots-csv")
    calls = I.calls(spark, sf_dir).select("call_num", "longitude", "latitude")
    calls.write.csv(f"{folder}/calls", header=True)
    I.tracts_text(spark, sf_dir).write.csv(f"{folder}/tracts", header=True)
    points = add_point_geometry(read_points_csv(spark, f"{folder}/calls"))
    tracts = read_tracts_wkt(spark, f"{folder}/tracts")
    return roadcalls_per_tract(points, tracts, TRACT_COLS).drop("geometry")


def coords_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    prospects = with_coordinates(I.prospects(spark, sf_dir), "lon", "lat")
    return prospects.select("point_id", "lat", "lon")


def calls_within_last_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = within_last_year(I.calls(spark, sf_dir), as_of=AS_OF)
    return calls.select("l_orderkey", "l_linenumber", "roadcall_call_dt")


def points_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog table read: recent rows with coordinates."""
    path = scratch_dir(spark, "calls")
    table = f"parcelgrid_calls_{uuid.uuid4().hex}"
    calls = I.calls(spark, sf_dir).withColumn(
        "latitude", F.when(F.col("l_orderkey") % 10 != 3, F.col("latitude"))
    )
    calls.write.option("path", path).saveAsTable(table)
    recent = read_points_table(spark, "default", table, as_of=AS_OF)
    return recent.select("l_orderkey", "l_linenumber", "latitude", "longitude")


def points_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point files read by path, without the one-year window."""
    path = scratch_dir(spark, "point-files")
    I.prospects(spark, sf_dir).withColumnsRenamed({"lat": "latitude", "lon": "longitude"}).write.parquet(path)
    return read_points_table(spark, path=path, last_year_only=False)


def tables_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of a database, here one per tract kind written from the tract table."""
    database = f"parcelgrid_list_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for kind in ("POLYGON", "MULTIPOLYGON"):
        name = f"{database}.{kind.lower()}s"
        shapes = I.shapes(spark, sf_dir).where(F.col("geometry.kind") == kind)
        write_table(shapes, scratch_dir(spark, kind.lower()), name)
    listed = list_tables(spark, database).select(
        F.regexp_replace("namespace", "_[0-9a-f]{32}$", "").alias("namespace"),
        F.col("tableName").alias("table_name"),
    )
    spark.sql(f"DROP DATABASE {database} CASCADE")  # the list is made by now
    return listed


def _lookup(spark: SparkSession, sf_dir: str, broadcast: bool) -> DataFrame:
    points = add_point_geometry(I.prospects(spark, sf_dir), "lon", "lat")
    found = spatial_lookup(
        points, I.parcels(spark, sf_dir), ["parcel_id", "owner"], broadcast=broadcast
    )
    return found.select("point_id", "parcel_id", "owner", "parcel_matched")


def parcel_lookup_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lowest of up to a thousand parcels about a point, many borders in every cell."""
    points = add_point_geometry(I.prospects(spark, sf_dir), "lon", "lat")
    found = spatial_lookup(points, I.nested_parcels(spark, sf_dir), ["parcel_id"])
    return found.select("point_id", "parcel_id", "parcel_matched")


def parcel_lookup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, broadcast=True)


def parcel_lookup_no_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, broadcast=False)


def _classified(spark: SparkSession, sf_dir: str, fields: list[str]) -> DataFrame:
    """Grades from some attributes only, the others taken as missing."""
    parcels = I.parcel_attributes(spark, sf_dir)
    grade = classify_parcel({name: F.col(name) for name in fields})
    return parcels.select("parcel_id", grade.alias("grade")).select(
        "parcel_id",
        "grade.truck_flag",
        "grade.confidence",
        F.array_join("grade.reasons", ";").alias("reasons"),
    )


def classify_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, ["owner", "address", "struct"])


def classify_zoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, ["zoning_type"])


def classify_lbcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, ["lbcs_activity", "lbcs_function"])


def classify_special_commercial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, ["owner", "zoning_subtype"])


def classify_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, PARCEL_ATTRS)


def sample_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample parcel attributes by row parity, graded; one row per customer."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    even = F.col("c_custkey") % 2 == 0
    state = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    attrs = {
        "owner": F.when(even, "Northgate Warehousing").otherwise("The Mill House"),
        "address": F.when(even, "7 Canal Quay").otherwise("4 Elm Row"),
        "zoning_type": F.when(even, "Industrial").otherwise("Residential"),
        "zoning_subtype": F.when(even, "Industrial").otherwise("Single Family"),
        "lbcs_activity": F.when(even, "3900").otherwise("1100"),
    }
    grade = classify_parcel(attrs)
    return customers.select(
        "c_custkey",
        F.coalesce(state, F.lit("XX")).alias("state2"),
        F.lower(F.coalesce(state, F.lit("XX"))).alias("county"),
        grade.alias("grade"),
    ).select(
        "c_custkey",
        "state2",
        "county",
        "grade.truck_flag",
        "grade.confidence",
        F.array_join("grade.reasons", ";").alias("reasons"),
    )


def point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers as ids where the column is missing; each number occurs once."""
    numbered = ensure_point_id(I.prospects(spark, sf_dir).drop("point_id"))
    number = F.substring("point_id", 2, 20).cast("bigint")
    return numbered.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(number).alias("first"),
        F.max(number).alias("last"),
        F.sum(number).alias("number_sum"),
    )


def point_ids_after_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id per row of a grouped table, whose partitions adaptive execution merges."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_shipped"))
    return ensure_point_id(orders).select("point_id")


def enrich_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(I.prospects(spark, sf_dir), I.parcels(spark, sf_dir))


def job_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of the hotspot job, from raw call rows and a tract table."""
    counts = hotspots(I.calls(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS)
    return counts.select(*TRACT_COLS, "roadcall_count", st_astext("geometry").alias("text"))


def job_prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of the enrichment job; what it observes on the way is what it gives."""
    seen = Observation()
    path = scratch_dir(spark, "graded")
    write_parquet(graded_prospects(I.prospects(spark, sf_dir), I.parcels(spark, sf_dir), observation=seen), path)
    totals = seen.get
    return spark.read.parquet(path).groupBy("truck_flag").agg(
        F.count(F.lit(1)).alias("prospects"),
        F.lit(totals["rows"]).alias("observed_rows"),
        F.lit(totals["flagged"]).alias("observed_flagged"),
    )


def enrich_lookup_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose lookup failed carry the message and no grade."""
    failed = F.when(F.col("point_id").cast("bigint") % 10 == 3, "boom")
    return enrich(
        I.prospects(spark, sf_dir).withColumn("lookup_error", failed),
        I.parcels(spark, sf_dir),
        error_col="lookup_error",
    ).select("point_id", "truck_flag", "confidence", "reasons", "parcel_owner", "error")


def enrich_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(enrich_output(spark, sf_dir))


def enrich_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that come with the action that writes the rows."""
    seen = Observation()
    rows = enrich(I.prospects(spark, sf_dir), I.parcels(spark, sf_dir), observation=seen)
    rows.write.parquet(scratch_dir(spark, "observed"))
    totals = seen.get
    return spark.createDataFrame(
        [(totals["rows"], totals["flagged"])], "row_count bigint, flagged bigint"
    )


def limit_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = enrich(I.prospects(spark, sf_dir), I.parcels(spark, sf_dir), limit=100)
    return enriched.select("point_id", "confidence", "reasons")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "enriched-csv")
    write_csv(enrich_output(spark, sf_dir), path)
    return spark.read.csv(path, header=True, escape='"')


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "enriched-parquet")
    write_parquet(enrich_output(spark, sf_dir), path)
    return spark.read.parquet(path)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"parcelgrid_hotspots_{uuid.uuid4().hex}"
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS)
    write_table(counts, scratch_dir(spark, "hotspots"), table)
    return spark.table(table)


def geoparquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "hotspots-geo")
    counts = roadcalls_per_tract(I.call_points(spark, sf_dir), I.tracts(spark, sf_dir), TRACT_COLS)
    write_geoparquet(counts, path)
    return spark.read.parquet(path).select(
        *TRACT_COLS,
        "roadcall_count",
        F.length("geometry").cast("bigint").alias("wkb_bytes"),
        F.hex(F.substring("geometry", 1, 9)).alias("wkb_head"),
    )


def geoparquet_wkb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracts written as GeoParquet: every byte of their WKB."""
    path = scratch_dir(spark, "tracts-geo")
    write_geoparquet(I.tracts(spark, sf_dir), path)
    return spark.read.parquet(path).select("n_nationkey", F.hex("geometry").alias("wkb"))


def shapefile_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes written as shapefiles, read back and joined with the calls."""
    folder = scratch_dir(spark, "shapes")
    write_shapefiles(I.shapes(spark, sf_dir), folder, "s_suppkey")
    shapes = read_tracts_shapefile(spark, folder)
    counts = roadcalls_per_tract(
        I.call_points(spark, sf_dir), shapes, ["s_suppkey", "label"], "l_orderkey"
    )
    return counts.select("s_suppkey", "label", "roadcall_count", F.col("geometry.kind").alias("kind"))


def shapefile_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes whose box meets a box; files outside are not read."""
    folder = scratch_dir(spark, "boxed-shapes")
    write_shapefiles(I.shapes(spark, sf_dir), folder, "s_suppkey")
    shapes = read_tracts_shapefile(spark, folder, box=(20.0, 30.0, 40.0, 45.5))
    return shapes.select("s_suppkey", F.col("geometry.bbox.xmin").alias("xmin"), F.col("geometry.bbox.ymax").alias("ymax"))


def shapefile_mixed_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of shapefiles with unlike attributes: each file's columns are there."""
    folder = scratch_dir(spark, "mixed")
    shapes = I.shapes(spark, sf_dir)
    write_shapefiles(shapes.where("s_suppkey % 2 = 0"), f"{folder}/a", "s_suppkey")
    write_shapefiles(shapes.where("s_suppkey % 2 = 1"), f"{folder}/b", "s_suppkey", "tag")
    return read_tracts_shapefile(spark, folder).select(
        "s_suppkey", "label", "tag", F.col("geometry.kind").alias("kind")
    )


QUERIES = {
    f.__name__: f
    for f in (
        point_geometry,
        srid_roundtrip,
        wkt_polygon_parse,
        wkt_text_roundtrip,
        wkt_text,
        distance,
        intersects_predicate,
        sql_functions,
        spatial_join_pairs,
        spatial_join_no_broadcast,
        spatial_join_wide_points,
        spatial_join_boundary,
        spatial_join_shapes,
        hotspots_per_tract,
        hotspots_no_broadcast,
        hotspots_duplicate_tracts,
        hotspots_geometry_only,
        hotspots_large_polygon,
        hotspots_timestamp_cols,
        hotspots_zoned_timestamps,
        hotspot_total,
        hotspots_from_csv,
        coords_not_null,
        calls_within_last_year,
        points_table,
        points_by_path,
        tables_listed,
        parcel_lookup_first,
        parcel_lookup_no_broadcast,
        parcel_lookup_nested,
        classify_keywords,
        classify_zoning,
        classify_lbcs,
        classify_special_commercial,
        classify_full,
        sample_attributes,
        point_ids,
        point_ids_after_shuffle,
        enrich_output,
        job_hotspots,
        job_prospects,
        enrich_lookup_errors,
        enrich_summary,
        enrich_totals,
        limit_head,
        csv_roundtrip,
        parquet_roundtrip,
        table_roundtrip,
        geoparquet_roundtrip,
        geoparquet_wkb,
        shapefile_roundtrip,
        shapefile_in_box,
        shapefile_mixed_schemas,
    )
}
