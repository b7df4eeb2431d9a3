"""Readers of point and polygon tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.functions.geometry import once, st_geomfromtext, st_setsrid
from parcelgrid.operators.points import with_coordinates, within_last_year
from parcelgrid.sources.register import qualified, register_source
from parcelgrid.sources.shapefile import ShapefileDataSource
from parcelgrid.types import WGS84


def read_points_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row. Every column is text; no rows are left out."""
    return spark.read.csv(path, header=True)


def read_points_table(
    spark: SparkSession,
    database: str | None = None,
    table: str | None = None,
    last_year_only: bool = True,
    as_of=None,
    path: str | None = None,
) -> DataFrame:
    """Catalog table ``database.table``, or the Parquet files at ``path``.

    Rows without latitude or longitude are left out, and by default rows older than one
    year. Both filters reach the file scan.
    """
    if path is not None:
        df = spark.read.parquet(path)
    else:
        df = spark.table(f"{database}.{table}" if database else table)
    if last_year_only:
        df = within_last_year(df, as_of=as_of)
    return with_coordinates(df)


def tracts_from_wkt(df: DataFrame, wkt_col: str = "wkt", srid: int = WGS84) -> DataFrame:
    """Add ``geometry`` from a WKT column, parsed once per row."""
    kept = [c for c in df.columns if c != "geometry"]
    # A SQL function may not stand inside a generator, hence two steps.
    parsed = df.select(*kept, st_geomfromtext(F.col(wkt_col), srid).alias("__parsed"))
    return parsed.select(*kept, once(F.col("__parsed")).alias("geometry"))


def read_tracts_wkt(spark: SparkSession, path: str, srid: int = WGS84) -> DataFrame:
    """CSV of polygons with a ``wkt`` column; attributes stay text, so codes keep zeros."""
    return tracts_from_wkt(spark.read.csv(path, header=True), "wkt", srid)


def read_tracts_shapefile(
    spark: SparkSession,
    prefix: str,
    srid: int = WGS84,
    box: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Shapefiles at a path or under a folder, the geometry tagged with ``srid``.

    With ``box`` (xmin, ymin, xmax, ymax) only shapes whose own box meets it; files outside
    are not read.
    """
    register_source(spark, ShapefileDataSource)
    reader = spark.read.format(ShapefileDataSource.name())
    if box is not None:
        reader = reader.option("box", ",".join(repr(float(v)) for v in box))
    df = reader.load(qualified(spark, prefix))
    return df.withColumn("geometry", st_setsrid("geometry", srid))


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {database}").where("NOT isTemporary")
