"""Points, tracts and parcels derived from the given tables.

Coordinates are multiples of 1/64 or 1/128, so products and sums are exact and every
engine agrees on what lies on an edge. The SELECT texts run in Spark and in the checking
engine alike: integer remainders, ``e0`` doubles, CASE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelgrid.operators import add_point_geometry
from parcelgrid.sources import tracts_from_wkt

# Road calls: one per line item; the seventh line of an order has no call number.
CALLS = """
SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS call_num,
       l_orderkey, l_linenumber,
       CAST((l_orderkey * 7919 + l_linenumber * 104729) % 6400 AS DOUBLE) / 64e0 AS longitude,
       CAST((l_orderkey * 6151 + l_linenumber * 3571) % 6400 AS DOUBLE) / 64e0 AS latitude,
       l_shipdate AS roadcall_call_dt
FROM lineitem
"""

# Tracts: 5 x 5 fields of 20 units; even keys fill theirs, odd keys are a triangle.
TRACTS = """
SELECT n_nationkey, n_name,
       CAST(n_nationkey % 5 AS INT) * 20 AS x0,
       CAST((n_nationkey - n_nationkey % 5) / 5 AS INT) * 20 AS y0,
       CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS full_field
FROM nation
"""

# Does call c lie in tract t? Edges belong to the tract.
IN_TRACT = """
c.longitude >= t.x0 AND c.latitude >= t.y0
AND CASE WHEN t.full_field = 1
         THEN c.longitude <= t.x0 + 20 AND c.latitude <= t.y0 + 20
         ELSE (c.longitude - t.x0) + (c.latitude - t.y0) <= 20e0 END
"""

# Odd shapes from suppliers, of four sizes: an L, a frame with a hole, a triangle, two squares.
SHAPES = """
SELECT s_suppkey,
       CAST(s_suppkey * 7919 % 6400 AS DOUBLE) / 64e0 AS ax,
       CAST(s_suppkey * 6151 % 6400 AS DOUBLE) / 64e0 AS ay,
       CASE s_suppkey % 5 WHEN 0 THEN 0.5e0 WHEN 1 THEN 2e0 WHEN 2 THEN 4e0
                          WHEN 3 THEN 1e0 ELSE 16e0 END AS unit,
       s_suppkey % 4 AS form
FROM supplier
"""

IN_SHAPE = """
c.longitude >= s.ax AND c.longitude <= s.ax + 3 * s.unit
AND c.latitude >= s.ay AND c.latitude <= s.ay + 3 * s.unit
AND CASE s.form
  WHEN 0 THEN c.longitude <= s.ax + 2 * s.unit AND c.latitude <= s.ay + 2 * s.unit
              AND NOT (c.longitude > s.ax + s.unit AND c.latitude > s.ay + s.unit)
  WHEN 1 THEN NOT (c.longitude > s.ax + s.unit AND c.longitude < s.ax + 2 * s.unit
                   AND c.latitude > s.ay + s.unit AND c.latitude < s.ay + 2 * s.unit)
  WHEN 2 THEN (c.longitude - s.ax) + (c.latitude - s.ay) <= 2 * s.unit
  ELSE c.latitude <= s.ay + s.unit
       AND (c.longitude <= s.ax + s.unit OR c.longitude >= s.ax + 2 * s.unit) END
"""

# Prospects: one per order; every 97th has no usable latitude.
PROSPECTS = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS point_id,
       CASE WHEN o_orderkey % 97 = 5 THEN NULL
            WHEN o_orderkey % 97 = 6 THEN 1000e0
            ELSE CAST(o_orderkey * 6151 % 6400 AS DOUBLE) / 128e0 END AS lat,
       CAST(o_orderkey * 7919 % 6400 AS DOUBLE) / 128e0 AS lon
FROM orders
"""

# Parcels: one overlapping square per part, with attributes cycled over all kinds of text.
PARCELS = """
SELECT p_partkey AS parcel_id,
       CAST(p_partkey * 7919 % 6400 AS DOUBLE) / 128e0 AS x0,
       CAST(p_partkey * 3571 % 6400 AS DOUBLE) / 128e0 AS y0,
       CAST(1 + p_partkey % 4 AS DOUBLE) / 8e0 AS side,
       CASE p_partkey % 16
         WHEN 0 THEN 'Love''s Country Store' WHEN 1 THEN 'UPSTATE FARM' WHEN 2 THEN 'ACME TRUCK'
         WHEN 3 THEN 'Northgate Warehousing' WHEN 4 THEN 'The Mill House' WHEN 5 THEN 'GAS PLAZA'
         WHEN 6 THEN 'IOWA  80' WHEN 7 THEN 'FedEx Ground' WHEN 8 THEN '' WHEN 9 THEN NULL
         WHEN 10 THEN 'flying j' WHEN 11 THEN 'TAX OFFICE' WHEN 12 THEN 'PETROLEUM LTD'
         WHEN 13 THEN 'Fuel Station' WHEN 14 THEN 'TA TRAVEL' ELSE 'LOVES LANE' END AS owner,
       CASE p_partkey % 5
         WHEN 0 THEN 'STOP 5 ROAD' WHEN 1 THEN '7 Canal Quay' WHEN 2 THEN NULL
         WHEN 3 THEN '4 Elm Row' ELSE 'ups way' END AS address,
       CASE p_partkey % 13
         WHEN 0 THEN 'truck wash' WHEN 1 THEN 'barn' ELSE NULL END AS struct,
       CASE p_partkey % 7
         WHEN 0 THEN ' Industrial ' WHEN 1 THEN 'Residential' WHEN 2 THEN 'MANUFACTURING'
         WHEN 3 THEN NULL WHEN 4 THEN concat(chr(9), 'Warehouse') WHEN 5 THEN 'Light Industrial'
         ELSE '' END AS zoning_type,
       CASE p_partkey % 3
         WHEN 0 THEN ' Special Commercial' WHEN 1 THEN 'Single Family' ELSE NULL END AS zoning_subtype,
       CASE p_partkey % 11
         WHEN 0 THEN '3900' WHEN 1 THEN '1100' WHEN 2 THEN '5000' WHEN 3 THEN '39.5'
         WHEN 4 THEN 'abc' WHEN 5 THEN ' ' WHEN 6 THEN '2999' WHEN 7 THEN '4999.5' ELSE NULL END
         AS lbcs_activity,
       CASE p_partkey % 17
         WHEN 0 THEN '4100' WHEN 1 THEN '3999.5' WHEN 2 THEN '+300' WHEN 3 THEN '' ELSE NULL END
         AS lbcs_function,
       CASE WHEN p_partkey % 2 = 0 THEN 'polk' ELSE NULL END AS county,
       CASE WHEN p_partkey % 2 = 0 THEN 'IA' ELSE 'OR' END AS state2
FROM part
"""

# Nested parcels: a thousand squares about one centre, 1/128 apart, a centre for every
# thousand parts. Some ids grow outwards, some inwards, some jump.
NESTED = """
SELECT CASE floor(p_partkey / 1000) % 3
         WHEN 0 THEN p_partkey WHEN 1 THEN 1000000 - p_partkey ELSE p_partkey * 7919 % 1000003 END AS parcel_id,
       CAST(8 + floor(p_partkey / 1000) % 3 * 16 AS DOUBLE) AS cx,
       CAST(8 + floor(p_partkey / 3000) * 4 AS DOUBLE) AS cy,
       CAST(1 + p_partkey % 1000 AS DOUBLE) / 128e0 AS half
FROM part
"""

# Coasts: one polygon of up to 200,000 vertices, the land below a jagged line of orders.
COAST = """
SELECT CAST(floor(o_orderkey / 200000) AS BIGINT) AS coast, o_orderkey % 200000 AS k,
       CAST(o_orderkey % 200000 AS DOUBLE) / 2048e0 AS x,
       50e0 + CAST(o_orderkey % 4096 AS DOUBLE) / 256e0 + CAST(o_orderkey * 6151 % 64 AS DOUBLE) / 64e0 AS y
FROM orders
"""

# Depots: a point per supplier, with a column of ten thousand characters.
DEPOTS = """
SELECT s_suppkey,
       CAST(s_suppkey * 7919 % 6400 AS DOUBLE) / 128e0 AS longitude,
       CAST(s_suppkey * 3571 % 6400 AS DOUBLE) / 128e0 AS latitude,
       repeat(s_name, 550) AS notes
FROM supplier
"""

# Every order as a point of a lattice: many lie on edges and corners of tracts.
LATTICE = """
SELECT o_orderkey AS call_num,
       CAST(o_orderkey % 21 * 5 AS DOUBLE) AS longitude,
       CAST(o_orderkey * 13 % 101 AS DOUBLE) AS latitude
FROM orders
"""


def _derive(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=source)


def _spread(df: DataFrame) -> DataFrame:
    """Rows of a small file dealt to all tasks, where each has much text to be parsed."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, CALLS, "lineitem")


def call_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_point_geometry(calls(spark, sf_dir))


def depot_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_point_geometry(_derive(spark, sf_dir, DEPOTS, "supplier"))


def lattice_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_point_geometry(_derive(spark, sf_dir, LATTICE, "orders"))


def _ring(*corners: tuple[str, str]) -> F.Column:
    """WKT of a closed ring through corners given as SQL expressions."""
    names = [part for corner in (*corners, corners[0]) for part in corner]
    pattern = "(" + ", ".join(["%s %s"] * (len(corners) + 1)) + ")"
    return F.format_string(pattern, *(F.expr(name).cast("string") for name in names))


def tracts_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracts with their shape as WKT."""
    low, right = ("x0", "y0"), ("x0 + 20", "y0")
    high, left = ("x0 + 20", "y0 + 20"), ("x0", "y0 + 20")
    ring = F.when(F.col("full_field") == 1, _ring(low, right, high, left)).otherwise(
        _ring(low, right, left)
    )
    return _derive(spark, sf_dir, TRACTS, "nation").select(
        "n_nationkey", "n_name", F.concat(F.lit("POLYGON("), ring, F.lit(")")).alias("wkt")
    )


def tracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracts_from_wkt(tracts_text(spark, sf_dir)).drop("wkt")


def shapes_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def at(x: int, y: int) -> tuple[str, str]:
        return f"ax + {x} * unit", f"ay + {y} * unit"

    def square(x: int, y: int, side: int) -> F.Column:
        return _ring(at(x, y), at(x + side, y), at(x + side, y + side), at(x, y + side))

    def text(kind: str, *pieces) -> F.Column:
        return F.concat(F.lit(kind), *(p if isinstance(p, F.Column) else F.lit(p) for p in pieces))

    ell = _ring(at(0, 0), at(2, 0), at(2, 1), at(1, 1), at(1, 2), at(0, 2))
    triangle = _ring(at(0, 0), at(2, 0), at(0, 2))
    wkt = (
        F.when(F.col("form") == 0, text("POLYGON(", ell, ")"))
        .when(F.col("form") == 1, text("POLYGON(", square(0, 0, 3), ",", square(1, 1, 1), ")"))
        .when(F.col("form") == 2, text("polygon (", triangle, ")"))
        .otherwise(
            text("MULTIPOLYGON((", square(0, 0, 1), "), (", square(2, 0, 1), "))")
        )
    )
    return _spread(_derive(spark, sf_dir, SHAPES, "supplier")).select("s_suppkey", "form", wkt.alias("wkt"))


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracts_from_wkt(shapes_text(spark, sf_dir)).drop("wkt")


def prospects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, PROSPECTS, "orders")


def nested_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = _ring(
        ("cx - half", "cy - half"), ("cx + half", "cy - half"), ("cx + half", "cy + half"), ("cx - half", "cy + half")
    )
    table = _spread(_derive(spark, sf_dir, NESTED, "part")).withColumn("wkt", F.concat(F.lit("POLYGON("), ring, F.lit(")")))
    return tracts_from_wkt(table).drop("cx", "cy", "half", "wkt")


def coasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertex = F.struct("k", F.format_string("%s %s", F.col("x").cast("string"), F.col("y").cast("string")).alias("text"))
    lines = _derive(spark, sf_dir, COAST, "orders").groupBy("coast").agg(
        F.array_sort(F.collect_list(vertex)).alias("line"), F.max("x").alias("right")
    )
    wkt = F.concat(
        F.lit("POLYGON((0 0, "), F.array_join("line.text", ", "), F.format_string(", %s 0, 0 0))", F.col("right").cast("string"))
    )
    return tracts_from_wkt(lines.select("coast", wkt.alias("wkt"))).drop("wkt")


def parcel_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, PARCELS, "part")


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = _ring(
        ("x0", "y0"), ("x0 + side", "y0"), ("x0 + side", "y0 + side"), ("x0", "y0 + side")
    )
    wkt = F.concat(F.lit("POLYGON("), ring, F.lit(")"))
    table = parcel_attributes(spark, sf_dir).withColumn("wkt", wkt)
    return tracts_from_wkt(table).drop("x0", "y0", "side", "wkt")
