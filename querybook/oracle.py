"""SQL the registered queries are checked against.

It shares only the derivation of the inputs. Shapes are plain comparisons, the grading
rules are written out once more with the checking engine's own functions.
"""

from __future__ import annotations

from querybook import inputs as I

# The keyword rules, once more as one pattern each.
STRONG = (
    r"(?i)\bTRUCK\s*STOP\b|\bTRUCKSTOP\b|\bTRUCKING\b|\bTRUCK\s*TERMINAL\b|\bFREIGHT\b"
    r"|\bLOGISTICS\b|\bDISTRIBUTION\b|\bWAREHOUS|\bTRANSLOAD\b|\bINTERMODAL\b|\bTERMINAL\b"
    r"|\bTRAVEL\s*CENTER\b|\bTRAVEL\s*PLAZA\b|\bTRAVEL\s*STOP\b|\bWEIGH\s*STATION\b"
    r"|\bTRUCK\s*WASH\b|\bPILOT\b|\bFLYING\s*J\b|\bLOVE''?S\b|\bPETRO\b|\bTA\s*TRAVEL\b"
    r"|\bIOWA\s*80\b|\bFEDEX\b|\bUPS\b"
)
WEAK = r"(?i)\bFUEL\b|\bTRAVEL\b|\bPLAZA\b|\bGAS\b|\bSTATION\b"

_ATTRS = [
    "owner",
    "address",
    "struct",
    "zoning_type",
    "zoning_subtype",
    "lbcs_activity",
    "lbcs_function",
]


def _graded(source: str, keys: str, fields: list[str]) -> str:
    """Query of ``keys``, truck_flag, confidence, reasons over ``source``."""
    attrs = ", ".join(f"{a} AS a_{a}" if a in fields else f"NULL::VARCHAR AS a_{a}" for a in _ATTRS)
    code = "CAST(substr(a_{0}, 1, 4) AS INT) BETWEEN 3000 AND 4999"
    digits = "regexp_full_match(substr(a_{0}, 1, 4), '[0-9]{{4}}')"
    hit = f"CASE WHEN {digits} THEN {code} ELSE FALSE END"
    return f"""
SELECT {keys},
  strong <> '' OR zoning IS NOT NULL OR code IS NOT NULL OR (special AND weak <> '') AS truck_flag,
  CASE WHEN strong <> '' THEN CASE WHEN zoning IS NOT NULL OR code IS NOT NULL THEN 'high' ELSE 'medium' END
       WHEN zoning IS NOT NULL AND code IS NOT NULL THEN 'high'
       WHEN zoning IS NOT NULL OR code IS NOT NULL THEN 'medium'
       WHEN special AND weak <> '' THEN 'low' ELSE 'high' END AS confidence,
  CASE WHEN strong <> '' OR zoning IS NOT NULL OR code IS NOT NULL
         THEN concat_ws(';', CASE WHEN strong <> '' THEN 'keyword: ''' || strong || '''' END, zoning, code)
       WHEN special AND weak <> '' THEN 'special commercial + weak keyword: ''' || weak || ''''
       ELSE 'no truck signal' END AS reasons
FROM (
  SELECT *,
    regexp_extract(words, '{STRONG}', 0) AS strong,
    regexp_extract(words, '{WEAK}', 0) AS weak,
    CASE WHEN lower(regexp_replace(a_zoning_type, '^\\s+|\\s+$', '', 'g'))
              IN ('industrial', 'manufacturing', 'warehouse') THEN 'zoning: ' || a_zoning_type END AS zoning,
    CASE WHEN {hit.format("lbcs_activity")} THEN 'lbcs_activity=' || a_lbcs_activity
         WHEN {hit.format("lbcs_function")} THEN 'lbcs_function=' || a_lbcs_function END AS code,
    coalesce(contains(lower(a_zoning_subtype), 'special commercial'), FALSE) AS special
  FROM (
    SELECT *, coalesce(a_owner, '') || ' ' || coalesce(a_address, '') || ' '
              || coalesce(a_struct, '') || ' ' || coalesce(a_zoning_subtype, '') AS words
    FROM (SELECT {keys}, {attrs} FROM {source})))
"""


_PAIRS = f"""
SELECT t.n_nationkey, t.n_name, c.l_orderkey, c.l_linenumber, c.call_num
FROM ({I.TRACTS}) t JOIN ({I.CALLS}) c ON {I.IN_TRACT}
"""
_COUNTS = f"SELECT n_nationkey, n_name, count(call_num) AS roadcall_count FROM ({_PAIRS}) GROUP BY ALL"
_SHAPE_PAIRS = f"""
SELECT s.s_suppkey, s.form, c.l_orderkey FROM ({I.SHAPES}) s JOIN ({I.CALLS}) c ON {I.IN_SHAPE}
"""
# The parcel of lowest id at each prospect. The outer join is on equality: with ranges and
# a condition on the left side in its ON clause, the checking engine lost left rows.
_FOUND = f"""
SELECT p.point_id, p.lat, p.lon, m.parcel_id
FROM ({I.PROSPECTS}) p LEFT JOIN (
  SELECT p.point_id, min(q.parcel_id) AS parcel_id
  FROM ({I.PROSPECTS}) p JOIN ({I.PARCELS}) q
    ON p.lon BETWEEN q.x0 AND q.x0 + q.side AND p.lat BETWEEN q.y0 AND q.y0 + q.side
  GROUP BY p.point_id) m ON m.point_id = p.point_id
"""


def _enriched(error: str = "CAST(NULL AS VARCHAR)") -> str:
    """``error`` is an expression over point_id: the lookup error given with a row."""
    return f"""
SELECT f.point_id, f.lat, f.lon,
  CASE WHEN e.error <> '' OR q.parcel_id IS NULL THEN FALSE ELSE g.truck_flag END AS truck_flag,
  CASE WHEN e.error <> '' THEN 'error' WHEN q.parcel_id IS NULL THEN 'high'
       ELSE g.confidence END AS confidence,
  CASE WHEN e.error <> '' THEN e.error WHEN q.parcel_id IS NULL THEN 'no parcel found'
       ELSE g.reasons END AS reasons,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.owner END AS parcel_owner,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.address END AS parcel_address,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.zoning_type END AS parcel_zoning_type,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.zoning_subtype END AS parcel_zoning_subtype,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.county END AS county,
  CASE WHEN q.parcel_id IS NULL THEN '' ELSE q.state2 END AS state,
  e.error
FROM ({_FOUND}) f
JOIN (SELECT point_id, coalesce({error},
        CASE WHEN lat IS NULL OR lat > 90 THEN 'invalid coordinates' END, '') AS error
      FROM ({I.PROSPECTS})) e ON e.point_id = f.point_id
LEFT JOIN ({I.PARCELS}) q ON q.parcel_id = f.parcel_id AND e.error = ''
LEFT JOIN ({_graded(f"({I.PARCELS})", "parcel_id", _ATTRS)}) g ON g.parcel_id = q.parcel_id
"""


_LOOKUP = f"""
SELECT f.point_id, f.parcel_id, q.owner, f.parcel_id IS NOT NULL AS parcel_matched
FROM ({_FOUND}) f LEFT JOIN ({I.PARCELS}) q ON q.parcel_id = f.parcel_id
"""


def _classified(fields: list[str]) -> str:
    return _graded(f"({I.PARCELS})", "parcel_id", fields)


_CORNERS = """
SELECT n_nationkey, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x0 + 20 AS DOUBLE) AS x1,
       CAST(y0 + 20 AS DOUBLE) AS y1, full_field = 1 AS square
"""
_TRACT_TEXT = f"""
SELECT n_nationkey, 'POLYGON ((' || x0 || ' ' || y0 || ', ' || x1 || ' ' || y0 || ', '
       || CASE WHEN square THEN x1 || ' ' || y1 || ', ' ELSE '' END
       || x0 || ' ' || y1 || ', ' || x0 || ' ' || y0 || '))' AS text
FROM ({_CORNERS} FROM ({I.TRACTS}))
"""


def _double(name: str) -> str:
    """The bytes, low end first, of the doubles that corners of tracts have."""
    return f"""CASE {name} WHEN 0 THEN '0000000000000000' WHEN 20 THEN '0000000000003440'
        WHEN 40 THEN '0000000000004440' WHEN 60 THEN '0000000000004E40'
        WHEN 80 THEN '0000000000005440' WHEN 100 THEN '0000000000005940' END"""


_X0, _Y0, _X1, _Y1 = (_double(name) for name in ("x0", "y0", "x1", "y1"))

_RECENT = "roadcall_call_dt >= TIMESTAMP '2000-02-28 00:00:00'"

ORACLES = {
    "point_geometry": f"""
        SELECT l_orderkey, l_linenumber, l_orderkey % 50 IN (0, 1) AS no_geometry,
               CASE WHEN l_orderkey % 50 NOT IN (0, 1) THEN longitude END AS x,
               CASE WHEN l_orderkey % 50 NOT IN (0, 1) THEN latitude END AS y,
               CASE WHEN l_orderkey % 50 NOT IN (0, 1) THEN 4326 END AS srid
        FROM ({I.CALLS})""",
    "srid_roundtrip": """
        SELECT 4326 AS srid_before, 3857 AS srid_after, count(*) AS points FROM lineitem""",
    "wkt_polygon_parse": f"""
        SELECT s_suppkey, CASE WHEN form = 3 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind,
               4326 AS srid,
               CAST(CASE WHEN form = 3 THEN 2 ELSE 1 END AS BIGINT) AS parts,
               CAST(CASE WHEN form IN (1, 3) THEN 2 ELSE 1 END AS BIGINT) AS rings,
               CAST(CASE form WHEN 0 THEN 7 WHEN 2 THEN 4 ELSE 10 END AS BIGINT) AS vertices,
               ax AS xmin, ay AS ymin,
               ax + CASE WHEN form IN (1, 3) THEN 3 ELSE 2 END * unit AS xmax,
               ay + CASE form WHEN 1 THEN 3 WHEN 3 THEN 1 ELSE 2 END * unit AS ymax
        FROM ({I.SHAPES})""",
    "wkt_text_roundtrip": "SELECT s_suppkey, TRUE AS same FROM supplier",
    "distance": f"""
        SELECT l_orderkey, l_linenumber,
               sqrt((longitude - 3e0) * (longitude - 3e0) + (latitude - 4e0) * (latitude - 4e0)) AS distance
        FROM ({I.CALLS})""",
    "intersects_predicate": f"""
        SELECT inside, inside AS inside_turned, count(*) AS points
        FROM (SELECT longitude BETWEEN 10 AND 90 AND latitude BETWEEN 10 AND 90
                     AND NOT (longitude > 40 AND longitude < 60 AND latitude > 40 AND latitude < 60)
                     AS inside
              FROM ({I.CALLS}))
        GROUP BY inside""",
    "sql_functions": f"""
        SELECT l_orderkey, l_linenumber, 4326 AS srid,
               sqrt((longitude - 3e0) * (longitude - 3e0) + (latitude - 4e0) * (latitude - 4e0)) AS distance,
               longitude <= 50 AND latitude <= 50 AS inside
        FROM ({I.CALLS})""",
    "spatial_join_pairs": f"SELECT n_nationkey, l_orderkey, l_linenumber FROM ({_PAIRS})",
    "spatial_join_no_broadcast": f"SELECT n_nationkey, l_orderkey, l_linenumber FROM ({_PAIRS})",
    "spatial_join_boundary": f"""
        SELECT t.n_nationkey, c.call_num FROM ({I.TRACTS}) t JOIN ({I.LATTICE}) c ON {I.IN_TRACT}""",
    "spatial_join_shapes": f"""
        SELECT s_suppkey, count(*) AS points, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
        FROM ({_SHAPE_PAIRS}) GROUP BY s_suppkey""",
    "hotspots_per_tract": f"SELECT *, 4326 AS srid FROM ({_COUNTS})",
    "hotspots_no_broadcast": _COUNTS,
    "hotspots_duplicate_tracts": f"""
        SELECT n_nationkey, n_name, 2 * roadcall_count AS roadcall_count FROM ({_COUNTS})""",
    "hotspots_geometry_only": f"""
        SELECT CAST(n_nationkey % 5 * 20 AS DOUBLE) AS xmin,
               CAST((n_nationkey // 5) * 20 AS DOUBLE) AS ymin, roadcall_count
        FROM ({_COUNTS})""",
    "hotspots_timestamp_cols": f"""
        SELECT n_nationkey, 1704067200000000 + k AS seen_micros, roadcall_count
        FROM ({_COUNTS}), (VALUES (1), (2)) v(k)""",
    "spatial_join_wide_points": f"""
        SELECT d.s_suppkey, q.parcel_id, md5(d.notes) AS notes_md5
        FROM ({I.DEPOTS}) d JOIN ({I.PARCELS}) q
          ON d.longitude BETWEEN q.x0 AND q.x0 + q.side AND d.latitude BETWEEN q.y0 AND q.y0 + q.side""",
    "wkt_text": f"SELECT n_nationkey, text, CAST(0 AS INT) AS srid FROM ({_TRACT_TEXT})",
    "geoparquet_wkb": f"""
        SELECT n_nationkey, '010300000001000000' || CASE WHEN square THEN '05' ELSE '04' END || '000000'
               || {_X0} || {_Y0} || {_X1} || {_Y0} || CASE WHEN square THEN {_X1} || {_Y1} ELSE '' END
               || {_X0} || {_Y1} || {_X0} || {_Y0} AS wkb
        FROM ({_CORNERS} FROM ({I.TRACTS}))""",
    "job_hotspots": f"""
        SELECT n_nationkey, n_name, roadcall_count, text FROM ({_COUNTS}) JOIN ({_TRACT_TEXT}) USING (n_nationkey)""",
    "job_prospects": f"""
        SELECT truck_flag, count(*) AS prospects, CAST(sum(count(*)) OVER () AS BIGINT) AS observed_rows,
               CAST(sum(count(*) FILTER (WHERE truck_flag)) OVER () AS BIGINT) AS observed_flagged
        FROM ({_enriched()}) GROUP BY truck_flag""",
    "hotspots_large_polygon": f"""
        SELECT coast, count(call_num) AS roadcall_count
        FROM ({I.CALLS}) c JOIN ({I.COAST}) t ON t.k = CAST(c.longitude * 2048 AS BIGINT)
        WHERE c.latitude <= t.y GROUP BY coast""",
    "hotspots_zoned_timestamps": f"""
        SELECT n_nationkey, 1730611800 + 3600 * k AS seen_seconds, roadcall_count
        FROM ({_COUNTS}), (VALUES (0), (1)) v(k)""",
    "hotspot_total": f"""
        SELECT CAST(sum(roadcall_count) AS BIGINT) AS total, count(*) AS tracts,
               CAST(0 AS BIGINT) AS no_geometry
        FROM ({_COUNTS})""",
    "hotspots_from_csv": f"""
        SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, roadcall_count FROM ({_COUNTS})""",
    "coords_not_null": f"SELECT * FROM ({I.PROSPECTS}) WHERE lat IS NOT NULL AND lon IS NOT NULL",
    "calls_within_last_year": f"""
        SELECT l_orderkey, l_linenumber, roadcall_call_dt FROM ({I.CALLS}) WHERE {_RECENT}""",
    "points_table": f"""
        SELECT l_orderkey, l_linenumber, latitude, longitude FROM ({I.CALLS})
        WHERE {_RECENT} AND l_orderkey % 10 <> 3""",
    "points_by_path": f"""
        SELECT point_id, lat AS latitude, lon AS longitude FROM ({I.PROSPECTS})
        WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    "tables_listed": """
        SELECT DISTINCT 'parcelgrid_list' AS namespace,
               CASE WHEN s_suppkey % 4 = 3 THEN 'multipolygons' ELSE 'polygons' END AS table_name
        FROM supplier""",
    "parcel_lookup_first": _LOOKUP,
    "parcel_lookup_no_broadcast": _LOOKUP,
    "parcel_lookup_nested": f"""
        SELECT point_id, min(parcel_id) AS parcel_id, min(parcel_id) IS NOT NULL AS parcel_matched
        FROM ({I.PROSPECTS}) p
        LEFT JOIN ({I.NESTED}) n ON abs(p.lon - n.cx) <= n.half AND abs(p.lat - n.cy) <= n.half
        GROUP BY point_id""",
    "classify_keywords": _classified(["owner", "address", "struct"]),
    "classify_zoning": _classified(["zoning_type"]),
    "classify_lbcs": _classified(["lbcs_activity", "lbcs_function"]),
    "classify_special_commercial": _classified(["owner", "zoning_subtype"]),
    "classify_full": _classified(_ATTRS),
    "sample_attributes": """
        SELECT c_custkey,
               CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE 'XX' END AS state2,
               lower(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE 'XX' END) AS county,
               c_custkey % 2 = 0 AS truck_flag, 'high' AS confidence,
               CASE WHEN c_custkey % 2 = 0
                    THEN 'keyword: ''Warehous'';zoning: Industrial;lbcs_activity=3900'
                    ELSE 'no truck signal' END AS reasons
        FROM customer""",
    "point_ids": """
        SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS first, count(*) - 1 AS last,
               CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS number_sum
        FROM orders""",
    "point_ids_after_shuffle": """
        SELECT 'P' || (row_number() OVER () - 1) AS point_id
        FROM (SELECT DISTINCT l_orderkey FROM lineitem)""",
    "enrich_output": _enriched(),
    "enrich_lookup_errors": f"""
        SELECT point_id, truck_flag, confidence, reasons, parcel_owner, error
        FROM ({_enriched("CASE WHEN CAST(point_id AS BIGINT) % 10 = 3 THEN 'boom' END")})""",
    "enrich_summary": f"""
        SELECT count(*) AS row_count, count(*) FILTER (truck_flag) AS flagged,
               count(*) FILTER (confidence = 'high') AS high_confidence,
               count(*) FILTER (error <> '') AS errors
        FROM ({_enriched()})""",
    "enrich_totals": f"""
        SELECT count(*) AS row_count, count(*) FILTER (truck_flag) AS flagged FROM ({_enriched()})""",
    "limit_head": f"""
        SELECT point_id, confidence, reasons FROM ({_enriched()}) ORDER BY point_id LIMIT 100""",
    "csv_roundtrip": f"""
        SELECT point_id, CAST(lat AS VARCHAR) AS lat, CAST(lon AS VARCHAR) AS lon,
               CAST(truck_flag AS VARCHAR) AS truck_flag, confidence, reasons,
               {", ".join(
                   f"nullif({c}, '') AS {c}" for c in ("parcel_owner", "parcel_address",
                   "parcel_zoning_type", "parcel_zoning_subtype", "county", "state", "error"))}
        FROM ({_enriched()})""",
    "parquet_roundtrip": _enriched(),
    "table_roundtrip": _COUNTS,
    "geoparquet_roundtrip": f"""
        SELECT n_nationkey, n_name, roadcall_count,
               CAST(CASE WHEN n_nationkey % 2 = 0 THEN 93 ELSE 77 END AS BIGINT) AS wkb_bytes,
               '010300000001000000' AS wkb_head
        FROM ({_COUNTS})""",
    "shapefile_in_box": f"""
        SELECT s_suppkey, ax AS xmin, ay + height AS ymax
        FROM (SELECT *, unit * CASE form WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 3 END AS width,
                     unit * CASE form WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 1 END AS height
              FROM ({I.SHAPES}))
        WHERE ax <= 40 AND ax + width >= 20 AND ay <= 45.5 AND ay + height >= 30""",
    "shapefile_roundtrip": f"""
        SELECT s_suppkey, 'shape ' || s_suppkey AS label, count(l_orderkey) AS roadcall_count,
               CASE WHEN form = 3 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind
        FROM ({_SHAPE_PAIRS}) GROUP BY s_suppkey, form""",
    "shapefile_mixed_schemas": f"""
        SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'shape ' || s_suppkey END AS label,
               CASE WHEN s_suppkey % 2 = 1 THEN 'shape ' || s_suppkey END AS tag,
               CASE WHEN form = 3 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind
        FROM ({I.SHAPES})""",
}
