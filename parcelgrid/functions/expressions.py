"""SQL text of the spatial expressions.

Each is written once, here, and used in two ways: as the body of a SQL function and
inside the expressions of the spatial join. Text goes to Spark in one call, while the
same tree built from Column calls takes one call per node.
"""

from __future__ import annotations

from parcelgrid.types import GEOMETRY_TYPE, PARTS_TYPE, VERTEX_TYPE

GEOMETRY = GEOMETRY_TYPE.simpleString()
PARTS = PARTS_TYPE.simpleString()
VERTEX = VERTEX_TYPE.simpleString()
RING = f"array<{VERTEX}>"
INFINITY = "double('Infinity')"

# Patterns of well-known text. White space is cut down first, then bodies are taken out
# and split at plain strings: no pattern repeats over vertices.
KIND_PATTERN = r"(?i)^(POINT|POLYGON|MULTIPOLYGON)(\(| EMPTY$)"
POINT_PATTERN = r"(?i)^POINT\((.*)\)$"
POLYGON_PATTERN = r"(?i)^POLYGON\(\((.*)\)\)$"
MULTIPOLYGON_PATTERN = r"(?i)^MULTIPOLYGON\(\(\((.*)\)\)\)$"
BETWEEN_PARTS = r"\)\),\(\("
BETWEEN_RINGS = r"\),\("
# Keeps out what a cast would take: NaN, Infinity, type suffixes.
VERTEX_PATTERN = r"^[-+0-9.eE]+ [-+0-9.eE]+$"

# An edge test gives 1 when the edge lies to the right of the point, and ON_EDGE when
# the point lies on it. A sum of tests is a hit when bit 0 (even-odd rule) or any bit
# from ON_EDGE upwards is set.
ON_EDGE = 1 << 32
HIT_MASK = ~(ON_EDGE - 2)


def point(x: str, y: str, srid: str) -> str:
    """Point struct; adding 0.0 turns -0.0 into 0.0, so equal points are one value."""
    return (
        f"named_struct('srid', {srid}, 'kind', 'POINT', 'parts', CAST(NULL AS {PARTS}), "
        f"'bbox', named_struct('xmin', {x} + 0e0, 'ymin', {y} + 0e0, "
        f"'xmax', {x} + 0e0, 'ymax', {y} + 0e0))"
    )


def polygon(parts: str, srid: str) -> str:
    def extreme(function: str, axis: str) -> str:
        return f"{function}(transform(flatten(flatten({parts})), v -> v.{axis}))"

    return (
        f"CAST(named_struct('srid', {srid}, "
        f"'kind', CASE WHEN size({parts}) > 1 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END, "
        f"'parts', {parts}, 'bbox', named_struct("
        f"'xmin', {extreme('array_min', 'x')}, 'ymin', {extreme('array_min', 'y')}, "
        f"'xmax', {extreme('array_max', 'x')}, 'ymax', {extreme('array_max', 'y')})) AS {GEOMETRY})"
    )


_VERTEX_OF = f"""
transform(array(try_cast(split(t, ' ') AS array<double>)), w ->
  CASE WHEN t RLIKE r'{VERTEX_PATTERN}' AND abs(w[0]) + abs(w[1]) < {INFINITY}
       THEN named_struct('x', w[0] + 0e0, 'y', w[1] + 0e0)
       ELSE CAST(raise_error(concat('bad coordinates in WKT: ', left(t, 80))) AS {VERTEX}) END)[0]
"""

_RING_OF = f"""
transform(array(transform(split(r, ','), t -> {_VERTEX_OF})), vs ->
  CASE WHEN size(vs) >= 4 AND vs[0] = element_at(vs, -1) THEN vs
       ELSE CAST(raise_error(concat('unclosed ring in WKT: ', left(r, 80))) AS {RING}) END)[0]
"""

_PARTS_OF = f"""
transform(
  CASE WHEN s.kind = 'POLYGON' THEN array(regexp_extract(s.n, r'{POLYGON_PATTERN}', 1))
       ELSE split(regexp_extract(s.n, r'{MULTIPOLYGON_PATTERN}', 1), r'{BETWEEN_PARTS}') END,
  body -> transform(split(body, r'{BETWEEN_RINGS}'), r -> {_RING_OF}))
"""

# One space between numbers, none beside brackets and commas.
_NORMAL = r"""
trim(regexp_replace(regexp_replace(wkt, r'\s+', ' '), r' ?([(),]) ?', '$1'))
"""

FROM_TEXT = f"""
transform(transform(array({_NORMAL}), n -> named_struct(
    'n', n, 'kind', upper(regexp_extract(n, r'{KIND_PATTERN}', 1)))), s ->
  CASE WHEN s.n IS NULL OR (s.kind <> '' AND s.n NOT LIKE '%(%') THEN CAST(NULL AS {GEOMETRY})
       WHEN s.kind = 'POINT' THEN transform(
         transform(array(regexp_extract(s.n, r'{POINT_PATTERN}', 1)), t -> {_VERTEX_OF}),
         v -> CAST({point("v.x", "v.y", "srid")} AS {GEOMETRY}))[0]
       WHEN s.kind <> '' THEN transform(
         array({_PARTS_OF}),
         p -> {polygon("p", "srid")})[0]
       ELSE CAST(raise_error(concat('unsupported WKT: ', left(s.n, 80))) AS {GEOMETRY}) END)[0]
"""

_RING_TEXT = (
    "concat('(', array_join(transform(r, v -> concat_ws(' ', CAST(v.x AS STRING), "
    "CAST(v.y AS STRING))), ', '), ')')"
)
_PARTS_TEXT = (
    f"array_join(transform(g.parts, p -> concat('(', array_join(transform(p, r -> {_RING_TEXT}), "
    "', '), ')')), ', ')"
)
AS_TEXT = f"""
CASE WHEN g.kind = 'POINT'
       THEN concat('POINT (', CAST(g.bbox.xmin AS STRING), ' ', CAST(g.bbox.ymin AS STRING), ')')
     WHEN g.kind = 'POLYGON' THEN concat('POLYGON ', {_PARTS_TEXT})
     WHEN g.kind = 'MULTIPOLYGON' THEN concat('MULTIPOLYGON (', {_PARTS_TEXT}, ')') END
"""


def edges(parts: str) -> str:
    """All edges of all rings, each with its lower (then left) end first.

    Neighbours that share an edge thus test it with the same arithmetic, so a point
    beside it falls in exactly one of them.
    """
    return f"""
flatten(transform(flatten({parts}), r -> zip_with(
  slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1),
  (p, q) -> CASE WHEN p.y < q.y OR (p.y = q.y AND p.x <= q.x)
                 THEN named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y)
                 ELSE named_struct('x1', q.x, 'y1', q.y, 'x2', p.x, 'y2', p.y) END)))
"""


def edge_test(x1: str, y1: str, x2: str, y2: str, x: str, y: str, on_edge: int = ON_EDGE) -> str:
    """Contribution of one edge (lower end first) to the test of the point (x, y).

    The upper end does not belong to an edge, so a vertex counts once. A horizontal
    edge never counts as crossed, it can only be touched.
    """
    side = f"({x2} - {x1}) * ({y} - {y1}) - ({x} - {x1}) * ({y2} - {y1})"
    return (
        f"CASE WHEN {y} < {y1} OR {y} > {y2} THEN 0L "
        f"WHEN {side} > 0e0 THEN CASE WHEN {y} < {y2} THEN 1L ELSE 0L END "
        f"WHEN {side} = 0e0 AND ({y1} < {y2} OR ({x} >= {x1} AND {x} <= {x2})) THEN {on_edge}L "
        f"ELSE 0L END"
    )


def edges_total(edge_array: str, x: str, y: str) -> str:
    test = edge_test("e.x1", "e.y1", "e.x2", "e.y2", x, y)
    return f"aggregate({edge_array}, 0L, (total, e) -> total + {test})"


def is_hit(total: str) -> str:
    return f"(({total}) & {HIT_MASK}L) <> 0L"


def polygon_hit(geom: str, x: str, y: str) -> str:
    """Exact even-odd test of one point over every edge; the boundary counts as inside."""
    return f"""
({x} BETWEEN {geom}.bbox.xmin AND {geom}.bbox.xmax
 AND {y} BETWEEN {geom}.bbox.ymin AND {geom}.bbox.ymax
 AND {is_hit(edges_total(edges(geom + ".parts"), x, y))})
"""


INTERSECTS = f"""
CASE WHEN a IS NULL OR b IS NULL THEN NULL
     WHEN a.srid <> b.srid THEN CAST(raise_error(
       concat('SRID mismatch: ', a.srid, ' and ', b.srid)) AS BOOLEAN)
     WHEN a.kind = 'POINT' AND b.kind = 'POINT'
       THEN a.bbox.xmin = b.bbox.xmin AND a.bbox.ymin = b.bbox.ymin
     WHEN b.kind = 'POINT' THEN {polygon_hit("a", "b.bbox.xmin", "b.bbox.ymin")}
     WHEN a.kind = 'POINT' THEN {polygon_hit("b", "a.bbox.xmin", "a.bbox.ymin")}
     ELSE CAST(raise_error('st_intersects of two polygons is not supported') AS BOOLEAN) END
"""

DISTANCE = """
CASE WHEN a IS NULL OR b IS NULL THEN NULL
     WHEN a.kind = 'POINT' AND b.kind = 'POINT'
       THEN sqrt(power(a.bbox.xmin - b.bbox.xmin, 2) + power(a.bbox.ymin - b.bbox.ymin, 2))
     ELSE CAST(raise_error('st_distance needs two points') AS DOUBLE) END
"""

SET_SRID = f"""
CASE WHEN g IS NOT NULL THEN CAST(named_struct(
  'srid', srid, 'kind', g.kind, 'parts', g.parts, 'bbox', g.bbox) AS {GEOMETRY}) END
"""

MAKE_POINT = f"""
CASE WHEN abs(px) < {INFINITY} AND abs(py) < {INFINITY} THEN
  CAST({point("px", "py", "CAST(0 AS INT)")} AS {GEOMETRY}) END
"""
