"""Cell index of polygons: the equi-join form of "point intersects polygon".

The plane is cut into square cells whose side is a power of two, so that cell numbers
of doubles are exact. Each polygon picks its own *level* (log2 of the side) from its
extent and vertex count, and is cut into the cells its box covers; a cell that lies
outside is dropped. A point has one cell per level in use.

A cell row carries only what a point *inside that cell* needs: the polygon's edges that
may pass through the cell, plus vertical stand-ins on the cell's right border for all
edges further right. To the right of the cell only the heights of edge ends matter, and
heights shared by two edges cancel, so mostly one stand-in or none is left. The even-odd
test over this short list equals the test over the whole polygon.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelgrid.functions import expressions as X
from parcelgrid.functions.geometry import once
from parcelgrid.session import written

POINT_X, POINT_Y = "__x", "__y"
KEY = "__cell"
EDGES = "__edges"
REST = "__rest"
LEVEL = "__level"

# Levels are multiples of LEVEL_STEP: fewer levels to probe, cells up to 4x too wide.
LEVEL_STEP = 2
MIN_LEVEL, MAX_LEVEL = -20, 42
# A key packs 6 bits of level and twice 29 bits of cell number.
CELL_BITS = 29
HALF_RANGE = 1 << (CELL_BITS - 1)
# Edges tested by plain generated code; the few cells with more keep the rest in an array.
SLOTS = 4

# Polygons of more vertices are indexed edge by edge, as rows, and not as one list.
LARGE = 10_000
HEAVY = 48
DIVISIONS = 4
# The rows of a cell that is divided take so many times as many bytes, as a rule.
GROWTH = 5

# Upper bounds in bytes for a cell row in a broadcast hash table, and for one more edge.
ROW_BYTES = 256
EDGE_BYTES = 64
# How many levels coarser a plan may go to fit the broadcast limit.
SHIFTS = (0, 2, 4)


@dataclass(frozen=True)
class LevelStats:
    """What one level of a polygon set holds, at each shift of ``SHIFTS``."""

    level: int
    polygons: int
    cells: dict[int, int]
    bytes: dict[int, int]


@dataclass(frozen=True)
class PolygonStats:
    levels: list[LevelStats]
    srid: int | None
    most_edges: int = 0
    box: tuple[float, float, float, float] | None = None

    def index_bytes(self, shift: int) -> int:
        return sum(level.bytes[shift] for level in self.levels)

    def index_cells(self, shift: int) -> int:
        return sum(level.cells[shift] for level in self.levels)

    def levels_at(self, shift: int) -> list[int]:
        return [level.level + shift for level in self.levels]

    def overlap(self) -> float:
        """How many polygons have a cell at an average spot of the box around them all."""
        if self.box is None:
            return 0.0
        xmin, ymin, xmax, ymax = self.box
        polygons = float(sum(level.polygons for level in self.levels))
        covered = sum(level.cells[0] * 4.0**level.level for level in self.levels)
        area = (xmax - xmin) * (ymax - ymin)
        return min(polygons, covered / area) if area > 0 else polygons


# 4 to 64 cells across the longer side of the box, by the number of vertices; wide
# enough for cell numbers to fit the key.
_LEVEL_OF = f"""
CASE WHEN g.kind = 'POINT' THEN CAST(raise_error('the polygon side holds a point') AS INT)
     ELSE CAST({LEVEL_STEP} * ceil(greatest(
       CASE WHEN greatest(g.bbox.xmax - g.bbox.xmin, g.bbox.ymax - g.bbox.ymin) > 0
            THEN log2(greatest(g.bbox.xmax - g.bbox.xmin, g.bbox.ymax - g.bbox.ymin)
              / greatest(4e0, least(64e0, aggregate(flatten(g.parts), 0, (n, r) -> n + size(r)) / 10e0)))
            ELSE {MIN_LEVEL} END,
       CASE WHEN greatest(abs(g.bbox.xmin), abs(g.bbox.ymin), abs(g.bbox.xmax), abs(g.bbox.ymax)) > 0
            THEN ceil(log2(greatest(
              abs(g.bbox.xmin), abs(g.bbox.ymin), abs(g.bbox.xmax), abs(g.bbox.ymax)))) - {CELL_BITS - 2}
            ELSE {MIN_LEVEL} END,
       {MIN_LEVEL}) / {LEVEL_STEP}) AS INT) END
"""


def side_of(level: str) -> str:
    """2 ** level, exactly."""
    return f"(shiftleft(1L, greatest({level}, 0)) / shiftleft(1L, greatest(-({level}), 0)))"


def _span(axis: str, side: str) -> str:
    return f"sequence(floor(g.bbox.{axis}min / {side}), floor(g.bbox.{axis}max / {side}))"


def _cells_passed(side: str) -> str:
    """Upper bound of the cells the edges pass, summed over the edges."""
    return f"""
aggregate({EDGES}, 0L, (n, e) -> n + 1
  + abs(floor(e.x2 / {side}) - floor(e.x1 / {side})) + floor(e.y2 / {side}) - floor(e.y1 / {side}))
"""


def _measured(polygons: DataFrame, columns: list) -> DataFrame:
    """``columns``, the geometry ``g`` and its level, each evaluated once; no NULL shapes."""
    shapes = polygons.select(*columns, once(F.col("geometry")).alias("g")).where("g IS NOT NULL")
    return shapes.select("*", once(F.expr(_LEVEL_OF)).alias(LEVEL))


def polygon_stats(polygons: DataFrame, payload: list[str]) -> PolygonStats:
    """One pass over the polygon side; at most one small row per level comes back."""
    payload_bytes = F.length(F.to_json(F.struct(*payload))) if payload else F.lit(0)
    sums = []
    for shift in SHIFTS:
        side = side_of(f"{LEVEL} + {shift}")
        cells = (
            f"(floor(xmax / {side}) - floor(xmin / {side}) + 1)"
            f" * (floor(ymax / {side}) - floor(ymin / {side}) + 1)"
        )
        # Coarser cells are passed less often, so the count of shift 0 bounds the others.
        size = f"{cells} * (__payload + {ROW_BYTES}) + __passed * {EDGE_BYTES}"
        sums += [
            F.expr(f"sum({cells}) AS cells_{shift}"),
            F.expr(f"sum({size}) AS bytes_{shift}"),
        ]
    box = ("xmin", "ymin", "xmax", "ymax")
    rows = (
        _measured(polygons, [payload_bytes.alias("__payload")])
        .select(
            "__payload",
            LEVEL,
            F.expr("g.srid AS srid"),
            *(F.expr(f"g.bbox.{name} AS {name}") for name in box),
            F.expr(f"{X.edges('g.parts')} AS {EDGES}"),
        )
        .select("*", F.expr(f"{_cells_passed(side_of(LEVEL))} AS __passed"))
        .groupBy(LEVEL)
        .agg(
            F.expr("count(1) AS polygons"),
            F.expr("min(srid) AS srid_min"),
            F.expr("max(srid) AS srid_max"),
            F.expr(f"max(size({EDGES})) AS most_edges"),
            *(F.expr(f"{'min' if name.endswith('min') else 'max'}({name}) AS {name}") for name in box),
            *sums,
        )
        .collect()
    )
    if any(r[LEVEL] + max(SHIFTS) > MAX_LEVEL for r in rows):
        raise ValueError("polygon coordinates are out of range")
    srids = {r["srid_min"] for r in rows} | {r["srid_max"] for r in rows}
    if len(srids) > 1:
        raise ValueError(f"polygons of several SRIDs in one join: {sorted(srids)}")
    levels = [
        LevelStats(
            r[LEVEL],
            r["polygons"],
            {s: r[f"cells_{s}"] for s in SHIFTS},
            {s: r[f"bytes_{s}"] for s in SHIFTS},
        )
        for r in sorted(rows, key=lambda r: r[LEVEL])
    ]
    most_edges = max((r["most_edges"] for r in rows), default=0)
    around = tuple(
        (min if name.endswith("min") else max)(r[name] for r in rows) for name in box
    ) if rows else None
    return PolygonStats(levels, next(iter(srids), None), most_edges, around)


def _pack(level: str, cx: str, cy: str) -> str:
    return (
        f"(shiftleft(CAST({level} - {MIN_LEVEL} AS BIGINT), {2 * CELL_BITS})"
        f" | shiftleft({cx} + {HALF_RANGE}L, {CELL_BITS}) | ({cy} + {HALF_RANGE}L))"
    )


def point_key(x: str, y: str, level: int) -> str:
    """Cell key of a point at one level; NULL far outside, where no polygon can be."""
    per_unit = f"{2.0**-level!r}D"
    limit = f"{float(HALF_RANGE - 1)!r}D"
    return (
        f"CASE WHEN abs({x} * {per_unit}) < {limit} AND abs({y} * {per_unit}) < {limit} THEN "
        + _pack(str(level), f"floor({x} * {per_unit})", f"floor({y} * {per_unit})")
        + " END"
    )


def point_keys(x: str, y: str, levels: list[int]) -> Column:
    """Generator of one cell key per level in use."""
    keys = ", ".join(point_key(x, y, level) for level in levels)
    return F.expr(f"explode(array({keys})) AS {KEY}")


def box_cells(polygons: DataFrame, payload: list[str], shift: int) -> DataFrame:
    """One row per polygon and cell of its box, with the whole geometry ``g``."""
    return _box_keys(_measured(polygons, payload), [*payload, "g"], shift)


def _box_keys(measured: DataFrame, kept: list[str], shift: int) -> DataFrame:
    side = side_of(f"{LEVEL} + {shift}")
    return (
        measured.select("*", F.expr(f"explode({_span('y', side)}) AS __cy"))
        .select("*", F.expr(f"explode({_span('x', side)}) AS __cx"))
        .select(*kept, F.expr(f"{_pack(f'{LEVEL} + {shift}', '__cx', '__cy')} AS {KEY}"))
    )


def most_in_a_cell(polygons: DataFrame, shift: int) -> int:
    """The most boxes that meet one cell: no cell of the index has more rows."""
    boxes = _measured(polygons, []).select(LEVEL, F.expr("named_struct('bbox', g.bbox) AS g"))
    counts = _box_keys(boxes, [], shift).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


# Where an edge runs inside the band, as first and last cell column, a little padded so
# that rounding never drops a cell.
_EDGE_IN_BAND = """
  transform(array(CASE WHEN e.y1 = e.y2 THEN named_struct('a', e.x1, 'b', e.x2)
    ELSE named_struct(
      'a', e.x1 + (greatest(e.y1, __bottom) - e.y1) * ((e.x2 - e.x1) / (e.y2 - e.y1)),
      'b', e.x1 + (least(e.y2, __top) - e.y1) * ((e.x2 - e.x1) / (e.y2 - e.y1))) END),
    s -> named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2,
      'c0', floor(greatest(least(s.a, s.b), least(e.x1, e.x2)) / __side
                  - 1e-6 - abs(e.x1 / __side) * 1e-13),
      'c1', floor(least(greatest(s.a, s.b), greatest(e.x1, e.x2)) / __side
                  + 1e-6 + abs(e.x1 / __side) * 1e-13)))[0]
"""
_IN_BAND = f"""
transform(filter({EDGES}, e -> e.y2 >= __bottom AND e.y1 < __top), e -> {_EDGE_IN_BAND})
"""

# Per cell of the band: edges that may pass it, and the end heights of edges further
# right, cut to the band; heights that occur twice cancel.
_CELLS_OF_BAND = """
explode(transform(sequence(__cx0, __cx1), cx -> named_struct(
  'cx', cx,
  'through', filter(__band, e -> e.c0 <= cx AND e.c1 >= cx),
  'heights', aggregate(
    array_sort(flatten(transform(filter(__band, e -> e.c0 > cx), e -> array(
      greatest(least(e.y1, __top), __bottom), greatest(least(e.y2, __top), __bottom))))),
    CAST(array() AS array<double>),
    (hs, h) -> CASE WHEN size(hs) > 0 AND get(hs, size(hs) - 1) = h
                    THEN slice(hs, 1, size(hs) - 1) ELSE concat(hs, array(h)) END)))) AS __c
"""

# The remaining heights come in pairs: [0, 1), [2, 3), ... are the stretches with an odd
# number of crossings further right, and become edges on the cell's right border.
_EDGES_OF_CELL = f"""
concat(
  transform(__c.through, e -> named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2)),
  transform(filter(__c.heights, (h, i) -> i % 2 = 0), (h, i) -> named_struct(
    'x1', (__c.cx + 1) * __side, 'y1', h,
    'x2', (__c.cx + 1) * __side, 'y2', get(__c.heights, 2 * i + 1)))) AS {EDGES}
"""


def _cut(bands: DataFrame, payload: list[str], kept: list[str], level: str) -> DataFrame:
    """Bands (__cy, __cx0 to __cx1, __side and edges) cut into cells, without those outside."""
    bands = bands.select("*", F.expr("__cy * __side AS __bottom"), F.expr("(__cy + 1) * __side AS __top"))
    cells = (
        bands.select("*", F.expr(f"{_IN_BAND} AS __band"))
        .select(*payload, *kept, "__side", "__cy", F.expr(_CELLS_OF_BAND))
        .where("size(__c.through) > 0 OR size(__c.heights) > 0")
    )
    key = F.expr(f"{_pack(level, '__c.cx', '__cy')} AS {KEY}")
    return cells.select(*payload, *(c for c in kept if c == LEVEL), key, F.expr(_EDGES_OF_CELL))


def polygon_cells(
    polygons: DataFrame,
    payload: list[str],
    shift: int,
    partitions: int,
    large: bool = False,
    limit: int = 0,
) -> DataFrame:
    """The index: ``payload`` columns, level, key and edge list per polygon and cell.

    Each polygon row is worked on by itself, so equal polygons stay separate rows.
    ``partitions`` > 0 spreads the polygons before the work, for sets read from few files.
    ``large`` says that some have more than ``LARGE`` edges; those are worked on as rows,
    and their cells divided where an index of ``limit`` bytes has room.
    """
    if large:
        rows = large_polygon_cells(polygons, payload, shift, limit)
        return rows.unionByName(_cells_by_list(polygons, payload, shift, partitions, True).drop(LEVEL))
    return _cells_by_list(polygons, payload, shift, partitions, False)


def _cells_by_list(
    polygons: DataFrame, payload: list[str], shift: int, partitions: int, large: bool
) -> DataFrame:
    if partitions:
        polygons = polygons.select(*payload, "geometry").repartition(partitions)
    side = side_of(f"{LEVEL} + {shift}")
    bands = (
        _measured(polygons, payload)
        .where(f"NOT {large} OR aggregate(flatten(g.parts), 0, (n, r) -> n + size(r) - 1) <= {LARGE}")
        .select("*", F.expr(f"{side} AS __side"))
        .select(
            *payload,
            LEVEL,
            "__side",
            F.expr(f"{X.edges('g.parts')} AS {EDGES}"),
            F.expr("floor(g.bbox.xmin / __side) AS __cx0"),
            F.expr("floor(g.bbox.xmax / __side) AS __cx1"),
            F.expr(f"explode({_span('y', '__side')}) AS __cy"),
        )
    )
    return _cut(bands, payload, [LEVEL], f"{LEVEL} + {shift}")


def large_polygon_cells(polygons: DataFrame, payload: list[str], shift: int, limit: int) -> DataFrame:
    """The same index for polygons of more than ``LARGE`` edges, which need not fit a task.

    Edges travel as rows to the cells they may pass. Their end heights concern all cells
    further left, but heights that occur twice cancel: first those of edges in one column,
    which leaves little more than the places where the border changes column, and then those
    of each cell. So no task holds more of a polygon than one cell's edges. Cells with more
    than ``HEAVY`` edges are then divided, ``DIVISIONS`` times at most and within ``limit``
    bytes; so the keys are of several levels.
    """
    shapes = _measured(polygons.select(*payload, "geometry"), payload)
    shapes = shapes.select("*", F.expr(f"{X.edges('g.parts')} AS {EDGES}")).where(f"size({EDGES}) > {LARGE}")
    shapes = written(
        shapes.select(
            F.monotonically_increasing_id().alias("__id"),
            *payload,
            LEVEL,
            F.expr(f"{side_of(f'{LEVEL} + {shift}')} AS __side"),
            F.expr("g.bbox.xmin AS __xmin"),
            F.expr("g.bbox.xmax AS __xmax"),
            EDGES,
        ),
        "large-polygons",
    )
    heads = shapes.select("__id", *payload, LEVEL, "__side")
    at = ["__id", "__cy"]
    edges = (
        shapes.select(
            "__id",
            "__side",
            F.expr("floor(__xmin / __side) AS __cx0"),
            F.expr("floor(__xmax / __side) AS __cx1"),
            F.expr(f"explode({EDGES}) AS e"),
        )
        .select("*", F.expr("explode(sequence(floor(e.y1 / __side), floor(e.y2 / __side))) AS __cy"))
        .select("*", F.expr("__cy * __side AS __bottom"), F.expr("(__cy + 1) * __side AS __top"))
        .select(*at, "__cx0", "__cx1", "__bottom", "__top", once(F.expr(_EDGE_IN_BAND)).alias("e"))
    )
    edges = written(edges, "large-polygon-edges")
    columns = "sequence(greatest(e.c0, __cx0), least(e.c1, __cx1))"
    passed = edges.where("least(e.c1, __cx1) >= greatest(e.c0, __cx0)").select(
        *at, F.expr(f"explode({columns}) AS __cx"), "e", F.lit(None).cast("double").alias("h")
    )
    ends = "array(greatest(least(e.y1, __top), __bottom), greatest(least(e.y2, __top), __bottom))"
    odd = F.expr("count(1) % 2 = 1")
    turns = edges.select(*at, "__cx0", "__cx1", F.expr("e.c0 AS c0"), F.expr(f"explode({ends}) AS h"))
    turns = turns.groupBy(*at, "__cx0", "__cx1", "c0", "h").agg(odd.alias("odd")).where("odd AND c0 > __cx0")
    left = turns.select(*at, F.expr("explode(sequence(__cx0, least(c0 - 1, __cx1))) AS __cx"), "h")
    left = left.groupBy(*at, "__cx", "h").agg(odd.alias("odd")).where("odd")
    left = left.select(*at, "__cx", F.lit(None).cast(edges.schema["e"].dataType).alias("e"), "h")
    cells = passed.union(left).groupBy(*at, "__cx").agg(
        F.array_sort(F.collect_list("e")).alias("through"), F.array_sort(F.collect_list("h")).alias("heights")
    )
    cell = F.expr("named_struct('cx', __cx, 'through', through, 'heights', heights) AS __c")
    key = F.expr(f"{_pack(f'{LEVEL} + {shift}', '__c.cx', '__cy')} AS {KEY}")
    rows = cells.select(*at, cell).join(heads, "__id").select(*payload, key, F.expr(_EDGES_OF_CELL))
    heavy = f"size({EDGES}) > {HEAVY} AND {DIVISIBLE}"
    size = row_bytes(payload)
    rows = written(rows, "large-polygon-cells")
    for _ in range(DIVISIONS):
        total, to_cut = rows.agg(F.sum(size), F.sum(F.when(F.expr(heavy), size))).first()
        if not to_cut or total + GROWTH * to_cut > limit:
            break
        rows = rows.where(f"NOT ({heavy})").union(divided(rows.where(heavy), payload))
        rows = written(rows, "large-polygon-cells")
    return rows


def levels_of(index: DataFrame) -> list[int]:
    return sorted(r[0] for r in index.select(F.expr(KEY_LEVEL)).distinct().collect())


# What a key says: level, column and row of the cell.
KEY_LEVEL = f"(CAST(shiftrightunsigned({KEY}, {2 * CELL_BITS}) AS INT) + {MIN_LEVEL})"
KEY_X = f"((shiftright({KEY}, {CELL_BITS}) & {2 * HALF_RANGE - 1}L) - {HALF_RANGE}L)"
KEY_Y = f"(({KEY} & {2 * HALF_RANGE - 1}L) - {HALF_RANGE}L)"
_FINER = 1 << LEVEL_STEP


def ancestor(level: str) -> str:
    """Key of the cell of a coarser ``level`` that holds the cell."""
    up = f"{level} - {KEY_LEVEL}"
    return _pack(level, f"shiftright({KEY_X}, {up})", f"shiftright({KEY_Y}, {up})")


# Cells one level step finer exist, and their numbers fit the key.
DIVISIBLE = (
    f"({KEY_LEVEL} - {LEVEL_STEP} >= {MIN_LEVEL}"
    f" AND greatest(abs({KEY_X}), abs({KEY_Y})) + 1 < {HALF_RANGE // _FINER})"
)

# The polygon holds the whole cell: all that is left is one upright edge on its right.
COVERS = f"""
(size({EDGES}) = 1 AND {EDGES}[0].x1 = {EDGES}[0].x2
 AND {EDGES}[0].x1 >= ({KEY_X} + 1) * {side_of(KEY_LEVEL)}
 AND {EDGES}[0].y1 <= {KEY_Y} * {side_of(KEY_LEVEL)}
 AND {EDGES}[0].y2 >= ({KEY_Y} + 1) * {side_of(KEY_LEVEL)})
"""


def divided(index: DataFrame, payload: list[str]) -> DataFrame:
    """Every cell row as rows of the cells one step finer: its edges are all they need."""
    bands = index.select(
        *payload,
        EDGES,
        F.expr(f"{KEY_LEVEL} - {LEVEL_STEP} AS __finer"),
        F.expr(f"{KEY_X} * {_FINER} AS __cx0"),
        F.expr(f"{KEY_X} * {_FINER} + {_FINER - 1} AS __cx1"),
        F.expr(f"explode(sequence({KEY_Y} * {_FINER}, {KEY_Y} * {_FINER} + {_FINER - 1})) AS __cy"),
    ).select("*", F.expr(f"{side_of('__finer')} AS __side"))
    return _cut(bands, payload, ["__finer"], "__finer")


def row_bytes(payload: list[str]) -> Column:
    """Upper bound of the bytes of an index row in a broadcast hash table."""
    own = F.length(F.to_json(F.struct(*payload))) if payload else F.lit(0)
    return own + ROW_BYTES + F.size(EDGES) * EDGE_BYTES


_ENDS = ("x1", "y1", "x2", "y2")


def with_slots(index: DataFrame) -> DataFrame:
    """Spread the first edges over plain double columns; unused slots can never hit."""
    slots = [
        F.expr(f"coalesce(get({EDGES}, {i}).{end}, {X.INFINITY}) AS __{end}_{i}")
        for i in range(SLOTS)
        for end in _ENDS
    ]
    rest = f"CASE WHEN size({EDGES}) > {SLOTS} THEN slice({EDGES}, {SLOTS + 1}, size({EDGES})) END"
    kept = [c for c in index.columns if c not in (EDGES, LEVEL)]
    return index.select(*kept, *slots, F.expr(f"{rest} AS {REST}"))


def _slots_total(x: str, y: str) -> str:
    # Each slot has its own on-edge bit, so the tests combine by XOR, which needs no
    # overflow check: the generated method stays small enough for the JIT compiler.
    tests = (
        X.edge_test(*(f"__{end}_{i}" for end in _ENDS), x, y, X.ON_EDGE << i) for i in range(SLOTS)
    )
    return f"({' ^ '.join(tests)})"


def slots_may_hit(x: str, y: str) -> Column:
    """Exact where no edges are left over, else "look again"."""
    return F.expr(f"{REST} IS NOT NULL OR {X.is_hit(_slots_total(x, y))}")


def slots_only_hit(x: str, y: str) -> Column:
    """Exact for rows without edges left over."""
    return F.expr(X.is_hit(_slots_total(x, y)))


def slots_hit(x: str, y: str) -> Column:
    total = f"{_slots_total(x, y)} + {X.edges_total(REST, x, y)}"
    return F.expr(f"{REST} IS NULL OR {X.is_hit(total)}")
