"""Python data source ``shapefile``: shapefiles as a table with a geometry column.

Large files are cut into ranges of records and small ones packed together, so there are as
many input partitions as the bytes need. The driver reads only the headers, many at a time;
a task reads its slices of the ``.shx`` index and then the matching bytes of ``.shp`` and
``.dbf``. With a box, or comparisons of ``geometry.bbox`` with numbers where Spark pushes them
down, a file whose header box lies outside is not opened by any task, and shapes outside are
not decoded.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema

from parcelgrid.types import GEOMETRY_TYPE, MULTIPOLYGON, POINT, POLYGON

# Fixed values of the format: shape type numbers (with Z and M variants).
_NULL = 0
_POINTS = {1, 11, 21}
_POLYGONS = {5, 15, 25}

_HEADER = 100
_PARTITION_BYTES = 32 << 20
# What opening one more file counts for when files are packed.
_OPEN_BYTES = 256 << 10
_HEADER_THREADS = 32
_BATCH_ROWS = 2048


@dataclass(frozen=True)
class _Field:
    name: str
    kind: str
    start: int
    width: int
    decimals: int


@dataclass(frozen=True)
class _Table:
    """Layout of a ``.dbf`` file."""

    rows: int
    header: int
    row_width: int
    fields: tuple[_Field, ...]
    encoding: str


@dataclass
class _Range:
    base: str
    first: int
    last: int
    table: _Table
    bytes: int


# Bounds for xmin, ymin, xmax and ymax of a shape: (lowest, highest) each.
_Bounds = dict[str, tuple[float, float]]
_BOX = ("xmin", "ymin", "xmax", "ymax")


_INFINITY = float("inf")
_ANYWHERE: _Bounds = dict.fromkeys(_BOX, (-_INFINITY, _INFINITY))


def _meeting(box: str | None) -> _Bounds:
    """Bounds of the shapes whose box meets ``box``, four numbers in a row."""
    if box is None:
        return _ANYWHERE
    xmin, ymin, xmax, ymax = (float(v) for v in box.split(","))
    below, above = (lambda v: (-_INFINITY, v)), (lambda v: (v, _INFINITY))
    return {"xmin": below(xmax), "ymin": below(ymax), "xmax": above(xmin), "ymax": above(ymin)}


def _narrowed(bounds: _Bounds, filters: list[Filter]) -> _Bounds:
    """With what the filters say about the corners of a box; other filters say nothing."""
    bounds = dict(bounds)
    for each in filters:
        column, value = getattr(each, "attribute", ()), getattr(each, "value", None)
        if column[:2] != ("geometry", "bbox") or not isinstance(value, (int, float)):
            continue
        low, high = bounds[column[2]]
        if isinstance(each, (GreaterThan, GreaterThanOrEqual, EqualTo)):
            low = max(low, value)
        if isinstance(each, (LessThan, LessThanOrEqual, EqualTo)):
            high = min(high, value)
        bounds[column[2]] = (low, high)
    return bounds


def _may_hold(bounds: _Bounds, box: tuple[float, ...], whole: bool) -> bool:
    """Whether a shape with this box (``whole``), or one inside of it, can meet the bounds."""
    xmin, ymin, xmax, ymax = box
    if whole:
        return all(bounds[name][0] <= v <= bounds[name][1] for name, v in zip(_BOX, box))
    sides = {"xmin": (xmin, xmax), "xmax": (xmin, xmax), "ymin": (ymin, ymax), "ymax": (ymin, ymax)}
    return all(bounds[n][0] <= high and bounds[n][1] >= low for n, (low, high) in sides.items())


@dataclass
class _Pack(InputPartition):
    """Ranges that one task reads."""

    ranges: list[_Range]


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path.removeprefix(scheme)
    if "://" in path or path.startswith("file:"):
        try:
            return pafs.FileSystem.from_uri(path)
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
            raise ValueError(f"this file format cannot reach {path}: {error}") from error
    return pafs.LocalFileSystem(), path


def _read(fs: pafs.FileSystem, path: str, start: int, size: int) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read_at(size, start)


def _find(fs: pafs.FileSystem, base: str, suffix: str) -> str | None:
    for candidate in (base + suffix, base + suffix.upper()):
        if fs.get_file_info(candidate).type == pafs.FileType.File:
            return candidate
    return None


def _needed(fs: pafs.FileSystem, base: str, suffix: str) -> str:
    found = _find(fs, base, suffix)
    if found is None:
        raise FileNotFoundError(f"{base}{suffix} is missing")
    return found


def _bases(path: str) -> tuple[pafs.FileSystem, list[str]]:
    fs, root = _filesystem(path)
    if fs.get_file_info(root).type == pafs.FileType.Directory:
        files = fs.get_file_info(pafs.FileSelector(root, recursive=True))
        bases = sorted(f.path[:-4] for f in files if f.path.lower().endswith(".shp"))
    else:
        bases = [root[:-4] if root.lower().endswith(".shp") else root]
    if not bases:
        raise FileNotFoundError(f"no .shp file under {path}")
    return fs, bases


def _each(bases: list[str], action: Callable) -> list:
    """``action`` on all files, many at a time: each waits for a few small reads."""
    with ThreadPoolExecutor(_HEADER_THREADS) as pool:
        return list(pool.map(action, bases))


def _dbf_layout(fs: pafs.FileSystem, base: str, encoding: str | None) -> _Table:
    path = _needed(fs, base, ".dbf")
    rows, header, row_width = struct.unpack("<IHH", _read(fs, path, 4, 8))
    raw = _read(fs, path, 32, header - 32)
    if encoding is None:
        cpg = _find(fs, base, ".cpg")
        text = _read(fs, cpg, 0, 64).decode("ascii").strip() if cpg else "utf-8"
        encoding = f"cp{text}" if text.isdigit() else text
        encoding = {"ANSI 1252": "cp1252"}.get(encoding, encoding)
    fields, start = [], 1  # byte 0 of a row is the deletion mark
    for at in range(0, len(raw) - 31, 32):
        if raw[at] == 0x0D:
            break
        name = raw[at : at + 11].split(b"\0")[0].decode(encoding)
        kind, width, decimals = chr(raw[at + 11]), raw[at + 16], raw[at + 17]
        fields.append(_Field(name, kind, start, width, decimals))
        start += width
    return _Table(rows, header, row_width, tuple(fields), encoding)


def _spark_type(field: _Field) -> T.DataType:
    if field.kind == "N" and field.decimals == 0:
        return T.LongType() if field.width <= 18 else T.DecimalType(min(field.width, 38), 0)
    if field.kind in "NF":
        return T.DoubleType()
    return {"D": T.DateType(), "L": T.BooleanType()}.get(field.kind, T.StringType())


def _wider(a: T.DataType, b: T.DataType, name: str, base: str) -> T.DataType:
    """The type that holds the values of both files' columns of one name."""
    if a == b:
        return a
    for wide, narrow in ((a, b), (b, a)):
        if isinstance(wide, T.DoubleType) and isinstance(narrow, (T.LongType, T.DecimalType)):
            return wide
        if isinstance(wide, T.DecimalType) and isinstance(narrow, T.LongType):
            return wide
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return a if a.precision > b.precision else b
    raise ValueError(f"column {name} of {base} is {b.simpleString()}, elsewhere {a.simpleString()}")


def _value(raw: bytes, field: _Field, encoding: str):
    if field.kind not in "NFDL":
        return raw.rstrip(b" \0").decode(encoding)
    text = raw.strip(b" \0*").decode("ascii")
    if not text or text == "?":
        return None
    if field.kind == "L":
        return text in "YyTt"
    if field.kind == "D":
        return date(int(text[:4]), int(text[4:6]), int(text[6:8]))
    if field.kind == "N" and field.decimals == 0:
        return int(Decimal(text)) if field.width <= 18 else Decimal(text)
    return float(text)


def _as(value, kind: T.DataType):
    """A number as the merged column holds it."""
    if isinstance(kind, T.DoubleType):
        return float(value)
    return Decimal(value) if isinstance(kind, T.DecimalType) else value


def _area(ring: np.ndarray) -> float:
    """Twice the signed area; negative for a clockwise ring, which is a shell."""
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1]))


def _inside(ring: np.ndarray, spot: np.ndarray) -> bool:
    (x1, y1), (x2, y2) = ring[:-1].T, ring[1:].T
    crosses = (y1 > spot[1]) != (y2 > spot[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        right = spot[0] < (x2 - x1) * (spot[1] - y1) / (y2 - y1) + x1
    return bool(np.count_nonzero(crosses & right) % 2)


def _group_rings(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons as shell plus holes; each hole goes to the smallest shell around it."""
    areas = [_area(ring) for ring in rings]
    shells = [i for i, area in enumerate(areas) if area <= 0]
    if len(shells) <= 1 or len(shells) == len(rings):
        if len(shells) == 1:
            order = [*shells, *(i for i in range(len(rings)) if i not in shells)]
            return [[rings[i] for i in order]]
        return [[ring] for ring in rings]
    polygons = {i: [rings[i]] for i in shells}
    for i, area in enumerate(areas):
        if area > 0:
            around = [s for s in shells if _inside(rings[s], rings[i][0])] or shells
            polygons[min(around, key=lambda s: -areas[s])].append(rings[i])
    return list(polygons.values())


def _shape(content: bytes) -> tuple[str, list[list[np.ndarray]], tuple] | None:
    """(kind, polygons of rings, box) of one record."""
    shape = struct.unpack_from("<i", content)[0]
    if shape == _NULL:
        return None
    if shape in _POINTS:
        x, y = struct.unpack_from("<2d", content, 4)
        return POINT, [], (x, y, x, y)
    if shape not in _POLYGONS:
        raise ValueError(f"shape type {shape} is not supported: only points and polygons are")
    n_parts, n_points = struct.unpack_from("<2i", content, 36)
    starts = np.frombuffer(content, "<i4", n_parts, 44)
    xy = np.frombuffer(content, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2) + 0.0
    rings = []
    for ring in [xy] if n_parts == 1 else np.split(xy, starts[1:]):
        if len(ring) and (ring[0, 0] != ring[-1, 0] or ring[0, 1] != ring[-1, 1]):
            ring = np.vstack([ring, ring[:1]])
        if len(ring) >= 4:
            rings.append(ring)
    if not rings:
        return None
    polygons = _group_rings(rings) if len(rings) > 1 else [rings]
    box = (*xy.min(axis=0), *xy.max(axis=0))
    return POLYGON if len(polygons) == 1 else MULTIPOLYGON, polygons, box


def _geometries(contents: list[bytes], kind: pa.StructType) -> pa.StructArray:
    """Records as a geometry column: flat coordinates, and offsets into them for each level."""
    shapes = [_shape(content) for content in contents]
    polygons = [p for s in shapes if s for p in s[1]]
    rings = [r for p in polygons for r in p]
    flat = np.concatenate([np.zeros((0, 2)), *rings])
    missing = np.array([s is None for s in shapes], bool)
    no_parts = np.array([s is None or s[0] == POINT for s in shapes], bool)

    def ends(sizes: list[int]) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype("i4"))

    fields = {f.name: f.type for f in kind}
    one_part = fields["parts"].value_type
    vertex = one_part.value_type.value_type
    vertices = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(vertex))
    ring_lists = pa.ListArray.from_arrays(ends([len(r) for r in rings]), vertices, type=one_part.value_type)
    part_lists = pa.ListArray.from_arrays(ends([len(p) for p in polygons]), ring_lists, type=one_part)
    parts = pa.ListArray.from_arrays(
        ends([len(s[1]) if s else 0 for s in shapes]), part_lists, type=fields["parts"], mask=pa.array(no_parts)
    )
    boxes = np.array([s[2] if s else (0.0,) * 4 for s in shapes], float).reshape(-1, 4)
    box = pa.StructArray.from_arrays([pa.array(b) for b in boxes.T], fields=list(fields["bbox"]))
    columns = {
        "srid": pa.array(np.zeros(len(shapes), np.int32)),
        "kind": pa.array([s[0] if s else "" for s in shapes]),
        "parts": parts,
        "bbox": box,
    }
    arrays = [columns[f.name].cast(f.type) if f.name in ("srid", "kind") else columns[f.name] for f in kind]
    return pa.StructArray.from_arrays(arrays, fields=list(kind), mask=pa.array(missing))


class ShapefileDataSource(DataSource):
    """Options: ``path`` (a file or a folder), ``encoding`` of the attribute text, ``box``
    (xmin,ymin,xmax,ymax: only shapes whose box meets it, boundary included), ``pushdown``
    (true: take filters; the session must have ``spark.sql.python.filterPushdown.enabled``)."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> T.StructType:
        fs, bases = _bases(self.options["path"])
        kinds: dict[str, T.DataType] = {}
        layouts = _each(bases, lambda base: _dbf_layout(fs, base, self.options.get("encoding")))
        for base, layout in zip(bases, layouts):
            for field in layout.fields:
                kind = _spark_type(field)
                kinds[field.name] = _wider(kinds.get(field.name, kind), kind, field.name, base)
        fields = [T.StructField(name, kind) for name, kind in kinds.items()]
        return T.StructType([*fields, T.StructField("geometry", GEOMETRY_TYPE)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        encoding, box = self.options.get("encoding"), self.options.get("box")
        pushing = self.options.get("pushdown", "false").lower() == "true"
        reader = _PushingReader if pushing else _ShapefileReader
        return reader(self.options["path"], encoding, schema, box)


class _ShapefileReader(DataSourceReader):
    def __init__(self, path: str, encoding: str | None, schema: T.StructType, box: str | None = None):
        self.path, self.encoding, self.schema = path, encoding, schema
        self.bounds = _meeting(box)

    @property
    def pruned(self) -> bool:
        return self.bounds != _ANYWHERE

    def partitions(self) -> list[_Pack]:
        fs, bases = _bases(self.path)

        def cut(base: str) -> list[_Range]:
            rows = (fs.get_file_info(_needed(fs, base, ".shx")).size - _HEADER) // 8
            shp = _needed(fs, base, ".shp")
            size = fs.get_file_info(shp).size
            if self.pruned and not _may_hold(self.bounds, struct.unpack("<4d", _read(fs, shp, 36, 32)), False):
                return []
            table = _dbf_layout(fs, base, self.encoding)
            if table.rows != rows:
                raise ValueError(f"{base}: {rows} shapes but {table.rows} rows of attributes")
            pieces = max(1, min(rows, -(-size // _PARTITION_BYTES)))
            cuts = [rows * i // pieces for i in range(pieces + 1)]
            return [_Range(base, a, b, table, size // pieces) for a, b in zip(cuts, cuts[1:])]

        packs, room = [], 0
        for piece in (r for ranges in _each(bases, cut) for r in ranges):
            cost = piece.bytes + _OPEN_BYTES
            if cost > room:
                packs.append(_Pack([]))
                room = _PARTITION_BYTES
            packs[-1].ranges.append(piece)
            room -= cost
        return packs

    def read(self, partition: _Pack) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        for piece in partition.ranges:
            yield from self._read_range(fs, piece)

    def _wanted(self, content: bytes) -> bool:
        """Whether a record, by the box at its head, can meet the bounds; no box meets none."""
        shape = struct.unpack_from("<i", content)[0]
        if shape in _POINTS:
            return _may_hold(self.bounds, struct.unpack_from("<2d", content, 4) * 2, True)
        return shape != _NULL and _may_hold(self.bounds, struct.unpack_from("<4d", content, 4), True)

    def _read_range(self, fs: pafs.FileSystem, partition: _Range) -> Iterator[pa.RecordBatch]:
        base, table = partition.base, partition.table
        arrow_schema = to_arrow_schema(self.schema)
        names = [f.name for f in self.schema.fields if f.name != "geometry"]
        by_name = {f.name: f for f in table.fields}
        kinds = {f.name: f.dataType for f in self.schema.fields}
        with (
            fs.open_input_file(_needed(fs, base, ".shx")) as shx,
            fs.open_input_file(_needed(fs, base, ".shp")) as shp,
            fs.open_input_file(_needed(fs, base, ".dbf")) as dbf,
        ):
            for first in range(partition.first, partition.last, _BATCH_ROWS):
                count = min(_BATCH_ROWS, partition.last - first)
                index = np.frombuffer(shx.read_at(8 * count, _HEADER + 8 * first), ">i4")
                # Offsets and lengths count 16-bit words; a record has an 8 byte header.
                starts, sizes = index[0::2].astype("i8") * 2 + 8, index[1::2].astype("i8") * 2
                low, high = int(starts.min()), int((starts + sizes).max())
                if high - low <= 2 * int(sizes.sum()) + 16 * count:
                    block = shp.read_at(high - low, low)
                    contents = [block[s - low : s - low + n] for s, n in zip(starts, sizes)]
                else:
                    contents = [shp.read_at(int(n), int(s)) for s, n in zip(starts, sizes)]
                rows = dbf.read_at(table.row_width * count, table.header + table.row_width * first)
                records = [
                    rows[i * table.row_width : (i + 1) * table.row_width] for i in range(count)
                ]
                kept = [i for i, row in enumerate(records) if row[:1] != b"*"]
                if self.pruned:
                    kept = [i for i in kept if self._wanted(contents[i])]
                columns = []
                for name in names:
                    field = by_name.get(name)
                    if field is None:
                        columns.append([None] * len(kept))
                        continue
                    span = slice(field.start, field.start + field.width)
                    values = [_value(records[i][span], field, table.encoding) for i in kept]
                    columns.append([None if v is None else _as(v, kinds[name]) for v in values])
                arrays = [pa.array(c, t) for c, t in zip(columns, arrow_schema.types)]
                shapes = _geometries([contents[i] for i in kept], arrow_schema.field("geometry").type)
                arrays.append(shapes)
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)


class _PushingReader(_ShapefileReader):
    """For sessions that push filters down: in others Spark refuses a reader that takes them."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes note of bounds on the box; Spark still evaluates all filters on what is read."""
        self.bounds = _narrowed(self.bounds, filters)
        return filters
