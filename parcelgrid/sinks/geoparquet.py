"""Python data source ``geoparquet``: a sink for GeoParquet 1.0.0.

Tasks write files with WKB geometry and the ``geo`` footer key into a job folder beside the
target, which the driver has made. Once all tasks are done and files that no commit message
names are gone, an overwrite puts the job folder in the target's place by renaming: a reader
finds the old files or the new ones, never both, and of two writers at once the last one's.
An append, or an object store that cannot rename folders, moves the files one by one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from parcelgrid.sources.shapefile import _filesystem
from parcelgrid.types import GEOMETRY_TYPE, MULTIPOLYGON, POINT, POLYGON, WGS84

VERSION = "1.0.0"

# Fixed values of the formats: WKB type numbers, and names in the footer.
_WKB_TYPE = {POINT: 1, POLYGON: 3, MULTIPOLYGON: 6}
_FOOTER_NAME = {POINT: "Point", POLYGON: "Polygon", MULTIPOLYGON: "MultiPolygon"}
_LITTLE_ENDIAN = 1
# File systems whose folders move by one rename.
_RENAMES_FOLDERS = ("local", "hdfs")
_ATTEMPTS = 100


def _is_geometry(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and data_type.names == GEOMETRY_TYPE.names


@dataclass
class _Extent:
    """What the footer says about a geometry column."""

    kinds: set[str] = field(default_factory=set)
    srids: set[int] = field(default_factory=set)
    box: tuple[float, float, float, float] | None = None

    def add(self, geometries: pa.StructArray) -> None:
        valid = geometries.drop_null()
        if not len(valid):
            return
        self.kinds |= set(valid.field("kind").unique().to_pylist())
        self.srids |= set(valid.field("srid").unique().to_pylist())
        box = valid.field("bbox")
        low = [float(np.min(box.field(n).to_numpy(zero_copy_only=False))) for n in ("xmin", "ymin")]
        high = [float(np.max(box.field(n).to_numpy(zero_copy_only=False))) for n in ("xmax", "ymax")]
        if self.box:
            low = [min(a, b) for a, b in zip(low, self.box[:2])]
            high = [max(a, b) for a, b in zip(high, self.box[2:])]
        self.box = (*low, *high)

    def metadata(self) -> dict:
        column = {
            "encoding": "WKB",
            "geometry_types": sorted(_FOOTER_NAME[k] for k in self.kinds),
        }
        # Longitude/latitude is the default of the format; other systems are not described.
        if self.srids - {WGS84}:
            column["crs"] = None
        if self.box:
            column["bbox"] = list(self.box)
        return column


def to_wkb(geometries: pa.StructArray) -> pa.Array:
    """WKB of a batch: every number is put in its place of one buffer, by offset arithmetic."""
    geometries = pa.concat_arrays([geometries])
    valid = geometries.is_valid().to_numpy(zero_copy_only=False)
    kinds = geometries.field("kind")
    is_point = pc.fill_null(pc.equal(kinds, POINT), False).to_numpy(zero_copy_only=False) & valid
    is_multi = pc.fill_null(pc.equal(kinds, MULTIPOLYGON), False).to_numpy(zero_copy_only=False) & valid
    box, parts = geometries.field("bbox"), geometries.field("parts")
    rings, part_at = parts.values, parts.offsets.to_numpy()
    vertices, ring_at = rings.values, rings.offsets.to_numpy()
    xy, vertex_at = vertices.values, vertices.offsets.to_numpy()
    # what lies outside of the valid polygons' lists, as under NULLs, takes no room
    held = np.zeros(len(rings), bool)
    owner = np.repeat(np.arange(len(geometries)), np.diff(part_at))
    held[part_at[0] : part_at[-1]] = (valid & ~is_point)[owner]

    points = np.diff(vertex_at)
    ring_bytes = 4 + 16 * points
    before_ring = np.concatenate([[0], np.cumsum(ring_bytes)])
    polygon_bytes = np.where(held, 9 + before_ring[ring_at[1:]] - before_ring[ring_at[:-1]], 0)
    before_polygon = np.concatenate([[0], np.cumsum(polygon_bytes)])
    sizes = np.where(is_point, 21, 9 * is_multi + before_polygon[part_at[1:]] - before_polygon[part_at[:-1]])
    offsets = np.concatenate([[0], np.cumsum(np.where(valid, sizes, 0))])
    out = np.zeros(offsets[-1], np.uint8)

    def put(places: np.ndarray, numbers: np.ndarray, kind: str) -> None:
        data = np.ascontiguousarray(numbers, kind)
        width = data.dtype.itemsize
        out[places[:, None] + np.arange(width)] = data.view(np.uint8).reshape(-1, width)

    def head(places: np.ndarray, kind: str) -> None:
        out[places] = _LITTLE_ENDIAN
        put(places + 1, np.full(len(places), _WKB_TYPE[kind]), "<u4")

    at_point = offsets[:-1][is_point]
    head(at_point, POINT)
    for k, name in enumerate(("xmin", "ymin")):
        put(at_point + 5 + 8 * k, box.field(name).to_numpy(zero_copy_only=False)[is_point], "<f8")
    head(offsets[:-1][is_multi], MULTIPOLYGON)
    put(offsets[:-1][is_multi] + 5, np.diff(part_at)[is_multi], "<u4")

    chosen = np.nonzero(held)[0]
    owner = np.repeat(np.arange(len(geometries)), np.diff(part_at))[chosen - part_at[0]]
    at_polygon = offsets[:-1][owner] + 9 * is_multi[owner] + (before_polygon[chosen] - before_polygon[part_at[owner]])
    head(at_polygon, POLYGON)
    put(at_polygon + 5, np.diff(ring_at)[chosen], "<u4")

    n = np.diff(ring_at)[chosen]
    ring = np.repeat(ring_at[:-1][chosen], n) + _within(n)
    at_ring = np.repeat(at_polygon + 9, n) + before_ring[ring] - np.repeat(before_ring[ring_at[:-1][chosen]], n)
    put(at_ring, points[ring], "<u4")
    n = points[ring]
    vertex = np.repeat(vertex_at[:-1][ring], n) + _within(n)
    at_vertex = np.repeat(at_ring + 4, n) + 16 * _within(n)
    for k, name in enumerate(("x", "y")):
        put(at_vertex + 8 * k, xy.field(name).to_numpy(zero_copy_only=False)[vertex], "<f8")

    bitmap = pa.array(valid).buffers()[1]
    kind = pa.binary() if offsets[-1] < 1 << 31 else pa.large_binary()
    ends = offsets.astype("<i4" if kind == pa.binary() else "<i8")
    return pa.Array.from_buffers(kind, len(valid), [bitmap, pa.py_buffer(ends.tobytes()), pa.py_buffer(out)])


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the pieces, end to end."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class GeoParquetDataSource(DataSource):
    """Options: ``path``, ``version`` (only 1.0.0), ``compression``."""

    @classmethod
    def name(cls) -> str:
        return "geoparquet"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        version = self.options.get("version", VERSION)
        if version != VERSION:
            raise ValueError(f"GeoParquet version {version} is not supported, only {VERSION}")
        if not any(_is_geometry(f.dataType) for f in schema.fields):
            raise ValueError("GeoParquet needs a geometry column")
        compression = self.options.get("compression", "snappy")
        writer = _GeoParquetWriter(self.options["path"], schema, overwrite, compression)
        writer.make_folder()
        return writer


class _GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, compression: str):
        self.path, self.schema, self.overwrite = path.rstrip("/"), schema, overwrite
        self.compression = compression
        self.job = uuid.uuid4().hex
        self.geometry = [f.name for f in schema.fields if _is_geometry(f.dataType)]

    def _target(self) -> tuple[pafs.FileSystem, str, str]:
        fs, root = _filesystem(self.path)
        parent, _, name = root.rpartition("/")
        return fs, root, f"{parent}/_{name}-writing-{self.job}"

    def make_folder(self) -> None:
        """Made once, on the driver: a task that runs on after an abort cannot make it anew."""
        fs, _, folder = self._target()
        fs.create_dir(folder, recursive=True)

    def _file_schema(self) -> pa.Schema:
        return pa.schema(
            [
                pa.field(f.name, pa.binary()) if f.name in self.geometry else f
                for f in to_arrow_schema(self.schema)
            ]
        )

    def _footer(self, extents: dict[str, _Extent]) -> dict[str, str]:
        primary = "geometry" if "geometry" in self.geometry else self.geometry[0]
        columns = {name: extent.metadata() for name, extent in extents.items()}
        geo = {"version": VERSION, "primary_column": primary, "columns": columns}
        return {"geo": json.dumps(geo)}

    def _write_file(self, name: str, batches: Iterator[pa.RecordBatch]) -> None:
        fs, _, folder = self._target()
        schema = self._file_schema()
        extents = {name: _Extent() for name in self.geometry}
        with (
            fs.open_output_stream(f"{folder}/{name}") as out,
            pq.ParquetWriter(out, schema, compression=self.compression) as writer,
        ):
            for batch in batches:
                arrays = []
                for column, target in zip(batch.columns, schema):
                    if target.name in extents:
                        extents[target.name].add(column)
                        column = to_wkb(column)
                    arrays.append(column.cast(target.type))
                writer.write_batch(pa.RecordBatch.from_arrays(arrays, schema=schema))
            writer.add_key_value_metadata(self._footer(extents))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        first = next(iterator, None)
        while first is not None and not first.num_rows:
            first = next(iterator, None)
        if first is None:
            return _Written([])
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"

        def batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from iterator

        self._write_file(name, batches())
        return _Written([name])

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root, folder = self._target()
        names = [name for m in messages if m is not None for name in m.files]
        if not names:
            # An empty result still leaves a file that says what its columns are.
            names = [f"part-00000-{uuid.uuid4().hex}.parquet"]
            self._write_file(names[0], iter(()))
        for entry in fs.get_file_info(pafs.FileSelector(folder)):
            if entry.base_name not in names:
                fs.delete_file(entry.path)  # of a repeated or failed attempt
        with fs.open_output_stream(f"{folder}/_SUCCESS"):
            pass
        if self.overwrite and fs.type_name in _RENAMES_FOLDERS:
            self._replace(fs, root, folder)
        else:
            self._move_files(fs, root, folder, names)

    def _replace(self, fs: pafs.FileSystem, root: str, folder: str) -> None:
        for attempt in range(_ATTEMPTS):
            if fs.get_file_info(root).type != pafs.FileType.NotFound:
                old = f"{folder}-old-{attempt}"
                try:
                    fs.move(root, old)
                except FileNotFoundError:
                    pass  # another writer was faster
                else:
                    self._delete(fs, old)
            try:
                fs.move(folder, root)
                return
            except OSError:  # another writer has put its folder there
                if attempt == _ATTEMPTS - 1:
                    raise

    def _move_files(self, fs: pafs.FileSystem, root: str, folder: str, names: list[str]) -> None:
        fs.create_dir(root, recursive=True)
        replaced = fs.get_file_info(pafs.FileSelector(root)) if self.overwrite else []
        for name in [*names, "_SUCCESS"]:
            fs.move(f"{folder}/{name}", f"{root}/{name}")
        for entry in replaced:
            if entry.base_name != "_SUCCESS":
                self._delete(fs, entry.path)
        fs.delete_dir(folder)

    @staticmethod
    def _delete(fs: pafs.FileSystem, path: str) -> None:
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)
        else:
            fs.delete_file(path)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, _, folder = self._target()
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            try:
                fs.delete_dir(folder)
            except OSError:  # a task has just written one more file
                fs.delete_dir(folder)
