"""Writes shapefiles of derived polygons, as input for the shapefile query and tests.

The library only reads the format, so this stays outside it. One file set per partition.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Ring = list[tuple[float, float]]


def _header(size: int, box: tuple[float, ...]) -> bytes:
    return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack(
        "<2i8d", 1000, 5, *box, 0, 0, 0, 0
    )


def _polygon(rings: list[Ring]) -> bytes:
    points = [xy for ring in rings for xy in ring]
    starts, at = [], 0
    for ring in rings:
        starts.append(at)
        at += len(ring)
    xs, ys = [x for x, _ in points], [y for _, y in points]
    return (
        struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), len(points))
        + struct.pack(f"<{len(starts)}i", *starts)
        + b"".join(struct.pack("<2d", x, y) for x, y in points)
    )


def shapefile_bytes(
    shapes: list[list[Ring] | None], columns: list[tuple[str, str, int, int]], rows: list[list[str]]
) -> dict[str, bytes]:
    """``.shp``, ``.shx`` and ``.dbf`` content. ``columns`` are name, type, width, decimals."""
    body, index = [], []
    at = 100
    for number, rings in enumerate(shapes, 1):
        content = struct.pack("<i", 0) if rings is None else _polygon(rings)
        index.append(struct.pack(">2i", at // 2, len(content) // 2))
        body.append(struct.pack(">2i", number, len(content) // 2) + content)
        at += 8 + len(content)
    points = [xy for rings in shapes if rings for ring in rings for xy in ring]
    xs, ys = [x for x, _ in points] or [0.0], [y for _, y in points] or [0.0]
    box = (min(xs), min(ys), max(xs), max(ys))
    fields = b"".join(
        name.encode().ljust(11, b"\0") + kind.encode() + bytes(4) + bytes([width, decimals]) + bytes(14)
        for name, kind, width, decimals in columns
    )
    width = 1 + sum(c[2] for c in columns)
    dbf = struct.pack("<4BIHH", 3, 124, 1, 1, len(rows), 33 + len(fields), width) + bytes(20)
    dbf += fields + b"\r"
    for row in rows:
        dbf += b" " + b"".join(
            value.encode().rjust(c[2]) if c[1] == "N" else value.encode().ljust(c[2])
            for value, c in zip(row, columns)
        )
    return {
        ".shp": _header(at, box) + b"".join(body),
        ".shx": _header(100 + 8 * len(index), box) + b"".join(index),
        ".dbf": dbf + b"\x1a",
    }


def write_shapefiles(polygons: DataFrame, folder: str, id_col: str, text_col: str = "label") -> int:
    """Write ``id_col``, a text and ``geometry`` under ``folder``; gives the number of polygons."""
    rings = F.flatten("geometry.parts")
    flat = polygons.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.transform(rings, lambda r: F.transform(r, lambda v: v["x"])).alias("xs"),
        F.transform(rings, lambda r: F.transform(r, lambda v: v["y"])).alias("ys"),
        F.spark_partition_id().alias("part"),
    )
    columns = [(id_col[:10], "N", 12, 0), (text_col, "C", 20, 0)]

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece, frame in enumerate(frames):
            if frame.empty:
                continue
            shapes, rows = [], []
            for row in frame.itertuples():
                rings = [list(zip(map(float, x), map(float, y))) for x, y in zip(row.xs, row.ys)]
                # The format wants shells clockwise and holes the other way; the derived
                # shapes are all anticlockwise, and only a frame's second ring is a hole.
                hole = len(rings) == 2 and rings[1][0][0] < max(x for x, _ in rings[0])
                shapes.append([r if hole and i else r[::-1] for i, r in enumerate(rings)])
                rows.append([str(row.id), f"shape {row.id}"])
            fs, root = (
                pafs.FileSystem.from_uri(folder)
                if "://" in folder or folder.startswith("file:")
                else (pafs.LocalFileSystem(), folder)
            )
            fs.create_dir(root, recursive=True)
            base = f"{root}/part-{int(frame.part.iloc[0]):05d}-{piece:05d}"
            for suffix, content in shapefile_bytes(shapes, columns, rows).items():
                with fs.open_output_stream(base + suffix) as out:
                    out.write(content)
            yield pd.DataFrame({"n": [len(rows)]})

    written = flat.mapInPandas(write, "n bigint")
    return written.agg(F.sum("n")).first()[0] or 0
