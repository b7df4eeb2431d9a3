"""Sources, sinks and the two jobs."""

from __future__ import annotations

import contextlib
import json
import random
import struct
import sys
import threading
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parcelgrid.functions import st_astext, st_geomfromtext
from parcelgrid.operators import roadcalls_per_tract, within_last_year
from parcelgrid.sinks import write_csv, write_geoparquet, write_table
from parcelgrid.sinks.geoparquet import GeoParquetDataSource, _Written, to_wkb
from parcelgrid.sources import (
    list_tables,
    read_points_csv,
    read_points_table,
    read_tracts_shapefile,
)
from parcelgrid.types import GEOMETRY_TYPE
from querybook.shapewriter import shapefile_bytes

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "jobs"))





def test_csv_columns_are_text(spark):
    from paths import FIXTURES

    calls = read_points_csv(spark, str(FIXTURES / "calls.csv"))
    assert set(t for _, t in calls.dtypes) == {"string"}
    assert calls.count() == 6


def test_geoparquet(spark, tmp_path):
    path = str(tmp_path / "out")
    texts = [
        (1, "POLYGON((0 0, 4 0, 4 4, 0 0), (1 0.5, 2 0.5, 2 1, 1 0.5))"),
        (2, "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))"),
        (3, "POINT(-3 7)"),
        (4, None),
    ]
    frame = spark.createDataFrame(texts, "id int, t string").select(
        "id", st_geomfromtext("t", 4326).alias("geometry")
    )
    write_geoparquet(frame.repartition(3), path)
    rows = {r["id"]: r["geometry"] for r in spark.read.parquet(path).collect()}
    assert rows[4] is None
    assert bytes(rows[3]).hex() == "0101000000" + "00000000000008c0" + "0000000000001c40"
    assert len(rows[1]) == 9 + 2 * (4 + 4 * 16)
    assert bytes(rows[1])[:13].hex() == "0103000000" + "02000000" + "04000000"
    assert len(rows[2]) == 9 + 2 * (9 + 4 + 4 * 16)
    assert bytes(rows[2])[:18].hex() == "0106000000" + "02000000" + "0103000000" + "01000000" + ""

    boxes, kinds = [], set()
    for file in Path(path).glob("*.parquet"):
        geo = json.loads(pq.read_metadata(file).metadata[b"geo"])
        assert geo["version"] == "1.0.0" and geo["primary_column"] == "geometry"
        column = geo["columns"]["geometry"]
        assert column["encoding"] == "WKB" and "crs" not in column
        kinds |= set(column["geometry_types"])
        if "bbox" in column:
            boxes.append(column["bbox"])
    assert kinds == {"Point", "Polygon", "MultiPolygon"}
    assert min(b[0] for b in boxes) == -3 and max(b[3] for b in boxes) == 7
    assert (Path(path) / "_SUCCESS").exists()
    assert not _leftovers(tmp_path)


def wkb_by_force(g):
    """One geometry, number by number."""
    if g is None:
        return None
    if g["kind"] == "POINT":
        return struct.pack("<BIdd", 1, 1, g["bbox"]["xmin"], g["bbox"]["ymin"])
    polygons = []
    for part in g["parts"]:
        data = struct.pack("<BII", 1, 3, len(part))
        for ring in part:
            data += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", v["x"], v["y"]) for v in ring)
        polygons.append(data)
    if g["kind"] == "POLYGON":
        return polygons[0]
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(polygons)


def test_wkb_of_all_kinds_byte_by_byte():
    rng = random.Random(4)
    rows = []
    for i in range(300):
        x, y = rng.uniform(-180, 180), rng.uniform(-90, 90)
        box = dict(xmin=x, ymin=y, xmax=x, ymax=y)
        ring = lambda: [dict(x=rng.random(), y=rng.random()) for _ in range(rng.randrange(4, 9))]
        part = lambda: [ring() for _ in range(rng.randrange(1, 4))]
        rows.append(
            None if i % 7 == 0
            else {"srid": 4326, "kind": "POINT", "parts": None, "bbox": box} if i % 3 == 0
            else {"srid": 4326, "kind": "POLYGON", "parts": [part()], "bbox": box} if i % 3 == 1
            else {"srid": 4326, "kind": "MULTIPOLYGON", "parts": [part() for _ in range(rng.randrange(1, 4))], "bbox": box}
        )
    kind = to_arrow_schema(T.StructType().add("g", GEOMETRY_TYPE)).field("g").type
    column = pa.array(rows, kind)
    want = [wkb_by_force(g) for g in rows]
    assert to_wkb(column).to_pylist() == want
    for a, n in ((0, 0), (5, 1), (17, 100), (250, 50)):
        assert to_wkb(column.slice(a, n)).to_pylist() == want[a : a + n]
    assert to_wkb(pa.array([None, None], kind)).to_pylist() == [None, None]


def _leftovers(folder):
    return [p.name for p in Path(folder).iterdir() if p.name.startswith("_")]


def test_geoparquet_overwrite_and_failure(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(4).select("id", st_geomfromtext(F.lit("POINT(1 2)"), 3857).alias("geometry"))
    write_geoparquet(frame, path)
    bad = frame.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        write_geoparquet(bad, path)
    # The failed write left the old result, and nothing else.
    assert spark.read.parquet(path).count() == 4
    assert not _leftovers(tmp_path)
    write_geoparquet(frame.limit(1), path)
    assert spark.read.parquet(path).count() == 1
    (file,) = Path(path).glob("*.parquet")
    assert json.loads(pq.read_metadata(file).metadata[b"geo"])["columns"]["geometry"]["crs"] is None
    write_geoparquet(frame.limit(0), path)
    assert spark.read.parquet(path).columns == ["id", "geometry"]
    assert spark.read.parquet(path).count() == 0
    with pytest.raises(Exception, match="geometry column"):
        write_geoparquet(frame.select("id"), path)


def _geo_writer(path, overwrite=True):
    schema = T.StructType().add("id", "long").add("geometry", GEOMETRY_TYPE)
    return GeoParquetDataSource({"path": str(path)}).writer(schema, overwrite)


def _geo_files(writer, ids):
    """One file per id, as tasks write them."""
    names = []
    for i in ids:
        row = {"id": i, "geometry": {"srid": 4326, "kind": "POINT", "parts": None, "bbox": dict(xmin=i, ymin=i, xmax=i, ymax=i)}}
        batch = pa.RecordBatch.from_pylist([row], to_arrow_schema(writer.schema))
        names.append(f"part-{i}-{writer.job}.parquet")
        writer._write_file(names[-1], iter([batch]))
    return [_Written([n]) for n in names]


def test_geoparquet_tasks_that_run_on_after_an_abort(tmp_path):
    for k in range(50):
        path = tmp_path / f"out{k}"
        writer = _geo_writer(path)
        _geo_files(writer, [1, 2])
        late = threading.Thread(target=_try, args=(lambda w=writer: _geo_files(w, range(3, 40)),))
        late.start()
        writer.abort([])
        late.join()
    assert not list(tmp_path.iterdir())


def _try(action):
    with contextlib.suppress(OSError):
        action()


def test_geoparquet_of_two_writers_one_whole_result_stays(tmp_path):
    path = tmp_path / "out"
    first = _geo_writer(path)
    first.commit(_geo_files(first, [0]))
    for k in range(30):
        writers = [_geo_writer(path) for _ in range(3)]
        written = [_geo_files(w, [10 * n + j for j in range(4)]) for n, w in enumerate(writers)]
        _geo_files(writers[0], [999])  # of a task that was run again: in no message
        threads = [threading.Thread(target=w.commit, args=(m,)) for w, m in zip(writers, written)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        ids = sorted(pq.read_table(f)["id"][0].as_py() for f in path.glob("*.parquet"))
        assert ids in [[10 * n + j for j in range(4)] for n in range(3)]
        assert (path / "_SUCCESS").exists() and not _leftovers(tmp_path)


def test_geoparquet_append_keeps_what_is_there(tmp_path):
    path = tmp_path / "out"
    for ids in ([1, 2], [3]):
        writer = _geo_writer(path, overwrite=False)
        writer.commit(_geo_files(writer, ids))
    assert len(list(path.glob("*.parquet"))) == 3 and not _leftovers(tmp_path)


def test_shapefile(spark, tmp_path):
    shell = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]
    island = [(8.0, 8.0), (8.0, 9.0), (9.0, 9.0), (8.0, 8.0)]
    content = shapefile_bytes(
        [[shell, island, hole], [island], None],
        [("FIPS", "C", 6, 0), ("POP", "N", 8, 0), ("RATE", "N", 8, 3)],
        [["000100", "12", "1.500"], ["Zoë", "", ""], ["x", "-3", "2"]],
    )
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        for suffix, data in content.items():
            (tmp_path / name / f"tracts{suffix}").write_bytes(data)
    tracts = read_tracts_shapefile(spark, str(tmp_path))
    assert [t for _, t in tracts.dtypes[:3]] == ["string", "bigint", "double"]
    rows = tracts.select("FIPS", "POP", "RATE", st_astext("geometry").alias("t"), "geometry.srid").collect()
    assert len(rows) == 6
    first = next(r for r in rows if r["FIPS"] == "000100")
    assert (first["POP"], first["RATE"], first["srid"]) == (12, 1.5, 4326)
    # The hole goes with the shell around it.
    assert first["t"].startswith("MULTIPOLYGON (((0.0 0.0, ")
    assert "(1.0 1.0, 2.0 1.0, 2.0 2.0, 1.0 2.0, 1.0 1.0)), ((8.0 8.0," in first["t"]
    second = next(r for r in rows if r["FIPS"].startswith("Zo"))
    assert second["POP"] is None and second["t"].startswith("POLYGON ((8.0 8.0")
    assert next(r for r in rows if r["FIPS"] == "x")["t"] is None


def test_shapefile_record_ranges(spark, tmp_path, monkeypatch):
    import parcelgrid.sources.shapefile as S

    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    shapes = [[[(x + i, y) for x, y in square]] for i in range(50)]
    content = shapefile_bytes(shapes, [("ID", "N", 6, 0)], [[str(i)] for i in range(50)])
    for suffix, data in content.items():
        (tmp_path / f"t{suffix}").write_bytes(data)
    reader = S._ShapefileReader(str(tmp_path / "t.shp"), None, S.ShapefileDataSource({"path": str(tmp_path)}).schema())
    monkeypatch.setattr(S, "_PARTITION_BYTES", 1000)
    monkeypatch.setattr(S, "_BATCH_ROWS", 3)
    ranges = reader.partitions()
    assert len(ranges) > 3
    rows = [row for r in ranges for batch in reader.read(r) for row in batch.to_pylist()]
    assert [r["ID"] for r in rows] == list(range(50))
    assert [r["geometry"]["bbox"]["xmin"] for r in rows] == [float(i) for i in range(50)]


def test_shapefiles_outside_a_box_are_not_read(spark, tmp_path):
    from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

    import parcelgrid.sources.shapefile as S

    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    for i in range(12):
        shapes = [[[(x + 10 * i + 2 * j, y) for x, y in square]] for j in range(4)] + [None]
        content = shapefile_bytes(shapes, [("ID", "N", 6, 0)], [[str(4 * i + j)] for j in range(4)] + [["-1"]])
        for suffix, data in content.items():
            (tmp_path / f"t{i:02}{suffix}").write_bytes(data)
    source = S.ShapefileDataSource({"path": str(tmp_path)})

    def files(reader):
        return sum(len(pack.ranges) for pack in reader.partitions())

    def ids(reader):
        return sorted(r["ID"] for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist())

    whole = source.reader(source.schema())
    assert files(whole) == 12 and len(ids(whole)) == 60
    boxed = S._ShapefileReader(str(tmp_path), None, source.schema(), "33.0,0.5,41.0,9.0")
    assert files(boxed) == 2 and ids(boxed) == [13, 14, 15, 16]  # 32-33 touches the box, as does 40-41
    pushed = S.ShapefileDataSource({"path": str(tmp_path), "pushdown": "true"}).reader(source.schema())
    filters = [GreaterThanOrEqual(("geometry", "bbox", "xmin"), 20.0), LessThan(("geometry", "bbox", "xmax"), 33.0), GreaterThanOrEqual(("ID",), 9)]
    assert list(pushed.pushFilters(filters)) == filters
    assert files(pushed) == 2 and ids(pushed) == [8, 9, 10, 11, 12, 13]  # Spark drops what is left over
    frame = read_tracts_shapefile(spark, str(tmp_path), box=(33, 0.5, 41, 9))
    assert sorted(r["ID"] for r in frame.collect()) == [13, 14, 15, 16]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        raw = spark.read.format("shapefile").option("pushdown", "true").load(str(tmp_path))
        few = raw.where("geometry.bbox.xmin >= 20 AND geometry.bbox.xmax < 33 AND ID >= 9")
        assert sorted(r["ID"] for r in few.collect()) == [9, 10, 11, 12]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_many_small_shapefiles_share_tasks(spark, tmp_path):
    square = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    for i in range(600):
        content = shapefile_bytes([[square]] * 2, [("ID", "N", 6, 0)], [[str(2 * i)], [str(2 * i + 1)]])
        for suffix, data in content.items():
            (tmp_path / f"t{i:04}{suffix}").write_bytes(data)
    shapes = read_tracts_shapefile(spark, str(tmp_path))
    assert shapes.select(F.spark_partition_id().alias("p")).distinct().count() == 5
    assert sorted(r["ID"] for r in shapes.select("ID").collect()) == list(range(1200))


def test_unsupported_shape_raises(spark, tmp_path):
    content = shapefile_bytes([[[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]]], [("ID", "N", 6, 0)], [["1"]])
    shp = bytearray(content[".shp"])
    shp[108] = 3
    content[".shp"] = bytes(shp)
    for suffix, data in content.items():
        (tmp_path / f"t{suffix}").write_bytes(data)
    with pytest.raises(Exception, match="shape type 3"):
        read_tracts_shapefile(spark, str(tmp_path)).collect()


def test_catalog_table(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_calls")
    rows = [
        ("leap", datetime(2023, 2, 28), 1.0, 1.0),
        ("early", datetime(2023, 2, 27, 23, 59, 59), 1.0, 1.0),
        ("no lat", datetime(2024, 1, 1), None, 1.0),
        ("no lon", datetime(2024, 1, 1), 1.0, None),
        ("no time", None, 1.0, 1.0),
    ]
    frame = spark.createDataFrame(
        rows, "call_num string, roadcall_call_dt timestamp, latitude double, longitude double"
    )
    frame.write.option("path", str(tmp_path / "calls")).saveAsTable("t_calls")
    as_of = datetime(2024, 2, 29)

    def ids(**options):
        return {r["call_num"] for r in read_points_table(spark, as_of=as_of, **options).collect()}

    assert ids(database="default", table="t_calls") == {"leap"}
    assert ids(path=str(tmp_path / "calls")) == {"leap"}
    assert ids(table="t_calls", last_year_only=False) == {"leap", "early", "no time"}
    assert "t_calls" in {r["tableName"] for r in list_tables(spark, "default").collect()}
    plan = read_points_table(spark, "default", "t_calls", as_of=as_of)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(roadcall_call_dt" in plan and "IsNotNull(latitude)" in plan
    assert within_last_year(frame).count() == 0


def test_table_sink(spark, tmp_path, points, tracts):
    spark.sql("DROP TABLE IF EXISTS t_hotspots")
    write_table(roadcalls_per_tract(points, tracts, ["FIPS"]), str(tmp_path / "t"), "t_hotspots")
    assert spark.table("t_hotspots").columns == ["FIPS", "roadcall_count"]
    assert spark.table("t_hotspots").count() == 2
    frame = spark.range(100).withColumn("geometry", F.lit(1))
    write_table(frame, str(tmp_path / "u"), "t_hundred", partitions=3)
    assert len(list((tmp_path / "u").glob("*.parquet"))) == 3


def test_csv_sink_keeps_text(spark, tmp_path):
    rows = [("a", " b ", 'say "hi", now', None), ("", "\t", "x;y", True)]
    write_csv(spark.createDataFrame(rows, "p string, q string, r string, s boolean").coalesce(1), str(tmp_path / "c"))
    (file,) = (tmp_path / "c").glob("*.csv")
    assert file.read_text().splitlines() == ["p,q,r,s", 'a, b ,"say ""hi"", now",', ",\t,x;y,true"]


def test_hotspot_job(spark, tmp_path, capsys):
    import hotspots

    assert hotspots.run(spark, hotspots._arguments([])) == 2
    out = str(tmp_path / "geo")
    assert hotspots.run(spark, hotspots._arguments(["--write", "--output", out])) == 2
    assert spark.read.parquet(out).agg(F.sum("roadcall_count")).first()[0] == 5
    printed = capsys.readouterr().out
    assert "2 tracts had calls" in printed and "29189000300" in printed
    args = hotspots._arguments(["--local", "--csv", "--catalog"])
    assert args.local


def test_hotspot_job_from_csv_and_shapefile(spark, tmp_path):
    import hotspots
    from paths import FIXTURES

    ring = [(-90.5, 38.5), (-90.5, 38.875), (-90.125, 38.875), (-90.125, 38.5), (-90.5, 38.5)]
    from parcelgrid.types import TRACT_COLS

    content = shapefile_bytes([[ring]], [(c, "C", 12, 0) for c in TRACT_COLS], [["1"] * 10])
    for suffix, data in content.items():
        (tmp_path / f"t{suffix}").write_bytes(data)
    argv = ["--csv", "--points", str(FIXTURES / "calls.csv"), "--tracts", str(tmp_path)]
    assert hotspots.run(spark, hotspots._arguments(argv)) == 1


def test_enrich_job(spark, tmp_path, capsys):
    import enrich_parcels

    box = "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))"
    spark.createDataFrame([(1, box, "PILOT")], "parcel_id int, wkt string, owner string").write.parquet(str(tmp_path / "parcels"))
    spark.createDataFrame([("a", 0.5, 0.5), ("b", 5.0, 5.0)], "point_id string, lat double, lon double").write.parquet(str(tmp_path / "points"))
    for form in ("csv", "parquet"):
        argv = ["--path", str(tmp_path / "points"), "--parcels", str(tmp_path / "parcels")]
        argv += ["--output", str(tmp_path / form), "--format", form]
        enrich_parcels.run(spark, enrich_parcels._arguments(argv))
        printed = capsys.readouterr().out
        assert "wrote 2 rows (flagged=1)" in printed
        assert "high_confidence: 1, errors: 0" in printed


def test_temporary_views_are_not_listed(spark):
    from parcelgrid.sources import list_tables

    spark.range(1).createOrReplaceTempView("only_here")
    assert "only_here" not in {r["tableName"] for r in list_tables(spark, "default").collect()}
    spark.catalog.dropTempView("only_here")


def test_shapefiles_with_unlike_columns_and_counts(spark, tmp_path):
    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]

    def put(name, columns, rows):
        for suffix, data in shapefile_bytes([[ring]] * len(rows), columns, rows).items():
            (tmp_path / f"{name}{suffix}").write_bytes(data)

    put("a", [("N", "N", 9, 0)], [["1"], ["2"]])
    put("b", [("N", "N", 9, 2), ("FIPS", "C", 4, 0)], [["1.5", "x"]])
    found = read_tracts_shapefile(spark, str(tmp_path)).select("N", "FIPS").collect()
    assert {tuple(r) for r in found} == {(1.0, None), (2.0, None), (1.5, "x")}

    put("c", [("N", "C", 9, 0)], [["text"]])
    with pytest.raises(Exception, match="column N"):
        read_tracts_shapefile(spark, str(tmp_path)).collect()

    content = shapefile_bytes([[ring]], [("N", "N", 9, 0)], [["1"]])
    (tmp_path / "c.dbf").write_bytes(content[".dbf"][:4] + (2).to_bytes(4, "little") + content[".dbf"][8:])
    with pytest.raises(Exception, match="1 shapes but 2 rows"):
        read_tracts_shapefile(spark, str(tmp_path)).collect()
