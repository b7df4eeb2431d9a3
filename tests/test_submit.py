"""The jobs as scripts, started from a folder that does not hold the package."""

from __future__ import annotations

import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq

from paths import FIXTURES, ROOT
from parcelgrid.types import TRACT_COLS
from querybook.shapewriter import shapefile_bytes


def run(tmp_path, *args, job="hotspots"):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    env |= {"PYSPARK_PYTHON": sys.executable}
    script = str(ROOT / "jobs" / f"{job}.py")
    done = subprocess.run(
        [sys.executable, script, *args], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_sample_files_are_counted_and_written(tmp_path):
    out = tmp_path / "out"
    assert "2 tracts had calls" in run(tmp_path, "--local", "--write", "--output", str(out))
    assert list(out.glob("*.parquet"))


def test_csv_and_shapefiles(tmp_path):
    ring = [(-90.5, 38.5), (-90.5, 38.875), (-90.125, 38.875), (-90.125, 38.5), (-90.5, 38.5)]
    content = shapefile_bytes([[ring]], [(c, "C", 12, 0) for c in TRACT_COLS], [["1"] * 10])
    (tmp_path / "tracts").mkdir()
    for suffix, data in content.items():
        (tmp_path / "tracts" / f"t{suffix}").write_bytes(data)
    args = ["--csv", "--points", str(FIXTURES / "calls.csv"), "--tracts", str(tmp_path / "tracts")]
    assert "1 tracts had calls" in run(tmp_path, *args)


def test_prospects_are_graded_and_written(tmp_path):
    prospects = pa.table({"point_id": ["a", "b", "c"], "lat": [0.5, 5.0, None], "lon": [0.5, 5.0, 1.0]})
    parcels = pa.table({
        "parcel_id": [1], "wkt": ["POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))"], "owner": ["Acme Truck Stop"], "county": ["polk"],
    })
    pq.write_table(prospects, tmp_path / "prospects.parquet")
    pq.write_table(parcels, tmp_path / "parcels.parquet")
    paths = ["--path", str(tmp_path / "prospects.parquet"), "--parcels", str(tmp_path / "parcels.parquet")]
    out = run(tmp_path, *paths, "--output", str(tmp_path / "out"), job="enrich_parcels")
    assert "wrote 3 rows (flagged=1)" in out and "errors: 1" in out
    assert list((tmp_path / "out").glob("*.csv"))
