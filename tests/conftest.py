"""One session for all tests, and the sample files as frames."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from parcelgrid.functions import register_sql_functions  # noqa: E402
from parcelgrid.operators import add_point_geometry  # noqa: E402
from parcelgrid.sources import read_points_csv, read_tracts_wkt  # noqa: E402
from paths import FIXTURES  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    register_sql_functions(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def points(spark):
    return add_point_geometry(read_points_csv(spark, str(FIXTURES / "calls.csv")))


@pytest.fixture(scope="session")
def tracts(spark):
    return read_tracts_wkt(spark, str(FIXTURES / "tracts.csv"))
