"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelgrid.functions.sql import register_sql_functions

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def start(app_name: str = "parcelgrid", catalog: bool = False) -> SparkSession:
    """A session with the SQL functions registered.

    ``catalog=True`` turns on the Hive catalog, so that ``db.table`` names of the
    metastore the cluster is configured for resolve.
    """
    builder = SparkSession.builder.appName(app_name)
    if catalog:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    register_sql_functions(spark)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one named by ``spark.checkpoint.dir``.

    Only where that setting is absent (a local session) is a temporary folder of this
    machine taken, and removed when the process ends.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_CHECKPOINT_DIR} must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="parcelgrid-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in a scratch folder: worked out once, whatever is asked of it later."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
