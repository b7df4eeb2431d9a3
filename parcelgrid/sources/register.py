"""Data sources made known to a session."""

from __future__ import annotations

import parcelgrid
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource


def register_source(spark: SparkSession, source: type[DataSource]) -> None:
    """Register ``source`` so that workers need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(parcelgrid)
    spark.dataSource.register(source)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme: one without means the cluster's default file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).makeQualified(target).toString()
