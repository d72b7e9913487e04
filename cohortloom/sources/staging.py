"""Intermediate tables that several later steps read: written once, so that plans stay short and lost executors cost no more than a task."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on one machine (a local master) a temporary folder where that is unset, on a cluster an error."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if "path" not in _own:
        _own["path"] = tempfile.mkdtemp(prefix="cohortloom-stage-")
    return _own["path"]


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back. The table goes when the driver ends: later plans may read it until then."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
