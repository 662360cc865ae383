"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a local session without one gets a warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one; the session removes it when it ends."""
    path = f"{shared_folder(spark)}/rxlake-{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet and read back, so later steps do not recompute them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
