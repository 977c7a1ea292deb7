"""Cutting lineage by tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """A new folder's path under spark.checkpoint.dir (a folder of our own only where that is unset, in local mode)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="kgspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/kgspark/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df written under the shared folder and read again."""
    spark, path = df.sparkSession, folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by cut()."""
    jvm = df.sparkSession.sparkContext._jvm
    for made in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/kgspark/" in made:
            path = jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
