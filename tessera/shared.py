"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a temporary folder in local mode, and an error on a cluster,
    whose executors couldn't read each other's files there."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster, tables need a folder that all share")
        at = f"file://{tempfile.mkdtemp()}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(at)
    return qualified(spark, at)


def qualified(spark: SparkSession, at: str) -> str:
    """A path as a URI: one without a scheme lies in the cluster's default file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", uri)


def keep(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and reread: its size is known, columns are pruned, filters pushed down."""
    at = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
