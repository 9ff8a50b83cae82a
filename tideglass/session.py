"""Sessions as observation jobs need them, and the folder that their tasks share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "tideglass", **conf: str) -> SparkSession:
    """A session on UTC with ANSI rules and zstd files; further settings as given."""
    builder = SparkSession.builder.appName(app)
    for key, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.parquet.compression.codec": "zstd", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that driver and executors share: spark.checkpoint.dir; unset, one of our own, under a local master only."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there, so that lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, label)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
