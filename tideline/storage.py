"""Where tables live that one step leaves for the next."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or, where all is one process and that is unset (tests), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not folder and (master.startswith("local-cluster") or not master.startswith("local")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{folder or tempfile.mkdtemp(prefix='spark-tideline-', dir='/tmp')}/step-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, and survives a lost executor."""
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
