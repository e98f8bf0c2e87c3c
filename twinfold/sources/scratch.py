"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error,
    since a folder of one machine would lose the tables of the others.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written to the shared folder and read back: lineage is cut and lost executors cost nothing."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
