"""Folders for what has to be written and read again: under spark.checkpoint.dir, which driver and executors share. Where that is unset, a temporary folder if all run on one machine; a cluster has to name one."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and the executors of {master} share")
        base = f"file://{tempfile.gettempdir()}/loomline"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table under the shared folder: its rows and order are fixed, its size is known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
