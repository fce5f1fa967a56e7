"""Tables that a job writes for itself, in a folder that outlives any executor."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all nodes see. Where none is set, a local master gets a new temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    return tempfile.mkdtemp(prefix="tokenframe-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own name in the shared one, so that the caller can remove it."""
    return f"{shared_folder(spark)}/tokenframe-{name}-{uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several plans read, so that they do not each work it out."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
