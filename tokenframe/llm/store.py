"""Tables that a job writes for itself, and joins against keys that may be hot."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SALT = "__llm_salt"


def shared_folder(spark: SparkSession) -> str:
    """The folder all nodes see. Where none is set, a local master gets a new temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write once what several plans read; an executor that is lost takes none of it along."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str, salts: int = 16, hint: str = ""
) -> DataFrame:
    """Join where one key may hold a large share of ``left``; ``right`` has few rows a key.

    ``spread`` is computed from the row, so a task that runs again repeats it. ``hint`` is a join hint
    for ``right``.
    """
    many = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(SALT)
    copies = right.select("*", many)
    return (
        left.withColumn(SALT, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        .join(copies.hint(hint) if hint else copies, [*keys, SALT], how)
        .drop(SALT)
    )


def neutral(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """``docs`` with columns ``c0``, ``c1``, …, the new name of each, and the way back.

    A stage that adds columns of its own cannot clash with those a table came with.
    """
    names = {name: f"c{k}" for k, name in enumerate(docs.columns)}

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(new).alias(name) for name, new in names.items()])

    return docs.toDF(*names.values()), names, back


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
