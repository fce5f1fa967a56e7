"""Read a model from its text files into two tables.

A model folder holds one definitions file (``<NAME>n</NAME> <VALUE>regex</VALUE>``
per line, order matters, anything after that is a comment) and any number of word
lists (first line ``TOKEN_CLASS:NAME``, then one entry per line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

DEFINITION_LINE = r"<NAME>(.*?)</NAME>\s*<VALUE>(.*?)</VALUE>"
CLASS_HEADER = r"^\x{FEFF}?TOKEN_CLASS:\s*(.*?)\s*$"


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """``(ord int, name string, regex string)`` in file order.

    The file is read whole, as line order is part of its meaning; it holds at most
    254 lines (``validate_model`` reports more). Order between files would mean nothing, so a
    folder with definitions in several files is an error.
    """
    lines = F.split(F.col("value"), r"\r?\n")
    found = (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(lines).alias("ord", "line"), F.col("_metadata.file_path").alias("file"))
        .where(F.col("line").rlike(DEFINITION_LINE))
    )
    files = [row.file for row in found.select("file").distinct().orderBy("file").limit(2).collect()]
    if len(files) > 1:
        raise ValueError(f"definitions in more than one file under '{path}': {files[0]}, {files[1]}")
    return found.select(
        "ord",
        F.trim(F.regexp_extract("line", DEFINITION_LINE, 1)).alias("name"),
        F.regexp_extract("line", DEFINITION_LINE, 2).alias("regex"),
    )


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    """``(class string, entry string)``, distinct, from every word list under ``path``.

    Lists are read line by line, so one of any length is split over tasks; the
    header lines, one per file, are matched to the entries by file. A file with entries and no
    header is an error, as is one with several.
    """
    lines = spark.read.text(path).select(
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("entry"),
        F.col("_metadata.file_path").alias("file"),
    )
    is_header = F.col("entry").rlike(CLASS_HEADER)
    headers = lines.where(is_header).select(
        F.col("file").alias("header_file"),
        F.regexp_extract("entry", CLASS_HEADER, 1).alias("class"),
    )
    per_file = lines.where(F.col("entry") != "").groupBy("file").agg(
        F.count_if(is_header).alias("headers"), F.count_if(~is_header).alias("entries")
    )
    wrong = per_file.where((F.col("headers") > 1) | ((F.col("headers") == 0) & (F.col("entries") > 0)))
    for row in wrong.orderBy("file").limit(1).collect():
        problem = "more than one" if row.headers else "no"
        raise ValueError(f"{problem} TOKEN_CLASS header in word list '{row.file}'")
    if headers.isEmpty():
        raise ValueError(f"no TOKEN_CLASS header found under '{path}'")
    entries = lines.where(~is_header & (F.col("entry") != ""))
    return (
        entries.join(headers, F.col("file") == F.col("header_file")).select("class", "entry").distinct()
    )
