"""What the queries share: a small model, patterns, and views of the tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenframe import Model

# Seven of these names are those of the fast rules, and the plain forms of numbers and words.
DEFINITIONS = [
    ("POSTALCODE", r"^[0-9]{5}-[0-9]{3,4}$"),
    ("ROUTE", r"^RTE.*$"),
    ("HASHCODE", r"^[A-Za-z]*#[0-9A-Za-z]+$"),
    ("WEBLINK", r"^https?://"),
    ("NUM", r"^[0-9]+$"),
    ("ALPHA", r"^[A-Za-z]+$"),
    ("NUM_EXTENDED", r"^[0-9][0-9.,/-]*$"),
    ("ALPHA_NUM", r"^[0-9]+[A-Za-z]+$|^[A-Za-z]+[0-9]+$"),
    ("ALPHA_EXTENDED", r"^[A-Za-z][A-Za-z.'-]*$"),
    ("ALPHA_NUM_EXTENDED", r"[A-Za-z][-./]?[0-9]|[0-9][-./]?[A-Za-z]"),
]
WORD_LISTS = {
    "STREETTYPE": ["ST", "AVE", "RD", "LANE", "ALLÉE", "CUL DE SAC", "ROW"],
    "DIRECTION": ["N", "S", "E", "W", "NORD-EST"],
    "ARTICLE": ["the", "la", "le", "der", "die", "el", "los", "La"],
}
STREET_TYPES = ["ST", "AVE", "RD", "LANE"]

# Fixed value: the address form that extraction is tried with.
ADDRESS = "<<CIVIC#>> <<STREET@+>> <<TYPE::STREETTYPE>>"
ADDRESS_SIDE = "<<CIVIC#>> <<STREET@+>> <<TYPE::STREETTYPE>> <<SIDE::DIRECTION>>"
ADDRESSEE = "<<WHO@>> <<CIVIC#>> <<STREET@+>> <<::STREETTYPE>>"
ARTICLE_PHRASE = "<<BEFORE@+>> <<ARTICLE::ARTICLE>> <<AFTER@+>>"


@lru_cache(maxsize=4)
def model(spark: SparkSession) -> Model:
    return Model.from_values(spark, DEFINITIONS, WORD_LISTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table to tokenize.

    Tables that lie in one small file are read by one task. A caller who wants more says so by
    ``spark.tokenframe.inputPartitions``; unset, as on a cluster, nothing is moved.
    """
    rows = table(spark, sf_dir, name).select(*columns)
    partitions = spark.conf.get("spark.tokenframe.inputPartitions", None)
    return rows.repartition(int(partitions)) if partitions else rows


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address per line item, such as ``ATTN 12 SMALL RING AVE N``; some are NULL."""
    lines = texts(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    order = F.col("l_orderkey")
    kind = F.array(*[F.lit(word) for word in STREET_TYPES])
    text = F.concat(
        F.when(order % 7 == 0, "ATTN ").otherwise(""),
        (order % 900 + 1).cast("string"),
        F.lit(" "),
        F.upper("p_name"),
        F.lit(" "),
        F.get(kind, (order % 4).cast("int")),
        F.when(F.col("l_linenumber") % 5 == 0, " N").otherwise(""),
    )
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey", "l_linenumber", F.when(order % 13 != 0, text).alias("address")
    )
