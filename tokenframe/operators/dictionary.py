"""Dictionaries: the values of an array column as a table with ids, and ids in their place.

Ids are dense from 0 and ascend with the value, in byte order for strings. The values are
made distinct first, so a value that is found everywhere is one row like any other; then they are
cut into ranges at quantiles of a sample, each range is sorted by one task, and
a value's id is its place in its range plus the sizes of the ranges before. Their number
follows the session's shuffle settings, so no task sees the whole dictionary and no number of parts is fixed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.literal_table import LiteralTable
from ..sources.storage import written_once
from .lookup import NAME_BYTES, lookup_by_join

LOOKUPS = ("join", "literal")
#: So many of the commonest values are carried in the plan beside a join, which then has the others.
COMMON = 4_000
_FOUND, _PLACE, _RANGE = "__tf_found", "__tf_place", "__tf_range"
# A row's number is its partition's, and below these bits its place in it.
_PLACE_BITS = 33


def dictionary_ordered(values: DataFrame, value: str = "value") -> DataFrame:
    """``(id, value)`` of the distinct non-NULL values of a column, ids in the order of the values.

    It is written once, to the shared folder: its sizes by range are read before its rows are numbered.
    """
    return _counted(values, value).select("id", "value")


def _counted(values: DataFrame, value: str = "value") -> DataFrame:
    """``(id, value, n)``: the dictionary with how often each value was there."""
    known = values.select(F.col(f"`{value}`").alias("value")).where("value IS NOT NULL")
    distinct = known.groupBy("value").agg(F.count("*").alias("n"))
    ranged = distinct.repartitionByRange("value").sortWithinPartitions("value")
    placed = written_once(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "ranges")
    number = F.shiftright(_PLACE, _PLACE_BITS).alias(_RANGE)
    sizes = placed.groupBy(number).agg(F.count("*").alias("rows"))
    # A row for each range: as many as the shuffle had partitions.
    before = F.sum("rows").over(Window.orderBy(_RANGE)) - F.col("rows")
    starts = sizes.select(_RANGE, before.alias("start"))
    numbered = placed.withColumn(_RANGE, number).join(F.broadcast(starts), _RANGE)
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return numbered.select((F.col("start") + place).alias("id"), "value", "n")


def dictionary_encode(
    df: DataFrame, array_col: str, out: str | None = None, lookup: str = "join"
) -> tuple[DataFrame, DataFrame]:
    """Dictionary of an array column's values, and the table with ids in their place.

    Gives ``(dictionary(id, value), encoded)``; see ``dictionary_ordered`` for the ids. NULL elements
    stay NULL. ``lookup`` is ``join``, for a dictionary of any size, or ``literal``, which puts it into the plan
    and needs no join; one too large for that is refused. Beside the join, the commonest values are in the plan.
    """
    _check(lookup)
    values = df.select(F.explode_outer(F.array_distinct(f"`{array_col}`")).alias("value"))
    counted = _counted(values)
    dictionary = counted.select("id", "value")
    common = _commonest(counted, "value") if lookup == "join" else None
    return dictionary, _replaced(df, array_col, dictionary, "value", "id", out, lookup, common)


def dictionary_decode(
    df: DataFrame, ids_col: str, dictionary: DataFrame, out: str | None = None, lookup: str = "join"
) -> DataFrame:
    """Values for the ids that ``dictionary_encode`` gave; ``lookup`` as there."""
    _check(lookup)
    common = None
    if lookup == "join":
        ids = df.select(F.explode_outer(f"`{ids_col}`").alias("id")).where("id IS NOT NULL")
        first = _commonest(ids.groupBy("id").agg(F.count("*").alias("n")), "id").select("id")
        # Written, as it is read twice; an id that the dictionary lacks is left to the join.
        common = written_once(dictionary.join(F.broadcast(first), "id", "left_semi"), "common")
    return _replaced(df, ids_col, dictionary, "id", "value", out, lookup, common)


def _commonest(counted: DataFrame, value: str) -> DataFrame:
    """The first ``COMMON`` values by their ``n``. Any choice gives the same result of a lookup."""
    return counted.orderBy(F.desc("n"), value).limit(COMMON)


def _check(lookup: str) -> None:
    if lookup not in LOOKUPS:
        raise ValueError(f"unknown lookup {lookup!r}, expected one of {', '.join(LOOKUPS)}")


def _replaced(
    df: DataFrame,
    array: str,
    table: DataFrame,
    value: str,
    payload: str,
    out: str | None,
    lookup: str,
    common: DataFrame | None,
) -> DataFrame:
    items = F.col(f"`{array}`")
    if lookup == "literal":
        literal = LiteralTable.build(table, value, payload)
        if literal is None:
            raise ValueError("the dictionary is too large for lookup='literal'; use lookup='join'")
        return df.withColumn(out or array, F.transform(items, literal.lookup))
    # Long values stay out of the plan.
    short = F.octet_length(F.col("value").cast("string")) <= NAME_BYTES
    literal = LiteralTable.build(common.where(short), value, payload)
    in_plan = (lambda item: F.lit(None)) if literal is None else literal.lookup
    found = lookup_by_join(
        df, array, lambda values: values, table, value, payload, _FOUND, lambda item: in_plan(item).isNotNull()
    )
    # Zipped, as an array that a lambda's body refers to could be built again per element.
    both = F.zip_with(items, _FOUND, lambda item, hit: F.coalesce(hit, in_plan(item)))
    return found.withColumn(out or array, both).drop(_FOUND)
