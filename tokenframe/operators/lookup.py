"""Look up every element of an array column in a table by join.

The join gives whole results under skew, without a limit on what may repeat:

* Rows are told apart by a digest of their content, and only the digest is shuffled with what is
  found. Contents with more than ``COPIES`` copies are found by a count first; of each of them one
  row is looked up, and its result is spread over salts, as many as its copies ask for, when it is joined back.
  By the pigeonhole principle no other content than the first ``FREQUENT`` of them holds more than
  a share of 1 / ``FREQUENT`` of all rows.
* Elements are joined by a name of bounded length, and each occurrence by one of ``SPREAD`` salts,
  so an element that is found everywhere is worked on by several tasks.
* A bitmap of the table's values, where the caller has one, drops what cannot be found before any
  shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Contents with more copies than this are looked up once, for one salt each so many copies.
COPIES = 1_000
FREQUENT = 2_000
MAX_SALTS = 1_024
SPREAD = 8
#: Longer elements are joined by their SHA-256.
NAME_BYTES = 64

_CONTENT, _SALT, _HITS = "__tf_content", "__tf_salt", "__tf_hits"
_POS, _VALUE, _HIT = "__tf_pos", "__tf_value", "__tf_hit"
_TEXT, _SALTS, _BITS = "__tf_text", "__tf_salts", "__tf_bits"
#: Places whose payloads travel together, a bit each.
BLOCK = 64


def lookup_by_join(
    df: DataFrame,
    col: str,
    elements_of: Callable[[Column], Column],
    table: DataFrame,
    value: str,
    payload: str,
    out: str,
    skip: Callable[[Column], Column] | None = None,
    few: bool = False,
) -> DataFrame:
    """Add ``out``: for each element of ``elements_of(col)`` its ``payload``, or NULL.

    ``table`` has unique, non-NULL values. Elements for which ``skip`` holds are not
    looked up. ``out`` ends with the last element found, or up to a block later; ``zip_with`` fills up the rest,
    or the caller cuts it. ``few`` says that many elements share a payload, as classes are shared: their places
    then travel as bits. A stream is refused: the join back needs a batch, as ``write_batches`` gives it.
    """
    if df.isStreaming:
        raise ValueError(
            "a lookup by join needs a batch: use write_batches on a stream, or a model with lookup='inline'"
        )
    kind, shape = table.schema[payload].dataType, df.schema[col].dataType
    named = table.select(element_name(F.col(value)).alias(_VALUE), F.col(payload).alias(_HIT))
    rows = df.withColumn(_CONTENT, _content_of(F.col(f"`{col}`"), shape))
    texts = rows.select(_CONTENT, F.col(f"`{col}`").alias(_TEXT))
    frequent = _frequent_contents(texts.select(_CONTENT))

    # Of a frequent content one row a task is left before the shuffle, and one after it.
    rare = texts.join(F.broadcast(frequent), _CONTENT, "left_anti")
    copied = texts.join(F.broadcast(frequent), _CONTENT, "left_semi").dropDuplicates([_CONTENT])
    hits = _found(rare, elements_of, named, skip).unionByName(_found(copied, elements_of, named, skip))
    # Bounded by the length of one row's array; rare copies bring the same hits again.
    if few:
        packed = _blocks(hits).groupBy(_CONTENT).agg(F.array_sort(F.collect_list(F.struct(_POS, _HIT))).alias(_HITS))
        dense = _from_blocks(_dense(F.col(_HITS), packed.schema[_HITS].dataType.elementType[_HIT].dataType), kind)
    else:
        packed = hits.groupBy(_CONTENT).agg(F.array_sort(F.collect_set(F.struct(_POS, _HIT))).alias(_HITS))
        dense = _dense(F.col(_HITS), kind)
    dense = F.coalesce(dense, F.array().cast(T.ArrayType(kind)))
    return _join_back(rows, packed, frequent).withColumn(out, dense).drop(_CONTENT, _HITS)


def element_name(value: Column) -> Column:
    """The value, or for a long one its digest: what an element is joined and broadcast by."""
    text = value.cast("string")
    digest = F.concat(F.lit("\u0000sha256:"), F.sha2(text, 256))
    return F.when(F.octet_length(text) <= NAME_BYTES, text).otherwise(digest)


def _content_of(value: Column, kind: T.DataType) -> Column:
    """Tells contents apart by 128 bits. JSON keeps NULLs and the borders between elements."""
    text = value if isinstance(kind, T.StringType) else F.to_json(value)
    return F.coalesce(F.substring(F.unhex(F.sha2(text, 256)), 1, 16), F.lit(b""))


def _frequent_contents(contents: DataFrame) -> DataFrame:
    counts = contents.groupBy(_CONTENT).agg(F.count("*").alias("n")).where(F.col("n") > COPIES)
    top = counts.orderBy(F.desc("n"), _CONTENT).limit(FREQUENT)
    salts = F.least(F.ceil(F.col("n") / COPIES), F.lit(MAX_SALTS)).cast("bigint")
    return top.select(_CONTENT, salts.alias(_SALTS))


def _found(
    texts: DataFrame, elements_of: Callable[[Column], Column], named: DataFrame, skip
) -> DataFrame:
    """``(content, pos, hit)`` of every element that the table has."""
    # The outer explode keeps Spark from adding a check that would work the array out twice.
    elements = texts.select(_CONTENT, F.posexplode_outer(elements_of(F.col(_TEXT))).alias(_POS, _VALUE))
    wanted = F.col(_VALUE).isNotNull()
    elements = elements.where(wanted if skip is None else wanted & ~skip(F.col(_VALUE)))
    spread = F.pmod(F.xxhash64(_CONTENT, _POS), F.lit(SPREAD))
    left = elements.select(_CONTENT, _POS, element_name(F.col(_VALUE)).alias(_VALUE), spread.alias(_SALT))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint")))
    right = named.select("*", salts.alias(_SALT))
    return left.join(right, [_VALUE, _SALT]).select(_CONTENT, _POS, _HIT)


def _join_back(rows: DataFrame, hits: DataFrame, frequent: DataFrame) -> DataFrame:
    # Rows may be equal in all columns, so the salt counts them where they are read, before any
    # shuffle. Every salt finds a copy of the hits, so any numbering gives the same result.
    none = F.lit(0).cast("bigint")
    known = F.broadcast(frequent)
    numbered = rows.withColumn(_SALT, F.monotonically_increasing_id()).join(known, _CONTENT, "left")
    left = numbered.withColumn(_SALT, F.coalesce(F.pmod(_SALT, _SALTS), none)).drop(_SALTS)
    salts = F.coalesce(F.sequence(none, F.col(_SALTS) - 1), F.array(none))
    right = hits.join(known, _CONTENT, "left").select(_CONTENT, _HITS, F.explode(salts).alias(_SALT))
    return left.join(right, [_CONTENT, _SALT], "left").drop(_SALT)


def _dense(hits: Column, kind: T.DataType) -> Column:
    """Array with each hit at its position and NULL in the gaps."""
    nothing = F.lit(None).cast(kind)

    def step(hit, i):
        before = F.coalesce(F.get(hits, i - 1)[_POS], F.lit(-1))
        return F.concat(F.array_repeat(nothing, hit[_POS] - before - 1), F.array(hit[_HIT]))

    return F.flatten(F.transform(hits, step))


def _blocks(hits: DataFrame) -> DataFrame:
    """``(content, pos, hit)`` for blocks of places: ``hit`` has the block's payloads, each with its places as bits.

    Bits are of fixed width and combined in the task, so a payload's row stands for all its places in a block,
    and those that copies bring again add nothing.
    """
    block = F.expr(f"{_POS} DIV {BLOCK}").cast("int").alias(_POS)
    bit = F.expr(f"shiftleft(1L, {_POS} % {BLOCK})")
    masks = hits.select(_CONTENT, block, _HIT, bit.alias(_BITS)).groupBy(_CONTENT, _POS, _HIT).agg(F.bit_or(_BITS).alias(_BITS))
    return masks.groupBy(_CONTENT, _POS).agg(F.collect_list(F.struct(_HIT, _BITS)).alias(_HIT))


def _from_blocks(blocks: Column, kind: T.DataType) -> Column:
    """Payloads of all places, NULL where there is none. A place has one payload, so their order is of no account."""
    places = F.sequence(F.lit(0), F.lit(BLOCK - 1))
    nothing = F.lit(None).cast(kind)
    has = lambda hit, place: F.bit_get(hit[_BITS], place) == 1

    def spread(hits: Column) -> Column:
        one = F.get(hits, F.lit(0))
        single = F.transform(places, lambda place: F.when(has(one, place), one[_HIT]))
        several = F.transform(places, lambda place: F.get(F.filter(hits, lambda hit: has(hit, place)), F.lit(0))[_HIT])
        return F.when(hits.isNull(), F.array_repeat(nothing, BLOCK)).when(F.size(hits) == 1, single).otherwise(several)

    return F.flatten(F.transform(blocks, spread))
