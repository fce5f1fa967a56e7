"""Find benchmark items inside documents.

A document holds an item if some window of it, as long as the item in words, is similar to
the item: multisets of 5-word shingles, lower case, sum of minima over sum of maxima
0.75 or more. Windows are compared by SimHash first. Fingerprints are cut into
``radius + 1`` blocks: two that differ in at most ``radius`` bits agree in one block, so
a join on (length, block, value) meets every pair within the radius. What it meets is
checked for its distance, then for exact similarity.

Only windows that begin with a shingle of a benchmark item get a fingerprint (or the last
window, where the shingle stands too near the end). That loses nothing: moving a window
right to its first shared shingle leaves its size and does not lower its similarity.

Defined cases: NULL texts hold nothing. An item of fewer than five words is never found. A
document shorter than an item is one window. The verdict depends on the text alone, so
repeated rows and NULL ids get the same. Columns of the input are read by the given names
only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .native import bound, fixed, shingle_hashes, words_of
from .store import neutral, salted_join, saved

SHINGLE = 5
SIMILARITY = 0.75
BITS = 64
# At a similarity of 0.75 two fingerprints differ in 11 bits on average, deviation 3.
RADIUS = 20
# Benchmark shingles up to this number are broadcast: 16 bytes each. More are shuffled.
BROADCAST_SHINGLES = 1_000_000

_KEY = "__d_key"


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of each block; widths differ by one at most."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _block(fingerprint: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fingerprint, shift).bitwiseAND(F.lit((1 << width) - 1))


def simhash(hashes: Column, longest: int) -> Column:
    """Bit b is set if more than half of the hashes have it set; repeats count each time.

    The 64 counts are kept bit by bit: word k of the state holds bit k of every count, so
    adding a hash is a ripple of ANDs and XORs over a few words. ``longest`` bounds the
    number of hashes.
    """
    width = max(1, longest.bit_length())
    names = [f"c{k}" for k in range(width)]

    def add(state: Column, value: Column) -> Column:
        carry, fields = value, []
        for name in names:
            fields.append(state[name].bitwiseXOR(carry).alias(name))
            carry = state[name].bitwiseAND(carry)
        return F.struct(*fields)

    def majority(state: Column) -> Column:
        half = F.shiftright(F.size(hashes), 1).cast("bigint")
        above, same = F.lit(0).cast("bigint"), F.lit(-1).cast("bigint")
        for k in reversed(range(width)):
            bit = -(F.shiftright(half, k).bitwiseAND(F.lit(1)))
            above = above.bitwiseOR(same.bitwiseAND(state[names[k]]).bitwiseAND(F.bitwise_not(bit)))
            same = same.bitwiseAND(F.bitwise_not(state[names[k]].bitwiseXOR(bit)))
        return above

    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in names])
    return F.aggregate(hashes, zero, add, majority)


def similarity(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of two multisets; columns, not expressions."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))
    )
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)
    return bound(common, lambda n: n / (F.size(a) + F.size(b) - n))


def _hashed(df: DataFrame, text: str, *columns: Column) -> DataFrame:
    words = words_of(F.lower(F.col(f"`{text}`")))
    return df.select(*columns, fixed(shingle_hashes(words, SHINGLE)).alias("__d_h"))


def _key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias(_KEY)


def found_items(
    docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str, radius: int = RADIUS
) -> DataFrame:
    """(``__d_key`` of the text, ``item_id``, ``similarity``): the items each text holds."""
    bench = saved(
        _hashed(items, item_text, F.col(f"`{item_id}`").alias("item_id")).where(F.size("__d_h") > 0),
        "items",
    )
    shingles = bench.select(F.size("__d_h").alias("__d_m"), F.explode("__d_h").alias("__d_x")).distinct()
    total, longest = bench.agg(
        F.coalesce(F.sum(F.size("__d_h")), F.lit(0)), F.coalesce(F.max(F.size("__d_h")), F.lit(1))
    ).first()
    small = F.broadcast if total <= BROADCAST_SHINGLES else (lambda df: df)

    hashed = _hashed(docs, text, _key(text))
    hits = hashed.select(_KEY, "__d_h", F.posexplode("__d_h").alias("__d_pos", "__d_x")).join(
        small(shingles), "__d_x"
    )
    n, m = F.size("__d_h"), F.col("__d_m")
    first = F.least(F.col("__d_pos"), F.greatest(n - m, F.lit(0)))
    windows = hits.select(_KEY, "__d_m", F.slice("__d_h", first + 1, F.least(n, m)).alias("__d_w"))
    windows = windows.select(_KEY, "__d_m", fixed(F.col("__d_w")).alias("__d_w"))
    prints = windows.select("*", fixed(simhash(F.col("__d_w"), longest)).alias("__d_f"))
    theirs = bench.select(
        "item_id", F.size("__d_h").alias("__d_m"), F.col("__d_h").alias("__d_i"),
        simhash(F.col("__d_h"), longest).alias("__d_g"),
    )
    cuts = _blocks(radius)
    numbered = lambda f: F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), _block(F.col(f), s, w).alias("v")) for k, (s, w) in enumerate(cuts)
    ])).alias("__d_b")
    met = prints.select("*", numbered("__d_f")).join(
        small(theirs.select("*", numbered("__d_g"))), ["__d_m", "__d_b"]
    )
    differ = F.col("__d_f").bitwiseXOR(F.col("__d_g"))
    # A pair meets in each block it shares; it is kept in the first of them.
    earliest = F.coalesce(*[F.when(_block(differ, s, w) == 0, F.lit(k)) for k, (s, w) in enumerate(cuts)])
    near = met.where((F.bit_count(differ) <= radius) & (earliest == F.col("__d_b.k")))
    scored = near.select(_KEY, "item_id", fixed(similarity(F.col("__d_w"), F.col("__d_i"))).alias("similarity"))
    return (
        scored.where(F.col("similarity") >= SIMILARITY)
        .groupBy(_KEY, "item_id")
        .agg(F.max("similarity").alias("similarity"))
    )


def contamination(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str
) -> DataFrame:
    """One row per document: whether it holds items, which, and how similar the nearest is."""
    found = saved(found_items(docs, text, items, item_id, item_text), "found")
    texts = found.groupBy(_KEY).agg(
        F.sort_array(F.collect_list("item_id")).alias("item_ids"),
        F.max("similarity").alias("max_similarity"),
    )
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), _key(text))
    joined = salted_join(ids, texts, [_KEY], F.col("doc_id"), "left")
    return joined.select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.when(F.col("item_ids").isNull(), 0).otherwise(F.size("item_ids")).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", F.array().cast(texts.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("max_similarity", F.lit(0.0)).alias("max_similarity"),
    )


def drop_contaminated(
    docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str
) -> DataFrame:
    """The documents that hold no benchmark item, with the columns they came with."""
    found = saved(found_items(docs, text, items, item_id, item_text).select(_KEY).distinct(), "found")
    rows, names, back = neutral(docs)
    keyed = rows.select("*", _key(names[text]))
    return back(salted_join(keyed, found, [_KEY], F.col(names[doc_id]), "left_anti"))
