"""A set of hashes as a bitmap that travels as one literal in the plan.

Rows ask it whether a value may be in a table, before anything of them is shuffled. It answers
yes for every value of the table, and for a few others: each hash sets two bits of at least
16 for each value. What gets through is looked up exactly afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: Bits for each value, and the largest bitmap: one megabyte. With fewer than 4 bits for each value
#: it would let through too much to be worth asking.
BITS_PER_VALUE = 16
MIN_BITS = 1 << 12
MAX_BITS = 1 << 23
LEAST_BITS_PER_VALUE = 4

_BIT = "__tf_bit"


def _bits_of(h: Column, bits: int) -> list[Column]:
    mask = F.lit(bits - 1).cast("bigint")
    return [h.bitwiseAND(mask), F.shiftrightunsigned(h, 32).bitwiseAND(mask)]


@dataclass(frozen=True)
class BitmapFilter:
    """``may_hold(h)`` is true for every 64-bit hash it was built from."""

    json: str = field(repr=False)
    bits: int

    @classmethod
    def build(cls, table: DataFrame, h: Column) -> BitmapFilter | None:
        """Of the hashes ``h`` of a table; None when a count shows that they would fill the bitmap."""
        n = table.count()
        if n * LEAST_BITS_PER_VALUE > MAX_BITS:
            return None
        bits = MIN_BITS
        while bits < n * BITS_PER_VALUE and bits < MAX_BITS:
            bits *= 2
        # Bitmaps of Spark count from 1 and hold 32,768 bits each.
        each = table.select(F.explode(F.array(*_bits_of(h, bits))).alias(_BIT)).select(F.col(_BIT) + 1)
        each = each.toDF(_BIT)
        parts = each.groupBy(F.bitmap_bucket_number(_BIT).alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(_BIT)).alias("bitmap")
        )
        held = np.zeros(max(bits // 8, 4_096), np.uint8)
        # At most one megabyte, by the limit above.
        for row in parts.collect():
            at = (row.part - 1) * 4_096
            held[at : at + 4_096] = np.frombuffer(row.bitmap, np.uint8)
        words = held[: bits // 8].view("<i8")
        return cls(f"[{','.join(map(str, words.tolist()))}]", bits)

    def may_hold(self, h: Column) -> Column:
        words = F.from_json(F.lit(self.json), "array<bigint>")
        # The index of a word is below 2**17.
        hits = [
            F.bit_get(F.get(words, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1
            for bit in _bits_of(h, self.bits)
        ]
        return hits[0] & hits[1]
