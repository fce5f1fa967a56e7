"""Cut a table into shards of nearly equal bytes.

Equal texts stay together: they form an atomic group, and the groups are ordered by a hash of
the text. Among all ways to cut that order into contiguous shards, the one whose largest
shard is smallest is found: binary search on the capacity, each capacity checked by filling
shards greedily. The groups never come to the driver. It sees sums over ranges of the
hash; ranges in which some capacity that is still possible would cut are split finer and
summed again, until each holds one group, so the result is exact.

Defined cases: a NULL text has no bytes. Every row counts one byte more than its text. An
empty table gives no rows. One group larger than a shard's share gets a shard of that size.
Repeated rows and NULL ids are rows like others; among equal rows the order of slots is free.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from .store import saved

#: A level splits each range by so many bits of the hash.
LEVEL_BITS = 8
FIRST_BITS = 12
SLOT_BUCKETS = 1_024

# The hash's unsigned order: its top bits, as a number without sign.
_TOP = 64


def _range_of(h: Column, bits: int) -> Column:
    return F.shiftrightunsigned(h, _TOP - bits)


class _Ranges:
    """Ordered ranges of the hash with their bytes; ``cut`` finds where a shard must end."""

    def __init__(self, rows: list[tuple[int, int, int, int]]) -> None:
        # (start of the range in hash space, bits, bytes, groups)
        self.rows = sorted(rows)
        self.sums = [0, *accumulate(r[2] for r in self.rows)]

    def greedy(self, capacity: int, shards: int) -> tuple[bool, list[int]]:
        """Whether shards of this capacity hold all, and the first range after each cut."""
        at, cuts = 0, []
        for _ in range(shards):
            at = bisect_right(self.sums, self.sums[at] + capacity) - 1
            if at >= len(self.rows):
                return True, cuts
            cuts.append(at)
        return False, cuts


def _smallest(ranges: _Ranges, low: int, high: int, shards: int) -> int:
    while low < high:
        mid = (low + high) // 2
        if ranges.greedy(mid, shards)[0]:
            high = mid
        else:
            low = mid + 1
    return low


def cut_points(groups: DataFrame, shards: int) -> list[int]:
    """First hash (unsigned) of shards 1, 2, …; ``groups`` has ``h`` and ``bytes``."""

    def summed(df: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
        rows = df.groupBy(_range_of(F.col("h"), bits).alias("r")).agg(F.sum("bytes"), F.count("*"))
        return [((r % (1 << bits)) << (_TOP - bits), bits, int(b), n) for r, b, n in rows.collect()]

    bits = FIRST_BITS
    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if total is None:
        return []
    ranges = _Ranges(summed(groups, bits))
    least = max(-(-int(total) // shards), int(largest))
    while True:
        # Cutting at borders of ranges only is possible, so its best capacity is enough. Where
        # a capacity between the bounds would cut lies between where the bounds would.
        most = _smallest(ranges, least, int(total), shards)
        wanted, low_at, high_at = set(), 0, 0
        for _ in range(shards):
            low_at = bisect_right(ranges.sums, ranges.sums[low_at] + least) - 1
            high_at = min(bisect_right(ranges.sums, ranges.sums[high_at] + most), len(ranges.rows))
            wanted.update(range(max(0, low_at), min(high_at + 1, len(ranges.rows))))
        split = [k for k in sorted(wanted) if ranges.rows[k][3] > 1 and ranges.rows[k][1] < _TOP]
        if not split:
            break
        bits = min(_TOP, bits + LEVEL_BITS)
        gone = {ranges.rows[k][0] for k in split}
        coarse: dict[int, list[int]] = {}
        for k in split:
            start, width = ranges.rows[k][:2]
            coarse.setdefault(width, []).append((start >> (_TOP - width)) - ((1 << width) if width == _TOP else 0))
        inside = F.lit(False)
        for width, numbers in coarse.items():
            inside = inside | _range_of(F.col("h"), width).isin(numbers)
        fine = summed(groups.where(inside), bits)
        ranges = _Ranges([r for r in ranges.rows if r[0] not in gone] + fine)
    return [ranges.rows[at][0] for at in ranges.greedy(most, shards)[1] if at < len(ranges.rows)]


def shard(docs: DataFrame, doc_id: str, text: str, shards: int = 16) -> DataFrame:
    """One row per document: size, text_crc32, law, shard, slot, grown_shard."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = saved(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            (F.octet_length(value) + 1).cast("bigint").alias("size"),
            F.crc32(F.encode(value, "UTF-8")).alias("text_crc32"),
            F.xxhash64(value).alias("h"),
        ),
        "sizes",
    )
    groups = saved(rows.groupBy("h").agg(F.sum("size").alias("bytes")), "groups")
    # Unsigned order as signed order: the sign bit turned.
    turned = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))
    number = F.lit(0)
    for start in cut_points(groups, shards):
        number = number + (turned >= F.lit(start - (1 << 63))).cast("int")
    placed = rows.select(
        "*", number.alias("shard"), F.pmod(F.xxhash64("h", "doc_id"), F.lit(SLOT_BUCKETS)).alias("bucket")
    )
    return _slotted(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _slotted(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0, bucket by bucket; no task sees a whole shard."""
    from pyspark.sql import Window

    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    starts = counts.select("shard", "bucket", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "h"))
    # As many rows as shards times buckets at most, so it can be broadcast.
    return placed.withColumn("place", place).join(F.broadcast(starts), ["shard", "bucket"]).withColumn(
        "slot", F.col("before") + F.col("place") - 1
    )
