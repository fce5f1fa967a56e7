"""A lookup table that travels as one literal in the plan.

For tables too long for ``isin`` and CASE, yet small by a checked count: rows then look
up their own values, with no join, no shuffle and no state. The table is an array of
small maps, and a value's hash says which map it is in, as Spark looks through a map
from its start.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

MAX_ROWS = 100_000
MAX_BYTES = 4 * 1024 * 1024


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class LiteralTable:
    json: str = field(repr=False)
    buckets: int
    kind: str

    @classmethod
    def build(cls, table: DataFrame, value: str, payload: str) -> LiteralTable | None:
        """From a table with unique values; None when a count shows that it is too large."""
        key, kind = F.col(value).cast("string"), table.schema[payload].dataType.simpleString()
        bytes_of = F.octet_length(key) + F.octet_length(F.col(payload).cast("string"))
        size = table.agg(F.count("*").alias("n"), F.sum(bytes_of).alias("b")).first()
        if size.n > MAX_ROWS or (size.b or 0) > MAX_BYTES:
            return None
        buckets = max(1, size.n // 2)
        entries = F.map_from_entries(F.collect_list(F.struct(key, F.col(payload))))
        maps = table.groupBy(_bucket(key, buckets).alias("b")).agg(F.to_json(entries).alias("m"))
        texts = ["{}"] * buckets
        for row in maps.collect():
            texts[row.b] = row.m
        return cls(f"[{','.join(texts)}]", buckets, kind)

    def lookup(self, value: Column) -> Column:
        """Payload of a value, NULL when the table does not have it."""
        maps = F.from_json(F.lit(self.json), f"array<map<string,{self.kind}>>")
        key = value.cast("string")
        return F.try_element_at(F.get(maps, _bucket(key, self.buckets)), key)
