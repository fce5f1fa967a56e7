"""Words and word shingles as built-in column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space, tab, line ends, VT and FF; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+"), "")


def shingle_hashes(words: Column, size: int) -> Column:
    """64-bit hash of each run of ``size`` words; empty with fewer words."""

    def hashes(bound_words: Column) -> Column:
        one = lambda i: F.xxhash64(*[F.get(bound_words, i + k) for k in range(size)])
        positions = F.sequence(F.lit(0), F.size(bound_words) - size)
        return F.when(F.size(bound_words) >= size, F.transform(positions, one)).otherwise(
            F.array().cast("array<bigint>")
        )

    return bound(words, hashes)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, although a lambda in ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fixed(value: Column) -> Column:
    """``value`` by an explode of one element: a filter above it does not compute it anew."""
    return F.explode(F.array(value))
