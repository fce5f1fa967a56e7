"""Near-duplicate groups by MinHash.

A document's set holds its distinct 5-word shingles, A-Z in lower case; with fewer words,
the whole sequence is the one member. Two documents are linked if 100 * |intersection| >=
75 * |union|, checked on the whole sets. Groups are the connected components of the links.

1. Documents with one and the same set are one class, named by its smallest id.
2. Each class gets the minima of 128 universal hash functions, in 32 bands of 4. Two sets at
   the similarity limit share no band with probability (1 - 0.75**4)**32 < 6e-6.
3. A band's value with several classes is a bucket. No bucket is turned into all its pairs:
   each member is first paired with the bucket's smallest member only, at most one pair a band and
   class. These pairs are checked by signature, then on the whole texts.
4. Buckets that lie inside one component are done. In the others, signatures are compared
   across components, block by block inside a task, and pairs that agree by their samples: all
   shingle hashes of a set of up to 512, else those below a limit. Only pairs that may still be
   links leave the task, and all of them are checked on the whole texts.
5. Components by alternating large-star and small-star steps.

Defined cases: a document without words is linked with nothing. A document without an id
can't be named: its component is NULL and it is kept. Rows that share an id are one node: what
is linked to one of them is linked to all. Repeated rows come out as often as they came in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import neutral, salted_join, saved, tasks_for
from .words import chained, mixed, slices, texts_of, words_in

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
LINK_PERCENT = 75
#: Of the minima, as many must agree; at the limit that fails for about one pair in 50,000.
AGREE = 75
#: Members of a bucket that are compared with each other in one group, and bytes compared at once.
BLOCK, COMPARED = 5_000, 1 << 25
#: Shingle hashes of a sample. Larger sets halve the range of hashes until about as many are left; a
#: link's sample then falls short of the limit by so many deviations for about one pair in 300,000.
SAMPLE, DEVIATIONS = 512, 4.5
#: Ids of candidates up to this number are broadcast (8 bytes each); more are shuffled.
BROADCAST_IDS = 1_000_000
#: The ids with most pairs get a copy of their text for each so many pairs.
HOT_IDS, PAIRS_PER_COPY = 1_000, 256

_GENERATOR = np.random.Generator(np.random.PCG64(20240502))
_A = _GENERATOR.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _GENERATOR.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for lo, hi in slices(texts):
        words = words_in(texts, lo, hi, lower=True)
        hashes, at = words.windows(SHINGLE)
        cuts = np.searchsorted(at, words.first)
        for d in range(hi - lo):
            a, b = words.first[d], words.first[d + 1]
            if b - a >= SHINGLE:
                yield np.unique(hashes[cuts[d] : cuts[d + 1]])
            elif b > a:
                yield chained([words.hashes[k : k + 1] for k in range(a, b)])
            else:
                yield np.empty(0, np.uint64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, HASHES) minima, high halves, of non-empty sets."""
    joined = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((HASHES, len(sets)), np.uint32)
    values = np.empty_like(joined)
    for k in range(HASHES):
        np.multiply(joined, _A[k], out=values)
        values += _B[k]
        out[k] = np.minimum.reduceat(values, first) >> np.uint64(32)
    return np.ascontiguousarray(out.T)


def band_values(signatures: np.ndarray) -> np.ndarray:
    """(sets, BANDS) values that agree where all rows of a band do."""
    rows = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    numbers = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    return mixed(chained([rows[..., k] for k in range(ROWS)]) + numbers)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(1))
        for lo, hi in slices(texts):
            sets = list(shingle_sets(texts[lo:hi]))
            full = [s for s in sets if len(s)]
            places = np.cumsum([len(s) > 0 for s in sets]) - 1
            if full:
                signatures = minima(full)
                bands, bits = band_values(signatures), (signatures & 0xFF).astype(np.uint8)
            pick = lambda f: [f(p) if len(s) else None for s, p in zip(sets, places, strict=True)]  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[lo:hi],
                    pa.array(
                        pick(lambda p: hashlib.blake2b(full[p].tobytes(), digest_size=16).digest()),  # noqa: B023
                        pa.binary(),
                    ),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(pick(lambda p: bands[p].tobytes()), pa.binary()),  # noqa: B023
                    pa.array(pick(lambda p: bits[p].tobytes()), pa.binary()),  # noqa: B023
                ],
                names=["doc_id", "key", "n", "bands", "bits"],
            )


def signatures(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    columns = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return columns.mapInArrow(
        _signed, "doc_id bigint, key binary, n bigint, bands binary, bits binary"
    )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        bands = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(ids)], names=["band", "cid"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        x, y = (
            np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES)
            for k in (2, 3)
        )
        agree = (x == y).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(agree, pa.int64())], names=["a", "b", "agree"]
        ).filter(pa.array(agree >= AGREE))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = texts_of(batch.column(2)), texts_of(batch.column(3))
        keep = []
        for a, b in zip(shingle_sets(x), shingle_sets(y), strict=True):
            common = len(np.intersect1d(a, b, assume_unique=True))
            union = len(a) + len(b) - common
            keep.append(union > 0 and 100 * common >= LINK_PERCENT * union)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1)], names=["a", "b"]
        ).filter(pa.array(keep, pa.bool_()))


def _with(pairs: DataFrame, side: str, table: DataFrame, column: str, hot: list[tuple[int, int]]) -> DataFrame:
    """Add ``column`` of ``table`` (by ``cid``) for one side of the pairs; ids of ``hot`` get several copies."""
    own = table.select(F.col("cid").alias(side), F.col(column).alias(f"{column}_{side}"))
    if not hot:
        return pairs.join(own.hint("merge"), side)
    copies = pairs.sparkSession.createDataFrame(hot, "hot bigint, copies int")
    other = "b" if side == "a" else "a"
    left = pairs.join(F.broadcast(copies), F.col(side) == F.col("hot"), "left").withColumn(
        "salt", F.pmod(F.xxhash64(other), F.coalesce("copies", F.lit(1))).cast("int")
    )
    right = own.join(F.broadcast(copies), F.col(side) == F.col("hot"), "left").select(
        side,
        f"{column}_{side}",
        F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("salt"),
    )
    return left.drop("hot", "copies").join(right.hint("merge"), [side, "salt"]).drop("salt")


def _both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Add ``column`` of both sides to written pairs.

    One count finds the ids with most pairs on either side, a fixed number.
    """
    ends = pairs.select(F.inline(F.array(*(F.struct(F.lit(x).alias("side"), F.col(x).alias("id")) for x in "ab"))))
    counts = ends.groupBy("side", "id").count().where(F.col("count") > PAIRS_PER_COPY)
    rows = counts.orderBy(F.desc("count"), "side", "id").limit(2 * HOT_IDS).collect()
    hot = {x: [(r["id"], -(-r["count"] // PAIRS_PER_COPY)) for r in rows if r["side"] == x] for x in "ab"}
    return _with(_with(pairs, "b", table, column, hot["b"]), "a", table, column, hot["a"])


def _promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree well enough, with the number of minima that do."""
    both = _both(pairs, classes, "bits")
    return both.select("a", "b", "bits_a", "bits_b").mapInArrow(
        _agreeing, "a bigint, b bigint, agree bigint"
    )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    both = _both(pairs, texts, "text")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_linked, "a bigint, b bigint")


def _neighbourhoods(edges: DataFrame) -> DataFrame:
    """Of every node: ``m``, the smallest of itself and its neighbours, and how many edges have it as
    their larger end, and in all."""
    both = F.array(
        F.struct(F.col("u").alias("node"), F.col("v").alias("other"), F.lit(1).alias("larger")),
        F.struct(F.col("v").alias("node"), F.col("u").alias("other"), F.lit(0).alias("larger")),
    )
    return (
        edges.select(F.inline(both))
        .groupBy("node")
        .agg(F.min("other").alias("m"), F.sum("larger").alias("upper"), F.count("*").alias("all"))
        .select("node", F.least("m", "node").alias("m"), "upper", "all")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge to another.

    Alternating large-star and small-star steps, each written out, until only stars are left: until
    every node is either one edge's larger end or smaller ends only.
    """
    up = F.greatest("a", "b").alias("u")
    down = F.least("a", "b").alias("v")
    now = saved(edges.where("a <> b").select(up, down).distinct(), "edges")
    while True:
        near = saved(_neighbourhoods(now), "near")
        if near.where("upper > 0 AND all > 1").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        # Large star: every larger neighbour goes to the smallest of the neighbourhood. An edge gives
        # one edge, so repeated ones wait for the next step.
        least = near.select(F.col("node").alias("v"), "m")
        large = salted_join(now, least, ["v"], F.col("u"), "inner", hint="merge")
        large = saved(large.select("u", F.col("m").alias("v")), "edges")
        # Small star: every smaller neighbour, and the node itself, goes to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = salted_join(large, least, ["u"], F.col("v"), "inner", hint="merge")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        now = saved(small.where("u <> v").distinct(), "edges")


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components once more links are known."""
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(links))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each set the level, and the hashes (32 bits, sorted) below 2**(32 - level)."""
    for batch in batches:
        levels, samples = [], []
        for hashes in shingle_sets(texts_of(batch.column(1))):
            level = max(0, (len(hashes) - 1) // SAMPLE).bit_length()
            high = np.unique((mixed(hashes) >> np.uint64(32)).astype(np.uint32))
            levels.append(level)
            samples.append(high[: np.searchsorted(high, 1 << (32 - level))].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(levels, pa.int32()), pa.array(samples, pa.binary())],
            names=["cid", "level", "sample"],
        )


class _Samples:
    """The samples of a group's members, with hashes numbered in their order."""

    def __init__(self, levels: list[int], samples: list[bytes]):
        self.levels = np.array(levels)
        ends = np.cumsum([0, *(len(s) // 4 for s in samples)])
        hashes, numbers = np.unique(np.frombuffer(b"".join(samples), np.uint32), return_inverse=True)
        self.sets = [numbers[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.marked = np.zeros(len(hashes), bool)
        # How many of a member's hashes lie in the range of each level.
        self.ranges = np.unique(self.levels)
        self.sizes = np.empty((len(self.ranges), len(levels)), np.int64)
        for k, level in enumerate(self.ranges):
            inside = np.cumsum([0, *(numbers < np.searchsorted(hashes, 1 << (32 - int(level))))])
            self.sizes[k] = inside[ends[1:]] - inside[ends[:-1]]

    def may_link(self, x: int, others: np.ndarray) -> np.ndarray:
        """Which of the others may be linked with ``x``; exact but for one hash at level 0."""
        sets = [self.sets[y] for y in others]
        self.marked[self.sets[x]] = True
        hits = np.cumsum(np.concatenate([[0], self.marked[np.concatenate(sets)]]))
        self.marked[self.sets[x]] = False
        ends = np.cumsum([0, *map(len, sets)])
        common = hits[ends[1:]] - hits[ends[:-1]]
        level = np.maximum(self.levels[x], self.levels[others])
        k = np.searchsorted(self.ranges, level)
        union = self.sizes[k, x] + self.sizes[k, others] - common
        share = LINK_PERCENT / 100
        slack = np.where(level == 0, 1, DEVIATIONS * np.sqrt(share * (1 - share) * union) + 1)
        return common + slack >= share * union


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs across components that may be links, from sorted rows, block by block."""
    key, members = None, []

    def close() -> pa.RecordBatch | None:
        cids, parts, bits, levels, samples = zip(*members, strict=True)
        part = np.array(parts)
        names, counts = np.unique(part, return_counts=True)
        if len(names) < 2:
            return None
        cid, table = np.array(cids), np.frombuffer(b"".join(bits), np.uint8).reshape(-1, HASHES)
        known = _Samples(levels, samples)
        # Inside the largest component nothing is compared.
        others = np.flatnonzero(part != names[counts.argmax()])
        step = max(1, COMPARED // table.size)
        out = [np.empty((0, 2), np.int64)]
        for lo in range(0, len(others), step):
            some = others[lo : lo + step]
            agree = np.count_nonzero(table[some][:, None, :] == table[None, :, :], axis=2)
            close_by = (agree >= AGREE) & (part[some][:, None] != part[None, :])
            for x, row in zip(some, close_by, strict=True):
                y = np.flatnonzero(row)
                if len(y) and len(y := y[known.may_link(x, y)]):
                    out.append(np.stack([np.full(len(y), cid[x]), cid[y]], axis=1))
        pairs = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for batch in batches:
        columns = (batch.column(k).to_pylist() for k in range(6))
        for own, *member in zip(*columns, strict=True):
            if own != key:
                if members and (found := close()):
                    yield found
                key, members = own, []
            members.append(member)
    if members and (found := close()):
        yield found


def _open_pairs(members: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct promising pairs across components that share a bucket.

    A bucket is compared in blocks: members fall into blocks of about ``BLOCK``, and each two blocks
    meet in one group, so a group has a bounded size whatever the bucket's.
    """
    placed = salted_join(
        members, found.select(F.col("node").alias("cid"), "component"), ["cid"], F.col("band"), "left"
    ).select("band", "cid", F.coalesce("component", "cid").alias("part"))
    several = (
        placed.groupBy("band")
        .agg(F.min("part").alias("x"), F.max("part").alias("y"), F.ceil(F.count("*") / BLOCK).alias("blocks"))
        .where("x <> y").select("band", "blocks")
    )
    opened = saved(salted_join(placed, several, ["band"], F.col("cid"), "inner"), "opened")
    wanted = texts.join(opened.select("cid").distinct(), "cid", "left_semi")
    samples = wanted.mapInArrow(_sampled, "cid bigint, level int, sample binary").distinct()
    opened = opened.join(classes.select("cid", "bits"), "cid").join(samples, "cid")
    kept = ["cid", "part", "bits", "level", "sample"]
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    met = opened.select("band", *kept, own.alias("own"), other.alias("other"))
    group = F.xxhash64("band", F.least("own", "other"), F.greatest("own", "other"))
    grouped = met.select(group.alias("g"), *kept)
    ordered = grouped.repartition(tasks_for(members.sparkSession), "g").sortWithinPartitions("g")
    return ordered.mapInArrow(_block_pairs, "a bigint, b bigint").distinct()


def near_groups(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    signed = saved(signatures(docs, doc_id, text), "signatures")
    classes = saved(
        signed.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("key")
        .agg(F.min("doc_id").alias("cid"), F.first("bands").alias("bands"), F.first("bits").alias("bits")),
        "classes",
    )
    bands = classes.select("cid", "bands").mapInArrow(_bands, "band bigint, cid bigint")
    buckets = (
        bands.groupBy("band").agg(F.min("cid").alias("leader"), F.max("cid").alias("last"))
        .where("leader < last").select("band", "leader")
    )
    members = saved(salted_join(bands, buckets, ["band"], F.col("cid"), "inner"), "members")
    needed = saved(members.select("cid").distinct(), "needed")
    ids = needed.select(F.col("cid").alias("needed_id"))
    ids = F.broadcast(ids) if needed.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("cid"), F.col(f"`{text}`").alias("text"))
    texts = saved(texts.join(ids, F.col("cid") == F.col("needed_id"), "left_semi"), "texts")

    stars = members.where("cid <> leader").select(F.col("cid").alias("a"), F.col("leader").alias("b"))
    close = saved(_promising(saved(stars.distinct(), "stars"), classes).select("a", "b"), "close")
    found = components(_verified(close, texts))
    last = saved(_open_pairs(members, found, classes, texts), "last")
    found = _merged(found, _verified(last, texts))

    named = classes.select("key", "cid").join(found, F.col("cid") == F.col("node"), "left")
    named = named.select("key", F.coalesce("component", "cid").alias("component_id"))
    own = signed.select("doc_id", "key", F.col("n").alias("n_shingles"))
    joined = salted_join(own, named, ["key"], F.col("doc_id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents that stand for their group, with the columns they came with."""
    gone = near_groups(docs, doc_id, text).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = saved(gone, "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    rows, names, back = neutral(docs)
    return back(rows.join(gone, F.col(names[doc_id]).cast("bigint") == F.col("gone_id"), "left_anti"))
