"""Remove passages that already stand in an earlier document.

A window is ``WINDOW`` consecutive words of one document. A word goes if it is covered by a
window whose words also begin somewhere in a document with a smaller id; windows are judged
on the input. Suffixes (one for each word at which a whole window begins) are dealt out by
prefixes as for a prefix-partitioned suffix tree, but no tree is built and no suffix is sorted: only
64-bit hashes of windows are compared, and equal hashes count as equal windows.

1. A bounded sample of suffixes decides where to split: a prefix of one word is one group; a
   group with too large a share of the sample is split by the next word, and so on, down to the
   whole window. The sample only balances the work; any split gives the same result.
2. Each suffix goes to the partition of its group, with the hash of its window and its place; of
   equal windows in one document only the first goes, so a group grows with documents, not with
   places inside them.
   Groups are packed into partitions of about ``SUFFIXES_PER_TASK`` suffixes.
3. A partition sorts the hashes of its windows. In each run of one window, the smallest document is found, and the others' places go back to their documents.
   Documents and places meet in partitions by id, the rows of documents packed and compressed as the places are.
   Neighbouring places merge there into longer passages, which are cut out.
4. Windows that are frequent in the sample, a fixed number, are leaves that need no subtree: their
   smallest documents are found by a plain aggregate, and each document compares for itself.

Defined cases: NULL and empty texts have no words, and nothing is cut from texts of fewer
than ``WINDOW`` words. A document without an id is neither cut nor does it cut others. Rows that
repeat an id are documents of equal rank: they cut nothing from each other. Texts may have any
length. Other columns pass through.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .store import neutral, tasks_for
from .words import Words, chained, mixed, slices, texts_of, words_in

WINDOW = 13
#: Bounds of the sample that balances the partitions.
SAMPLE_DOCS, SAMPLE_PER_DOC = 2_000, 50
HOT_WINDOWS, HOT_IN_SAMPLE = 4_096, 25
SUFFIXES_PER_TASK = 4_000_000
#: Texts of so many bytes are sorted by partition at a time.
FLUSH_BYTES = 8 << 20

_ID, _TEXT, _ROW, _PLACES = "__s_id", "__s_text", "__s_row", "__s_places"
#: What a blob holds; places stand before the rows they are for.
_OF_PLACES, _OF_ROWS = 0, 1


def _member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


class Splits:
    """Prefixes to be split, by length, and the partition of each group that is known."""

    def __init__(self, sample: np.ndarray, partitions: int) -> None:
        """``sample`` has a row for each suffix: the hashes of its first 1, 2, … words."""
        self.partitions = partitions
        self.split: list[np.ndarray] = []
        share = max(1, len(sample) // (8 * partitions))
        left, leaves = sample, []
        for depth in range(WINDOW - 1):
            values, counts = np.unique(left[:, depth], return_counts=True)
            large = values[counts > share]
            leaves += zip(counts[counts <= share].tolist(), values[counts <= share].tolist(), strict=True)
            self.split.append(large)
            left = left[_member(left[:, depth], large)]
        values, counts = np.unique(left[:, WINDOW - 1], return_counts=True)
        leaves += zip(counts.tolist(), values.tolist(), strict=True)
        windows, counts = np.unique(sample[:, WINDOW - 1], return_counts=True)
        order = np.argsort(-counts, kind="stable")[:HOT_WINDOWS]
        self.hot = np.sort(windows[order][counts[order] >= HOT_IN_SAMPLE])
        # Largest group first, each to the emptiest partition.
        load = [(0, k) for k in range(partitions)]
        placed = {}
        for count, value in sorted(leaves, reverse=True):
            if count < 2:
                break
            size, k = load[0]
            placed[value] = k
            heapq.heapreplace(load, (size + count, k))
        self.known = np.array(sorted(placed), np.uint64)
        self.place = np.array([placed[int(v)] for v in self.known], np.int32)

    def partition_of(self, words: Words, at: np.ndarray) -> np.ndarray:
        key = prefix_hash(words, at, 1)
        open_ = np.arange(len(at))
        for depth, large in enumerate(self.split, 1):
            open_ = open_[_member(key[open_], large)]
            if not len(open_):
                break
            key[open_] = prefix_hash(words, at[open_], depth + 1)
        out = (key % np.uint64(self.partitions)).astype(np.int32)
        if len(self.known):
            hit = _member(key, self.known)
            out[hit] = self.place[np.searchsorted(self.known, key[hit])]
        return out


def prefix_hash(words: Words, at: np.ndarray, length: int) -> np.ndarray:
    return chained([words.hashes[at + k] for k in range(length)])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(0))
        for lo, hi in slices(texts):
            words = words_in(texts, lo, hi)
            _, at = words.windows(WINDOW)
            cuts = np.searchsorted(at, words.first)
            some = [
                at[a + (np.arange(min(b - a, SAMPLE_PER_DOC)) * (b - a)) // max(1, min(b - a, SAMPLE_PER_DOC))]
                for a, b in zip(cuts, cuts[1:], strict=False)
            ]
            at = np.concatenate(some)
            table = np.stack([prefix_hash(words, at, k + 1) for k in range(WINDOW)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([table.tobytes()], pa.binary()), pa.array([len(words.hashes)], pa.int64())],
                names=["table", "words"],
            )


def _splits(docs: DataFrame) -> Splits:
    count = docs.count()
    fraction = min(1.0, SAMPLE_DOCS / max(1, count))
    # The limit holds the bound should the sample come out larger.
    some = docs.sample(fraction=fraction, seed=7).limit(2 * SAMPLE_DOCS).select(_TEXT)
    rows = some.mapInArrow(_sampled, "table binary, words bigint").collect()
    sample = np.frombuffer(b"".join(r[0] for r in rows), np.uint64).reshape(-1, WINDOW)
    words = sum(r[1] for r in rows) / max(fraction, 1e-12)
    spark = docs.sparkSession
    return Splits(sample, max(tasks_for(spark), int(words / SUFFIXES_PER_TASK) + 1))


def _hot_firsts(splits: Splits):
    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, int] = {}
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), texts_of(batch.column(1))
            for lo, hi in slices(texts):
                words = words_in(texts, lo, hi)
                hashes, at = words.windows(WINDOW)
                hit = _member(hashes, splits.hot)
                docs = ids[lo:hi][np.searchsorted(words.first, at[hit], "right") - 1]
                for h, d in zip(hashes[hit].tolist(), docs.tolist(), strict=True):
                    if d < best.get(h, d + 1):
                        best[h] = d
        keys = np.array(list(best), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(list(best.values()), pa.int64())], names=["h", "first"]
        )

    return firsts


def _first_of_each(docs: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Of equal windows of one document, the first."""
    order = np.lexsort((hashes, docs))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(docs[order]) != 0) | (hashes[order][1:] != hashes[order][:-1])
    return np.sort(order[fresh])


def _all_like(words: Words, hashes: np.ndarray, at: np.ndarray, d: int, places: np.ndarray) -> np.ndarray:
    """Where windows equal to those at ``places`` of a document stand in it."""
    a, b = np.searchsorted(at, [words.first[d], words.first[d + 1]])
    marked = np.unique(hashes[a:b][np.searchsorted(at[a:b], places + words.first[d])])
    return at[a:b][_member(hashes[a:b], marked)]


def _dealer(splits: Splits):
    """Rows (partition, blob): the suffixes of a run of documents that go to a partition."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(2).to_numpy(zero_copy_only=False)
            texts = texts_of(batch.column(1))
            held, size = [], 0
            for lo, hi in slices(texts):
                words = words_in(texts, lo, hi)
                hashes, at = words.windows(WINDOW)
                cold = ~_member(hashes, splits.hot)
                hashes, at = hashes[cold], at[cold]
                docs = np.searchsorted(words.first, at, "right") - 1
                once = _first_of_each(docs, hashes)
                hashes, at, docs = hashes[once], at[once], docs[once]
                held.append(
                    (
                        splits.partition_of(words, at), hashes, (docs + lo).astype(np.int32),
                        (at - words.first[docs]).astype(np.uint32),
                    )
                )
                size += int(words.offsets[-1])
                if size >= FLUSH_BYTES:
                    yield from _blobs(held, ids, rows)
                    held, size = [], 0
            if held:
                yield from _blobs(held, ids, rows)

    return deal


def _blobs(held: list, ids: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    part, hashes, docs, places = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(part, kind="stable")
    part, hashes, docs, places = part[order], hashes[order], docs[order], places[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    packer = zstandard.ZstdCompressor(level=1)
    parts, blobs = [], []
    for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True):
        if a == b:
            continue
        own, first, n = np.unique(docs[a:b], return_index=True, return_counts=True)
        head = np.array([b - a, len(own)], np.int64).tobytes()
        # Within a document, places grow: their differences are small numbers.
        steps = np.diff(places[a:b], prepend=np.uint32(0))
        steps[first] = places[a:b][first]
        rest = b"".join([ids[own].tobytes(), rows[own].tobytes(), n.astype(np.uint32).tobytes()])
        planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
        blobs.append(head + hashes[a:b].tobytes() + packer.compress(rest + planes))
        parts.append(int(part[a]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"]
    )


def _open(blob: bytes) -> tuple[np.ndarray, ...]:
    n, d = np.frombuffer(blob, np.int64, 2)
    hashes = np.frombuffer(blob, np.uint64, n, 16)
    rest = zstandard.ZstdDecompressor().decompress(blob[16 + 8 * n :])
    ids, rows = np.frombuffer(rest, np.int64, d), np.frombuffer(rest, np.int64, d, 8 * d)
    counts = np.frombuffer(rest, np.uint32, d, 16 * d)
    steps = np.ascontiguousarray(np.frombuffer(rest, np.uint8, 4 * n, 20 * d).reshape(4, n).T)
    steps = steps.view(np.uint32).ravel().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    sums = np.cumsum(steps)
    places = sums - np.repeat(sums[first] - steps[first], counts)
    return hashes, ids, rows, counts, places


def _home(keys: np.ndarray, partitions: int) -> np.ndarray:
    """The partition in which a document meets its places."""
    return (mixed(keys.astype(np.uint64)) % np.uint64(partitions)).astype(np.int32)


def _subtree(partitions: int):
    """Places (by document) of windows that stand in a document with a smaller id too,
    packed for the partition that gathers what its documents get."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            held += [_open(blob) for blob in batch.column(1).to_pylist()]
        if not held:
            return
        hashes, ids, rows, counts, places = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        doc = np.repeat(np.arange(len(ids), dtype=np.int64), counts)
        order = np.argsort(hashes)
        ordered = hashes[order]
        node = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        own = ids[doc[order]]
        smallest = np.repeat(np.minimum.reduceat(own, node), np.diff([*node, len(own)]))
        hit = np.sort(order[own > smallest])
        target = _home(ids, partitions).astype(np.int64)[doc[hit]]
        hit = hit[np.argsort(target, kind="stable")]
        target = np.sort(target)
        packer = zstandard.ZstdCompressor(level=1)
        cuts = (np.flatnonzero(np.diff(target)) + 1).tolist()
        for x, y in zip([0, *cuts], [*cuts, len(hit)], strict=True):
            if x == y:
                continue
            docs, n = np.unique(doc[hit[x:y]], return_counts=True)
            planes = places[hit[x:y]].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
            arrays = [ids[docs], rows[docs], n.astype(np.uint32)]
            blob = packer.compress(b"".join(v.tobytes() for v in arrays) + planes)
            head = np.array([len(docs), y - x], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(target[x])], pa.int32()), pa.array([head + blob], pa.binary())],
                names=["part", "blob"],
            )

    return cut


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with all its places."""
    keys, counts, places = [], [], []
    for batch in batches:
        for blob in batch.column(1).to_pylist():
            d, n = np.frombuffer(blob, np.int64, 2)
            rest = zstandard.ZstdDecompressor().decompress(blob[16:])
            keys.append(np.frombuffer(rest, np.int64, 2 * d).reshape(2, d))
            counts.append(np.frombuffer(rest, np.uint32, d, 16 * d))
            planes = np.frombuffer(rest, np.uint8, 4 * n, 20 * d).reshape(4, n)
            places.append(np.ascontiguousarray(planes.T).view(np.uint32).ravel())
    if not keys:
        return
    key = np.concatenate(keys, axis=1)
    first = np.repeat(np.arange(key.shape[1]), np.concatenate(counts))
    order = np.lexsort((key[1], key[0]))
    fresh = np.concatenate([[True], (np.diff(key[:, order]) != 0).any(axis=0)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    at = np.argsort(rank[first], kind="stable")
    found = np.concatenate(places)[at]
    ends = np.cumsum(np.bincount(rank[first], minlength=int(fresh.sum())))
    docs = order[fresh]
    for lo in range(0, len(docs), 5_000):
        own = range(lo, min(lo + 5_000, len(docs)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[0][docs[own.start : own.stop]]),
                pa.array(key[1][docs[own.start : own.stop]]),
                pa.array([found[(ends[k - 1] if k else 0) : ends[k]].tobytes() for k in own], pa.binary()),
            ],
            names=[_ID, _ROW, _PLACES],
        )


def _packed_rows(partitions: int):
    """Rows (partition, blob): the rows of documents that go to a partition."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, rows = batch.column(_ID), batch.column(_ROW)
            # Documents without an id have no places to meet.
            target = _home(pc.coalesce(ids, rows).to_numpy(zero_copy_only=False), partitions)
            order = np.argsort(target, kind="stable")
            target, dealt = target[order], batch.take(pa.array(order))
            cuts = (np.flatnonzero(np.diff(target)) + 1).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(target)], strict=True):
                if x == y:
                    continue
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as stream:
                    stream.write_batch(dealt.slice(x, y - x))
                blob = packer.compress(sink.getvalue())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target[x]], pa.int32()), pa.array([blob], pa.binary())], names=["part", "blob"]
                )

    return deal


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Rows of documents, some ``FLUSH_BYTES`` at a time, and the places of each."""
    packed: list[bytes] = []
    places: dict[tuple[int, int], bytes] = {}
    held, size = [], 0

    def joined() -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
        for own in pa.Table.from_batches(held).combine_chunks().to_batches():
            keys = zip(own.column(_ID).to_pylist(), own.column(_ROW).to_pylist(), strict=True)
            yield own, [places.get(key) for key in keys]

    for batch in batches:
        for kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if kind == _OF_PLACES:
                packed.append(blob)
                continue
            if packed:
                blobs = pa.array(packed, pa.binary())
                found = _gathered(iter([pa.RecordBatch.from_arrays([blobs, blobs], names=["part", "blob"])]))
                for some in found:
                    places.update(zip(zip(*(c.to_pylist() for c in some.columns[:2]), strict=True), some[2].to_pylist(), strict=True))
                packed = []
            held += pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob))
            size += held[-1].nbytes
            if size >= FLUSH_BYTES:
                yield from joined()
                held, size = [], 0
    if held:
        yield from joined()


def _cutter(columns: list[str], text: str, splits: Splits, hot: np.ndarray, first: np.ndarray, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, back in _with_places(batches):
            texts = texts_of(batch.column(text))
            ids = batch.column(_ID).to_pylist()
            for lo, hi in slices(texts):
                words = words_in(texts, lo, hi)
                hashes, at = words.windows(WINDOW)
                n = len(words.hashes)
                covered = np.zeros(n + 1, np.int32)
                marks = []
                hit = np.flatnonzero(_member(hashes, hot))
                if len(hit):
                    docs = np.searchsorted(words.first, at[hit], "right") - 1
                    own = np.array([np.iinfo(np.int64).min if x is None else x for x in ids[lo:hi]], np.int64)
                    later = own[docs] > first[np.searchsorted(hot, hashes[hit])]
                    marks.append(at[hit][later])
                for d, places in enumerate(back[lo:hi]):
                    if places:
                        marks.append(_all_like(words, hashes, at, d, np.frombuffer(places, np.uint32)))
                if marks:
                    at = np.unique(np.concatenate(marks)).astype(np.int64)
                    covered += np.bincount(at, minlength=n + 1).astype(np.int32)
                    covered -= np.bincount(np.minimum(at + WINDOW, n), minlength=n + 1).astype(np.int32)
                gone = np.cumsum(covered)[:n] > 0
                yield _cut_rows(batch.slice(lo, hi - lo).select(columns), words, gone, with_text)

    return cut


def _cut_rows(own: pa.RecordBatch, words: Words, gone: np.ndarray, with_text: bool) -> pa.RecordBatch:
    data, removed, sums, texts = words.data.tobytes(), [], [], []
    for d in range(len(own)):
        a, b = int(words.first[d]), int(words.first[d + 1])
        out = gone[a:b]
        removed.append(int(out.sum()))
        starts, ends = words.starts[a:b], words.ends[a:b]
        text = data[words.offsets[d] : words.offsets[d + 1]]
        if not removed[-1]:
            sums.append(hashlib.sha256(b" ".join(text.split()) if a < b else b"").hexdigest())
            texts.append(text)
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], out, [True]]).astype(np.int8)))
        base, pieces, kept = int(words.offsets[d]), [], []
        for x, y in zip(edges[::2], edges[1::2], strict=True):
            # Words x to y - 1 stay; a piece takes what stands behind it along.
            until = starts[y] if y < b - a else words.offsets[d + 1]
            pieces.append(data[starts[x] if x or a == b else base : until])
            kept.append(b" ".join(data[starts[x] : ends[y - 1]].split()))
        sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        texts.append(b"".join(pieces))
    extra = [pa.array(np.diff(words.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(sums, pa.string())]
    names = [*own.schema.names, "__s_n_words", "__s_n_removed", "__s_sha256"]
    if with_text:
        extra.append(pa.array([t.decode() for t in texts], pa.string()))
        names.append("__s_kept")
    return pa.RecordBatch.from_arrays([*own.columns, *extra], names=names)


def cut_repeats(docs: DataFrame, doc_id: str, text: str, keep: list[str], with_text: bool) -> DataFrame:
    """Columns ``keep``, then ``__s_n_words, __s_n_removed, __s_sha256`` of the kept words joined
    by one space, and with ``with_text`` the kept text as it was spaced, ``__s_kept``."""
    value: Column = F.col(f"`{text}`")
    tagged = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{doc_id}`").cast("bigint").alias(_ID),
        value.alias(_TEXT),
        F.xxhash64(value).alias(_ROW),
    )
    named = tagged.where(F.col(_ID).isNotNull()).select(_ID, _TEXT, _ROW)
    splits = _splits(named)
    hot = np.empty(0, np.uint64)
    first = np.empty(0, np.int64)
    if len(splits.hot):
        rows = (
            named.select(_ID, _TEXT).mapInArrow(_hot_firsts(splits), "h bigint, first bigint")
            .groupBy("h").agg(F.min("first").alias("first")).collect()  # HOT_WINDOWS rows at most
        )
        pairs = sorted((h % (1 << 64), d) for h, d in rows)
        hot = np.array([h for h, _ in pairs], np.uint64)
        first = np.array([d for _, d in pairs], np.int64)
    dealt = named.mapInArrow(_dealer(splits), "part int, blob binary")
    placed = dealt.repartitionById(splits.partitions, F.col("part")).mapInArrow(
        _subtree(splits.partitions), "part int, blob binary"
    )
    # A text that stands in a column to keep goes along once.
    carried = tagged.drop(_TEXT) if text in keep else tagged
    packed = carried.mapInArrow(_packed_rows(splits.partitions), "part int, blob binary")
    met = placed.select("part", F.lit(_OF_PLACES).alias("kind"), "blob").unionAll(
        packed.select("part", F.lit(_OF_ROWS).alias("kind"), "blob")
    )
    met = met.repartitionById(splits.partitions, F.col("part")).sortWithinPartitions("kind").select("kind", "blob")
    fields = [T.StructField(docs.schema[c].name, docs.schema[c].dataType) for c in keep] + [
        T.StructField("__s_n_words", T.LongType()),
        T.StructField("__s_n_removed", T.LongType()),
        T.StructField("__s_sha256", T.StringType()),
        *[T.StructField("__s_kept", T.StringType())] * with_text,
    ]
    own = text if text in keep else _TEXT
    return met.mapInArrow(_cutter(keep, own, splits, hot, first, with_text), T.StructType(fields))


def substring_report(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    cut = cut_repeats(docs, doc_id, text, [doc_id], False)
    return cut.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col("__s_n_words").alias("n_words"),
        F.col("__s_n_removed").alias("n_removed"),
        F.col("__s_sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The documents with repeats cut from their texts, and the columns they came with."""
    rows, names, back = neutral(docs)
    cut = cut_repeats(rows, names[doc_id], names[text], rows.columns, True)
    return back(cut.withColumn(names[text], F.when(F.col(names[text]).isNotNull(), F.col("__s_kept"))))
