"""Score texts with a Katz backoff model of words and word pairs.

Words (A-Z in lower case) and one end per text are the tokens; the end also stands before
the first word. Every word of the training documents is a word of the model, however rare; all
others are one more word with a count of 0. Pairs seen ``CUT`` times or fewer are discounted by
Good-Turing; what that frees goes to the words that do not follow, in proportion to their own
probabilities, so that each word's followers sum to one: P(w | v) = d(r) * r / c(v) if the pair is
in the table, else alpha(v) * P(w).

Up to ``VOCABULARY`` words, the most frequent of all documents, are the head: each task has their
counts, and they travel as numbers. All other words, the tail, travel as 64-bit hashes.

1. Tokens travel, packed, to the pair table; it never travels to them. A pair is dealt by its
   second word if that is in the tail, else by its first if that is, else by both. So a partition
   meets a tail word w in all its places, and counts c(w) itself. It counts its pairs in the training
   documents and answers for every document with sums: how many of its pairs have a count of 1,
   2, …, the logarithms of larger counts, and the head words after which it must back off.
2. What stands after a tail word v goes on to the table of contexts, dealt by v. There all
   followers of v are together: its discount and weight are computed and applied, and sums go on,
   packed, to buckets of documents.
3. There discounts and weights of the head are applied to the sums of step 1; each document is one row.

Pairs of the ``DENSE`` most frequent words are counted in a dense table instead, and so is, in a list, each
other pair that stands in more than ``TOKENS_PER_TASK`` places: at most one for each partition. Of the
pairs that are dealt none stands in more; a tail word stands in at most 1 of ``VOCABULARY`` places. So no
group fills a partition alone. Pairs are told apart by 64-bit hashes.

What the driver sees is bounded: a histogram of counts, the head, the dense table of fixed size, the list
of hot pairs, and one row of backoff sums per head word. Counts cover all training documents.

Defined cases: a NULL text is empty, so only its end is scored. A NULL id is a training document.
Repeated rows are counted and scored one by one. Without training documents each probability
comes from the added halves. Columns of the input are read by the two given names only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .store import saved, tasks_for
from .words import chained, mixed, slices, texts_of, words_in

HELD_OUT_FOLDS, HELD_OUT = 5, 1
#: Words of the head, and the number that stands for any other word.
VOCABULARY = 65_535
UNKNOWN = VOCABULARY
DENSE = 512
CUT = 5
FLUSH_BYTES = 8 << 20
#: Tokens for each partition of the pair table.
TOKENS_PER_TASK = 6_000_000
END = np.uint64(0x5F3759DF5F3759DF)

_ID, _TEXT, _CRC, _TRAIN = "__k_id", "__k_text", "__k_crc", "__k_train"
#: Counts of pairs with 1, …, CUT; tail words known; logarithms of pairs, and of tail words.
_STATS = CUT + 3
_HEADS, _DOCS, _CONTEXTS, _AFTER_TAIL = 0, 1, 2, 3


class Lookup:
    """Positions of 64-bit keys by their top bits, then by comparing."""

    def __init__(self, keys: np.ndarray) -> None:
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        bits = max(1, min(22, 3 + int(len(keys)).bit_length()))
        self.shift = np.uint64(64 - bits)
        slots = np.arange((1 << bits) + 1, dtype=np.float64)
        tops = (self.keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(tops, slots[:-1]).astype(np.int32)
        self.most = int(np.bincount(tops).max()) if len(keys) else 0

    def __call__(self, values: np.ndarray) -> np.ndarray:
        """Index into the keys as given, or -1."""
        out = np.full(len(values), -1, np.int32)
        if not len(self.keys):
            return out
        at = self.first[(values >> self.shift).astype(np.int64)]
        for k in range(self.most):
            place = np.minimum(at + k, len(self.keys) - 1)
            hit = self.keys[place] == values
            out[hit] = place[hit]
        known = out >= 0
        out[known] = self.order[out[known]]
        return out


def _tokens(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words with an end after each text, and where each text begins."""
    words = words_in(texts, lo, hi, lower=True)
    hashes = np.insert(words.hashes, words.first[1:], END)
    return hashes, words.first + np.arange(hi - lo + 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of each word in the training documents, and in all."""
    for batch in batches:
        texts = texts_of(batch.column(0))
        if not len(texts):
            continue
        train = batch.column(1).to_numpy(zero_copy_only=False)
        held = []
        for lo, hi in slices(texts):
            hashes, first = _tokens(texts, lo, hi)
            values, at = np.unique(hashes, return_inverse=True)
            own = np.bincount(at[np.repeat(train[lo:hi], np.diff(first))], minlength=len(values))
            held.append((values, own, np.bincount(at, minlength=len(values))))
        hashes, own, every = (np.concatenate(x) for x in zip(*held, strict=True))
        values, at = np.unique(hashes, return_inverse=True)
        own = np.bincount(at, own, len(values)).astype(np.int64)
        every = np.bincount(at, every, len(values)).astype(np.int64)
        for k in range(0, len(values), 1 << 18):
            some = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values[some].view(np.int64)), pa.array(own[some]), pa.array(every[some])],
                names=["h", "n", "every"],
            )


@dataclass
class Unigrams:
    """The head, most frequent first, and totals over all words; ``places`` counts all documents."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    distinct: int
    places: int = 0
    #: Of the places, those of words outside the head.
    tail: int = 0
    #: So many words have the dense table; so many stand in more than ``TOKENS_PER_TASK`` places.
    dense: int = DENSE
    frequent: int = 0
    #: Codes of the hot pairs, ascending, and their counts.
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    hot_counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def __post_init__(self) -> None:
        size = len(self.hashes)
        self.context = np.zeros(UNKNOWN + 1)
        self.context[:size] = self.counts
        #: Of each word, what its probability is in proportion to.
        self.mass = self.context + 0.5
        self.down = self.total + 0.5 * (self.distinct + 1)
        self.log_p = np.log10(self.mass / self.down)

    def ids(self, lookup: Lookup, hashes: np.ndarray) -> np.ndarray:
        at = lookup(hashes)
        return np.where(at >= 0, at, UNKNOWN).astype(np.uint32)

    def in_dense(self, prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
        return (cur < self.dense) & (prev < self.dense)

    def hot_at(self, prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
        """Place of each pair among the hot ones, or -1."""
        if not len(self.hot):
            return np.full(len(cur), -1)
        codes = _codes(prev, cur)
        at = np.minimum(np.searchsorted(self.hot, codes), len(self.hot) - 1)
        return np.where(self.hot[at] == codes, at, -1)


def _codes(prev: np.ndarray, cur: np.ndarray) -> np.ndarray:
    return (prev.astype(np.int64) << 16) | cur.astype(np.int64)


def _histories(ids: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[first[:-1]] = end
    return before


def _dense_counter(words: Unigrams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(words.hashes)
        end = int(lookup(np.array([END]))[0]) % (UNKNOWN + 1)
        table = np.zeros(words.dense**2, np.int64)
        for batch in batches:
            texts = texts_of(batch.column(0))
            for lo, hi in slices(texts):
                hashes, first = _tokens(texts, lo, hi)
                cur = words.ids(lookup, hashes)
                prev = _histories(cur, first, end)
                both = words.in_dense(prev, cur)
                table += np.bincount(prev[both].astype(np.int64) * words.dense + cur[both], minlength=len(table))
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["pair", "n"])

    return count


def _frequent_counter(words: Unigrams):
    """Places of pairs of frequent words outside the dense table, in the training documents and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(words.hashes)
        end = int(lookup(np.array([END]))[0]) % (UNKNOWN + 1)
        for batch in batches:
            texts = texts_of(batch.column(0))
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in slices(texts):
                hashes, first = _tokens(texts, lo, hi)
                cur = words.ids(lookup, hashes)
                prev = _histories(cur, first, end)
                wanted = (cur < words.frequent) & (prev < words.frequent) & ~words.in_dense(prev, cur)
                pairs, at = np.unique(_codes(prev[wanted], cur[wanted]), return_inverse=True)
                own = np.bincount(at[np.repeat(train[lo:hi], np.diff(first))[wanted]], minlength=len(pairs))
                every = np.bincount(at, minlength=len(pairs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs), pa.array(own), pa.array(every)], names=["pair", "n", "every"]
                )

    return count


def _with_hot_pairs(rows: DataFrame, words: Unigrams) -> Unigrams:
    """Find the pairs that stand in more than ``TOKENS_PER_TASK`` places of ``rows`` (text, train).

    Both words of such a pair do so too. There is at most one such pair for each partition.
    """
    if words.frequent <= words.dense:
        return words
    counts = rows.mapInArrow(_frequent_counter(words), "pair bigint, n bigint, every bigint").groupBy("pair")
    hot = counts.agg(F.sum("n").alias("n"), F.sum("every").alias("every")).where(F.col("every") > TOKENS_PER_TASK)
    hot = hot.orderBy("pair").toArrow()
    return replace(words, hot=hot["pair"].to_numpy(), hot_counts=hot["n"].to_numpy())


def _dealer(words: Unigrams, partitions: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(words.hashes)
        end = int(lookup(np.array([END]))[0]) % (UNKNOWN + 1)
        for batch in batches:
            texts = texts_of(batch.column(1))
            keys = np.stack(
                [
                    batch.column(0).fill_null(0).to_numpy(zero_copy_only=False),
                    batch.column(2).to_numpy(zero_copy_only=False),
                    batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
                    + 2 * np.asarray(batch.column(0).is_null()).astype(np.int64),
                ],
                axis=1,
            )
            held, size = [], 0
            for lo, hi in slices(texts):
                hashes, first = _tokens(texts, lo, hi)
                cur = words.ids(lookup, hashes)
                prev = _histories(cur, first, end)
                doc = np.repeat(np.arange(lo, hi, dtype=np.uint64), np.diff(first))
                cold = ~words.in_dense(prev, cur) & (words.hot_at(prev, cur) < 0)
                before = _histories(hashes, first, END)
                held.append((prev[cold], cur[cold], before[cold], hashes[cold], doc[cold]))
                size += len(hashes) * 6
                if size >= FLUSH_BYTES:
                    yield from _blobs(held, keys, partitions)
                    held, size = [], 0
            if held:
                yield from _blobs(held, keys, partitions)

    return deal


def _blobs(held: list, keys: np.ndarray, partitions: int) -> Iterator[pa.RecordBatch]:
    prev, cur, before, word, doc = (np.concatenate(x) for x in zip(*held, strict=True))
    if not len(prev):
        return
    rare = cur == UNKNOWN, prev == UNKNOWN
    deal = np.where(rare[0], word, np.where(rare[1], before, mixed((prev.astype(np.uint64) << np.uint64(16)) | cur)))
    part = (mixed(deal) % np.uint64(partitions)).astype(np.uint16 if partitions < 65_536 else np.uint32)
    order = np.argsort(part, kind="stable")
    part, doc = part[order], doc[order].astype(np.int64)
    prev, cur, before, word = prev[order].astype(np.uint16), cur[order].astype(np.uint16), before[order], word[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    packer, blobs, parts = zstandard.ZstdCompressor(level=1), [], []
    for a, b in zip([0, *cuts], [*cuts, len(part)], strict=True):
        own, n = np.unique(doc[a:b], return_counts=True)
        planes = [_planes(prev[a:b]), _planes(cur[a:b])]
        tails = before[a:b][prev[a:b] == UNKNOWN].tobytes() + word[a:b][cur[a:b] == UNKNOWN].tobytes()
        rest = packer.compress(b"".join([keys[own].T.tobytes(), n.astype(np.uint32).tobytes(), *planes]))
        blobs.append(np.array([b - a, len(own), len(rest)], np.int64).tobytes() + rest + tails)
        parts.append(int(part[a]))
    yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])


def _planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second bytes, …; zeros stand together."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: type, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8, size * n, at).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _open(blob: bytes) -> tuple[np.ndarray, ...]:
    """Numbers of both words of each pair, hashes of those in the tail, documents and their runs."""
    n, d, size = np.frombuffer(blob, np.int64, 3).tolist()
    rest = zstandard.ZstdDecompressor().decompress(blob[24 : 24 + size])
    keys = np.frombuffer(rest, np.int64, 3 * d).reshape(3, d).T
    counts = np.frombuffer(rest, np.uint32, d, 24 * d)
    prev, cur = (_from_planes(rest, np.uint16, n, 28 * d + k) for k in (0, 2 * n))
    tails = np.frombuffer(blob, np.uint64, offset=24 + size) if len(blob) > 24 + size else np.empty(0, np.uint64)
    cut = int((prev == UNKNOWN).sum())
    return prev, cur, tails[:cut], tails[cut:], keys, counts


def _answerer(words: Unigrams, partitions: int, contexts: int):
    """For one partition of the pair table: backoff sums of the head, sums for documents, and what
    stands after tail words."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_open(blob) for batch in batches for blob in batch.column(1).to_pylist()]
        if not held:
            return
        prev, cur, before, word, keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        # Documents that fall together: a document may have come in several runs.
        unique, row = np.unique(keys, axis=0, return_inverse=True)
        doc = np.repeat(row.ravel().astype(np.int32), counts)
        train = (unique[:, 2] & 1).astype(bool)[doc]
        after_rare, rare = np.flatnonzero(prev == UNKNOWN), np.flatnonzero(cur == UNKNOWN)
        v, w = prev.astype(np.uint64), cur.astype(np.uint64)
        v[after_rare], w[rare] = before, word
        _, first, place = np.unique(chained([v, w]), return_index=True, return_inverse=True)
        seen = np.bincount(place[train], minlength=len(first))
        r = seen[place]
        del place, w
        mass = words.mass[cur]
        _, same = np.unique(word, return_inverse=True)
        of_word = np.bincount(same[train[rare]], minlength=int(same.max()) + 1 if len(same) else 0)[same]
        mass[rare] += of_word

        met = first[seen > 0]
        yield _blob_row(_HEADS, 0, list(_backoff_sums(prev[met].astype(np.int64), r[met], mass[met])))

        sums = lambda at, x=None: np.bincount(doc[at], x, len(unique))
        stats = np.zeros((len(unique), _STATS))
        for k in range(1, CUT + 1):
            stats[:, k - 1] = sums(r == k)
        big, none = r > CUT, r == 0
        stats[:, CUT] = sums(rare, of_word > 0)
        stats[:, CUT + 1] = sums(big, np.log10(r[big])) + sums(none, np.log10(mass[none] / words.down))
        stats[:, CUT + 2] = sums(rare, np.log10(of_word + 0.5))
        back = np.flatnonzero(none & (prev != UNKNOWN))
        back = back[np.argsort(doc[back], kind="stable")]
        n_after = np.bincount(doc[back], minlength=len(unique))
        begins = np.concatenate([[0], np.cumsum(n_after)])
        bucket = _bucket_of(unique, partitions)
        for b in np.unique(bucket):
            at = np.flatnonzero(bucket == b)
            words_after = prev[np.concatenate([back[begins[k] : begins[k + 1]] for k in at])]
            yield _blob_row(
                _DOCS, int(b),
                [_keys(unique[at]), stats[at, : CUT + 1].astype(np.uint32).T.ravel(), stats[at, CUT + 1 :].T.ravel(),
                 n_after[at].astype(np.uint32), words_after],
            )

        met = met[prev[met] == UNKNOWN]
        own, table = _backoff_sums(v[met], r[met], mass[met])
        table = table.reshape(-1, CUT + 3)
        bucket_of = lambda h: (mixed(h) % np.uint64(contexts)).astype(np.int64)
        target, rows_of = bucket_of(before), bucket_of(own)
        order = np.lexsort((before, target))
        target, places = target[order], after_rare[order]
        cuts = np.flatnonzero(np.diff(target)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(target)], strict=True):
            if a == z:
                continue
            at = places[a:z]
            values, n = np.unique(v[at], return_counts=True)
            docs, local = np.unique(doc[at], return_inverse=True)
            rows = np.zeros((len(values), CUT + 3))
            here = rows_of == target[a]
            rows[np.searchsorted(values, own[here])] = table[here]
            yield _blob_row(
                _CONTEXTS, int(target[a]),
                [values, n.astype(np.uint32), rows.ravel(), _keys(unique[docs]), local.astype(np.uint32), none[at]],
            )

    return answer


def _bucket_of(keys: np.ndarray, partitions: int) -> np.ndarray:
    return (mixed(keys[:, 0].astype(np.uint64)) % np.uint64(partitions)).astype(np.int64)


def _keys(keys: np.ndarray) -> np.ndarray:
    """Sorted keys of documents, column by column; ids as steps, which are small."""
    return np.concatenate([np.diff(keys[:, 0], prepend=np.int64(0)), keys[:, 1], keys[:, 2]])


def _from_keys(flat: np.ndarray) -> np.ndarray:
    keys = flat.reshape(3, -1).T.copy()
    keys[:, 0] = np.cumsum(keys[:, 0])
    return keys


def _blob_row(kind: int, bucket: int, arrays: list[np.ndarray]) -> pa.RecordBatch:
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(map(_planes, arrays)))
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([head + body], pa.binary())],
        names=["kind", "bucket", "blob"],
    )


def _arrays(blob: bytes, kinds: list[type]) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(kinds))
    body = zstandard.ZstdDecompressor().decompress(blob[8 * len(kinds) :])
    out, at = [], 0
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(_from_planes(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _backoff_sums(prev: np.ndarray, r: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word: followers with 1, …, CUT + 1; sum of larger counts; sum of their masses."""
    own, at = np.unique(prev, return_inverse=True)
    table = np.zeros((len(own), CUT + 3))
    for k in range(1, CUT + 2):
        table[:, k - 1] = np.bincount(at[r == k], minlength=len(own))
    table[:, CUT + 1] = np.bincount(at, np.where(r > CUT, r, 0), len(own))
    table[:, CUT + 2] = np.bincount(at, mass, len(own))
    return own, table.ravel()


_SUMS = [f"s{k}" for k in range(CUT + 3)]


def _backoff_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            own, table = _arrays(blob, [np.int64, np.float64])
            table = table.reshape(-1, CUT + 3)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own), *[pa.array(table[:, k]) for k in range(CUT + 3)]], names=["prev", *_SUMS]
            )


def _weights(
    sums: np.ndarray, context: np.ndarray, discount: np.ndarray, down: float
) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of what counts are divided by, and of the backoff weight."""
    kept = sums[:, :CUT] @ (discount * np.arange(1, CUT + 1)) + sums[:, CUT + 1]
    # Where nothing is freed, one count is set aside, so that no follower is impossible.
    tight = context - kept < 1e-9 * np.maximum(context, 1)
    whole = np.maximum(context + tight, 1)
    free = np.where(context > 0, 1 - kept / whole, 1.0)
    left = np.maximum(1 - sums[:, CUT + 2] / down, 1e-12)
    return np.log10(whole), np.log10(np.maximum(free, 1e-300) / left)


class Model:
    """Discounts of all pairs, counts of those that are not dealt, and backoff weights of the head.

    In ``sums``, the row of ``UNKNOWN`` adds up all tail words: it is there for the discounts only.
    """

    def __init__(self, words: Unigrams, dense: np.ndarray, sums: np.ndarray) -> None:
        self.words, self.dense = words, dense
        prev, cur = np.divmod(np.flatnonzero(dense), words.dense)
        met = words.hot_counts > 0
        counts = np.concatenate([dense[prev * words.dense + cur], words.hot_counts[met]])
        prev = np.concatenate([prev, words.hot[met] >> 16])
        cur = np.concatenate([cur, words.hot[met] & 0xFFFF])
        own, table = _backoff_sums(prev, counts, words.mass[cur])
        sums = sums.copy()
        sums[own] += table.reshape(-1, CUT + 3)
        self.discount = good_turing(sums[:, : CUT + 1].sum(axis=0))
        sums[UNKNOWN] = 0
        self.log_down, self.log_alpha = _weights(sums, words.context, self.discount, words.down)
        self.log_kept = np.log10(self.discount * np.arange(1, CUT + 1))

    def known(self, prev: np.ndarray, cur: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are dense or hot, and the counts of these."""
        dense, at = self.words.in_dense(prev, cur), self.words.hot_at(prev, cur)
        r = np.zeros(len(cur), np.int64)
        r[dense] = self.dense[prev[dense].astype(np.int64) * self.words.dense + cur[dense]]
        r[at >= 0] = self.words.hot_counts[at[at >= 0]]
        both = dense | (at >= 0)
        return both, r[both]

    def seen_logs(self, r: np.ndarray) -> np.ndarray:
        return np.where(r <= CUT, self.log_kept[np.clip(r, 1, CUT) - 1], np.log10(np.maximum(r, 1)))


def good_turing(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, …, CUT from the numbers of pairs with counts 1, …, CUT + 1.

    Where the numbers are too thin for the formula, half a count is taken off.
    """
    r = np.arange(1, CUT + 1)
    half = (r - 0.5) / r
    if (n <= 0).any():
        return half
    common = (CUT + 1) * n[CUT] / n[0]
    d = ((r + 1) * n[1:] / n[:-1] / r - common) / (1 - common) if common < 1 else half
    return np.where((d > 0) & (d < 1), d, half)


def _by_document(keys: list, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and for each the sums of its values."""
    unique, row = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
    return unique, np.stack([np.bincount(row.ravel(), x, len(unique)) for x in np.concatenate(values).T], axis=1)


_PARTS = ["cold", "rare_known", "rare_base"]


def _doc_sums(model: Model):
    """A row for each document of a partition: all that the other tables answered, weights applied."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values = [], []
        for batch in batches:
            for kind, blob in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if kind == _AFTER_TAIL:
                    k, score = _arrays(blob, [np.int64, np.float64])
                    known = rare = np.zeros_like(score)
                else:
                    k, few, logs, n_after, after = _arrays(
                        blob, [np.int64, np.uint32, np.float64, np.uint32, np.uint16]
                    )
                    d = len(n_after)
                    few, (pairs, rare) = few.reshape(CUT + 1, d), logs.reshape(2, d)
                    known = few[CUT].astype(np.float64)
                    score = few[:CUT].T @ model.log_kept + pairs
                    doc = np.repeat(np.arange(d), n_after)
                    score += np.bincount(doc, (model.log_alpha + model.log_down)[after], d)
                keys.append(_from_keys(k))
                values.append(np.stack([score, known, rare], axis=1))
        if keys:
            unique, total = _by_document(keys, values)
            ids = pa.array(unique[:, 0], mask=unique[:, 2] >= 2)
            columns = [pa.array(np.ascontiguousarray(x)) for x in total.T]
            yield pa.RecordBatch.from_arrays([ids, pa.array(unique[:, 1]), *columns], names=[_ID, _CRC, *_PARTS])

    return sums


def _context_sums(discount: np.ndarray, down: float, partitions: int):
    """One partition of the table of contexts: what its tail words give to the documents, packed for
    each bucket of documents."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [np.uint64, np.uint32, np.float64, np.int64, np.uint32, np.bool_]
        held = [_arrays(blob, kinds) for batch in batches for blob in batch.column(1).to_pylist()]
        if not held:
            return
        own, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        rows = np.concatenate([h[2] for h in held]).reshape(-1, CUT + 3)
        table = np.stack([np.bincount(at, rows[:, k], len(own)) for k in range(CUT + 3)], axis=1)
        # Something follows a word wherever it stands.
        context = table[:, :CUT] @ np.arange(1, CUT + 1) + table[:, CUT + 1]
        log_down, log_alpha = _weights(table, context, discount, down)
        keys, values, begin = [], [], 0
        for h in held:
            word = np.repeat(at[begin : begin + len(h[0])], h[1])
            begin += len(h[0])
            given = np.where(h[5], log_alpha[word], -log_down[word])
            keys.append(_from_keys(h[3]))
            values.append(np.bincount(h[4], given, len(keys[-1]))[:, None])
        unique, total = _by_document(keys, values)
        bucket = _bucket_of(unique, partitions)
        order = np.argsort(bucket, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            yield _blob_row(_AFTER_TAIL, int(bucket[some[0]]), [_keys(unique[some]), total[some, 0]])

    return sums


def _doc_rows(model: Model):
    """What a document can tell by itself, from the head."""
    words = model.words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(words.hashes)
        log_count = np.log10(words.mass)
        end = int(lookup(np.array([END]))[0]) % (UNKNOWN + 1)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in slices(texts):
                hashes, first = _tokens(texts, lo, hi)
                cur = words.ids(lookup, hashes)
                prev = _histories(cur, first, end)
                d = hi - lo
                doc = np.repeat(np.arange(d), np.diff(first))
                # Tail words are counted where their places are together.
                logs = np.where(cur == UNKNOWN, 0.0, log_count[cur])
                own = -model.log_down[prev]
                both, r = model.known(prev, cur)
                backed = model.log_alpha[prev[both]] + words.log_p[cur[both]] + model.log_down[prev[both]]
                own[both] += np.where(r > 0, model.seen_logs(r), backed)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        batch.column(2)[lo:hi],
                        pa.array(np.diff(first)),
                        pa.array(np.bincount(doc, words.context[cur] > 0, d).astype(np.int64)),
                        pa.array(np.bincount(doc, logs, d)),
                        pa.array(np.bincount(doc, own, d)),
                    ],
                    names=[_ID, _CRC, "n", "known", "base", "own"],
                )

    return rows


def fit_and_score(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    value: Column = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.col(f"`{doc_id}`").cast("bigint")
    fold = F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % HELD_OUT_FOLDS, F.lit(0))
    rows = docs.select(
        key.alias(_ID), value.alias(_TEXT), F.crc32(F.encode(value, "UTF-8")).alias(_CRC),
        (fold != HELD_OUT).alias(_TRAIN),
    )
    training = rows.where(_TRAIN).select(_TEXT)
    counts = rows.select(_TEXT, _TRAIN).mapInArrow(_counted, "h bigint, n bigint, every bigint")
    words = _unigrams(saved(counts.groupBy("h").agg(F.sum("n").alias("n"), F.sum("every").alias("every")), "unigrams"))
    words = _with_hot_pairs(rows.select(_TEXT, _TRAIN), words)
    dense = np.zeros(words.dense**2, np.int64)
    found = (
        training.mapInArrow(_dense_counter(words), "pair bigint, n bigint").groupBy("pair")
        .agg(F.sum("n").alias("n")).toArrow()  # words.dense ** 2 rows at most
    )
    dense[found["pair"].to_numpy()] = found["n"].to_numpy()

    partitions = max(tasks_for(spark), words.places // TOKENS_PER_TASK + 1)
    contexts = max(tasks_for(spark), words.tail // TOKENS_PER_TASK + 1)
    packed = "kind int, bucket int, blob binary"
    dealt = rows.select(_ID, _TEXT, _CRC, _TRAIN).mapInArrow(_dealer(words, partitions), "part int, blob binary")
    answers = saved(
        dealt.repartitionById(partitions, F.col("part")).mapInArrow(_answerer(words, partitions, contexts), packed),
        "answers",
    )
    sums = np.zeros((UNKNOWN + 1, CUT + 3))
    table = (
        answers.where(F.col("kind") == _HEADS).select("blob")
        .mapInArrow(_backoff_rows, "prev bigint, " + ", ".join(f"{s} double" for s in _SUMS))
        .groupBy("prev").agg(*[F.sum(s).alias(s) for s in _SUMS]).toArrow()  # a row per head word, and one
    )
    sums[table["prev"].to_numpy()] = np.stack([table[s].to_numpy() for s in _SUMS], axis=1)
    model = Model(words, dense, sums)

    after_tail = (
        answers.where(F.col("kind") == _CONTEXTS).select("bucket", "blob")
        .repartitionById(contexts, F.col("bucket"))
        .mapInArrow(_context_sums(model.discount, words.down, partitions), packed)
    )
    cold = (
        answers.where(F.col("kind") == _DOCS).unionAll(after_tail)
        .repartitionById(partitions, F.col("bucket"))
        .mapInArrow(_doc_sums(model), f"{_ID} bigint, {_CRC} bigint, " + ", ".join(f"{k} double" for k in _PARTS))
    )
    own = rows.select(_ID, _TEXT, _CRC).mapInArrow(
        _doc_rows(model), f"{_ID} bigint, {_CRC} bigint, n bigint, known bigint, base double, own double"
    )
    nothing = {
        "times": "bigint", "n": "bigint", "known": "bigint", "base": "double", "own": "double", "cold": "double",
        "rare_known": "double", "rare_base": "double",
    }

    def filled(df: DataFrame) -> DataFrame:
        return df.select(
            _ID, _CRC, *[(F.col(k) if k in df.columns else F.lit(None).cast(t)).alias(k) for k, t in nothing.items()]
        )

    mine = own.withColumn("times", F.lit(1).cast("bigint"))
    together = filled(mine).unionAll(filled(cold)).groupBy(_ID, _CRC).agg(
        *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in nothing]
    )
    # Rows that are equal were added up; each gets its share.
    once = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("__k_copy")
    share = lambda name: F.col(name) / F.col("times")
    down = float(np.log10(words.down))
    whole = lambda *names: sum(map(share, names), F.lit(0)).cast("bigint")
    fold = F.coalesce(F.crc32(F.encode(F.col(_ID).cast("string"), "UTF-8")) % HELD_OUT_FOLDS, F.lit(0))
    return together.select("*", once).select(
        F.col(_ID).alias("doc_id"),
        (fold == HELD_OUT).alias("held_out"),
        whole("n").alias("n_tokens"),
        whole("known", "rare_known").alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (share("base") + share("rare_base") - share("n") * F.lit(down)).alias("base_score"),
        (share("own") + share("cold")).alias("score"),
    )


def _unigrams(counts: DataFrame) -> Unigrams:
    """Totals, and the head: all words above a count that keeps them within the bound, and the end."""
    step = F.floor(F.log2("every") * 64).cast("int")
    sums = F.sum("n"), F.sum((F.col("n") > 0).cast("bigint")), F.sum("every")
    steps = sorted(counts.groupBy(step.alias("s")).agg(F.count("*"), *sums).collect(), reverse=True)
    total, distinct, places = (sum(s[k] for s in steps) for k in (2, 3, 4))
    held, limit = 1, 1 << 20
    for s, many, *_ in steps:
        held += many
        if held > VOCABULARY:
            break
        limit = s
    end = F.col("h") == F.lit(int(END.astype(np.int64)))
    table = counts.where((step >= limit) | end).toArrow()
    hashes, n, every = table["h"].to_numpy().view(np.uint64), table["n"].to_numpy(), table["every"].to_numpy()
    order = np.lexsort((hashes, -every))
    return Unigrams(
        hashes[order], n[order], total, distinct, places, places - int(every.sum()),
        DENSE, int((every > TOKENS_PER_TASK).sum()),
    )
