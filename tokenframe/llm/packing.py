"""Pack documents into sequences of equal length.

A document's tokens are cut into whole sequences while that many are left; the rest is
cut into pieces of at most ``MAX_PIECE`` tokens. The pieces of some hundred sequences form a
cell. In a cell, Karmarkar-Karp multiway differencing deals them to windows: each piece
begins as a partial partition of its own; the two partitions with the largest imbalance
are merged, the fullest window of one onto the emptiest of the other, until one is left. The
windows come out nearly equal; if one exceeds the capacity, there is one window more and
the cell is dealt again.

Cells are made in the task that tokenizes, in the order of its rows, so nothing is shuffled.
A task that runs again reads the same rows and makes the same cells.

Defined cases: a NULL text is empty. Every document ends with an end token, so an empty one
has a single piece of one token. Repeated rows and NULL ids are packed row by row. An empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .words import Words, slices, texts_of, words_in

CAPACITY = 4_096
MAX_PIECE = 1_024
END_ID = 2
CELL_SEQUENCES = 256
#: Size of the table of words that a task keeps, so that a common word is encoded once in it.
KNOWN_BYTES = 32 << 20
#: Letters that normalisation only makes small, then marks: two pre-tokens at most.
PLAIN = r"\A(?P<letters>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+)(?P<marks>[.,;:!?]*)\z"


def karmarkar_karp(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal item numbers to ``windows`` lists with nearly equal sums."""
    # A partial partition: sums and items of its filled windows, fullest first.
    heap = [(-size, k, [size], [[k]]) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, s, x = heapq.heappop(heap)
        _, _, t, y = heapq.heappop(heap)
        room = max(0, windows - len(s))
        # The emptiest windows of one partition, empty ones first, meet the fullest of the other.
        sums, items = list(s), list(x)
        fresh = min(room, len(t))
        sums += t[:fresh]
        items += y[:fresh]
        for k in range(fresh, len(t)):
            at = len(s) - 1 - (k - fresh)
            sums[at] += t[k]
            items[at] = items[at] + y[k]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[k] for k in order], [items[k] for k in order]
        low = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (low - sums[0], number, sums, items))
        number += 1
    found = heap[0][3] if heap else []
    return found + [[] for _ in range(windows - len(found))]


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows that all hold; one more for as long as one is too full."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = karmarkar_karp(sizes, windows)
        if max(sum(sizes[k] for k in w) for w in found) <= capacity:
            return [w for w in found if w]
        windows += 1


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` with these starts and sizes, one behind the other."""
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    shift += np.arange(len(shift))
    return flat[shift]


@dataclass
class _Known:
    """Words met before, in the order of their hashes: spelling and ids of each."""

    hashes: np.ndarray
    letters: np.ndarray
    letter_starts: np.ndarray
    letter_sizes: np.ndarray
    ids: np.ndarray
    id_starts: np.ndarray
    id_sizes: np.ndarray

    @classmethod
    def none(cls) -> _Known:
        numbers = [np.empty(0, np.int64)] * 2
        return cls(np.empty(0, np.uint64), np.empty(0, np.uint8), *numbers, np.empty(0, np.uint32), *numbers)

    def nbytes(self) -> int:
        return sum(part.nbytes for part in vars(self).values())

    def joined(self, other: _Known) -> _Known:
        order = np.argsort(np.concatenate([self.hashes, other.hashes]), kind="stable")
        both = lambda a, b, shift=0: np.concatenate([a, b + shift])
        return _Known(
            both(self.hashes, other.hashes)[order],
            both(self.letters, other.letters),
            both(self.letter_starts, other.letter_starts, len(self.letters))[order],
            both(self.letter_sizes, other.letter_sizes)[order],
            both(self.ids, other.ids),
            both(self.id_starts, other.id_starts, len(self.ids))[order],
            both(self.id_sizes, other.id_sizes)[order],
        )


class WordTokens:
    """Ids of texts, word by word: this kind of tokenizer never joins across blanks.

    A distinct word is encoded once. Words are looked up by a hash and checked by their bytes. The words
    met so far are kept up to ``KNOWN_BYTES``, for as long as this object, so for one task.
    """

    def __init__(self, path: str) -> None:
        # A task has one core; threads of its own would take those of others.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        # For words of plain small letters, which no normalisation changes and no rule splits.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = _Known.none()

    def ids(self, texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a run of texts, and how many each text has."""
        words = words_in(texts, lo, hi)
        sizes = words.ends - words.starts
        hashes, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        if not self._alike(words.data, words.starts, sizes, words.starts[first][inverse], sizes[first][inverse]):
            return self._one_by_one(words)
        known = self.known
        at = np.minimum(np.searchsorted(known.hashes, hashes), max(0, len(known.hashes) - 1))
        there = known.hashes[at] == hashes if len(known.hashes) else np.zeros(len(hashes), bool)
        own, old = first[there], at[there]
        old_letters = _gathered(known.letters, known.letter_starts[old], known.letter_sizes[old])
        if not np.array_equal(sizes[own], known.letter_sizes[old]) or not np.array_equal(
            _gathered(words.data, words.starts[own], sizes[own]), old_letters
        ):
            return self._one_by_one(words)
        if not there.all():
            new = first[~there]
            fresh = self._learnt(hashes[~there], words.data, words.starts[new], sizes[new])
            if known.nbytes() > KNOWN_BYTES:
                # Start again with the words of these texts.
                known, fresh = _Known.none(), self._learnt(hashes, words.data, words.starts[first], sizes[first])
            self.known = known = known.joined(fresh)
            at = np.searchsorted(known.hashes, hashes)
        places = at[inverse]
        lengths = known.id_sizes[places]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        return _gathered(known.ids, known.id_starts[places], lengths), np.diff(sums[words.first])

    def _alike(self, data, starts, sizes, other_starts, other_sizes) -> bool:
        return np.array_equal(sizes, other_sizes) and np.array_equal(
            _gathered(data, starts, sizes), _gathered(data, other_starts, other_sizes)
        )

    def _one_by_one(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The same without hashes, for texts with words that share one."""
        spelt = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
        ids, sizes = self._flat(self._ids(spelt))
        sums = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(sums[words.first])

    def _learnt(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> _Known:
        letters = _gathered(data, starts, sizes)
        ends = np.cumsum(sizes)
        offsets = pa.py_buffer(np.concatenate([[0], ends]))
        spelt = pa.LargeStringArray.from_buffers(len(sizes), offsets, pa.py_buffer(letters))
        ids, lengths = self._encoded(spelt)
        return _Known(hashes, letters, ends - sizes, sizes, ids, np.cumsum(lengths) - lengths, lengths)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has. Plain words are encoded many at a time, and cut
        apart where a token ends a word; letters and the marks behind them are separate pre-tokens."""
        parts = pc.extract_regex(words, PLAIN)
        plain = parts.is_valid()
        mask = plain.to_numpy(zero_copy_only=False)
        letters = pc.utf8_lower(parts.filter(plain).field(0)).dictionary_encode()
        marks = parts.filter(plain).field(1).dictionary_encode()
        runs = letters.dictionary.to_pylist()
        runs = [" ".join(runs[k : k + 256]) for k in range(0, len(runs), 256)]
        found = self._flat(self.plain.encode_batch_fast(runs, add_special_tokens=False))[0]
        ends = np.flatnonzero(self.ends[found]) + 1
        if len(ends) != len(letters.dictionary) or len(ends) and ends[-1] != len(found):
            raise ValueError("the tokenizer does not end each word by a token of its own")
        behind, behind_sizes = self._flat(self._ids(marks.dictionary.to_pylist()))
        other, other_sizes = self._flat(self._ids(words.filter(pc.invert(plain)).to_pylist()))
        # Each word is a run of letters' ids and one of marks' ids, or one of its own.
        flat = np.concatenate([found, behind, other])
        starts, sizes = np.zeros((2, len(words), 2), np.int64)
        own = np.diff(ends, prepend=0)
        for k, coded, first, size in (
            (0, letters, ends - own, own),
            (1, marks, len(found) + np.cumsum(behind_sizes) - behind_sizes, behind_sizes),
        ):
            at = coded.indices.to_numpy(zero_copy_only=False)
            starts[mask, k], sizes[mask, k] = first[at], size[at]
        starts[~mask, 0] = len(found) + len(behind) + np.cumsum(other_sizes) - other_sizes
        sizes[~mask, 0] = other_sizes
        return _gathered(flat, starts.ravel(), sizes.ravel()), sizes.sum(axis=1)

    def _flat(self, encodings: list) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in encodings]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _ids(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def _packer(path: str, with_ids: bool):
    def pieces(ids: np.ndarray) -> Iterator[tuple[int, int]]:
        at, whole = 0, len(ids) // CAPACITY * CAPACITY
        while at < len(ids):
            step = min(CAPACITY if at < whole else MAX_PIECE, len(ids) - at)
            yield at, step
            at += step

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        sequence = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        cell: list[tuple] = []
        size = 0

        def close() -> None:
            nonlocal sequence, size
            for window in deal([p[2] for p in cell], CAPACITY):
                offset = 0
                for k in window:
                    rows.append((*cell[k][:5], sequence, offset, *cell[k][5:]))
                    offset += cell[k][2]
                sequence += 1
            cell.clear()
            size = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.binary()))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[*NAMES, *["ids"] * with_ids])

        for batch in batches:
            texts = texts_of(batch.column(1))
            keys = batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                flat, counts = tokens.ids(texts, lo, hi)
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, END_ID).astype("<u4", copy=False)
                begins = ends - counts + np.arange(hi - lo)
                for key, begin, count in zip(keys[lo:hi], begins.tolist(), counts.tolist(), strict=True):
                    ids = flat[begin : begin + count + 1]
                    for start, length in pieces(ids):
                        raw = ids[start : start + length].tobytes()
                        piece = (key, start, length, zlib.crc32(raw), len(ids), *[raw] * with_ids)
                        if length == CAPACITY:
                            rows.append((*piece[:5], sequence, 0, *piece[5:]))
                            sequence += 1
                            continue
                        cell.append(piece)
                        size += length
                        if size >= CELL_SEQUENCES * CAPACITY - MAX_PIECE:
                            close()
                    if len(rows) >= 4_096:
                        yield out()
        if cell:
            close()
        if rows:
            yield out()

    return pack


def pack_documents(
    docs: DataFrame, doc_id: str, text: str, tokenizer: str, with_ids: bool = False
) -> DataFrame:
    """One row per piece; with ``with_ids`` also its tokens, as little-endian 32-bit numbers.

    Sequences shorter than the capacity are padded to it by whoever reads them.
    """
    columns = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return columns.mapInArrow(_packer(tokenizer, with_ids), SCHEMA + ", ids binary" * with_ids)
