"""Fill-in-the-middle samples, assembled by secondary sort.

A text is cut into units, and at two of their borders into prefix, middle and suffix. The task
that reads it emits pieces, runs of units of bounded size, keyed by document and by place in
the output. They are partitioned by document and sorted by (document, place), so the next
task sees each output as a stream and feeds it to a digest piece by piece; it never holds a
text. The same stream is read for its marks, which tells where each piece of it belongs in the text.
Sorted again by that, inside the partition and without another shuffle, the pieces stream into a
second digest: that of the text rebuilt from the output and its form.

Defined cases: a NULL text is empty, and an empty text is plain. A NULL id is the empty word in the
seed. Equal rows (id and text) are collapsed where they are read, carried as a number of copies,
and come out as that many rows. Rows with one id and different texts are documents of their own.
An empty table gives no rows. Other columns are left out, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import NOT_BLANK

#: The marks, and the order in which each form writes the three parts.
MARKS = (b"<P>", b"<S>", b"<M>")
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
ORDERS = {
    "psm": ((b"<P>", PREFIX), (b"<S>", SUFFIX), (b"<M>", MIDDLE)),
    "spm": ((b"<S>", SUFFIX), (b"<P>", PREFIX), (b"<M>", MIDDLE)),
}
HEAD = -1

#: A piece ends after so many units or so many bytes, whichever comes first.
PIECE_UNITS = 4_096
PIECE_BYTES = 1 << 15
# Bytes that a task gathers before it hands a batch on, and bytes whose blanks are found at once.
BATCH_BYTES = 4 << 20
SCAN_BYTES = 4 << 20

META = "doc_id string, n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"key binary, place bigint, copies bigint, {META}, piece binary"
PARTS = f"key binary, part int, place bigint, copies bigint, {META}, output_sha256 string, piece binary"
TEXTS = f"{META}, output string"
DIGESTS = f"{META}, output_sha256 string, restored_sha256 string"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = (field.split() for field in schema.split(", "))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


class _Batches:
    """Rows gathered into Arrow batches of bounded bytes."""

    def __init__(self, schema: str) -> None:
        self.schema = _arrow(schema)
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size + 100
        if self.bytes >= BATCH_BYTES:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.schema]
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def unit_ends(text: bytes) -> np.ndarray:
    """Byte where each unit ends: a word with the blanks before it, or blanks at the end."""
    ends, n = [], len(text)
    data = np.frombuffer(text, np.uint8)
    for lo in range(0, n, SCAN_BYTES):
        inside = NOT_BLANK[data[lo : lo + SCAN_BYTES + 1]]
        ends.append(np.flatnonzero(inside[:-1] & ~inside[1:]) + lo + 1)
    if n and (not ends[-1].size or ends[-1][-1] < n):
        ends.append(np.array([n]))
    return np.concatenate(ends) if ends else np.empty(0, np.int64)


class Plan:
    """Where a text is cut, and in which order its parts are written."""

    def __init__(self, doc_id: str, text: bytes, seed: int, rate: int, spm_rate: int) -> None:
        self.text, self.ends = text, unit_ends(text)
        self.n = len(self.ends)
        digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
        h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
        self.cuts = sorted((h[0] % (self.n + 1), h[1] % (self.n + 1)))
        if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= rate:
            self.form = "plain"
        else:
            self.form = "spm" if h[3] % 100 < spm_rate else "psm"

    def chars(self) -> tuple[int | None, int | None]:
        if self.form == "plain":
            return None, None
        a, b = (self._byte(k) for k in self.cuts)
        return len(self.text[:a].decode()), len(self.text[a:b].decode())

    def _byte(self, unit: int) -> int:
        return int(self.ends[unit - 1]) if unit else 0

    def pieces(self) -> Iterator[bytes]:
        """The output, piece by piece. A mark stands at the front of its part's first piece."""
        if self.form == "plain":
            yield from self._part(0, self.n, b"")
            return
        a, b = self.cuts
        units = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, self.n)}
        for mark, part in ORDERS[self.form]:
            yield from self._part(*units[part], mark)

    def _part(self, first: int, last: int, mark: bytes) -> Iterator[bytes]:
        if first == last:
            yield mark
        for unit in range(first, last, PIECE_UNITS):
            at, stop = self._byte(unit), self._byte(min(unit + PIECE_UNITS, last))
            for lo in range(at, stop, PIECE_BYTES):
                yield mark + self.text[lo : min(lo + PIECE_BYTES, stop)]
                mark = b""


class Restorer:
    """Reads an output as a stream and tells which part of the text each of its bytes is in."""

    def __init__(self, form: str) -> None:
        self.order = ORDERS.get(form, ())
        self.at = -1 if self.order else 0
        self.held = b""

    def _part(self) -> int:
        return self.order[self.at][1] if self.order else PREFIX

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.held + data
        self.held = b""
        while self.at + 1 < len(self.order):
            mark = self.order[self.at + 1][0]
            found = data.find(mark)
            if found < 0:
                # A mark may go on in the next piece.
                keep = len(mark) - 1
                self.held = data[-keep:]
                data = data[:-keep]
                break
            if self.at >= 0 and found:
                yield self._part(), data[:found]
            elif self.at < 0 and found:
                raise ValueError("an output of this form must begin with a mark")
            data = data[found + len(mark) :]
            self.at += 1
        if data:
            yield self._part(), data

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.held:
            yield self._part(), self.held


def fim_pieces(
    docs: DataFrame, doc_id: str, text: str, seed: int = 42, rate: int = 50, spm_rate: int = 80
) -> DataFrame:
    """Pieces of each document's output; what is known of the document stands with place 0."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(PIECES)
        for batch in batches:
            copies: dict[tuple[str | None, str | None], int] = {}
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                copies[row] = copies.get(row, 0) + 1
            for (number, value), many in copies.items():
                data = (value or "").encode()
                name = b"" if number is None else b"+" + number.encode()
                key = hashlib.blake2b(len(name).to_bytes(8) + name + data, digest_size=16).digest()
                plan = Plan(number or "", data, seed, rate, spm_rate)
                meta = (many, number, plan.n, plan.form, *plan.chars())
                for place, piece in enumerate(plan.pieces()):
                    yield from out.add((key, place, *meta, piece), len(piece))
                    meta = (None,) * len(meta)
        yield out.batch()

    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(emit, PIECES)


def _sorted(pieces: DataFrame) -> DataFrame:
    return pieces.repartition("key").sortWithinPartitions("key", "place")


def _repeated(out: _Batches, row: tuple, copies: int, size: int = 0) -> Iterator[pa.RecordBatch]:
    for _ in range(copies):
        yield from out.add(row, size)


class _Streams:
    """Documents out of a stream of sorted pieces, one at a time."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        self.rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        self.next = next(self.rows, None)

    def __iter__(self) -> Iterator[tuple[bytes, Iterator[tuple]]]:
        while self.next is not None:
            key = self.next[0]
            document = self._document(key)
            yield key, document
            for _ in document:
                pass

    def _document(self, key: bytes) -> Iterator[tuple]:
        while self.next is not None and self.next[0] == key:
            row, self.next = self.next, next(self.rows, None)
            yield row


def _output(document: Iterator[tuple]) -> Iterator[tuple[int, tuple | None, bytes]]:
    """``(copies, meta, piece)`` of one document: copies are added up over rows of place 0, which
    come first, and a place that came more than once is given once."""
    first = next(document)
    copies, last = first[2], 0
    for row in document:
        if row[1] == 0:
            copies += row[2]
            continue
        if first is not None:
            yield copies, first[3:8], first[8]
            first = None
        if row[1] != last:
            last = row[1]
            yield copies, None, row[8]
    if first is not None:
        yield copies, first[3:8], first[8]


def fim_texts(docs: DataFrame, doc_id: str, text: str, **options) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``: the samples themselves."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(TEXTS)
        for _, document in _Streams(batches):
            copies, meta, parts = 0, (), []
            for copies, found, piece in _output(document):
                meta = found or meta
                parts.append(piece)
            whole = b"".join(parts).decode()
            yield from _repeated(out, (*meta, whole), copies, len(whole))
        yield out.batch()

    return _typed(_sorted(fim_pieces(docs, doc_id, text, **options)).mapInArrow(join, TEXTS), docs, doc_id)


def fim_digests(docs: DataFrame, doc_id: str, text: str, **options) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``."""

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(PARTS)
        nothing = (None,) * 7
        for key, document in _Streams(batches):
            digest = hashlib.sha256()
            copies, meta, reader, place = 0, (), None, 0
            for copies, found, piece in _output(document):
                if reader is None:
                    meta, reader = found, Restorer(found[2])
                digest.update(piece)
                for part, data in reader.feed(piece):
                    yield from out.add((key, part, place, *nothing, data), len(data))
                    place += 1
            for part, data in reader.end():
                yield from out.add((key, part, place, *nothing, data), len(data))
            yield from out.add((key, HEAD, 0, copies, *meta, digest.hexdigest(), b""))
        yield out.batch()

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(DIGESTS)
        for _, document in _Streams(batches):
            digest = hashlib.sha256()
            head = next(document)
            for row in document:
                digest.update(row[10])
            yield from _repeated(out, (*head[4:10], digest.hexdigest()), head[3])
        yield out.batch()

    parts = _sorted(fim_pieces(docs, doc_id, text, **options)).mapInArrow(outputs, PARTS)
    again = parts.sortWithinPartitions("key", "part", "place")
    return _typed(again.mapInArrow(restored, DIGESTS), docs, doc_id)


def _typed(found: DataFrame, docs: DataFrame, doc_id: str) -> DataFrame:
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))
