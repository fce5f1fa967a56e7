"""Token counts that follow edits.

A text is cut into pre-tokens, the pieces that a byte-pair encoder encodes one by one, and runs
of ``LEAF`` pre-tokens are the leaves of a segment tree: each leaf knows its characters and its
tokens, each inner node the sums of its two children. An edit replaces characters by others. Only the
leaves it touches, and one in front of them, as a pre-token may grow backwards, are cut and
encoded again; cutting goes on until a pre-token begins where an old leaf began, from where on
nothing can differ. Then the sums above are updated.

Defined cases: a NULL text is empty and has no tokens. Edits apply one after the other, each to
the text that the ones before it left; places beyond the end mean the end, and a NULL replacement is
empty. A NULL list has no edits. Rows are counted one by one, whatever their ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

LEAF = 64
CACHED_PIECES = 400_000


class Counter:
    """Tokens of pre-tokens, each encoded once in a task as long as it is common."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def count(self, pieces: list[str]) -> int:
        known = self.known
        try:
            return sum(map(known.__getitem__, pieces))
        except KeyError:
            total = 0
            for piece in pieces:
                n = known.get(piece)
                if n is None:
                    n = len(self.encoding.encode_ordinary(piece))
                    if len(known) < CACHED_PIECES and len(piece) < 64:
                        known[piece] = n
                total += n
            return total


class Tree:
    """Segment tree over the leaves of one text."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        self.leaves = self._cut(text)
        self.encoded = len(text)
        self._sum()

    def _cut(self, text: str) -> list[tuple[str, int]]:
        pieces = self.counter.pieces.findall(text)
        runs = [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)]
        return [("".join(run), self.counter.count(run)) for run in runs]

    def _sum(self) -> None:
        """Nodes 2k and 2k + 1 are the children of k; node = (characters, tokens)."""
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        self.nodes = [(0, 0)] * (2 * self.size)
        for k, (text, tokens) in enumerate(self.leaves):
            self.nodes[self.size + k] = (len(text), tokens)
        for k in range(self.size - 1, 0, -1):
            self._pull(k)

    def _pull(self, k: int) -> None:
        (a, x), (b, y) = self.nodes[2 * k], self.nodes[2 * k + 1]
        self.nodes[k] = (a + b, x + y)

    @property
    def chars(self) -> int:
        return self.nodes[1][0]

    @property
    def tokens(self) -> int:
        return self.nodes[1][1]

    def text(self) -> str:
        return "".join(leaf for leaf, _ in self.leaves)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.size:
            left = self.nodes[2 * node][0]
            if place < begin + left:
                node = 2 * node
            else:
                begin, node = begin + left, 2 * node + 1
        return node - self.size, begin

    def replace(self, start: int, stop: int, new: str) -> None:
        start = max(0, min(start, self.chars))
        stop = max(start, min(stop, self.chars))
        if not self.leaves:
            self.leaves = self._cut(new)
            self.encoded += len(new)
            self._sum()
            return
        first, begin = self.leaf_at(min(start, self.chars - 1))
        if first:
            first -= 1
            begin -= len(self.leaves[first][0])
        last, last_begin = self.leaf_at(min(stop, self.chars - 1))
        old = "".join(leaf for leaf, _ in self.leaves[first : last + 1])
        changed = old[: start - begin] + new + old[stop - begin :]
        # Old leaves behind the edit, by where they begin in the changed text.
        shift = len(new) - (stop - start)
        until, texts, joins = last + 1, [changed], {}
        at = last_begin + len(self.leaves[last][0]) + shift - begin
        pieces, place, settled = [], 0, None
        while settled is None:
            # One leaf more than what is looked at, as the last pre-token may reach into it.
            joins[at] = until
            if until < len(self.leaves):
                texts.append(self.leaves[until][0])
                at += len(self.leaves[until][0])
                until += 1
            pieces, place, settled = [], 0, None
            for match in self.counter.pieces.finditer("".join(texts)):
                if match.start() in joins:
                    settled = joins[match.start()]
                    break
                pieces.append(match[0])
            if settled is None and until >= len(self.leaves):
                settled = len(self.leaves)
        runs = [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)]
        fresh = [("".join(run), self.counter.count(run)) for run in runs]
        self.encoded += sum(len(leaf) for leaf, _ in fresh)
        same = len(fresh) == settled - first
        self.leaves[first:settled] = fresh
        if not same:
            self._sum()
            return
        touched = set()
        for k, (text, tokens) in enumerate(fresh, first):
            self.nodes[self.size + k] = (len(text), tokens)
            touched.add((self.size + k) // 2)
        while touched - {0}:
            for k in touched:
                self._pull(k)
            touched = {k // 2 for k in touched if k > 1}


def _counter(ranks_path: str, pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_path, pattern)
        for batch in batches:
            rows = []
            for text, edits in zip(batch.column(1), batch.column(2), strict=True):
                tree = Tree(text.as_py() or "", counter)
                before, encoded = tree.tokens, tree.encoded
                changes = edits.as_py() or []
                for edit in changes:
                    tree.replace(edit["start"] or 0, edit["stop"] or 0, edit["new"] or "")
                rows.append((before, len(tree.leaves), len(changes), tree.tokens, tree.chars, tree.encoded - encoded))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                names=["doc_id", "n_tokens", "n_leaves", "n_edits", "tokens_after", "chars_after", "chars_reencoded"],
            )

    return count


def count_tokens(
    docs: DataFrame, doc_id: str, text: str, edits: str | None, ranks_path: str, pattern: str
) -> DataFrame:
    """One row per document: tokens before and after its edits.

    ``edits`` names an ``array<struct<start, stop, new>>`` column, in characters; without it there are
    none. ``ranks_path`` is a file of byte-pair ranks, ``pattern`` cuts a text into pre-tokens.
    """
    kind = "array<struct<start: bigint, stop: bigint, new: string>>"
    changes = F.col(f"`{edits}`") if edits else F.lit(None)
    columns = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text}`").alias("text"),
        changes.cast(kind).alias("edits"),
    )
    return columns.mapInArrow(
        _counter(ranks_path, pattern),
        "doc_id bigint, n_tokens bigint, n_leaves bigint, n_edits bigint, tokens_after bigint, "
        "chars_after bigint, chars_reencoded bigint",
    )
