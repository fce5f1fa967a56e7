"""A Merkle manifest of a table: a leaf for each row, a tree for each source, a tree over those.

Every row's leaf is a digest of its fields. The leaves of a source, in order of the row's id,
are reduced three at a time to the source's root, and these roots, in order of the source, likewise to the
root of the table. A row's proof is what stands beside its path in every run of three; with
it the root can be folded anew from the row alone.

Leaves get their place by a range partitioning on (source, id, leaf) and a running sum over each
partition, so no task sees a whole source. Then trees are worked on by superblock: 3**8
consecutive nodes. Going up, a superblock gives its own root, and these roots are the nodes of the
next round, until every tree has one. Going down, the nodes of a round are cogrouped by superblock
with the outer nodes above it, what stands beside the path from its root to the table's: the group reduces its
nodes again, joins the proofs and, for rows, folds them. A group holds one superblock at most.

Defined cases: a NULL field is ``-`` in the leaf, and NULL sources are one source, the first. Ids
ascend with NULL first; rows equal in source and id are ordered by leaf. Equal rows are collapsed
to a count before they are shuffled, and get places of their own. A source of one row has that row's
leaf as its root. An empty table gives no rows. Only the named columns are read, so other
columns' names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import saved

ARITY = 3
#: Levels that one group reduces, and so the nodes it holds at most.
LEVELS = 8
BLOCK = ARITY**LEVELS

#: In a proof, the node itself among its siblings, and the border between levels.
SELF, NEXT = "*", "/"

NODES = "tree string, pos bigint, digest string"
PATHS = f"{NODES}, path string, subroot string, root string"
PROOFS = "doc_id string, source string, leaf string, proof string, subroot string, root string, folded_root string"


def leaf_of(columns: Sequence[Column]) -> Column:
    """Digest of a row: each field as its bytes' count, a colon and itself, or ``-``."""
    fields = []
    for column in columns:
        value = column.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def _h(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def reduced(digests: list[str], block: int) -> list[list[str]]:
    """Levels of a superblock, its nodes first. Only a tree's sole superblock may end early."""
    levels = [digests]
    sole = block == 0 and len(digests) < BLOCK
    while len(levels[-1]) > 1 if sole else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([_h("".join(below[k : k + ARITY])) for k in range(0, len(below), ARITY)])
    return levels


def paths_in(levels: list[list[str]]) -> list[str]:
    """What stands beside each node's way to the superblock's root, level by level."""
    above = [""]
    for level in reversed(levels[:-1]):
        here = []
        for k in range(len(level)):
            first = k - k % ARITY
            run = level[first : first + ARITY]
            run[k - first] = SELF
            up = above[k // ARITY]
            here.append("".join(run) + (NEXT + up if up else ""))
        above = here
    return above


def folded(leaf: str, path: str) -> str:
    """The root that a leaf and what stands beside its path give."""
    for level in path.split(NEXT) if path else ():
        leaf = _h(level.replace(SELF, leaf))
    return leaf


def _joined(inner: str, outer: str) -> str:
    return NEXT.join(part for part in (inner, outer) if part)


def placed(rows: DataFrame, order: list[str], copies: str) -> DataFrame:
    """Add ``start``: the rows before it in its ``tree``, by ``order``, each counted ``copies`` times.

    ``rows`` has a column ``tree`` without NULLs and no two rows equal in tree and order.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tree = batch.column("tree")
            many = batch.column(copies).to_numpy()
            before = np.cumsum(many) - many
            first = np.ones(len(tree), bool)
            first[1:] = tree[1:].to_numpy(zero_copy_only=False) != tree[:-1].to_numpy(zero_copy_only=False)
            first[0] = tree[0].as_py() != last
            carried = 0 if first[0] else done
            starts = np.flatnonzero(first)
            base = np.zeros(len(tree), np.int64)
            base[starts] = np.diff(np.concatenate([[0], before[starts]]))
            before = before - np.cumsum(base)
            before[: starts[0] if len(starts) else len(tree)] += carried
            last, done = tree[-1].as_py(), int(before[-1] + many[-1])
            yield batch.append_column("start", pa.array(before, pa.int64()))

    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = ranged.withColumn("range", F.spark_partition_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema)
    table = saved(ranged.mapInArrow(numbered, f"{fields}, start bigint"), "places")
    # Ranges are in order, so a range's first tree alone may have begun before: a row a range at most.
    sums = table.groupBy("tree", "range").agg(F.sum(copies).alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("range")) - F.col("n")
    offsets = saved(sums.select("tree", "range", before.alias("offset")).where("offset > 0"), "offsets")
    moved = table.join(F.broadcast(offsets), ["tree", "range"], "left")
    return moved.withColumn("start", F.col("start") + F.coalesce("offset", F.lit(0))).drop("offset", "range")


def _grouped(nodes: DataFrame):
    return nodes.groupBy("tree", F.expr(f"pos DIV {BLOCK}").alias("block"))


def _up(nodes: DataFrame) -> DataFrame:
    """The roots of superblocks, as nodes of the next round."""

    def roots(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, block = key
        levels = reduced(group.sort_values("pos")["digest"].tolist(), block)
        return pd.DataFrame({"tree": [tree], "pos": [block], "digest": levels[-1]})

    return saved(_grouped(nodes.select("tree", "pos", "digest")).applyInPandas(roots, NODES), "nodes")


def _down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Paths of a round's nodes; ``outer`` has those of their superblocks' roots."""

    def join(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        inner = paths_in(reduced(group["digest"].tolist(), key[1]))
        up = above.iloc[0]
        return pd.DataFrame(
            {
                "tree": group["tree"], "pos": group["pos"], "digest": group["digest"],
                "path": [_joined(path, up["path"]) for path in inner],
                "subroot": up["subroot"], "root": up["root"],
            }
        )

    found = _grouped(nodes).cogroup(outer.groupBy("tree", F.col("pos").alias("block")))
    return saved(found.applyInPandas(join, PATHS), "paths")


def _rounds(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """The nodes of each round, the last with one node a tree."""
    rounds = [nodes]
    while largest > 1 or len(rounds) == 1:
        rounds.append(_up(rounds[-1]))
        largest = -(-largest // BLOCK)
    return rounds


def manifest(
    docs: DataFrame, doc_id: str, source: str, columns: Sequence[str], now: dict[str, Column] | None = None
) -> DataFrame:
    """``(doc_id, source, leaf, proof, subroot, root, folded_root)``, a row for each row of ``docs``.

    ``now`` gives columns as they are found at a later check, in terms of those of ``docs``;
    ``folded_root`` is folded from the row as it is then, and is the root exactly when nothing changed.
    ``proof`` holds, level by level up to the root and divided by ``/``, the run of siblings
    with ``*`` for the row's own node.
    """
    now = now or {}
    leaf = leaf_of([F.col(f"`{name}`") for name in columns])
    later = leaf_of([now.get(name, F.col(f"`{name}`")) for name in columns]) if now else leaf
    # NULL is before every source, also in UTF-8's order.
    tree = F.coalesce(F.concat(F.lit("+"), F.col(f"`{source}`").cast("string")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"), F.col(f"`{doc_id}`").alias("id"), leaf.alias("leaf"), later.alias("later")
    )
    counted = rows.groupBy("tree", "id", "leaf").agg(F.min("later").alias("later"), F.count("*").alias("copies"))
    leaves = placed(counted, ["id", "leaf"], "copies")
    # Equal rows apart again, in two steps, so that no array is longer than a superblock.
    step = lambda first, last: F.explode(F.sequence(first, last, F.lit(BLOCK).cast("bigint")))
    last = F.col("start") + F.col("copies") - 1
    leaves = leaves.withColumn("from", step(F.col("start"), last)).withColumn(
        "pos", F.explode(F.sequence("from", F.least(F.col("from") + BLOCK - 1, last)))
    )
    leaves = leaves.select("tree", "pos", "id", F.col("leaf").alias("digest"), "later")

    largest = leaves.agg(F.max("pos") + 1).first()[0] or 0
    rounds = _rounds(leaves, largest)
    subroots = placed(rounds[-1].select("tree", "digest", F.lit(1).cast("bigint").alias("one"))
                      .withColumnRenamed("tree", "of").withColumn("tree", F.lit("")), ["of"], "one")
    tops = saved(subroots.select("tree", F.col("start").alias("pos"), "digest", "of"), "subroots")
    over = _rounds(tops.select("tree", "pos", "digest"), tops.count())
    paths = over[-1].select(
        "*", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root")
    )
    for nodes in reversed(over[:-1]):
        paths = _down(nodes, paths)
    # From here on a tree is a source, and its root the only node of its last round.
    paths = tops.select("pos", F.col("of").alias("tree"), F.col("digest").alias("subroot")).join(
        paths.select("pos", "path", "root"), "pos"
    )
    paths = paths.select(
        "tree", F.lit(0).cast("bigint").alias("pos"), F.col("subroot").alias("digest"), "path", "subroot", "root"
    )
    for nodes in reversed(rounds[1:-1]):
        paths = _down(nodes, paths)
    return _proofs(leaves, paths).select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "source", "leaf", "proof", "subroot",
        "root", "folded_root",
    )


def _proofs(leaves: DataFrame, outer: DataFrame) -> DataFrame:
    """Leaves and the nodes outside their superblock: reduce, join the proofs, fold."""

    def finish(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        levels = reduced(group["digest"].tolist(), key[1])
        up = above.iloc[0]
        inner = paths_in(levels)
        # What ends in the superblock's own root goes on alike, so that way is folded once.
        kept, whole = levels[-1][0], folded(levels[-1][0], up["path"])
        ends = [folded(later, path) for later, path in zip(group["later"], inner, strict=True)]
        return pd.DataFrame(
            {
                "doc_id": group["id"], "source": group["tree"].str[1:].where(group["tree"] != "", None),
                "leaf": group["digest"], "proof": [_joined(path, up["path"]) for path in inner],
                "subroot": up["subroot"], "root": up["root"],
                "folded_root": [whole if end == kept else folded(end, up["path"]) for end in ends],
            }
        )

    rows = leaves.withColumn("id", F.col("id").cast("string"))
    found = _grouped(rows).cogroup(outer.groupBy("tree", F.col("pos").alias("block")))
    return found.applyInPandas(finish, PROOFS)
