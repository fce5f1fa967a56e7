"""The manifest against trees built in memory, with superblocks of every size."""

from __future__ import annotations

import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tokenframe.llm import merkle, queries

from .test_operators import docs, empty, odd, texts  # noqa: F401

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF_DIR = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root of a list of nodes, and for each its siblings by level, with its own place among them."""
    ways = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, way in enumerate(ways):
            first = at[k] - at[k] % 3
            run = nodes[first : first + 3]
            way.append((run[: at[k] - first], run[at[k] - first + 1 :]))
            at[k] //= 3
        nodes = [h(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)]
    return nodes[0], ways


def by_hand(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((first(row["doc_id"]), leaf(row, row["text"]), row))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        leaves = sorted(by_source[name], key=lambda x: x[:2])
        trees[name] = (leaves, *tree([x[1] for x in leaves]))
    root, over = tree([trees[name][1] for name in names])
    out = []
    for name, above in zip(names, over, strict=True):
        leaves, subroot, ways = trees[name]
        for (_, digest, row), way in zip(leaves, ways, strict=True):
            whole = way + above
            text, number = row["text"], row["doc_id"]
            if text is not None and number is not None and zlib.crc32(str(number).encode()) % 2 == 0:
                text = text.replace("\n", "")
            end = leaf(row, text)
            for left, right in whole:
                end = h(*left, end, *right)
            proof = h(*(d for left, right in whole for d in (*left, *right)))
            out.append((number, digest, subroot, root, proof, end, end == root))
    return out


def query(df, monkeypatch):
    monkeypatch.setattr(queries, "_table", lambda spark, sf_dir, name: df)
    rows = queries.op11_merkle_manifest(df.sparkSession, "").collect()
    return sorted(map(tuple, rows), key=repr)


def rows_of(df):
    return [row.asDict() for row in df.select(*FIELDS).collect()]


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(spark, docs, monkeypatch, levels):  # noqa: F811
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 3**levels)
    more = spark.createDataFrame(
        [(k % 11 or None, "line\nfeed" * (k % 3), None, "hot", 1) for k in range(70)]
        + [(1, "alone\n", "x", "é", 3), (2, None, "x", None, None), (3, "", None, "", 0)],
        SCHEMA,
    )
    df = docs.unionByName(more, allowMissingColumns=True)
    want = by_hand(rows_of(df))
    assert query(df, monkeypatch) == sorted(want, key=repr)
    assert {row[-1] for row in want} == {True, False}


def test_odd_tables(odd, empty, monkeypatch):  # noqa: F811
    assert query(odd, monkeypatch) == sorted(by_hand(rows_of(odd)), key=repr)
    assert query(empty, monkeypatch) == []


def test_clashing_columns(docs, monkeypatch):  # noqa: F811
    clash = docs.selectExpr("*", "1 AS tree", "2 AS pos", "3 AS leaf", "4 AS copies", "5 AS start", "6 AS id", "7 AS later")
    assert query(clash, monkeypatch) == query(docs, monkeypatch)


def test_proof_folds_to_the_root(docs):  # noqa: F811
    found = merkle.manifest(docs, "doc_id", "source", FIELDS).collect()
    assert all(merkle.folded(row.leaf, row.proof) == row.root == row.folded_root for row in found)
    assert {row.source for row in found} == {row.source for row in docs.collect()}


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    df = spark.range(400).select(
        F.lit(5).cast("bigint").alias("doc_id"), F.lit("same\n").alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(5).cast("bigint").alias("n_chars"),
    )
    assert query(df, monkeypatch) == sorted(by_hand(rows_of(df)), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_on_the_tables(spark):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = sorted(map(tuple, queries.op11_merkle_manifest(spark, SF_DIR).collect()), key=repr)
    assert got == sorted(by_hand(rows_of(df)), key=repr)
