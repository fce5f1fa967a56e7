"""The pipeline on small tables: what goes, what stays, and tables that are awkward."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tokenframe.llm import chat, queries

CLASHING = ["gone_id", "__llm_salt", "key", "band", "cid", "bucket", "kept", "pos", "c0", "c1", "found", "text_"]
BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SCHEMA = BASE + "".join(f", `{name}` string" for name in CLASHING)


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def made(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(4)
    item = made(rng, 40)
    passage = made(rng, 60)
    clean = {k: made(rng, 80) for k in range(20)}
    base = made(rng, 200)
    near = base.split()
    near[100] = "changed"
    docs = {
        **clean,
        100: base, 101: " ".join(near), 102: base,
        110: f"{made(rng, 50)} {item} {made(rng, 50)}",
        120: f"{made(rng, 40)} {passage}", 121: f"{passage} {made(rng, 40)}",
        130: "too short", 131: "again and again and again " * 30, 132: None, 133: "", 134: " \n ",
    }
    nameless = made(rng, 70)
    rows = [(k, t) for k, t in docs.items()] + [(3, clean[3]), (None, nameless), (None, None)]
    folder = tmp_path_factory.mktemp("tables")
    for name, own in (("full", rows), ("empty", [])):
        full = [(k, t, "en", f"h{(k or 0) % 3}", len(t or ""), *CLASHING) for k, t in own]
        df = spark.createDataFrame(full, SCHEMA)
        df.repartition(3).write.parquet(f"{folder}/{name}/documents.parquet")
        items = spark.createDataFrame([(1, item)] if own else [], "item_id bigint, text string")
        items.write.parquet(f"{folder}/{name}/benchmark.parquet")
    return folder, docs, clean, nameless, passage


def test_stages(spark, tables):
    folder, docs, clean, nameless, passage = tables
    sf_dir = f"{folder}/full"
    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = now.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/out/{name}"
        stage(spark, now, sf_dir).write.parquet(path)
        now = spark.read.parquet(path)
        assert now.columns == columns
        kept[name] = {row.doc_id: row.text for row in now.collect()}
        assert all(row[c] == c for row in now.collect() for c in CLASHING)
    assert not {130, 131, 132, 133, 134} & set(kept["quality_rules"])
    assert {100, 101, 102} & set(kept["quality_rules"]) and set(clean) <= set(kept["quality_rules"])
    assert {100, 101, 102} & set(kept["near_dedup"]) == {100}
    cut = kept["substring_dedup"]
    assert passage in cut[120] and words(cut[121]) == words(docs[121])[60:]
    last = kept["decontamination"]
    assert 110 not in last and 110 in cut
    # Clean documents come through all stages as they were.
    assert all(words(last[k]) == words(text) for k, text in clean.items())
    assert words(last[None]) == words(nameless)
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir).collect()
    rows = Counter(row.doc_id for row in now.collect())
    tokens = Counter()
    for row in packed:
        assert len(np.frombuffer(row.ids, np.uint32)) == row.length
        tokens[row.doc_id] += row.length
    assert set(tokens) == set(rows)
    sizes = {row.doc_id: row.doc_tokens for row in packed}
    assert all(tokens[k] == sizes[k] * n for k, n in rows.items())


def test_run(spark, tables):
    folder = tables[0]
    found = corpus_pipeline.run(spark, f"{folder}/full")
    assert found.count() > 20 and "sequence_id" in found.columns
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0


@pytest.mark.parametrize("kind", ["int", "string"])
def test_conversation_ids_of_other_types(spark, kind):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "bye")]
    df = spark.createDataFrame(rows, "c bigint, turn bigint, role string, text string")
    df = df.withColumn("c", df.c.cast(kind))
    found = chat.read_back(chat.format_turns(df, "c", "turn", "role", "text")).collect()
    assert sorted((row.conv_id, row.n_turns) for row in found) == [(1, 2), (2, 1)]


def test_conversation_of_control_strings_is_in_the_query(spark, monkeypatch):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    monkeypatch.setattr(queries, "_table", lambda *_: none)
    (row,) = queries.op9_chat_formatting(spark, "").collect()
    assert (row.conv_id, row.n_turns, row.loss_chars) == (-1, 2, len("</s>[INST] ok [/INST]"))
