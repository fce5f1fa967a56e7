"""Fill-in-the-middle samples against a version that holds whole texts."""

from __future__ import annotations

import hashlib
import re

import pytest

from tokenframe.llm import fim

from .test_operators import docs, empty, made_texts, odd, texts  # noqa: F401

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
ODD_TEXTS = ["<<S", "a <P", "x<P>y", "<S <", "<P<S<M", " <M", "longé" * 30_000, " " * 5_000 + "x", "\n \nend <S\n"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sizes = (len(prefix), len(middle))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        form, output, sizes = "plain", text, (None, None)
    elif h[3] % 100 < 80:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, *sizes), output


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture(scope="module")
def rows():
    made = made_texts() + ODD_TEXTS
    rows = list(enumerate(made)) + [(k, made[k]) for k in range(0, len(made), 3)]
    return rows + [(None, "a text without id"), (None, "a text without id"), (None, None), (7, "other <text> a b")]


@pytest.mark.parametrize(("units", "size"), [(4_096, 1 << 15), (3, 5)])
def test_digests(spark, rows, monkeypatch, units, size):
    monkeypatch.setattr(fim, "PIECE_UNITS", units)
    monkeypatch.setattr(fim, "PIECE_BYTES", size)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = []
    for doc_id, text in rows:
        known, output = by_hand(doc_id, text)
        want.append((*known, sha(output), sha(text or "")))
    assert ordered(fim.fim_digests(df, "doc_id", "text").collect()) == ordered(want)
    assert {row[2] for row in want} == {"plain", "spm", "psm"}


def test_texts(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = [(*known, output) for known, output in (by_hand(*row) for row in rows)]
    assert ordered(fim.fim_texts(df, "doc_id", "text").collect()) == ordered(want)


def test_other_options(spark):
    df = spark.createDataFrame([("a", "b c d e")], "id string, body string")
    got = fim.fim_texts(df, "id", "body", seed=1, rate=100, spm_rate=0).first()
    assert got.doc_id == "a" and got.form == "psm" and got.output.startswith("<P>")


def test_odd_tables(docs, odd, empty):  # noqa: F811
    assert fim.fim_digests(odd, "doc_id", "text").count() == odd.count()
    assert fim.fim_digests(empty, "doc_id", "text").count() == 0
    clash = docs.selectExpr("*", "doc_id AS key", "text AS piece", "1 AS place", "2 AS copies")
    assert fim.fim_digests(clash, "doc_id", "text").count() == docs.count()


def test_one_shuffle(docs):  # noqa: F811
    plan = fim.fim_digests(docs, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key") == 1


@pytest.mark.parametrize("step", [1, 2, 3, 100])
def test_restorer_reads_marks_across_pieces(step):
    output = b"<S>su<S <P<P>pre<<M>mid<M>dle"
    got = {}
    reader = fim.Restorer("spm")
    for at in range(0, len(output), step):
        for part, data in reader.feed(output[at : at + step]):
            got[part] = got.get(part, b"") + data
    for part, data in reader.end():
        got[part] = got.get(part, b"") + data
    assert got == {fim.SUFFIX: b"su<S <P", fim.PREFIX: b"pre<", fim.MIDDLE: b"mid<M>dle"}
