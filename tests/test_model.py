from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tokenframe as tf
from registry.inputs import DEFINITIONS, WORD_LISTS
from tokenframe.functions import literal_table, membership
from tokenframe.functions.literal_table import LiteralTable
from tokenframe.functions.membership import BitmapFilter
from tokenframe.sources import read_classes, read_definitions
from tokenframe.sources.model import CLASSES_SCHEMA, DEFINITIONS_SCHEMA

FIXTURE = str(Path(__file__).parent / "fixtures" / "model")


def test_files_give_the_tables(spark):
    definitions = tf.read_definitions(spark, f"{FIXTURE}/TOKENDEFINITION").orderBy("ord").collect()
    assert [(r.ord, r.name, r.regex) for r in definitions] == [
        (i, name, regex) for i, (name, regex) in enumerate(DEFINITIONS)
    ]
    classes = tf.read_classes(spark, f"{FIXTURE}/TOKENCLASS").collect()
    assert sorted((r["class"], r.entry) for r in classes) == sorted(
        (name, word) for name, words in WORD_LISTS.items() for word in words
    )


def test_loaded_model_equals_the_written_one(spark, model):
    loaded = tf.Model.load(spark, FIXTURE)
    for field in ("definitions", "class_names", "entries", "blank_types", "class_values"):
        assert getattr(loaded, field) == getattr(model, field)


def test_header_forms(spark, tmp_path):
    (tmp_path / "A.param").write_text("TOKEN_CLASS: A \n x y \n\nz\r\nz\n")
    (tmp_path / "B.param").write_bytes("﻿TOKEN_CLASS:B\nÉ".encode())
    rows = tf.read_classes(spark, str(tmp_path)).collect()
    assert sorted((r["class"], r.entry) for r in rows) == [("A", "x y"), ("A", "z"), ("B", "É")]


def test_broken_files_are_refused(spark, tmp_path):
    (tmp_path / "A.param").write_text("x\ny\n")
    with pytest.raises(ValueError, match="no TOKEN_CLASS header"):
        tf.read_classes(spark, str(tmp_path))
    (tmp_path / "A.param").write_text("TOKEN_CLASS:A\nx\nTOKEN_CLASS:B\ny\n")
    with pytest.raises(ValueError, match="more than one TOKEN_CLASS header"):
        tf.read_classes(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no usable model in folder"):
        tf.Model.load(spark, str(tmp_path / "nowhere"))


def test_vocabulary(spark):
    definitions = spark.createDataFrame([(0, "b", "b"), (1, "A", "a")], DEFINITIONS_SCHEMA)
    classes = spark.createDataFrame([("É", "x"), ("B", "y"), ("B", "z")], CLASSES_SCHEMA)
    rows = tf.vocabulary(definitions, classes).collect()
    assert sorted((r.kind, r.id, r.value) for r in rows) == [
        ("class", 0, "A"),
        ("class", 1, "B"),
        ("class", 2, "b"),
        ("class", 3, "É"),
        ("type", 0, "A"),
        ("type", 1, "b"),
    ]


def test_every_problem_is_named(spark):
    definitions = spark.createDataFrame(
        [(0, "", "e"), (1, "A", "a"), (2, "A", "b"), (3, "C", None)]
        + [(i, f"N{i}", "x") for i in range(10, 262)],
        DEFINITIONS_SCHEMA,
    )
    classes = spark.createDataFrame(
        [("", "q"), ("P", ""), ("P", "both"), ("Q", "both"), ("Q", "both")], CLASSES_SCHEMA
    )
    found = {(r.problem, r.detail) for r in tf.validate_model(definitions, classes).collect()}
    assert found == {
        ("empty definition name", "e"),
        ("definition without regex", "C"),
        ("duplicate definition name", "A"),
        ("empty class name", "q"),
        ("empty class entry", "P"),
        ("entry in more than one class", "both"),
        ("vocabulary too large", "type 255"),
        ("vocabulary too large", "class 257"),
    }


def test_invalid_models_are_refused(spark):
    with pytest.raises(ValueError, match="entry in more than one class: x"):
        tf.Model.from_values(spark, [("A", "a")], {"P": ["x"], "Q": ["x"]})
    with pytest.raises(ValueError, match="does not compile"):
        tf.Model.from_values(spark, [("A", "a(")], {"P": ["x"]})
    names = [(f"N{i}", "x") for i in range(254)]
    with pytest.raises(ValueError, match="class 255"):
        tf.Model.from_values(spark, names, {"P": ["x"]})


def types(spark, model, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r.types for r in tf.tokenize(df, "t", model).select("t.types").collect()]


def test_fast_rules_need_their_definition(spark):
    m = tf.Model.from_values(spark, [("LETTER", "[a-z]"), ("ALPHA_NUM_EXTENDED", "^$")], {})
    assert types(spark, m, "abc", "ABC", "7", "a1", "LETTER") == [
        ["LETTER"],
        ["ABC"],
        ["7"],
        ["ALPHA_NUM_EXTENDED"],
        ["LETTER"],
    ]


def test_a_raw_token_may_spell_a_name(spark):
    m = tf.Model.from_values(spark, [("NUM", "^[0-9]+$"), ("B", "^b$")], {"W": ["w"]})
    df = spark.createDataFrame([("NUM 7 W x",)], "t string")
    for layout in ({}, {"types": False, "classes": False}):
        row = tf.tokenize(df, "t", m, type_ids=True, class_ids=True, **layout).first().t
        assert row.type_ids == [1, 255, 1, 255, 255, 255, 255]
        assert row.class_ids == [1, 255, 1, 255, 2, 255, 255]
    found = tf.extract(df, "t", m, "<<N#>> <<M#>> <<W::W>>", "start").select("t.*").first()
    assert tuple(found) == ("NUM", "7", "W", " x")


def test_definitions_may_name_blanks(spark):
    m = tf.Model.from_values(spark, [("GAP", "^ $"), ("LINE", r"^\s*\n\s*$")], {})
    assert types(spark, m, "a b\nc  d\n \ne") == [
        ["a", "GAP", "b", "LINE", "c", "  ", "d", "LINE", "e"]
    ]


def test_definitions_that_cannot_be_put_together(spark):
    m = tf.Model.from_values(spark, [("TWICE", r"^(.)\1$"), ("LOW", "(?i)^Q$")], {})
    assert types(spark, m, "zz", "q", "zy") == [["TWICE"], ["LOW"], ["zy"]]


def test_literal_table(spark, monkeypatch):
    rows = [(f'k"{i}é', i) for i in range(500)]
    table = spark.createDataFrame(rows, "k string, v bigint")
    literal = LiteralTable.build(table, "k", "v")
    found = table.select("k", "v", literal.lookup(table.k).alias("w"))
    assert found.where("v != w OR w IS NULL").count() == 0
    empty = LiteralTable.build(table.limit(0), "k", "v")
    for other in (literal, empty):
        assert spark.range(1).select(other.lookup(F.lit("no"))).first()[0] is None
    monkeypatch.setattr("tokenframe.functions.literal_table.MAX_ROWS", 499)
    assert LiteralTable.build(table, "k", "v") is None


def write_files(folder, files):
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text)
    return str(folder)


def test_a_list_without_header_is_an_error(spark, tmp_path):
    path = write_files(tmp_path / "lists", {"a": "TOKEN_CLASS:A\nx\n", "b": "y\nz\n"})
    with pytest.raises(ValueError, match="no TOKEN_CLASS header in word list .*b"):
        read_classes(spark, path)


def test_many_lists_of_one_class(spark, tmp_path):
    path = write_files(tmp_path / "lists", {f"f{k}": f"TOKEN_CLASS:A\nw{k}\n" for k in range(260)})
    found = read_classes(spark, path)
    assert found.count() == 260 and found.select("class").distinct().count() == 1


def test_definitions_in_two_files_are_an_error(spark, tmp_path):
    line = "<NAME>{0}</NAME> <VALUE>{0}</VALUE>\n"
    path = write_files(tmp_path / "definitions", {"a": line.format("x"), "b": line.format("y")})
    with pytest.raises(ValueError, match="more than one file"):
        read_definitions(spark, path)


def test_an_error_tells_how_many_problems_there_are(spark):
    from tokenframe import Model

    shared = [f"word{k}" for k in range(30)]
    with pytest.raises(ValueError, match="20 of 30 shown"):
        tf.Model.from_values(spark, [("NUM", "^[0-9]+$")], {"A": shared, "B": shared})


@pytest.mark.parametrize("n", [0, 10, 5_000, 70_000])
def test_bitmap_holds_all_and_little_else(spark, n):
    name = lambda letter: F.xxhash64(F.concat(F.lit(letter), F.col("id")))
    held = BitmapFilter.build(spark.range(n), name("w"))
    assert spark.range(n).where(~held.may_hold(name("w"))).count() == 0
    assert spark.range(20_000).where(held.may_hold(name("x"))).count() < 600


def test_bitmap_too_full_is_not_built(spark, monkeypatch):
    monkeypatch.setattr(membership, "MAX_BITS", 4_096)
    assert BitmapFilter.build(spark.range(1_024), F.xxhash64("id")) is not None
    assert BitmapFilter.build(spark.range(1_025), F.xxhash64("id")) is None


def test_lists_too_long_for_a_plan_need_an_explicit_join(spark, monkeypatch):
    monkeypatch.setattr(literal_table, "MAX_ROWS", 3)
    lists = {"A": ["a", "b", "c", "d"]}
    with pytest.raises(ValueError, match="lookup='join'"):
        tf.Model.from_values(spark, [("NUM", "^[0-9]+$")], lists, max_inline_entries=2)
    assert not tf.Model.from_values(spark, [("NUM", "^[0-9]+$")], lists, lookup="join").inline
    with pytest.raises(ValueError, match="unknown lookup"):
        tf.Model.from_values(spark, [("NUM", "^[0-9]+$")], lists, lookup="auto")
