from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

import tokenframe as tf
from registry.inputs import DEFINITIONS, WORD_LISTS
from tokenframe.functions import decode_col, encode_col
from tokenframe.functions.tokens import definition_type
from tokenframe.operators import dictionary as dictionary_module, lookup

from . import brute
from .texts import TEXTS


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, address string")


def by_id(df):
    return {row["id"]: row for row in df.collect()}


def test_matches_the_rules_row_by_row(frame, model):
    rows = by_id(tf.tokenize(frame, "address", model, type_ids=True, class_ids=True))
    types = sorted(name for name, _ in DEFINITIONS)
    classes = sorted([*types, *WORD_LISTS])
    for i, text in enumerate(TEXTS):
        found = rows[i]["address"]
        assert found["raw_value"] == text
        if text is None:
            assert all(value is None for value in found)
            continue
        tokens = brute.split(text)
        kinds = [brute.type_of(t, DEFINITIONS) for t in tokens]
        named = [brute.class_of(t, DEFINITIONS, WORD_LISTS) for t in tokens]
        assert found["tokens"] == tokens
        assert found["types"] == kinds, text
        assert found["classes"] == named, text
        assert found["type_ids"] == [types.index(k) if k in types else 255 for k in kinds]
        assert found["class_ids"] == [classes.index(c) if c in classes else 255 for c in named]


@pytest.mark.parametrize("which", ["table_model", "join_model"])
def test_every_way_to_look_up_words_agrees(frame, model, which, request, monkeypatch):
    # One frequent content and element, so that both joins take part.
    monkeypatch.setattr(lookup, "COPIES", 1)
    monkeypatch.setattr(lookup, "FREQUENT", 1)
    other = request.getfixturevalue(which)
    options = {"type_ids": True, "class_ids": True}
    copies = frame.unionAll(frame.where("id < 7")).unionAll(frame.where("id = 1"))
    expected = tf.tokenize(copies, "address", model, **options)
    found = tf.tokenize(copies, "address", other, **options)
    assert found.schema == expected.schema
    assert found.exceptAll(expected).count() == 0
    assert expected.exceptAll(found).count() == 0


def test_layouts_without_names_give_the_same_ids(frame, model):
    full = tf.tokenize(frame, "address", model, type_ids=True, class_ids=True)
    bare = tf.tokenize(
        frame,
        "address",
        model,
        raw_value=False,
        types=False,
        classes=False,
        type_ids=True,
        class_ids=True,
    )
    assert bare.schema["address"].dataType.names == ["tokens", "type_ids", "class_ids"]
    pick = ["id", "address.tokens", "address.type_ids", "address.class_ids"]
    assert full.select(pick).exceptAll(bare.select(pick)).count() == 0


def test_schema_is_known_without_running(frame, model):
    strings, ids = T.ArrayType(T.StringType()), T.ArrayType(T.ShortType())
    schema = tf.tokenize_schema(type_ids=True, class_ids=True)
    assert [(f.name, f.dataType) for f in schema] == [
        ("raw_value", T.StringType()),
        ("tokens", strings),
        ("types", strings),
        ("classes", strings),
        ("type_ids", ids),
        ("class_ids", ids),
    ]
    found = tf.tokenize(frame, "address", model, out="parsed", class_ids=True)
    assert found.columns == ["id", "address", "parsed"]
    assert found.schema["parsed"].dataType.simpleString() == (
        tf.tokenize_schema(class_ids=True).simpleString()
    )


def test_output_options(frame, model):
    categorical = tf.tokenize(frame, "address", model, class_output="categorical")
    assert categorical.exceptAll(tf.tokenize(frame, "address", model)).count() == 0
    with pytest.raises(ValueError, match="enum"):
        tf.tokenize(frame, "address", model, type_output="enum")
    with pytest.raises(ValueError, match="unknown list output"):
        tf.tokenize_schema(token_output="utf8")
    with pytest.raises(ValueError, match="must be a string"):
        tf.tokenize(frame, "id", model)
    with pytest.raises(ValueError, match="unknown lookup"):
        tf.tokenize(frame, "address", model, lookup="hash")


def test_too_long_lists_cannot_be_inlined(frame, join_model):
    with pytest.raises(ValueError, match="too long"):
        tf.tokenize(frame, "address", join_model, lookup="inline")


@pytest.mark.parametrize("which", ["model", "join_model"])
def test_long_form(frame, which, request):
    long = tf.tokens_long(frame, "id", "address", request.getfixturevalue(which))
    rows = {(r["id"], r["pos"]): (r["token"], r["type"], r["class"]) for r in long.collect()}
    expected = {}
    for i, text in enumerate(TEXTS):
        if not text:
            expected[i, None] = (None, None, None)
        for pos, token in enumerate(brute.split(text or "")):
            expected[i, pos] = (
                token,
                brute.type_of(token, DEFINITIONS),
                brute.class_of(token, DEFINITIONS, WORD_LISTS),
            )
    assert rows == expected


def test_ids_decode(spark):
    vocab = ("ALPHA", "NUM", "ST")
    df = spark.createDataFrame(
        [(["a", " ", "7", "q"], ["ALPHA", " ", "NUM", "x"])],
        "tokens array<string>, names array<string>",
    )
    ids = encode_col(F.col("names"), vocab)
    row = df.select(ids.alias("ids"), decode_col(ids, F.col("tokens"), vocab).alias("back")).first()
    assert row.ids == [0, 255, 1, 255]
    assert row.back == ["ALPHA", " ", "NUM", "q"]
    odd = F.array(*[F.lit(i).cast("smallint") for i in (2, 3, -1, 254)])
    assert df.select(decode_col(odd, F.col("tokens"), vocab)).first()[0] == ["ST", " ", "7", "q"]


@pytest.mark.parametrize("how", ["literal", "join", "join with hot rows"])
def test_dictionary(spark, how, monkeypatch):
    if how == "join with hot rows":
        monkeypatch.setattr(lookup, "COPIES", 1)
    how = how.split()[0]
    rows = [
        (1, ["a", "b", "a", None, '"', "a|b"]),
        (2, None),
        (3, []),
        (4, [None]),
        (5, ["b", None]),
        (5, ["b", None]),
        (6, ["b", "c"]),
    ]
    df = spark.createDataFrame(rows, "id int, items array<string>")
    dictionary, encoded = tf.dictionary_encode(df, "items", lookup=how)
    names = {row.id: row.value for row in dictionary.collect()}
    assert sorted(names) == list(range(len(names)))
    assert [names[i] for i in sorted(names)] == ['"', "a", "a|b", "b", "c"]
    decoded = [
        (row.id, None if row["items"] is None else [names.get(i) for i in row["items"]])
        for row in encoded.collect()
    ]
    assert sorted(decoded, key=repr) == sorted(rows, key=repr)
    back = tf.dictionary_decode(encoded, "items", dictionary, lookup=how)
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0


def test_common_values_of_a_dictionary_are_not_joined(spark, monkeypatch):
    left = []

    def spied(df, col, elements_of, table, value, payload, out, skip):
        items = df.select(F.explode(col).alias("item")).where("item IS NOT NULL")
        left.append({row.item for row in items.where(~skip(F.col("item"))).collect()})
        return lookup.lookup_by_join(df, col, elements_of, table, value, payload, out, skip)

    monkeypatch.setattr(dictionary_module, "COMMON", 2)
    monkeypatch.setattr(dictionary_module, "lookup_by_join", spied)
    rows = [(1, ["a", "b", "c", None]), (2, ["b", "a"]), (3, ["b", "d", "a"]), (4, ["b", "a", "d"]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "id int, items array<string>")
    names, encoded = tf.dictionary_encode(df, "items")
    back = tf.dictionary_decode(encoded, "items", names)
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    assert left == [{"c", "d"}, {2, 3}]


def test_plan_has_no_shuffle_and_no_python(frame, model, table_model):
    for m in (model, table_model):
        plan = tf.tokenize(frame, "address", m)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_unused_outputs_are_pruned(spark, model, tmp_path):
    spark.createDataFrame([(1, "a b")], "id int, t string").write.parquet(str(tmp_path / "t"))
    df = tf.tokenize(spark.read.parquet(str(tmp_path / "t")), "t", model, out="k")

    def plan(*columns):
        return df.select(*columns)._jdf.queryExecution().executedPlan().toString()

    assert "transform" not in plan("k.tokens") and "zip_with" not in plan("k.tokens")
    assert "regexp_extract_all" not in plan("k.raw_value")
    assert "ReadSchema: struct<id:int>" in plan("id")
    assert plan("k.classes").count("regexp_extract_all") == 1


def test_ids_and_names_of_a_token_take_its_rules_once(spark, model, capsys):
    df = spark.createDataFrame([("12 MAIN ST",)], "address string")
    tf.tokenize(df, "address", model, type_ids=True, class_ids=True).explain()
    plan = capsys.readouterr().out
    postal = r"^[\s_-]*[A-Za-z]"
    # In one transform only, and no id is looked up by its name.
    assert sum(postal in line for line in plan.splitlines()) == 1
    assert "transform(__tf_types" not in plan and "transform(__tf_classes" not in plan


def test_rules_found_by_halving_are_the_first_that_match(spark):
    rules = [
        ("A", "^a"), ("B", "b$|^xb"), ("C", "(^c|d)e"), ("D", "[|^]f"), ("E", "^e|^f"), ("F", "g"), ("G", "^[ab|]+$"),
    ]
    tokens = ["a", "ab", "b", "xb", "ce", "xde", "xce", "|f", "e", "xe", "f", "xg", "b|a", "b|", "", "é", "a\nb", "b\n"]
    df = spark.createDataFrame([(token,) for token in tokens], "t string")
    t = F.col("t")
    chain = F
    for name, regex in rules:
        chain = chain.when(t.rlike("(?d)" + regex), F.lit(name))
    for row in df.select("t", definition_type(t, rules).alias("found"), chain.alias("expected")).collect():
        assert row.found == row.expected, row


def test_places_of_a_class_travel_as_bits(spark, model, join_model, capsys):
    words = ["ST", "the", "N", "x", "12", "a.b"]
    texts = [" ".join(words[(i * k) % 6] for i in range(n)) for k, n in ((1, 31), (1, 32), (5, 33), (1, 200), (4, 129))]
    rows = [(i, text) for i, text in enumerate([*texts, *texts[:2], "x " * 90 + "ST", "", None])]
    df = spark.createDataFrame(rows, "id int, address string")
    for options in ({"types": False}, {"type_ids": True, "class_ids": True}):
        found = tf.tokenize(df, "address", join_model, **options)
        assert by_id(found) == by_id(tf.tokenize(df, "address", model, **options))
    tf.tokenize(df, "address", join_model, types=False).explain()
    assert "bit_or" in capsys.readouterr().out
