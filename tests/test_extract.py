from __future__ import annotations

import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import tokenframe as tf
from registry.inputs import ADDRESS, DEFINITIONS, WORD_LISTS

from . import brute
from .texts import TEXTS

MODES = ("whole", "start", "end", "any")
PATTERNS = [
    ADDRESS,
    "<<A@+>>",
    "<<A@+>> <<B@+>>",
    "<<A@>> <<B@+>> <<C@>>",
    "<<A@+>> <<N#>>",
    " <<A@+>> <<N#>>",
    "<<A@>> <<B@+>> <<N#>> <<C@+>> <<D@+>>",
    "<<#>> <<A@+>> <<::STREETTYPE>>",
    "<<N#+>> <<A@>>",
    "<<A@+>><<B@+>>",
    "<<N#>> ",
    "<<X@>> <<X@>>",
]


def expected(text, pattern, mode):
    if text is None:
        names, _ = brute.extract([], [], pattern, mode)
        return {**names, "complement": None}
    tokens = brute.split(text)
    classes = [brute.class_of(t, DEFINITIONS, WORD_LISTS) for t in tokens]
    fields, rest = brute.extract(tokens, classes, pattern, mode)
    return {**fields, "complement": rest}


def check_all(spark, model, texts, mode):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, address string").coalesce(2)
    for i, pattern in enumerate(PATTERNS):
        df = tf.extract(df, "address", model, pattern, mode, out=f"c{i}")
    for row in df.collect():
        for i, pattern in enumerate(PATTERNS):
            wanted = expected(row.address, pattern, mode)
            assert row[f"c{i}"].asDict() == wanted, (row.address, pattern, mode)


@pytest.mark.parametrize("mode", MODES)
def test_matches_the_rules_row_by_row(spark, model, mode):
    check_all(spark, model, TEXTS, mode)


words = st.sampled_from(["A", "B", "7", "12", "ST", "É", "N", "a-b"])
texts = st.lists(
    st.lists(st.tuples(words, st.sampled_from([" ", " ", "  ", "\n"])), max_size=9).map(
        lambda pairs: "".join(word + blank for word, blank in pairs)
    ).flatmap(lambda text: st.sampled_from([text, text.rstrip(), " " + text])),
    min_size=60,
    max_size=120,
)


@pytest.mark.parametrize("mode", MODES)
@settings(
    max_examples=2,
    deadline=None,
    derandomize=True,
    suppress_health_check=list(HealthCheck),
)
@given(texts=texts)
def test_matches_the_rules_on_random_texts(spark, model, mode, texts):
    check_all(spark, model, texts, mode)


@pytest.mark.parametrize("mode", MODES)
def test_every_input_form_agrees(spark, model, join_model, table_model, mode):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, address string")
    raw = tf.extract(df, "address", model, ADDRESS, mode).select("id", "address.*")
    layouts = [
        {},
        {"raw_value": False, "types": False},
        {"classes": False, "class_ids": True},
        {"raw_value": False, "types": False, "classes": False, "class_ids": True},
        {"class_ids": True},
    ]
    others = [
        tf.extract(tf.tokenize(df, "address", model, **layout), "address", model, ADDRESS, mode)
        for layout in layouts
    ]
    others.append(tf.extract(df, "address", table_model, ADDRESS, mode))
    if mode == "any":
        others.append(tf.extract(df, "address", join_model, ADDRESS, mode))
    for other in others:
        found = other.select("id", "address.*")
        assert found.columns == ["id", "CIVIC", "STREET", "TYPE", "complement"]
        assert found.exceptAll(raw).count() == raw.exceptAll(found).count() == 0


def struct_frame(spark, rows, fields):
    return spark.createDataFrame([(row,) for row in rows], f"t struct<{fields}>")


def test_class_ids_count_where_classes_are_null(spark, model):
    num, alpha = model.class_values.index("NUM"), model.class_values.index("ALPHA")
    rows = [
        (["1", " ", "x"], ["NUM", " ", "ALPHA"], [255, 255, 255]),
        (["1", " ", "x"], None, [num, 255, alpha]),
        (None, None, None),
        None,
    ]
    fields = "tokens: array<string>, classes: array<string>, class_ids: array<smallint>"
    df = struct_frame(spark, rows, fields)
    found = tf.extract(df, "t", model, "<<N#>> <<A@>>").select("t.*").collect()
    assert [tuple(r) for r in found] == [("1", "x", "")] * 2 + [(None, None, None)] * 2


@pytest.mark.parametrize(
    ("row", "message"),
    [
        ((None, ["1"], ["NUM"]), "inconsistent NULLs"),
        (("1", None, None), "inconsistent NULLs"),
        (("1", ["1"], None), "inconsistent NULLs"),
        ((None, None, ["NUM"]), "inconsistent NULLs"),
        (("1", ["1", None], ["NUM", "NUM"]), "may not be NULL"),
        (("1", ["1"], [None]), "may not be NULL"),
        (("1 ", ["1", " "], ["NUM"]), "different lengths"),
    ],
)
@pytest.mark.parametrize("field", ["N", "complement"])
def test_broken_structs_raise(spark, model, row, message, field):
    fields = "raw_value: string, tokens: array<string>, classes: array<string>"
    df = tf.extract(struct_frame(spark, [row], fields), "t", model, "<<N#>>", "any")
    if message == "inconsistent NULLs" and row[0] is None and row[1] is not None:
        # Only the text is missing: it is put together from the tokens.
        assert df.select(f"t.{field}").first()[0] in ("1", "")
        return
    with pytest.raises(Exception, match=message):
        df.select(f"t.{field}").collect()


def test_broken_id_lists_raise(spark, model):
    fields = "tokens: array<string>, class_ids: array<int>"
    for row, message in [((["1"], [None]), "NULL"), ((["1"], [1, 2]), "lengths"), ((["1"], None), "NULLs")]:
        df = tf.extract(struct_frame(spark, [row], fields), "t", model, "<<N#>>")
        with pytest.raises(Exception, match=message):
            df.select("t.N").collect()


@pytest.mark.parametrize(
    ("fields", "message"),
    [
        ("classes: array<string>", "no list of tokens"),
        ("tokens: array<string>", "needs 'classes' or 'class_ids'"),
        ("tokens: array<int>, classes: array<string>", "array<string>"),
        ("tokens: array<string>, class_ids: array<string>", "array of integers"),
        ("raw_value: int, tokens: array<string>, classes: array<string>", "must be a string"),
    ],
)
def test_wrong_struct_types_are_refused(spark, model, fields, message):
    with pytest.raises(ValueError, match=message):
        tf.extract(struct_frame(spark, [], fields), "t", model, "<<N#>>")


def test_wrong_arguments_are_refused(spark, model):
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    for column, pattern, mode, message in [
        ("id", "<<N#>>", "whole", "must be a string"),
        ("t", "<<N#>>", "middle", "unknown mode"),
        ("t", "<<N::NOPE>>", "whole", "unknown class"),
        ("t", "<<N#", "whole", "unsupported syntax"),
        ("t", "x <<N#>>", "whole", "unsupported syntax"),
        ("t", "<<N!>>", "whole", "unsupported syntax"),
        ("t", "", "whole", "no element"),
        ("t", "<<a#>> <<A#>>", "whole", "collide"),
        ("t", "<<Complement#>>", "whole", "collide"),
    ]:
        with pytest.raises(ValueError, match=message):
            tf.extract(df, column, model, pattern, mode)


def test_field_names_and_schema(spark, model):
    assert tf.capture_field_names(ADDRESS) == ["CIVIC", "STREET", "TYPE"]
    assert tf.capture_field_names("<<#>> <<B@>> <<A#>> <<B@>>") == ["B", "A"]
    assert tf.extract_schema("<<#>> <<B@>>").simpleString() == "struct<B:string,complement:string>"
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    found = tf.extract(df, "t", model, "<<B@>>", out="p")
    assert found.columns == ["id", "t", "p"]
    assert found.schema["p"].dataType == tf.extract_schema("<<B@>>")


def test_first_matching_pattern_wins(spark, model):
    texts = ["1 A ST N", "1 A ST", "x 1", "x", None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rules = [
        ("side", ADDRESS + " <<SIDE::DIRECTION>>"),
        ("plain", ADDRESS),
        ("number", "<<CIVIC#>>", "end"),
    ]
    found = tf.extract_first(df, "t", model, rules, out="p").select("p.*")
    assert found.columns == ["pattern", "CIVIC", "STREET", "TYPE", "SIDE", "complement"]
    assert [tuple(r) for r in found.collect()] == [
        ("side", "1", "A", "ST", "N", ""),
        ("plain", "1", "A", "ST", None, ""),
        ("number", "1", None, None, None, "x "),
        (None, None, None, None, None, "x"),
        (None, None, None, None, None, None),
        (None, None, None, None, None, ""),
    ]
    with pytest.raises(ValueError, match="collide"):
        tf.extract_first(df, "t", model, [("a", "<<pattern#>>")])
    with pytest.raises(ValueError, match="at least one"):
        tf.extract_first(df, "t", model, [])


@pytest.mark.parametrize(
    "pattern",
    [
        "<<A@+>> <<N#>>",
        " <<A@+>> <<N#>>",
        "<<A@>> <<B@+>> <<C@+>> <<N#>>",
        "<<A@+>> <<T::STREETTYPE>> <<B@+>>",
    ],
)
def test_long_runs_stay_linear(spark, model, pattern):
    long = " ".join(["word"] * 60_000)
    df = spark.createDataFrame([(long,), (long + " 7",)], "t string")
    started = time.time()
    for mode in MODES:
        found = tf.extract(df, "t", model, pattern, mode, out="p")
        rows = [r.complement for r in found.select("p.complement").collect()]
        assert rows[0] == long
    assert time.time() - started < 40


def test_filters_on_fields_do_not_repeat_the_work(spark, model, tmp_path):
    spark.createDataFrame([(1, "a b")], "id int, t string").write.parquet(str(tmp_path / "t"))
    df = tf.extract(spark.read.parquet(str(tmp_path / "t")), "t", model, ADDRESS, out="p")
    kept = df.select("id", "p.*").where("CIVIC = '7' AND STREET LIKE 'M%' AND id > 3")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("regexp_replace") == 1
    assert "GreaterThan(id,3)" in plan


def test_plan_has_no_shuffle_and_splits_once(spark, model, tmp_path):
    spark.createDataFrame([(1, "a b")], "id int, t string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = tf.extract(df, "t", model, ADDRESS, "any").where(F.col("id") > 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") == 1 and plan.count("regexp_replace") == 1
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,3)]" in plan


def test_all_patterns_and_modes_take_one_regex(spark, model):
    df = spark.createDataFrame([("1 MAIN ST",)], "t string")
    patterns = [("a", ADDRESS), ("n", "<<N#>>"), ("w", "<<W@+>>")]
    report = tf.extraction_report(df, "t", model, patterns, ["whole", "start", "end", "any"])
    first = tf.extract_first(df, "t", model, [(name, text, "any") for name, text in patterns])
    for found in (report, first):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") == 1


@pytest.mark.parametrize("operator", ["report", "first"])
def test_long_runs_stay_linear_with_several_patterns(spark, model, operator):
    long = " ".join(["word"] * 60_000)
    df = spark.createDataFrame([(long,), (long + " 7",)], "t string")
    patterns = [("p", "<<A@+>> <<N#>> <<B@>>"), ("q", "<<A@+>> <<B@+>> <<N#>>")]
    if operator == "report":
        rows = tf.extraction_report(df, "t", model, patterns, ["whole", "any"]).collect()
        assert {(r.pattern, r.mode): r.n_matched for r in rows} == {
            ("p", "whole"): 0, ("p", "any"): 0, ("q", "whole"): 1, ("q", "any"): 1
        }
    else:
        found = tf.extract_first(df, "t", model, [(*pattern, "any") for pattern in patterns])
        assert sorted(r.t.pattern or "" for r in found.collect()) == ["", "q"]
