from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import tokenframe as tf
from registry.inputs import ADDRESS, DEFINITIONS, WORD_LISTS

from tokenframe.functions import tokens as tk
from tokenframe.plans import reports

from . import brute
from .texts import TEXTS

TYPES = sorted(name for name, _ in DEFINITIONS)
CLASSES = sorted([*TYPES, *WORD_LISTS])


@pytest.fixture(params=["model", "table_model", "join_model"])
def any_model(request):
    return request.getfixturevalue(request.param)


@pytest.fixture
def frame(spark):
    rows = [(i, i % 3, text) for i, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, grp int, t string")


def labelled(token, kind):
    value = (
        brute.class_of(token, DEFINITIONS, WORD_LISTS)
        if kind == "class"
        else brute.type_of(token, DEFINITIONS)
    )
    if all(c in brute.WHITE for c in token):
        return "(blank)"
    return value if value in (CLASSES if kind == "class" else TYPES) else "(raw)"


@pytest.mark.parametrize("kind", ["class", "type"])
def test_class_profile(frame, any_model, kind):
    counts: dict[int, Counter] = defaultdict(Counter)
    for i, text in enumerate(TEXTS):
        counts[i % 3].update(labelled(token, kind) for token in brute.split(text or ""))
    expected = {
        (group, name, n, n / sum(counter.values()))
        for group, counter in counts.items()
        for name, n in counter.items()
    }
    found = tf.class_profile(frame, "t", any_model, by="grp", kind=kind)
    assert found.columns == ["grp", kind, "n_tokens", "share"]
    assert {tuple(r) for r in found.collect()} == expected
    whole = tf.class_profile(frame, "t", any_model, kind=kind)
    assert {r[0]: r.n_tokens for r in whole.collect()} == sum(counts.values(), Counter())


def test_shape_profile(frame, any_model):
    shapes = defaultdict(list)
    for text in TEXTS:
        if text is not None:
            labels = [labelled(t, "class") for t in brute.split(text)]
            shapes["".join(" " if x == "(blank)" else x for x in labels)].append(text)
    ranked = sorted(((s, len(ts), min(ts)) for s, ts in shapes.items()), key=lambda r: (-r[1], r[2]))
    found = tf.shape_profile(frame, "t", any_model, 6).collect()
    assert [tuple(r) for r in found] == ranked[:6]


@pytest.mark.parametrize("level", ["type", "class"])
def test_unknown_tokens(frame, any_model, level):
    totals, keys = Counter(), defaultdict(set)
    by_group: dict[int, Counter] = defaultdict(Counter)
    for i, text in enumerate(TEXTS):
        for token in brute.split(text or ""):
            if labelled(token, level) == "(raw)":
                totals[token] += 1
                keys[token].add(i)
                by_group[i % 3][token] += 1
    ranked = sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))
    found = tf.unknown_tokens(frame, "t", any_model, 4, key="id", level=level).collect()
    assert [tuple(r) for r in found] == [(t, n, len(keys[t])) for t, n in ranked[:4]]
    bare = tf.unknown_tokens(frame, "t", any_model, 100, level=level).collect()
    assert [tuple(r) for r in bare] == ranked
    grouped = tf.unknown_tokens(frame, "t", any_model, 2, by="grp", level=level).collect()
    expected = {
        (group, token, n)
        for group, counter in by_group.items()
        for token, n in sorted(counter.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
    }
    assert {tuple(r) for r in grouped} == expected


def test_extraction_report(frame, any_model):
    patterns = [("address", ADDRESS), ("number", "<<N#>>")]
    modes = ["whole", "start", "end", "any"]
    expected = set()
    for name, pattern in patterns:
        for mode in modes:
            rows = matched = left = 0
            for text in TEXTS:
                if text is None:
                    continue
                tokens = brute.split(text)
                classes = [brute.class_of(t, DEFINITIONS, WORD_LISTS) for t in tokens]
                fields, rest = brute.extract(tokens, classes, pattern, mode)
                rows += 1
                matched += any(v is not None for v in fields.values())
                left += rest != ""
            expected.add((name, mode, rows, matched, left))
    found = tf.extraction_report(frame, "t", any_model, patterns, modes)
    assert {tuple(r) for r in found.collect()} == expected


def test_class_coverage(frame, any_model):
    counts = Counter(token for text in TEXTS for token in brute.split(text or ""))
    expected = set()
    for name, listed in WORD_LISTS.items():
        for word in listed:
            status = "unreachable" if " " in word else "used" if counts[word] else "unused"
            expected.add((name, word, status, 0 if " " in word else counts[word]))
    assert {tuple(r) for r in tf.class_coverage(frame, "t", any_model).collect()} == expected


def test_sound_tables_pass_the_check(frame, model):
    tokenized = tf.tokenize(frame, "t", model, type_ids=True, class_ids=True)
    found = {r.check: r.bad_rows for r in tf.check_tokenized(tokenized, "t", model).collect()}
    assert len(found) == 7 and set(found.values()) == {0}
    bare = tf.tokenize(frame, "t", model, raw_value=False, types=False, classes=False)
    assert {r.check for r in tf.check_tokenized(bare, "t", model).collect()} == {
        "tokens are not empty",
        "lists hold no NULL",
    }


def test_each_break_is_found(spark, model):
    fields = "raw_value: string, tokens: array<string>, classes: array<string>, class_ids: array<int>"
    num = model.class_values.index("NUM")
    rows = [
        ("1 ", ["1"], ["NUM"], [num]),
        ("1", ["1", ""], ["NUM", ""], [num, 255]),
        ("1", ["1"], [None], [num]),
        ("1", ["1"], ["NUM", "NUM"], [num]),
        (None, ["1"], ["NUM"], [num]),
        ("1", ["1"], ["NUM"], [num + 1]),
        (None, None, None, None),
    ]
    df = spark.createDataFrame([(row,) for row in rows], f"t struct<{fields}>")
    found = {r.check: r.bad_rows for r in tf.check_tokenized(df, "t", model).collect()}
    assert found["tokens join to raw_value"] == 1
    assert found["tokens are not empty"] == 1
    assert found["lists hold no NULL"] == 1
    assert found["lists have one length"] == 1
    assert found["NULLs are consistent"] == 1
    assert found["class_ids decode to classes"] >= 1


def test_wrong_arguments_are_refused(frame, model):
    with pytest.raises(ValueError, match="unknown kind"):
        tf.class_profile(frame, "t", model, kind="shape")
    with pytest.raises(ValueError, match="unknown level"):
        tf.unknown_tokens(frame, "t", model, 3, level="shape")
    with pytest.raises(ValueError, match="at least one"):
        tf.extraction_report(frame, "t", model, [])
    with pytest.raises(ValueError, match="tokenized struct"):
        tf.check_tokenized(frame, "t", model)


def test_texts_are_split_once_and_counted_before_the_shuffle(spark, model, tmp_path):
    spark.createDataFrame([(1, "x", "a b")], "id int, g string, t string").write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))

    def plan(report):
        return report._jdf.queryExecution().executedPlan().toString()

    profile = plan(tf.class_profile(df, "t", model, by="g"))
    assert profile.count("regexp_extract_all") == 1 and "partial_count" in profile
    assert "ReadSchema: struct<g:string,t:string>" in profile
    long = plan(tf.tokens_long(df, "id", "t", model).where(F.col("pos").isNotNull()))
    assert long.count("regexp_extract_all") == 1 and "Exchange" not in long
    unknown = plan(tf.unknown_tokens(df, "t", model, 3, by="g"))
    assert unknown.count("regexp_extract_all") == 1 and "WindowGroupLimit" in unknown
    report = plan(tf.extraction_report(df, "t", model, [("a", ADDRESS)], ["any", "start"]))
    assert report.count("regexp_extract_all") == 1 and report.count("Exchange") == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shapes_are_counted_without_a_sort_or_a_text_in_the_first_exchange(frame, model, monkeypatch):
    plans = []
    within = reports._within_border
    monkeypatch.setattr(reports, "_within_border", lambda df, k: plans.append(_plan(df)) or within(df, k))
    assert "SortAggregate" not in _plan(tf.shape_profile(frame, "t", model, 3))
    (first,) = plans
    assert "SortAggregate" not in first and "HashAggregate" in first
    assert "hashpartitioning(__tf_h1" in first


def test_shapes_tied_at_the_border(spark, model, monkeypatch):
    texts = ["same prefix 1", "same prefix x", "same prefix 1 1", "same prefix x x", "same prefix", "a", "a", "1"]
    df = spark.createDataFrame([(t,) for t in texts * 2], "t string")
    whole = [tuple(r) for r in tf.shape_profile(df, "t", model, 100).collect()]
    assert whole == sorted(whole, key=lambda r: (-r[1], r[2]))
    for limit in (0, 100_000):
        monkeypatch.setattr(reports, "BROADCAST_ROWS", limit)
        for k in range(1, len(whole) + 1):
            assert [tuple(r) for r in tf.shape_profile(df, "t", model, k).collect()] == whole[:k]


@pytest.mark.parametrize("by", [None, "grp"])
@pytest.mark.parametrize("k", [1, 3, 70])
def test_pruned_top_tokens_are_the_same(spark, model, by, k, monkeypatch):
    rows = [(i % 7 or None, i % 3 or None, " ".join(f"#{j}!" for j in range(1, 90) if i % j == 0)) for i in range(120)]
    df = spark.createDataFrame([*rows, (1, 1, None), (None, 2, "")], "id int, grp int, t string")
    for key, listed in ((None, 9), ("id", 0), ("id", 2_000)):
        monkeypatch.setattr(reports, "LISTED", listed)
        plain, pruned = (
            tf.unknown_tokens(df, "t", model, k, key=key, by=by, prune=prune).collect() for prune in (False, True)
        )
        assert sorted(map(tuple, plain), key=repr) == sorted(map(tuple, pruned), key=repr)
    counts = Counter()
    keys = defaultdict(set)
    for number, group, text in rows:
        for token in text.split():
            place = (group, token) if by else (token,)
            counts[place] += 1
            keys[place] |= {number} - {None}
    ranked = defaultdict(list)
    for place, n in sorted(counts.items(), key=lambda kv: (-kv[1], kv[0][-1])):
        ranked[place[:-1]].append((*place, n, len(keys[place])))
    want = [row for group in ranked.values() for row in group[:k]]
    assert sorted(map(tuple, pruned), key=repr) == sorted(want, key=repr)


def test_keys_are_counted_without_a_row_for_each_token_and_key(frame, model):
    plan = _plan(tf.unknown_tokens(frame, "t", model, 4, key="id"))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("token" in line and "id#" in line for line in exchanges)


@pytest.mark.parametrize("lookup", ["inline", "join"])
@pytest.mark.parametrize("bitmap", [True, False])
def test_entries_of_several_tokens_are_counted_in_rows_of_tokens(spark, monkeypatch, lookup, bitmap):
    if not bitmap:
        monkeypatch.setattr(reports.BitmapFilter, "build", lambda *args: None)
    lists = {"P": ["CUL DE SAC", "A A", "A A A", "tab\tbed", " lead", "one"], "Q": ["DE SAC", "never there"]}
    texts = ["CUL DE SAC", "a CUL DE SAC DE SAC", "A A A A", "CUL  DE SAC", "tab\tbed one", "x lead", None, "", "A"]
    m = tf.Model.from_values(spark, DEFINITIONS, lists, lookup=lookup)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.entry: (r.status, r.n_tokens, r.n_phrases) for r in tf.class_coverage(df, "t", m, True).collect()}
    for entry in [w for words in lists.values() for w in words]:
        run = brute.split(entry)
        if len(run) == 1:
            assert found[entry] == ("used", 1, None)
            continue
        n = 0
        for text in texts:
            tokens = brute.split(text or "")
            n += sum(tokens[i : i + len(run)] == run for i in range(len(tokens)))
        assert found[entry] == ("unreachable", 0, n)
    plain = tf.class_coverage(df, "t", m)
    assert plain.columns == ["class", "entry", "status", "n_tokens"] and plain.count() == len(found)


def test_tokens_are_counted_before_they_are_looked_up(spark, model, join_model, capsys):
    rows = [(i % 3, text) for i, text in enumerate([*TEXTS, "12 MAIN ST", "STREETTYPE ST", "NUM_EXTENDED", "RTE\n7"])]
    df = spark.createDataFrame(rows, "g int, text string")
    found = tf.class_profile(df, "text", join_model, by="g")
    expected = tf.class_profile(df, "text", model, by="g")
    assert sorted(found.collect()) == sorted(expected.collect())
    assert sorted(tf.class_profile(df, "text", join_model).collect()) == sorted(tf.class_profile(df, "text", model).collect())
    found.explain()
    assert "__tf_content" not in capsys.readouterr().out


@pytest.mark.parametrize("by", ["g", None])
def test_pruning_applies_the_rules_once(spark, model, by, capsys):
    df = spark.createDataFrame([(i % 3, text) for i, text in enumerate(TEXTS)], "g int, text string")
    found = tf.unknown_tokens(df, "text", model, 3, by=by, prune=True)
    found.explain()
    assert "regexp_extract_all" not in capsys.readouterr().out
    expected = tf.unknown_tokens(df, "text", model, 3, by=by)
    assert sorted(found.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("level", ["type", "class"])
def test_pruning_reads_a_text_once(spark, model, level, monkeypatch):
    plans, write = [], reports.written_once
    monkeypatch.setattr(reports, "written_once", lambda df, name: plans.append(_plan(df)) or write(df, name))
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    found = tf.unknown_tokens(df, "text", model, 3, key="id", level=level, prune=True)
    assert sum(plan.count("regexp_extract_all") for plan in [*plans, _plan(found)]) == 1
    expected = tf.unknown_tokens(df, "text", model, 3, key="id", level=level)
    assert found.collect() == expected.collect()


@pytest.mark.parametrize("on", [{"ALPHA", "NUM"}, {"ALPHA"}, {"NUM"}, set()])
def test_only_plain_words_before_a_blank_are_stepped_over(spark, on):
    m = tf.Model.from_values(spark, [d for d in DEFINITIONS if d[0] in on or d[0] not in ("ALPHA", "NUM")], WORD_LISTS)
    rnd = random.Random(5)
    pieces = ["a", "Zb", "7", "é", "!", "'", "\x0b", "\u00a0", "\U0001f600", " ", "  ", "\n", "\t\r\f"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randrange(12))) for _ in range(400)]
    texts += [*filter(None, TEXTS), "ab 12 " * 100_000 + "é", "ab " * 100_000, " " * 300_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", tk.maybe_unknown_col(F.col("t"), m).alias("found")).collect()
    plain = re.compile("|".join([*["[A-Za-z]+"] * ("ALPHA" in on), *["[0-9]+"] * ("NUM" in on), "(?!)"]))
    for text, tokens in found:
        words = re.findall(r"[^ \t\n\r\f]+", text)
        known = [bool(plain.fullmatch(word)) for word in words]
        # The last word has no blank behind it, so the rules see it.
        open_end = bool(words) and text.endswith(words[-1])
        last = len(words) - 1
        assert [t for t in tokens if t] == [w for i, w in enumerate(words) if not known[i] or open_end and i == last]
