"""Reports over whole tables: what the model makes of a corpus.

Each one classifies inside the row, sends only what it counts through the explode,
and aggregates before it shuffles, so a hot group costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import tokens as tk
from ..functions.membership import BitmapFilter
from ..functions.patterns import outline_regex
from ..operators.extract import cut_by, shape_source
from ..operators.lookup import SPREAD, element_name
from ..operators.tokenize import string_column, tokenize
from ..sources.storage import written_once

BLANK_LABEL = "(blank)"
# Parts of a group that rank their own tokens first.
GROUP_PARTS = 256
RAW_LABEL = "(raw)"
TOKENS, SHAPE, RAW = "__tf_tokens", "__tf_shape", "__tf_raw"
_STRUCT, _ID, _BLANK_ID = "__tf_struct", "__tf_id", -1
_H1, _H2, _FIRST, _UNKNOWN = "__tf_h1", "__tf_h2", "__tf_first", "__tf_unknown"
_PART, _RANK, _BIT, _BOUND, _CUT = "__tf_part", "__tf_rank", "__tf_bit", "__tf_bound", "__tf_cut"
_NAME = "__tf_name"
# Tables of fixed-width rows up to this length are broadcast, after a count.
BROADCAST_ROWS = 100_000
# So many names of tokens, of bounded length, are written out in a plan.
LISTED = 2_000
# Hash buckets for each of the k tokens asked for, and tokens in one bitmap of a key.
BUCKETS_PER_TOKEN = 64
WORD_BITS = 63


def _names(by) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def _arrays(df: DataFrame, col: str, model, *keep: str) -> DataFrame:
    """Token arrays for models whose word lists are looked up by join."""
    return tokenize(df.select(*keep, col), col, model, out=_STRUCT, raw_value=False)


def class_profile(
    df: DataFrame, col: str, model, by: str | list[str] | None = None, kind: str = "class"
) -> DataFrame:
    """``(by…, class, n_tokens, share)``: how often each class (or type) occurs per group.

    Blank tokens count as ``(blank)`` and tokens that stand for themselves as ``(raw)``,
    so a group has at most 256 rows; ``unknown_tokens`` lists the latter.
    """
    if kind not in ("class", "type"):
        raise ValueError(f"unknown kind {kind!r}, expected class or type")
    keys = _names(by)
    vocab = model.class_values if kind == "class" else model.type_values
    emit, raw = tk.emit_id(vocab)
    blank = F.lit(_BLANK_ID).cast("smallint")
    tokens = df.select(*keys, tk.tokens_col(string_column(df, col)).alias(TOKENS))
    if not model.inline and kind == "class":
        counts = _class_counts_by_join(tokens, keys, model)
    else:

        def token_id(token: Column) -> Column:
            if kind == "class":
                return tk.class_expr(token, model, emit=emit, raw=raw, blank=lambda _: blank)
            return F.when(tk.is_blank(token), blank).otherwise(
                tk.type_expr(token, model, emit, raw)
            )

        ids = F.transform(TOKENS, token_id)
        # The outer explode keeps Spark from adding a non-empty check that would classify twice.
        each = tokens.select(*keys, F.explode_outer(ids).alias(_ID))
        counts = each.where(F.col(_ID).isNotNull()).groupBy(*keys, _ID).agg(F.count("*").alias("n_tokens"))
    names = F.array(*[F.lit(v) for v in vocab])
    label = (
        F.when(F.col(_ID) == _BLANK_ID, BLANK_LABEL)
        .when(F.col(_ID) == tk.RAW_ID, RAW_LABEL)
        .otherwise(F.get(names, F.col(_ID).cast("int")))
    )
    total = F.sum("n_tokens").over(Window.partitionBy(*keys))
    return counts.select(
        *keys, label.alias(kind), "n_tokens", (F.col("n_tokens") / total).alias("share")
    )


def _class_counts_by_join(tokens: DataFrame, keys: list[str], model) -> DataFrame:
    """``(keys…, id, n_tokens)``, with word lists looked up by join.

    Tokens are counted before they are classified: a token of a group is one row for each task, is joined
    once with the entries, of which each is one row, and takes the rules once. Blanks need no join.
    """
    emit, raw = tk.emit_id(model.class_values)
    token = F.col("token")
    each = tokens.select(*keys, F.explode_outer(TOKENS).alias("token")).where(token.isNotNull())
    # A token that many groups have is spread over salts, and every salt finds a copy of its entry.
    counted = _token_counts(each, keys).withColumn(_PART, F.pmod(F.xxhash64(*keys, F.lit(0)), F.lit(SPREAD)))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint")))
    entries = model.classes.select(element_name(F.col("entry")).alias(_NAME), "class", salts.alias(_RANK))
    found = ~tk.is_blank(token) & (element_name(token) == F.col(_NAME)) & (F.col(_PART) == F.col(_RANK))
    joined = counted.join(entries, found, "left")
    listed = F.when(F.col("class").isNotNull(), tk.value_id(F.col("class"), model.class_values))
    blank = F.lit(_BLANK_ID).cast("smallint")
    # ``type_expr`` with ids of classes: a token that spells a class name counts as it.
    label = F.when(tk.is_blank(token), blank).otherwise(F.coalesce(listed, tk.type_expr(token, model, emit, raw)))
    return joined.groupBy(*keys, label.alias(_ID)).agg(F.sum("n_tokens").alias("n_tokens"))


def shape_profile(df: DataFrame, col: str, model, k: int) -> DataFrame:
    """``(shape, n_rows, example)``: the k commonest class sequences.

    A shape is written as its class names, ``(raw)`` for tokens that stand for
    themselves and one space for a blank token. The example is the smallest text.

    Two passes. The first counts by a 128-bit hash of the shape, with the first bytes of the smallest
    text as a number: columns of fixed width, so a hash aggregate, and no text is shuffled. That gives the
    border of the k first, ties kept. The second sees shapes and texts within the border only.
    """
    source = shape_source(df.select(col), col, model)
    shaped = source.df.select(source.shape(source.tokens).alias(SHAPE), source.raw.alias(RAW))
    keyed = shaped.select(
        F.xxhash64(SHAPE).alias(_H1), F.xxhash64(F.lit(1), SHAPE).alias(_H2), SHAPE, RAW,
        _first_bytes(F.col(RAW)).alias(_FIRST),
    )
    counted = keyed.select(_H1, _H2, _FIRST).groupBy(_H1, _H2)
    # NULL texts are one group, left out by its count.
    counts = counted.agg(F.count(_FIRST).alias("n_rows"), F.min(_FIRST).alias(_FIRST)).where("n_rows > 0")
    within = _within_border(counts, k)
    # Only texts that begin as their group's smallest. A set of one shape is gathered by hash, without a sort.
    found = keyed.join(within, [_H1, _H2, _FIRST]).groupBy(_H1, _H2, "n_rows").agg(
        F.collect_set(SHAPE).alias(SHAPE), F.min(RAW).alias("example")
    )
    top = found.orderBy(F.desc("n_rows"), "example").limit(k)
    return top.select(_readable(F.get(SHAPE, F.lit(0)), model).alias("shape"), "n_rows", "example")


def _within_border(counts: DataFrame, k: int) -> DataFrame:
    """Hashes and counts of the k first groups, and of all that are tied with the last of these."""
    spark = counts.sparkSession
    fields = [_H1, _H2, _FIRST, "n_rows"]
    # k rows of four numbers, and one more to see whether the last is tied.
    head = counts.orderBy(F.desc("n_rows"), _FIRST).limit(k + 1).collect()
    place = lambda row: (row.n_rows, row[_FIRST])
    sure = head if len(head) <= k else [row for row in head if place(row) != place(head[k])]
    rows = spark.createDataFrame([tuple(row[f] for f in fields) for row in sure], counts.select(*fields).schema)
    if len(head) <= k or len(sure) == k:
        return F.broadcast(rows) if k <= BROADCAST_ROWS else rows
    n, first = place(head[k])
    tied = counts.where((F.col("n_rows") == n) & (F.col(_FIRST) == first)).select(*fields)
    return _broadcast_if_small(written_once(rows.unionAll(tied), "border"))


def _first_bytes(text: Column) -> Column:
    """The first seven bytes as a number: of two texts the smaller has no larger one."""
    head = F.hex(F.substring(F.encode(text, "UTF-8"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("bigint")


def _readable(shape: Column, model) -> Column:
    names = F.array(*[F.lit(v) for v in model.class_values])
    place = lambda char: F.ascii(char) - F.lit(tk.SHAPE_BASE)
    return F.array_join(
        F.transform(
            F.split(shape, ""),
            lambda char: F.when(char == tk.SHAPE_BLANK, " ")
            .when(char == tk.SHAPE_UNKNOWN, RAW_LABEL)
            .otherwise(F.get(names, place(char))),
        ),
        "",
    )


def _broadcast_if_small(table: DataFrame) -> DataFrame:
    """With a broadcast hint if a count shows few rows; else the join shuffles, with the same result.

    ``table`` is read from files, so that counting it costs little."""
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(table) if few else table


def unknown_tokens(
    df: DataFrame,
    col: str,
    model,
    k: int,
    key: str | None = None,
    by: str | list[str] | None = None,
    level: str = "type",
    prune: bool = False,
) -> DataFrame:
    """``(by…, token, n_tokens[, n_keys])``: the k commonest tokens the model has no name for.

    ``level="type"`` asks for tokens whose type is the token itself, ``"class"`` leaves
    out those that a word list covers. ``n_keys`` counts the distinct keys they occur in.
    With ``by`` there are k tokens per group. ``prune`` writes the unknown tokens of each row once, reads them
    three times and shuffles only tokens that may be among the first k; the result is the same.
    """
    if level not in ("type", "class"):
        raise ValueError(f"unknown level {level!r}, expected type or class")
    keys = _names(by)
    arrays = _unknown_arrays(df, col, model, list(dict.fromkeys([*keys, *_names(key)])), level)
    if prune:
        # Read three times, so the rules run once and only the tokens they leave are written. Rows without one
        # are written too: a filter on the array would be pushed below it, and the rules would run twice.
        arrays = written_once(arrays, "unknown")
    each = arrays.select(*keys, F.explode_outer(_UNKNOWN).alias("token")).where("token IS NOT NULL")
    counts = _pruned_counts(each, keys, k) if prune else _token_counts(each, keys)
    top = _first_k(counts, keys, k)
    if key is None:
        return top
    top = written_once(top, "tokens")
    # A token is unknown wherever it stands, so the first ones are found again without the rules.
    names = [row[0] for row in top.select(element_name(F.col("token"))).distinct().limit(LISTED + 1).collect()]
    if len(names) <= LISTED:
        tokens = F.col(_UNKNOWN)
        if not prune:
            arrays, tokens = df, tk.maybe_unknown_col(string_column(df, col), model)
        tokens = F.filter(tokens, lambda t: element_name(t).isin(names))
        arrays = arrays.select(*[F.col(f"`{name}`") for name in dict.fromkeys([*keys, key])], tokens.alias(_UNKNOWN))
    return _with_n_keys(top, arrays, keys, key)


def _unknown_arrays(df: DataFrame, col: str, model, keep: list[str], level: str) -> DataFrame:
    """``keep`` and the array of each row's unknown tokens."""
    vocab = model.type_values if level == "type" else model.class_values
    if not model.inline and level == "class":
        arrays = _arrays(df, col, model, *keep)
        pairs = F.arrays_zip(f"{_STRUCT}.tokens", f"{_STRUCT}.classes")
        unknown = F.transform(
            F.filter(
                pairs,
                lambda p: ~tk.is_blank(p["tokens"]) & (tk.value_id(p["classes"], vocab) == tk.RAW_ID),
            ),
            lambda p: p["tokens"],
        )
    else:
        arrays = df.select(*keep, tk.maybe_unknown_col(string_column(df, col), model).alias(TOKENS))

        def is_unknown(token: Column) -> Column:
            known = lambda _: F.lit(False)
            itself = lambda t: ~t.isin(list(vocab))
            if level == "class":
                return tk.class_expr(token, model, emit=known, raw=itself, blank=known)
            return ~tk.is_blank(token) & tk.type_expr(token, model, known, itself)

        unknown = F.filter(TOKENS, is_unknown)
    return arrays.select(*keep, unknown.alias(_UNKNOWN))


def _token_counts(each: DataFrame, keys: list[str]) -> DataFrame:
    return each.groupBy(*keys, "token").agg(F.count("*").alias("n_tokens"))


def _first_k(counts: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = [F.desc("n_tokens"), F.col("token")]
    if not keys:
        return counts.orderBy(*order).limit(k)
    # The first k of each part of a group, then of the group, so that no task sorts all its tokens.
    counts = counts.withColumn(_PART, F.pmod(F.xxhash64("token"), F.lit(GROUP_PARTS)))
    for within in ([*keys, _PART], keys):
        rank = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        counts = counts.withColumn(_RANK, rank).where(F.col(_RANK) <= k)
    return counts.drop(_RANK, _PART)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality in which NULL is a group like others."""
    result = F.lit(True)
    for name in names:
        result = result & left[name].eqNullSafe(right[name])
    return result


def _pruned_counts(each: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Exact counts of all tokens that may be among the first k of their group.

    Tasks count by hash buckets, so what leaves them is bounded by the buckets. The tokens of the fullest
    buckets are counted exactly; the k-th of these is a lower bound of the k-th of all. Tokens in a
    bucket that holds less in all cannot reach it and stay in the task; the rest is counted exactly.
    """
    buckets = 1 << 16
    while buckets < BUCKETS_PER_TOKEN * k:
        buckets *= 2
    each = each.withColumn(_PART, F.pmod(F.xxhash64("token"), F.lit(buckets)))
    sums = written_once(each.groupBy(*keys, _PART).agg(F.count("*").alias("n")), "buckets")

    def counted(kept: DataFrame) -> DataFrame:
        kept = _broadcast_if_small(kept.select(*keys, _PART))
        # A bucket is never NULL.
        same = _same(each, kept, keys) & (each[_PART] == kept[_PART])
        return _token_counts(each.join(kept, same, "left_semi"), keys)

    within = Window.partitionBy(*keys)
    fullest = F.row_number().over(within.orderBy(F.desc("n"), _PART))
    ranked = written_once(sums.withColumn(_RANK, fullest), "ranked")
    lead = written_once(counted(ranked.where(F.col(_RANK) <= 2 * k)), "lead")
    kth = F.row_number().over(within.orderBy(F.desc("n_tokens"), "token"))
    # A group with fewer tokens has no bound, and all its buckets are counted.
    bound = lead.withColumn(_RANK, kth).where(F.col(_RANK) == k).select(*keys, F.col("n_tokens").alias(_BOUND))
    rest = ranked.where(F.col(_RANK) > 2 * k)
    bounded = rest.join(bound, _same(rest, bound, keys), "left").where(F.col("n") >= F.coalesce(_BOUND, F.lit(0)))
    survivors = written_once(bounded.select(*[rest[name] for name in [*keys, _PART]]), "survivors")
    return lead.unionByName(counted(survivors))


def _with_n_keys(top: DataFrame, arrays: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Add ``n_keys``: each key gets a bitmap of the first tokens it has, and bits are summed.

    Only bitmaps are shuffled, a row a key for 63 tokens, and none for a token and key; a hot key or token is
    combined in the task.
    """
    order = [F.desc("n_tokens"), F.col("token")]
    ranked = top.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    held = arrays.select(
        *[F.col(f"`{name}`") for name in dict.fromkeys([*keys, key])],
        F.explode_outer(F.array_distinct(_UNKNOWN)).alias("token"),
    ).where(F.col("token").isNotNull() & F.col(f"`{key}`").isNotNull())
    held = held.withColumn(_NAME, element_name(F.col("token"))).drop("token")
    known = _broadcast_if_small(ranked.select(*keys, element_name(F.col("token")).alias(_NAME), _RANK))
    met = held.join(known, _same(held, known, keys) & (held[_NAME] == known[_NAME])).select(
        *[held[name] for name in dict.fromkeys([*keys, key])],
        F.expr(f"{_RANK} DIV {WORD_BITS}").alias(_PART),
        F.expr(f"shiftleft(1L, {_RANK} % {WORD_BITS})").alias(_BIT),
    )
    maps = met.groupBy(*dict.fromkeys([*keys, key, _PART])).agg(F.bit_or(_BIT).alias(_BIT))
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda i: F.bit_get(_BIT, i) == 1)
    each = maps.select(*keys, _PART, F.explode(places).alias(_BIT))
    each = each.select(*keys, (F.col(_PART) * WORD_BITS + F.col(_BIT)).cast("int").alias(_RANK))
    sums = each.groupBy(*keys, _RANK).agg(F.count("*").alias("n_keys"))
    joined = ranked.join(sums, _same(ranked, sums, [*keys, _RANK]), "left")
    found = joined.select(
        *[ranked[name] for name in [*keys, "token", "n_tokens"]], F.coalesce("n_keys", F.lit(0)).alias("n_keys")
    )
    return found if keys else found.orderBy(*order)


def extraction_report(
    df: DataFrame,
    col: str,
    model,
    patterns: Sequence[tuple[str, str]],
    modes: Iterable[str] = ("whole",),
) -> DataFrame:
    """``(pattern, mode, n_rows, n_matched, n_complement)`` for ``(name, pattern)`` pairs.

    ``n_rows`` counts non-NULL texts, ``n_complement`` those with something left over.
    The table is tokenized once and read once for all patterns and modes.
    """
    modes = list(modes)
    cases = [(name, text, mode) for name, text in patterns for mode in modes]
    if not cases:
        raise ValueError("extraction_report needs at least one pattern and mode")
    regex = outline_regex([(text, mode) for _, text, mode in cases], model.class_values)
    source = shape_source(df.select(col), col, model)
    staged = source.df.select(source.shape(source.tokens).alias(SHAPE))
    staged = staged.withColumn(_CUT, cut_by(regex, 3 * len(cases), F.col(SHAPE)))
    aggregates = [F.count(SHAPE).alias("n_rows")]
    for i in range(len(cases)):
        before, match, after = (F.get(_CUT, F.lit(3 * i + j)) for j in range(3))
        around = (before != "") | (after != "")
        aggregates.append(F.count_if(match != "").alias(f"m{i}"))
        aggregates.append(F.count_if(F.when(match != "", around).otherwise(F.col(SHAPE) != "")).alias(f"c{i}"))
    counts = staged.agg(*aggregates)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("pattern"),
                F.lit(mode).alias("mode"),
                F.col("n_rows").alias("n_rows"),
                F.col(f"m{i}").alias("n_matched"),
                F.col(f"c{i}").alias("n_complement"),
            )
            for i, (name, _, mode) in enumerate(cases)
        ]
    )
    return counts.select(F.inline(rows))


def class_coverage(df: DataFrame, col: str, model, phrases: bool = False) -> DataFrame:
    """``(class, entry, status, n_tokens[, n_phrases])`` for every entry of the word lists.

    ``unreachable`` entries hold a blank, so no single token can equal them; others are
    ``used`` or ``unused``. With ``phrases`` unreachable entries of several tokens have in ``n_phrases`` how
    often their tokens stand in a row, overlaps included; for other entries it is NULL.
    """
    tokens = tk.tokens_col(string_column(df, col))
    if not model.inline:
        wanted = F.filter(tokens, lambda token: ~tk.cannot_be_listed(token, model))
    else:
        wanted = F.filter(tokens, lambda token: tk.is_listed(token, model))
    each = df.select(F.explode_outer(wanted).alias("token")).where(F.col("token").isNotNull())
    # One row per distinct token and per distinct entry: neither side has a hot key.
    counts = each.groupBy("token").agg(F.count("*").alias("n"))
    entries = model.classes.select("class", "entry")
    joined = entries.join(counts, F.col("entry") == F.col("token"), "left")
    unreachable = F.col("entry").rlike(r"[ \t\n\r\f]") | tk.is_blank(F.col("entry"))
    status = F.when(unreachable, "unreachable").when(F.col("n").isNull(), "unused").otherwise("used")
    found = joined.select(
        "class",
        "entry",
        status.alias("status"),
        F.when(unreachable, F.lit(0)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("n_tokens"),
    )
    if not phrases:
        return found
    runs = _phrase_counts(df, col, entries).withColumnRenamed("entry", "__tf_run")
    several = (F.col("status") == "unreachable") & (F.size(tk.tokens_col(F.col("entry"))) > 1)
    return found.join(runs, F.col("entry") == F.col("__tf_run"), "left").select(
        *found.columns, F.when(several, F.coalesce("n", F.lit(0))).alias("n_phrases")
    )


def _phrase_counts(df: DataFrame, col: str, entries: DataFrame) -> DataFrame:
    """``(entry, n)``: runs of tokens that spell an entry of several tokens.

    For each length that entries have, a row hashes the first and the last token of its runs of this length. Only
    runs whose hash is in a bitmap of the entries are spelled out, counted per task, and joined.
    """
    spelled = tk.tokens_col(F.col("entry"))
    listed = entries.select("entry", spelled.alias(TOKENS)).where(F.size(TOKENS) > 1).distinct()
    lengths = sorted(row[0] for row in listed.select(F.size(TOKENS)).distinct().collect())
    ends = lambda first, last, n: F.xxhash64(first, last, n)
    held = BitmapFilter.build(
        listed, ends(F.get(TOKENS, F.lit(0)), F.element_at(TOKENS, -1), F.size(TOKENS))
    )
    rows = df.select(tk.tokens_col(string_column(df, col)).alias(TOKENS))
    nothing = F.array().cast("array<string>")

    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(TOKENS) - n)
        if held is not None:
            starts = F.filter(
                starts, lambda i: held.may_hold(ends(F.get(TOKENS, i), F.get(TOKENS, i + (n - 1)), F.lit(n)))
            )
        texts = F.transform(starts, lambda i: F.array_join(F.slice(TOKENS, i + 1, F.lit(n)), ""))
        return F.when(F.size(TOKENS) >= n, texts).otherwise(nothing)

    runs = F.concat(nothing, *map(runs_of, lengths))
    each = rows.select(F.explode_outer(runs).alias("entry")).where(F.col("entry").isNotNull())
    return each.groupBy("entry").agg(F.count("*").alias("n"))


def check_tokenized(df: DataFrame, col: str, model) -> DataFrame:
    """``(check, bad_rows)`` over a tokenized struct column, in one aggregate.

    Checks that need a field the struct does not have are left out.
    """
    kind = df.schema[col].dataType
    if not isinstance(kind, T.StructType) or "tokens" not in kind.names:
        raise ValueError(f"column '{col}' must be a tokenized struct")
    have = set(kind.names)
    s = F.col(f"`{col}`")
    tokens = s["tokens"]
    lists = [n for n in ("types", "classes", "type_ids", "class_ids") if n in have]
    checks: dict[str, Column] = {}
    if "raw_value" in have:
        checks["tokens join to raw_value"] = F.array_join(tokens, "") != s["raw_value"]
    checks["tokens are not empty"] = F.array_contains(tokens, "")
    # A list whose type allows no NULL needs no look.
    checks["lists hold no NULL"] = _any(
        F.exists(s[name], lambda item: item.isNull()) for name in ["tokens", *lists] if kind[name].dataType.containsNull
    )
    if lists:
        checks["lists have one length"] = _any(F.size(s[n]) != F.size(tokens) for n in lists)
    others = [n for n in ("raw_value", *lists) if n in have]
    if others:
        checks["NULLs are consistent"] = _any(s[n].isNull() != tokens.isNull() for n in others)
    for ids, names, vocab in (
        ("type_ids", "types", model.type_values),
        ("class_ids", "classes", model.class_values),
    ):
        if ids in have and names in have:
            decoded = tk.decode_col(s[ids], tokens, vocab)
            checks[f"{ids} decode to {names}"] = decoded != s[names]
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("bad_rows"))
        for i, name in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _any(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result
