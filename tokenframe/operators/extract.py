"""Extract named fields from a text or tokenized column of a table.

Each row's classes become a *shape*, one character per token, so that a place in the
shape is a place in the token array. A pattern becomes one regex over shapes whose
groups tile the match without gaps; the groups' lengths then cut the token array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import tokens as tk
from ..functions.patterns import COMPLEMENT, ShapePattern, capture_field_names, first_regex, shape_pattern
from .tokenize import string_column, tokenize

_STRUCT, _TOKENS, _MATCH = "__tf_struct", "__tf_tokens", "__tf_match"
_BORDER = "|"  # no shape character


def extract_schema(pattern: str) -> T.StructType:
    """Fields that a pattern gives: its captures, then what is left over."""
    names = [*capture_field_names(pattern), COMPLEMENT]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def extract(
    df: DataFrame,
    col: str,
    model,
    pattern: str,
    mode: str = "whole",
    out: str | None = None,
) -> DataFrame:
    """Replace ``col`` (or add ``out``) by a struct of the captures and ``complement``.

    ``col`` is a string, or a tokenized struct with ``tokens`` and ``classes`` or
    ``class_ids``. ``mode`` is ``whole``, ``start``, ``end`` or ``any``. Without a match
    the captures are NULL and the complement is the whole text; a NULL row gives NULLs.
    """
    compiled = shape_pattern(pattern, model.class_values, mode)
    source = shape_source(df, col, model)

    staged = source.df.withColumn(_TOKENS, source.tokens)
    tokens = F.col(_TOKENS)
    matched = _with_one(
        staged,
        _MATCH,
        F.array(
            F.struct(
                tokens.alias("tokens"),
                match_parts(compiled, source.shape(tokens)).alias("parts"),
            )
        ),
    )
    tokens, parts = F.col(f"{_MATCH}.tokens"), F.col(f"{_MATCH}.parts")
    values = captures(compiled, tokens, parts)
    fields = [values[name].alias(name) for name, _ in compiled.fields]
    fields.append(leftover(source.raw, tokens, parts).alias(COMPLEMENT))
    return matched.withColumn(out or col, F.struct(*fields)).drop(_MATCH, _TOKENS, _STRUCT)


def extract_first(
    df: DataFrame,
    col: str,
    model,
    patterns: Iterable[tuple[str, str] | tuple[str, str, str]],
    out: str | None = None,
) -> DataFrame:
    """Try ``(name, pattern[, mode])`` in order and keep the first that matches.

    The struct has ``pattern`` (the name, NULL without a match), the fields of all
    patterns and ``complement``. All patterns read one shape.
    """
    rules = [(rule[0], rule[1], rule[2] if len(rule) > 2 else "whole") for rule in patterns]
    if not rules:
        raise ValueError("extract_first needs at least one pattern")
    compiled = [shape_pattern(text, model.class_values, mode) for _, text, mode in rules]
    names = list(dict.fromkeys(name for c in compiled for name, _ in c.fields))
    if len({n.lower() for n in names} | {"pattern"}) <= len(names):
        raise ValueError(f"field names collide (case is ignored, 'pattern' is taken): {names}")

    source = shape_source(df, col, model)
    nothing = F.lit(None).cast("string")

    def struct(rule: str | None, values: dict[str, Column], rest: Column) -> Column:
        return F.struct(
            (nothing if rule is None else F.lit(rule)).alias("pattern"),
            *[values.get(name, nothing).alias(name) for name in names],
            rest.alias(COMPLEMENT),
        )

    # All rules in one regex: the first that matches fills its groups, the others stay empty.
    places = [1 + sum(c.groups for c in compiled[:i]) for i in range(len(compiled))]

    def fields(i: int, tokens: Column, parts: Column) -> Column:
        own = F.slice(parts, places[i], compiled[i].groups)
        return let(
            own,
            lambda p: struct(rules[i][0], captures(compiled[i], tokens, p), leftover(source.raw, tokens, p)),
        )

    def outcome(tokens: Column, parts: Column) -> Column:
        chain = F
        for i, place in enumerate(places):
            # The group of the first element, which is never empty in a match.
            hit = is_match(parts) & (F.get(parts, F.lit(place)) != "")
            chain = chain.when(hit, fields(i, tokens, parts))
        return chain.otherwise(struct(None, {}, source.raw))

    def found(tokens: Column) -> Column:
        cut = cut_by(first_regex(compiled), sum(c.groups for c in compiled), source.shape(tokens))
        return let(cut, lambda parts: outcome(tokens, parts))

    one = F.transform(F.array(source.tokens), found)
    return _with_one(source.df, out or col, one).drop(_STRUCT)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_one(df: DataFrame, out: str, one: Column) -> DataFrame:
    """Add the element of an array of exactly one, in place of a column of that name.

    It comes out of an explode. Spark copies a plain column's expression into every filter
    on it that it pushes down, and would then match each text again for each condition;
    filters on other columns still go to the scan.
    """
    element = F.explode_outer(one).alias(out)
    names = df.columns if out in df.columns else [*df.columns, out]
    return df.select(*[element if name == out else F.col(f"`{name}`") for name in names])


@dataclass(frozen=True)
class ShapeSource:
    """Where texts, token arrays and shapes come from; ``shape`` takes the token array."""

    df: DataFrame
    raw: Column
    tokens: Column
    shape: Callable[[Column], Column]


def shape_source(df: DataFrame, col: str, model) -> ShapeSource:
    kind = df.schema[col].dataType
    if isinstance(kind, T.StructType):
        return _shape_from_struct(df, col, kind, model)
    text = string_column(df, col)
    if not model.inline:
        staged = tokenize(df, col, model, out=_STRUCT, raw_value=False, types=False)
        classes = F.col(f"{_STRUCT}.classes")
        return ShapeSource(
            staged,
            text,
            F.col(f"{_STRUCT}.tokens"),
            lambda _: tk.shape_of_classes(classes, model),
        )
    return ShapeSource(
        df, text, tk.tokens_col(text), lambda tokens: tk.shape_of_tokens(tokens, model)
    )


def _shape_from_struct(df: DataFrame, col: str, kind: T.StructType, model) -> ShapeSource:
    """Shape of a tokenized struct. Errors sit inside the shape, as every output needs it."""
    _check_struct(col, kind)
    have = set(kind.names)
    struct = F.col(f"`{col}`")
    tokens = struct["tokens"]
    raw = struct["raw_value"] if "raw_value" in have else F.lit(None).cast("string")
    # Lists the shape may come from, first choice first; ids count where classes are NULL.
    sources = []
    if "classes" in have:
        classes = struct["classes"]
        sources.append((classes, tk.shape_of_classes(classes, model)))
    if "class_ids" in have:
        ids = struct["class_ids"]
        sources.append((ids, tk.shape_of_ids(ids, tokens, model)))

    def problem(message: str) -> Column:
        return F.raise_error(F.lit(f"tokenized column '{col}': {message}")).cast("string")

    def has_null(array: Column) -> Column:
        return F.exists(array, lambda item: item.isNull())

    all_null = tokens.isNull() & raw.isNull()
    for values, _ in sources:
        all_null = all_null & values.isNull()
    chain = F.when(all_null, F.lit(None).cast("string"))
    chain = chain.when(tokens.isNull(), problem("inconsistent NULLs across fields"))
    chain = chain.when(has_null(tokens), problem("list values may not be NULL"))
    for values, shape in sources:
        usable = values.isNotNull()
        chain = chain.when(usable & has_null(values), problem("list values may not be NULL"))
        chain = chain.when(
            usable & (F.size(values) != F.size(tokens)), problem("lists of different lengths")
        )
        chain = chain.when(usable, shape)
    chain = chain.otherwise(problem("inconsistent NULLs across fields"))
    return ShapeSource(df, F.coalesce(raw, F.array_join(tokens, "")), tokens, lambda _: chain)


def _check_struct(col: str, kind: T.StructType) -> None:
    def is_list_of(name, *elements):
        found = kind[name].dataType
        return isinstance(found, T.ArrayType) and isinstance(found.elementType, elements)

    if "tokens" not in kind.names:
        raise ValueError(f"struct column '{col}' has {', '.join(kind.names)}, but no list of tokens ('tokens')")
    if "classes" not in kind.names and "class_ids" not in kind.names:
        raise ValueError(
            f"struct column '{col}' has {', '.join(kind.names)}; it needs 'classes' or 'class_ids' as well"
        )
    for name in ("tokens", "classes"):
        if name in kind.names and not is_list_of(name, T.StringType):
            raise ValueError(f"field '{name}' of '{col}' must be array<string>")
    if "class_ids" in kind.names and not is_list_of("class_ids", T.IntegralType):
        raise ValueError(f"field 'class_ids' of '{col}' must be an array of integers")
    if "raw_value" in kind.names and not isinstance(kind["raw_value"].dataType, T.StringType):
        raise ValueError(f"field 'raw_value' of '{col}' must be a string")


def match_parts(compiled: ShapePattern, shape: Column) -> Column:
    """The match cut into head, elements and tail; a single part without a match."""
    return cut_by(compiled.regex, compiled.groups, shape)


def cut_by(regex: str, groups: int, shape: Column) -> Column:
    """What the groups of a regex that covers the whole shape hold; the shape itself without a match."""
    borders = _BORDER.join(f"${i}" for i in range(1, groups + 1))
    return F.split(F.regexp_replace(shape, F.lit(regex), F.lit(borders)), f"\\{_BORDER}", -1)


def is_match(parts: Column) -> Column:
    return F.size(parts) > 1


def captures(compiled: ShapePattern, tokens: Column, parts: Column) -> dict[str, Column]:
    def text_of(group: int) -> Column:
        start = F.length(F.get(parts, F.lit(0)))
        for i in range(1, group):
            start = start + F.length(F.get(parts, F.lit(i)))
        count = F.length(F.get(parts, F.lit(group)))
        return F.when(is_match(parts), F.array_join(F.slice(tokens, start + 1, count), ""))

    return {name: text_of(group) for name, group in compiled.fields}


def leftover(raw: Column, tokens: Column, parts: Column) -> Column:
    """Text before and after the match; the whole text without a match, NULL for NULL.

    It is cut from the raw text by the lengths of the tokens outside the match, so it stays as written
    where tokens were normalised since. Where that changed a token's length, the head still counts
    from the start of the raw text and the tail from its end.
    """
    head = F.length(F.get(parts, F.lit(0)))
    tail = F.length(F.element_at(parts, -1))
    before = F.length(F.array_join(F.slice(tokens, F.lit(1), head), ""))
    after = F.length(F.array_join(F.slice(tokens, F.size(tokens) - tail + 1, tail), ""))
    cut = F.concat(F.left(raw, before), F.right(raw, after))
    return F.when(is_match(parts), cut).when(parts.isNotNull(), raw)
