"""Tokenize a text column of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import tokens as tk
from .lookup import lookup_by_join

_TOKENS, _TYPES, _CLASSES = "__tf_tokens", "__tf_types", "__tf_classes"
_TYPE_IDS, _CLASS_IDS = "__tf_type_ids", "__tf_class_ids"
_LISTED, _STRUCT = "__tf_listed", "__tf_struct"
_STRINGS = T.ArrayType(T.StringType())
_IDS = T.ArrayType(T.ShortType())


def tokenize_schema(
    raw_value: bool = True,
    types: bool = True,
    classes: bool = True,
    type_ids: bool = False,
    class_ids: bool = False,
    token_output: str = "string",
    type_output: str = "string",
    class_output: str = "string",
) -> T.StructType:
    """Fields of the tokenized struct for these options, in order."""
    for option in (token_output, type_output, class_output):
        if option == "enum":
            raise ValueError("enum list output is not supported; use 'string' or 'categorical'")
        if option not in ("string", "categorical"):
            raise ValueError(f"unknown list output {option!r}; use 'string' or 'categorical'")
    wanted = [
        ("raw_value", T.StringType(), raw_value),
        ("tokens", _STRINGS, True),
        ("types", _STRINGS, types),
        ("classes", _STRINGS, classes),
        ("type_ids", _IDS, type_ids),
        ("class_ids", _IDS, class_ids),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind, on in wanted if on])


def string_column(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    if not isinstance(kind, T.StringType):
        raise ValueError(f"column '{col}' must be a string, got {kind.simpleString()}")
    return F.col(f"`{col}`")


def tokenize(
    df: DataFrame,
    col: str,
    model,
    out: str | None = None,
    raw_value: bool = True,
    types: bool = True,
    classes: bool = True,
    type_ids: bool = False,
    class_ids: bool = False,
    token_output: str = "string",
    type_output: str = "string",
    class_output: str = "string",
    lookup: str | None = None,
) -> DataFrame:
    """Replace ``col`` (or add ``out``) by a struct with one array element per token.

    A NULL text gives a struct of NULLs. ``categorical`` lists are plain string
    arrays, which Parquet stores dictionary-encoded; ``dictionary_encode`` makes the
    dictionary explicit. ``lookup`` is ``inline`` (word lists as literals in the plan,
    no shuffle, also on streams) or ``join`` (word lists of any length, batches only); by
    default it is what the model was built for.
    """
    schema = tokenize_schema(
        raw_value, types, classes, type_ids, class_ids, token_output, type_output, class_output
    )
    text = string_column(df, col)
    lookup = lookup or ("inline" if model.inline else "join")
    if lookup not in ("inline", "join"):
        raise ValueError(f"unknown lookup {lookup!r}, expected inline or join")
    if lookup == "inline" and not model.inline:
        raise ValueError("the model was built with lookup='join', so its lists are too long for lookup='inline'")

    needs_classes = classes or class_ids
    by_join = lookup == "join" and needs_classes
    # What is found by join is there first, so that the join moves the text and no arrays of it.
    found = _listed_by_join(df, col, model) if by_join else df
    # One staged column per array: used several times below, computed once per row.
    staged = found.withColumn(_TOKENS, tk.tokens_col(text))
    # Where ids and names are both wanted, the rules give ids, which are cheap to turn into names.
    if types:
        if type_ids:
            staged = staged.withColumn(_TYPE_IDS, _ids_of_types(model))
            names = tk.decode_col(F.col(_TYPE_IDS), F.col(_TOKENS), model.type_values)
        else:
            names = F.transform(_TOKENS, lambda token: tk.type_expr(token, model))
        staged = staged.withColumn(_TYPES, names)
    if by_join:
        staged = staged.withColumn(_CLASSES, _classes_with_listed(model, types)).drop(_LISTED)
    elif classes and class_ids:
        staged = staged.withColumn(
            _CLASS_IDS,
            F.zip_with(_TOKENS, _TYPE_IDS, lambda token, kind: tk.class_id_expr(token, model, kind))
            if types and type_ids
            else _ids_of_classes(model),
        )
        names = tk.decode_col(F.col(_CLASS_IDS), F.col(_TOKENS), model.class_values)
        staged = staged.withColumn(_CLASSES, names)
    elif classes and types:
        staged = staged.withColumn(
            _CLASSES,
            F.zip_with(_TOKENS, _TYPES, lambda token, kind: tk.class_expr(token, model, kind)),
        )
    elif classes:
        staged = staged.withColumn(
            _CLASSES, F.transform(_TOKENS, lambda token: tk.class_expr(token, model))
        )

    values = {
        "raw_value": text,
        "tokens": F.col(_TOKENS),
        "types": F.col(_TYPES),
        "classes": F.col(_CLASSES),
    }
    if type_ids:
        values["type_ids"] = F.col(_TYPE_IDS) if types else _ids_of_types(model)
    if class_ids and by_join:
        values["class_ids"] = tk.encode_col(F.col(_CLASSES), model.class_values)
    elif class_ids:
        values["class_ids"] = F.col(_CLASS_IDS) if classes else _ids_of_classes(model)
    struct = F.struct(*[values[field.name].alias(field.name) for field in schema])
    return staged.withColumn(out or col, struct).drop(_TOKENS, _TYPES, _CLASSES, _TYPE_IDS, _CLASS_IDS)


def _ids_of_types(model) -> Column:
    emit, raw = tk.emit_id(model.type_values)
    return F.transform(_TOKENS, lambda token: tk.type_expr(token, model, emit, raw))


def _ids_of_classes(model) -> Column:
    emit, raw = tk.emit_id(model.class_values)
    return F.transform(_TOKENS, lambda token: tk.class_expr(token, model, emit=emit, raw=raw))


def _listed_by_join(df: DataFrame, col: str, model) -> DataFrame:
    """Classes of the tokens in word lists, for tokens that may be in one."""
    skip = lambda token: tk.cannot_be_listed(token, model)
    return lookup_by_join(df, col, tk.tokens_col, model.classes, "entry", "class", _LISTED, skip, few=True)


def _classes_with_listed(model, typed: bool) -> Column:
    # What is found comes in blocks and may end behind the last token.
    listed = F.slice(_LISTED, F.lit(1), F.size(_TOKENS))
    if not typed:
        # Only tokens that are in no list take the rules.
        unlisted = lambda token: F.when(tk.is_blank(token), token).otherwise(tk.type_expr(token, model))
        return F.zip_with(_TOKENS, listed, lambda token, hit: F.coalesce(hit, unlisted(token)))
    types = F.zip_with(
        _TOKENS, _TYPES, lambda token, kind: F.when(tk.is_blank(token), token).otherwise(kind)
    )
    return F.zip_with(types, listed, lambda other, hit: F.coalesce(hit, other))


def tokens_long(df: DataFrame, key: str | list[str], col: str, model) -> DataFrame:
    """A row per token: ``(key…, pos, token, type, class)``.

    A row whose text is NULL or empty stays as one row with NULLs.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not model.inline:
        return _tokens_long_from_arrays(df, keys, col, model)
    # Only keys and tokens go through the explode; types are worked out after it, where
    # they are part of generated code. The outer form also keeps Spark from adding a
    # non-empty check that would split each text again.
    tokens = df.select(*keys, tk.tokens_col(string_column(df, col)).alias(_TOKENS))
    rows = tokens.select(*keys, F.posexplode_outer(_TOKENS).alias("pos", "token"))
    token = F.col("token")
    return rows.withColumn("type", tk.type_expr(token, model)).withColumn(
        "class", F.when(token.isNotNull(), tk.class_expr(token, model, F.col("type")))
    )


def _tokens_long_from_arrays(df, keys, col, model):
    rows = tokenize(df.select(*keys, col), col, model, out=_STRUCT, raw_value=False)
    zipped = F.arrays_zip(f"{_STRUCT}.tokens", f"{_STRUCT}.types", f"{_STRUCT}.classes")
    long = rows.select(*keys, F.posexplode_outer(zipped).alias("pos", "t"))
    return long.select(
        *keys,
        "pos",
        F.col("t.tokens").alias("token"),
        F.col("t.types").alias("type"),
        F.col("t.classes").alias("class"),
    )
