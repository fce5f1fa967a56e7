"""Column expressions: split a text, type and classify a token, ids, shapes.

Everything here is a built-in Spark expression and looks at one row only, so it
works the same on batch and streaming DataFrames.

``model`` is a ``Model`` snapshot. Expressions that classify take ``emit``, which
turns a known name into a column, and ``raw``, which does so for a token that
stands for itself. The defaults give names; ids and shape characters come straight
from the same rules without building the names first.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The token rules of the supported model format.
SPLIT_PATTERN = r"[ \t\n\r\f]+|[^ \t\n\r\f]+"
BLANK_PATTERN = (
    r"^[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*\z"
)
FAST_RULES = {
    "POSTALCODE": (
        r"^[\s_-]*[A-Za-z][\s_-]*[0-9][\s_-]*[A-Za-z][\s_-]*[0-9]"
        r"[\s_-]*[A-Za-z][\s_-]*[0-9][\s_-]*\z"
    ),
    "NUM": r"^[0-9]+\z",
    "ALPHA": r"^[A-Za-z]+\z",
    "NUM_EXTENDED": r"^[0-9-]*[0-9][0-9-]*\z",
    "ALPHA_EXTENDED": r"^[A-Za-z'-]*[A-Za-z][A-Za-z'-]*\z",
    "ALPHA_NUM": r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+\z",
    "ALPHA_NUM_EXTENDED": r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9'-]+\z",
}
RAW_ID = 255
# Fast rules that a token meets by its characters alone.
PLAIN_RULES = {"ALPHA": "[A-Za-z]++", "NUM": "[0-9]++"}

# Any token that a fast rule matches consists of these.
FAST_CHARACTERS = r"^[A-Za-z0-9\s'_-]+\z"
COMMON_BLANKS = (" ", "\n", "  ", "\n\n", "\t", "\r\n")

# Shape alphabet, in Unicode's private use area: one character per token.
SHAPE_BASE = 0xE000
SHAPE_UNKNOWN = chr(0xE0FF)
SHAPE_BLANK = chr(0xE100)

Emit = Callable[[str], Column]
Raw = Callable[[Column], Column]


def _itself(token: Column) -> Column:
    return token


def tokens_col(text: Column) -> Column:
    """Split into maximal runs of blanks and of non-blanks; joining them gives the text."""
    return F.regexp_extract_all(text, F.lit(SPLIT_PATTERN), F.lit(0))


def maybe_unknown_col(text: Column, model) -> Column:
    """The tokens of a text that a model may have no name for, in order, and an empty one at its end.

    One regex steps over blanks and over plain words before a blank, so these never become tokens. Its parts
    are possessive: a long run of plain words is walked once, without recursion.
    """
    plain = "|".join(regex for name, regex in PLAIN_RULES.items() if name in model.names)
    known = rf"(?:(?:{plain})?+[ \t\n\r\f]++)*+"
    return F.regexp_extract_all(text, F.lit(rf"{known}([^ \t\n\r\f]*+)"), F.lit(1))


def is_blank(token: Column) -> Column:
    """All whitespace in the Unicode sense, or empty.

    Nearly all blanks are one space. Other whitespace is below ``!`` or outside ASCII,
    so most words are settled by comparing their first byte.
    """
    maybe = (token < F.lit("!")) | (token >= F.lit("\u0080"))
    return (token == " ") | (maybe & token.rlike(BLANK_PATTERN))


# Only a line feed ends a line: U+0085, U+2028 and U+2029 are characters like others.
UNIX_LINES = "(?d)"


def definition_type(token: Column, definitions, emit: Emit = F.lit) -> Column:
    """Name of the first definition whose regex is found in the token, else NULL."""
    return _first_match(token, definitions, emit)


def _first_match(token: Column, rules, emit: Emit, sure: bool = False) -> Column:
    """The first of the rules that matches, found by halving: one regex tells whether it is in the first half.

    With ``sure`` the caller knows that one of them matches, so the last one left needs no test.
    """
    rules = list(rules)
    if len(rules) == 1 and sure:
        return emit(rules[0][0])
    regexes = [regex for _, regex in rules]
    if len(rules) == 1 or not all(map(_combines, regexes)):
        chain = F
        for name, regex in rules:
            chain = chain.when(token.rlike(UNIX_LINES + regex), emit(name))
        return chain
    if not sure:
        return F.when(_matches_any(token, regexes), _first_match(token, rules, emit, True))
    half = len(rules) // 2
    first, second = (_first_match(token, part, emit, True) for part in (rules[:half], rules[half:]))
    return F.when(_matches_any(token, regexes[:half]), first).otherwise(second)


def _combines(regex: str) -> bool:
    """Does a regex keep its meaning inside an alternation?"""
    return not re.search(r"\\[1-9kQ]|\(\?[^:=!]", regex)


def _matches_any(token: Column, regexes) -> Column:
    """Does one of the regexes match? Those that do so at the start of a token only are tried there only."""
    anchored = [regex for regex in regexes if _is_anchored(regex)]
    others = [regex for regex in regexes if not _is_anchored(regex)]
    tests = []
    if anchored:
        tests.append(token.rlike(UNIX_LINES + r"\A(?:" + "|".join(anchored) + ")"))
    if others:
        tests.append(token.rlike(UNIX_LINES + "|".join(f"(?:{regex})" for regex in others)))
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def _is_anchored(regex: str) -> bool:
    """Every alternative begins with the start of the text; a regex that hides its alternatives does not count."""
    if "|" not in regex:
        return regex.startswith("^")
    return not re.search(r"[(\\]|\[[^\]]*\|", regex) and all(part.startswith("^") for part in regex.split("|"))


def known_type(token: Column, model, emit: Emit = F.lit, blanks: bool = True) -> Column:
    """Type of one token by the fast rules, then the definitions in order, else NULL.

    The fast rules are checked commonest first. ALPHA (letters only) and NUM (digits
    only) exclude each other and every rule before them, so order does not matter there.
    Usual blanks, half of all tokens, are answered from the model; with ``blanks=False``
    the caller has dealt with them.
    """
    on = {name: rule for name, rule in FAST_RULES.items() if name in model.names}
    nameless = [""]
    chain = F
    if blanks:
        nameless += [blank for blank, name in model.blank_types if name is None]
        for blank, name in model.blank_types:
            if name is not None:
                chain = chain.when(token == blank, emit(name))
    # All of these come before the exclamation mark, and most words do not.
    chain = chain.when((token < F.lit("!")) & token.isin(nameless), F.lit(None))
    if "ALPHA" in on:
        chain = chain.when(token.rlike(on.pop("ALPHA")), emit("ALPHA"))
    if "NUM" in on:
        # A digit comes before the colon; most words do not, and skip the regex.
        chain = chain.when((token < F.lit(":")) & token.rlike(on.pop("NUM")), emit("NUM"))
    definitions = _first_match(token, model.definitions, emit)
    if not on:
        return chain.otherwise(definitions)
    fast = _first_match(token, [*on.items(), *model.definitions], emit)
    return chain.when(token.rlike(FAST_CHARACTERS), fast).otherwise(definitions)


def type_expr(token: Column, model, emit: Emit = F.lit, raw: Raw = _itself) -> Column:
    """Type of one token; what has no other type stands for itself."""
    return F.coalesce(known_type(token, model, emit), raw(token))


def is_listed(token: Column, model) -> Column:
    if model.entries is None:
        return model.word_table.lookup(token).isNotNull()
    words = [word for _, listed in model.entries for word in listed]
    return token.isin(words) if words else F.lit(False)


def listed_class(token: Column, model, emit: Emit = F.lit) -> Column:
    """Class whose word list holds the token exactly, else NULL."""
    if model.entries is None:
        found = model.word_table.lookup(token)
        return found if emit is F.lit else _emitted(found, model.class_names, emit)
    lists = [(name, list(words)) for name, words in model.entries if words]
    if not lists:
        return F.lit(None)
    chain = F
    for name, words in lists:
        chain = chain.when(token.isin(words), emit(name))
    # Most tokens are in no list: one probe tells.
    return chain if len(lists) == 1 else F.when(is_listed(token, model), chain)


def _emitted(name: Column, names, emit: Emit) -> Column:
    """Looked up by place, so that the name itself is worked out once."""
    values = F.array(*[emit(known) for known in names])
    return F.get(values, (F.array_position(F.array(*map(F.lit, names)), name) - 1).cast("int"))


def class_expr(
    token: Column,
    model,
    type_of: Column | None = None,
    emit: Emit = F.lit,
    raw: Raw = _itself,
    blank: Raw | None = None,
) -> Column:
    """Class of one token: itself if blank, else its word list, else its type."""
    listed = listed_class(token, model, emit)
    if type_of is None:
        named = F.coalesce(listed, known_type(token, model, emit, blanks=False), raw(token))
    else:
        named = F.coalesce(listed, type_of)
    return F.when(is_blank(token), (blank or raw)(token)).otherwise(named)


def element_hash(token: Column) -> Column:
    """By which a bitmap of word lists is asked for a token."""
    return F.xxhash64(token)


def cannot_be_listed(token: Column, model) -> Column:
    """Blank, or not in the model's bitmap of entries, where it has one."""
    blank = is_blank(token)
    return blank if model.word_filter is None else blank | ~model.word_filter.may_hold(element_hash(token))


def value_id(value: Column, vocab) -> Column:
    place = F.array_position(F.array(*[F.lit(v) for v in vocab]), value)
    return F.when(place > 0, place - 1).otherwise(RAW_ID).cast("smallint")


def encode_col(values: Column, vocab) -> Column:
    """Ids of an array of names; what is not in the vocabulary becomes 255."""
    return F.transform(values, lambda value: value_id(value, vocab))


def decode_col(ids: Column, tokens: Column, vocab) -> Column:
    """Names for ids; 255 and ids outside the vocabulary give the token at that place."""
    names = F.array(*[F.lit(v) for v in vocab])
    return F.zip_with(
        ids, tokens, lambda i, token: F.coalesce(F.when(i >= 0, F.get(names, i.cast("int"))), token)
    )


def emit_id(vocab) -> tuple[Emit, Raw]:
    """``emit`` and ``raw`` that give ids. A raw token may happen to spell a known name."""
    place = {value: i for i, value in enumerate(vocab)}
    return (
        lambda name: F.lit(place[name]).cast("smallint"),
        lambda token: F.when(spells_one(token, vocab), value_id(token, vocab)).otherwise(
            F.lit(RAW_ID).cast("smallint")
        ),
    )


def spells_one(token: Column, vocab) -> Column:
    """Is the token one of the names? Blanks and most words lie before or behind all of them."""
    if not vocab:
        return F.lit(False)
    return (token >= F.lit(vocab[0])) & (token <= F.lit(vocab[-1])) & token.isin(list(vocab))


def class_id_expr(token: Column, model, type_id: Column) -> Column:
    """Id of a token's class, where the id of its type is known: listed, or the type's place among the classes."""
    vocab = model.class_values
    emit, raw = emit_id(vocab)
    place = {value: i for i, value in enumerate(vocab)}
    places = F.array(*[F.lit(place[name]).cast("smallint") for name in model.type_values])
    of_type = F.when(type_id != RAW_ID, F.get(places, type_id.cast("int")))
    named = F.coalesce(listed_class(token, model, emit), of_type, raw(token))
    return F.when(is_blank(token), raw(token)).otherwise(named)


def shape_char(place: int) -> str:
    return chr(SHAPE_BASE + place)


def class_char(name: Column, vocab) -> Column:
    """Shape character of a class name."""
    chars = F.array(*[F.lit(c) for c in [SHAPE_UNKNOWN, *map(shape_char, range(len(vocab)))]])
    place = F.array_position(F.array(*[F.lit(v) for v in vocab]), name)
    return F.when(is_blank(name), SHAPE_BLANK).otherwise(F.get(chars, place.cast("int")))


def shape_of_tokens(tokens: Column, model) -> Column:
    """One character per token, for its class."""
    vocab = model.class_values
    place = {value: i for i, value in enumerate(vocab)}

    def raw(token):
        known = F.when(token.isin(list(vocab)), class_char(token, vocab))
        return known.otherwise(SHAPE_UNKNOWN)

    def char(token):
        return class_expr(
            token,
            model,
            emit=lambda name: F.lit(shape_char(place[name])),
            raw=raw,
            blank=lambda _: F.lit(SHAPE_BLANK),
        )

    return F.array_join(F.transform(tokens, char), "")


def shape_of_classes(classes: Column, model) -> Column:
    vocab = model.class_values
    return F.array_join(F.transform(classes, lambda c: class_char(c, vocab)), "")


def shape_of_ids(ids: Column, tokens: Column, model) -> Column:
    return shape_of_classes(decode_col(ids, tokens, model.class_values), model)
