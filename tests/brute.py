"""The rules in plain Python, one row at a time, to test the columns against."""

from __future__ import annotations

import re

WHITE = "\t\n\x0b\x0c\r \x85\xa0                　"
DIGITS, LETTERS = set("0123456789"), set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def split(text: str) -> list[str]:
    tokens: list[str] = []
    for char in text:
        blank = char in " \t\n\r\f"
        if tokens and (tokens[-1][-1] in " \t\n\r\f") == blank:
            tokens[-1] += char
        else:
            tokens.append(char)
    return tokens


def type_of(token: str, definitions) -> str:
    names = [name for name, _ in definitions]
    chars = set(token)

    def only(allowed):
        return bool(chars) and chars <= allowed

    compact = [c for c in token if c not in "\t\n\x0b\x0c\r -_"]
    postal = len(compact) == 6 and all(
        c in (LETTERS if i % 2 == 0 else DIGITS) for i, c in enumerate(compact)
    )
    rules = [
        ("POSTALCODE", postal),
        ("NUM", only(DIGITS)),
        ("ALPHA", only(LETTERS)),
        ("NUM_EXTENDED", only(DIGITS | {"-"}) and chars & DIGITS),
        ("ALPHA_EXTENDED", only(LETTERS | {"-", "'"}) and chars & LETTERS),
        ("ALPHA_NUM", only(LETTERS | DIGITS) and chars & LETTERS and chars & DIGITS),
        (
            "ALPHA_NUM_EXTENDED",
            only(LETTERS | DIGITS | {"-", "'"}) and chars & LETTERS and chars & DIGITS,
        ),
    ]
    if token:
        for name, hit in rules:
            if hit and name in names:
                return name
        for name, regex in definitions:
            if re.search(regex, token):
                return name
    return token


def class_of(token: str, definitions, lists) -> str:
    if all(c in WHITE for c in token):
        return token
    for name, words in lists.items():
        if token in words:
            return name
    return type_of(token, definitions)


def elements_of(pattern: str):
    found = []
    for part in re.findall(r"<<.*?>>| +", pattern):
        if part.startswith(" "):
            found.append((None, None, False))
        elif "::" in part:
            name, cls = part[2:-2].split("::")
            found.append((name, cls, False))
        else:
            many = part.endswith("+>>")
            body = part[2:-2].rstrip("+")
            found.append((body[:-1], {"#": "NUM", "@": "ALPHA"}[body[-1]], many))
    return found


def ways(elements, classes, at):
    """Every way to match from a place, greediest first, as lists of (start, end)."""
    if not elements:
        yield []
        return
    _, cls, many = elements[0]

    def is_hit(i):
        if i >= len(classes):
            return False
        blank = all(c in WHITE for c in classes[i])
        return blank if cls is None else classes[i] == cls

    if not is_hit(at):
        return
    ends = [at + 1]
    if many:
        while (
            ends[-1] + 1 < len(classes)
            and all(c in WHITE for c in classes[ends[-1]])
            and is_hit(ends[-1] + 1)
        ):
            ends.append(ends[-1] + 2)
    for end in reversed(ends):
        for rest in ways(elements[1:], classes, end):
            yield [(at, end), *rest]


def extract(tokens, classes, pattern: str, mode: str):
    """Fields by name and the complement."""
    elements = elements_of(pattern)
    starts = [0] if mode in ("whole", "start") else range(len(tokens) + 1)
    for start in starts:
        for way in ways(elements, classes, start):
            if mode in ("whole", "end") and way[-1][1] != len(tokens):
                continue
            fields = {}
            for (name, _, _), (a, b) in zip(elements, way, strict=True):
                if name:
                    fields.setdefault(name, "".join(tokens[a:b]))
            return fields, "".join(tokens[: way[0][0]] + tokens[way[-1][1] :])
    names = {name: None for name, _, _ in elements if name}
    return names, "".join(tokens)
