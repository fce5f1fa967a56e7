"""Turn a pattern argument into a regex over shapes.

A pattern is a sequence of elements and spaces:

=====================  ======================================================
``<<NAME#>>``          one token of class NUM
``<<NAME@>>``          one token of class ALPHA
``<<NAME::CLASS>>``    one token of class CLASS
``#+`` or ``@+``       one or more such tokens, one blank token between each two
a space                one blank token of any length, in no field
=====================  ======================================================

The name may be left out: the element then matches but gives no field. A name used
twice gives one field, filled by its first use.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from .tokens import SHAPE_BLANK, shape_char

MODES = ("whole", "start", "end", "any")
COMPLEMENT = "complement"

_ELEMENT = re.compile(
    r"<<(?P<name>[A-Za-z_][A-Za-z0-9_]*)?(?:(?P<kind>[#@])(?P<many>\+)?|::(?P<cls>[^<>:+\s]+))>>"
)
_KINDS = {"#": "NUM", "@": "ALPHA"}


@dataclass(frozen=True)
class Element:
    """One pattern element; ``cls`` is None for a space."""

    cls: str | None
    name: str | None = None
    many: bool = False


@dataclass(frozen=True)
class ShapePattern:
    """A regex over shapes whose groups tile the match: head, each element, tail."""

    regex: str
    groups: int
    fields: tuple[tuple[str, int], ...]


def parse_pattern(pattern: str) -> list[Element]:
    if not isinstance(pattern, str) or not pattern.strip(" "):
        raise ValueError(f"pattern {pattern!r} has no element")
    elements: list[Element] = []
    at = 0
    while at < len(pattern):
        if pattern[at] == " ":
            at += len(pattern[at:]) - len(pattern[at:].lstrip(" "))
            elements.append(Element(None))
            continue
        found = _ELEMENT.match(pattern, at)
        if found is None:
            raise ValueError(f"unsupported syntax in pattern {pattern!r} at {pattern[at:]!r}")
        cls = found["cls"] or _KINDS[found["kind"]]
        elements.append(Element(cls, found["name"], bool(found["many"])))
        at = found.end()
    return elements


def capture_field_names(pattern: str) -> list[str]:
    """Names of the fields a pattern gives, in order of first use."""
    names = list(dict.fromkeys(e.name for e in parse_pattern(pattern) if e.name))
    folded = [name.lower() for name in names]
    if len(set(folded)) < len(folded) or COMPLEMENT in folded:
        raise ValueError(
            f"field names of pattern {pattern!r} collide (case is ignored, "
            f"'{COMPLEMENT}' is taken): {names}"
        )
    return names


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    return mode


def shape_pattern(pattern: str, class_values, mode: str = "whole") -> ShapePattern:
    """Compile for a class vocabulary. Only the argument text is looked at, no data."""
    names = capture_field_names(pattern)
    elements = parse_pattern(pattern)
    head, body, tail = _regexes(pattern, elements, class_values, mode)
    first = {}
    for group, element in enumerate(elements, start=1):
        if element.name:
            first.setdefault(element.name, group)
    return ShapePattern(
        regex=head + "".join(f"({part})" for part in body) + tail,
        groups=len(elements) + 2,
        fields=tuple((name, first[name]) for name in names),
    )


def outline_regex(cases: Iterable[tuple[str, str]], class_values) -> str:
    """One regex for many ``(pattern, mode)``, matched against a shape once.

    It always matches. Each case has three groups, what is before its match, the match, and what is
    after; all are empty where the case does not match, and a match never is. Cases stand in look-aheads
    side by side, so each finds the match it would find alone.
    """
    parts = []
    for pattern, mode in cases:
        capture_field_names(pattern)
        head, body, tail = _regexes(pattern, parse_pattern(pattern), class_values, mode)
        parts.append(f"(?=(?:{head}({''.join(body)}){tail})?)")
    return f"^{''.join(parts)}.*\\z"


def first_regex(compiled: Iterable[ShapePattern]) -> str:
    """One regex for several patterns, of which the first that matches wins; groups follow each other."""
    return "|".join(f"(?:{one.regex})" for one in compiled)


def _regexes(pattern: str, elements, class_values, mode: str) -> tuple[str, list[str], str]:
    """What comes before a match, one part for each element, and what comes after."""
    check_mode(mode)
    place = {value: i for i, value in enumerate(class_values)}
    unknown = [e.cls for e in elements if e.cls is not None and e.cls not in place]
    if unknown:
        raise ValueError(f"unknown class {unknown[0]!r} in pattern {pattern!r}")
    body = []
    for i, element in enumerate(elements):
        char = SHAPE_BLANK if element.cls is None else shape_char(place[element.cls])
        many = element.many and not _follows_repeated(elements, i)
        body.append(f"{char}(?:{SHAPE_BLANK}{char})*" if many else char)
    guard = _run_guard(elements, place)
    head, tail = {
        "whole": ("^()", r"()\z"),
        "start": ("^()", r"(.*)\z"),
        "end": (f"^(.*?){guard}", r"()\z"),
        "any": (f"^(.*?){guard}", r"(.*)\z"),
    }[mode]
    return head, body, tail


def _follows_repeated(elements, i) -> bool:
    """Is there an earlier repeated element in the same unbroken run of one class?

    Of blank-separated neighbours of one class only the first repeated one can hold
    more than one token, as it takes all that the others leave. Saying so in the regex
    keeps the matcher from trying every way to share a run between them.
    """
    j = i - 2
    while j >= 0 and elements[j + 1].cls is None and elements[j].cls == elements[i].cls:
        if elements[j].many:
            return True
        j -= 2
    return False


def _run_guard(elements, place) -> str:
    """Look-behind that lets a match start only at the start of a run.

    When the leading elements are of one class and one of them repeats, a match that
    starts inside a run of that class can be extended to the left, so the leftmost
    match starts at the run's start. Without this every start in a long run would
    scan the rest of it.
    """
    led_by_blank = elements[0].cls is None
    words = elements[1:] if led_by_blank else elements
    if not words:
        return ""
    leading = 0
    while (
        leading < len(words)
        and words[leading].cls == words[0].cls
        and (leading == 0 or words[leading - 1].cls is None)
    ):
        leading += 2
    if not any(element.many for element in words[:leading]):
        return ""
    char = shape_char(place[words[0].cls])
    return f"(?<!{SHAPE_BLANK}{char})" if led_by_blank else f"(?<!{char}{SHAPE_BLANK})"
