"""Find licence notices by templates, and fixed phrases.

A template is text with markup: ``[[ … ]]`` may be left out, ``{{name:1-5}}`` stands for so many
words of any kind, everything else is mandatory wording. Each template is compiled into an
automaton over words. A match begins where the template's first words stand, and follows the
text word by word; it is accepted if every mandatory word is there, in order, exactly.

Words are runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case, so
punctuation and spacing never matter.

Defined cases: a NULL text is empty and has no words; its places are NULL, its labels empty,
its score 0. Rows are judged one by one. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import ALPHANUMERIC, chained, slices, texts_of, words_in

# Phrases and labels of the base scan.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates of notices, label by label.
TEMPLATES = {
    "notice-cc": ["licensed under [[the]] [[a]] [[creative commons]] cc by [[nc]] [[nd]] [[sa]] {{version:0-2}}"],
    "notice-gpl": [
        "licensed under the [[terms of the]] gnu [[lesser]] [[affero]] general public license [[v]] "
        "[[version]] {{version:0-2}}",
        "redistribute it and or modify it under the terms [[and conditions]] of [[version {{version:1-2}} of]] "
        "the gnu [[lesser]] [[library]] [[affero]] general public license [[v]] [[version {{version:1-2}}]] "
        "[[as published by the free software foundation [[either version {{version:1-2}} of the license "
        "[[or at your option any later version]]]]]]",
    ],
    "notice-reserved": ["copyright [[c]] {{holder:1-40}} all rights reserved"],
    "notice-apache": ["licensed under the apache license [[version]] {{version:1-2}}"],
    "notice-mit": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "{{documentation:0-6}} to deal in the software without restriction",
        "licensed under the mit license",
        "released under the mit license",
    ],
    "notice-bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "[[provided that the following conditions are met]]"
    ],
    "notice-mpl": ["subject to the terms of the mozilla public license [[v]] [[version]] {{version:0-2}}"],
    "spdx": ["spdx license identifier {{id:1-4}}"],
}

_MARKUP = re.compile(r"\[\[|\]\]|\{\{\w+:(\d+)-(\d+)\}\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """States 0, 1, …: each has steps (word or None for any word, next state) and free moves."""

    steps: list[list[tuple[str | None, int]]]
    free: list[list[int]]
    final: int
    prefix: list[str]

    def closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for to in self.free[todo.pop()]:
                if to not in out:
                    out.add(to)
                    todo.append(to)
        return out

    def longest(self, words: Iterator[str]) -> int:
        """Words of the longest match from here; 0 if there is none."""
        now, found = self.closed({0}), 0
        for n, word in enumerate(words, 1):
            now = self.closed({to for s in now for w, to in self.steps[s] if w is None or w == word})
            if not now:
                break
            if self.final in now:
                found = n
        return found


def compile_template(text: str) -> Automaton:
    steps: list[list[tuple[str | None, int]]] = [[]]
    free: list[list[int]] = [[]]
    open_, prefix, literal = [], [], True

    def state() -> int:
        steps.append([])
        free.append([])
        return len(steps) - 1

    at = 0
    for m in _MARKUP.finditer(text):
        if m[0] == "[[":
            open_.append(at)
            literal = False
        elif m[0] == "]]":
            free[open_.pop()].append(at)
        elif m[1]:
            literal = False
            least, most = int(m[1]), int(m[2])
            ends = [at] if least == 0 else []
            for k in range(1, most + 1):
                to = state()
                steps[at].append((None, to))
                at = to
                if k >= least:
                    ends.append(at)
            end = state()
            for e in ends:
                free[e].append(end)
            at = end
        else:
            to = state()
            steps[at].append((m[0].lower(), to))
            at = to
            if literal:
                prefix.append(m[0].lower())
    if open_ or not prefix:
        raise ValueError(f"template needs balanced markup and mandatory first words: {text!r}")
    return Automaton(steps, free, at, prefix)


def _hash(words: list[str]) -> int:
    own = words_in(pa.array([" ".join(words)], pa.large_string()), 0, 1, True, ALPHANUMERIC).hashes
    return int(chained([own[k : k + 1] for k in range(len(own))])[0])


def _scanner(templates: dict[str, list[str]]):
    compiled = [(label, compile_template(t)) for label, texts in templates.items() for t in texts]
    phrases = [(label, len(p.split()), _hash(p.split())) for p, label in PHRASES.items()]
    starts = [(label, a, len(a.prefix[:3]), _hash(a.prefix[:3])) for label, a in compiled]
    sizes = sorted({n for _, n, _ in phrases} | {n for *_, n, _ in starts})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for lo, hi in slices(texts):
                words = words_in(texts, lo, hi, True, ALPHANUMERIC)
                yield _rows(batch.column(0)[lo:hi], words)

    def _rows(ids, words) -> pa.RecordBatch:
        n = len(ids)
        doc_of = lambda at: np.searchsorted(words.first, at, "right") - 1
        windows = {k: words.windows(k) for k in sizes}
        base: list[list[int]] = [[] for _ in range(n)]
        base_labels: list[set[str]] = [set() for _ in range(n)]
        labels: list[set[str]] = [set() for _ in range(n)]
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for label, size, wanted in phrases:
            hashes, at = windows[size]
            found = at[hashes == np.uint64(wanted)]
            for place, d in zip(found.tolist(), doc_of(found).tolist(), strict=True):
                base[d].append(place - int(words.first[d]))
                base_labels[d].add(label)
                spans[d].append((place, place + size))
        for label, automaton, size, wanted in starts:
            hashes, at = windows[size]
            found = at[hashes == np.uint64(wanted)]
            for place, d in zip(found.tolist(), doc_of(found).tolist(), strict=True):
                end = int(words.first[d + 1])
                own = (words.data[words.starts[k] : words.ends[k]].tobytes().decode() for k in range(place, end))
                if length := automaton.longest(own):
                    labels[d].add(label)
                    spans[d].append((place, place + length))
        total = np.diff(words.first)
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(total, pa.int64()),
                pa.array([len(b) for b in base], pa.int64()),
                pa.array([min(b) if b else None for b in base], pa.int64()),
                pa.array([max(b) if b else None for b in base], pa.int64()),
                pa.array([",".join(sorted(x)) for x in base_labels]),
                pa.array([",".join(sorted(x | y)) for x, y in zip(base_labels, labels, strict=True)]),
                pa.array([_covered(s) / t if t else 0.0 for s, t in zip(spans, total.tolist(), strict=True)], pa.float64()),
            ],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )

    return scan


def _covered(spans: list[tuple[int, int]]) -> int:
    total, until = 0, -1
    for a, b in sorted(spans):
        total += max(0, b - max(a, until))
        until = max(until, b)
    return total


def scan_licenses(
    docs: DataFrame, doc_id: str, text: str, templates: dict[str, list[str]] | None = None
) -> DataFrame:
    """One row per document. ``score`` is the share of its words inside phrases and notices."""
    columns = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    return columns.mapInArrow(
        _scanner(templates or TEMPLATES),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )
