"""Fixed forms against the plain expressions, and the bootstrap against a version in memory."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import defaultdict

import pytest

from tokenframe.llm import pii, queries

from .test_operators import docs, empty, odd, texts  # noqa: F401

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_by_hand(text):
    out = []
    for number, (kind, regex) in enumerate(PLAIN.items()):
        for match in re.finditer(regex, text, re.ASCII):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": lambda m: True,
                "ip": lambda m: all(int(part) <= 255 for part in m[0].split(".")),
                "card": lambda m, d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda m, d=digits: 9 <= len(d) <= 15,
            }[kind]
            if good(match):
                out.append((match.start(), match.end(), number))
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_fixed_forms():
    rng = random.Random(3)
    pieces = ["a", "Z9", "@", "@@", ".", "..", "-", "+", "+1", " ", "  ", "(", ")", "12", "7", "255", "256", "é", "\n",
              "4111111111111111", "4111 1111 1111 1111", "0000", "x@y.z", "1.2.3.4", "%_", "日本", "+49 30 1234567"]
    for _ in range(4_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(text) == base_by_hand(text), text


@pytest.mark.parametrize("run", ["a", "1", "1 ", "1.", "+1", "a@", "a.", "(", "@", "1-", " "])
def test_long_runs_stay_linear(run):
    started = time.time()
    text = run * 200_000
    base = pii.base_spans(text)
    list(pii.identifiers(text, base))
    assert time.time() - started < 10


def card(rng, valid=True):
    while True:
        digits = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        if luhn(digits) == valid:
            return digits


def corpus():
    rng = random.Random(9)
    words = "lorem ipsum dolor sit amet tempor magna".split()
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for k in range(30):
        rows.append(f"{some(4)} card number {card(rng)} {some(3)}")
        rows.append(f"{some(2)} write to user{k}@mail{k % 4}.example.com {some(2)}")
    rows += [f"{some(3)} card number {card(rng, False)} {some(2)}" for _ in range(4)]
    rows += [f"{some(3)} write to user9{k}@localhost, {some(2)}" for k in range(3)]
    rows += [f"{some(3)} order {rng.randrange(10**7, 10**8)} {some(2)}" for _ in range(20)]
    rows += ["call +1 (017) 555-7713 now", "from 10.0.0.1 and 999.1.1.1", None, "", "x" * 50_000 + "1", rows[0]]
    return [(k, text) for k, text in enumerate(rows)] + [(0, rows[0]), (None, rows[1]), (None, None)]


def found_by_hand(rows):
    """Instances that the bootstrap knows at its end, and spans by row."""
    edges, seen = {}, []
    for doc_id, text in rows:
        text = text or ""
        base = pii.base_spans(text)
        spans = [*base, *((a, b, None) for a, b in pii.identifiers(text, base))]
        seen.append((doc_id, text, base, spans))
        for a, b, kind in spans:
            for pattern in pii.patterns_at(text, a, b):
                edge = (pattern, text[a:b].lower())
                kinds = [k for k in (edges.get(edge), kind) if k is not None]
                edges[edge] = min(kinds) if kinds else None
    seeds = {(instance, kind) for (_, instance), kind in edges.items() if kind is not None}
    sizes, members = defaultdict(int), defaultdict(list)
    for pattern, instance in edges:
        sizes[pattern] += 1
        members[instance].append(pattern)
    found = {}
    for _ in range(pii.ROUNDS):
        known = [(i, k, 1.0) for i, k in seeds] + [(i, k, score) for i, (k, score) in found.items()]
        mass, support = defaultdict(float), defaultdict(int)
        for instance, kind, score in known:
            for pattern in members[instance]:
                mass[pattern, kind] += score
                support[pattern, kind] += 1
        trusted = {
            key: m / (sizes[key[0]] + 1)
            for key, m in mass.items()
            if support[key] >= pii.SUPPORT and m / (sizes[key[0]] + 1) >= pii.TRUSTED
        }
        doubt = defaultdict(lambda: 1.0)
        for (pattern, instance), kind in edges.items():
            if kind is None:
                for number in range(4):
                    if (pattern, number) in trusted:
                        doubt[instance, number] *= 1 - trusted[pattern, number]
        found = {}
        for (instance, number), d in doubt.items():
            if 1 - d >= pii.KNOWN and (instance not in found or (1 - d, -number) > (found[instance][1], -found[instance][0])):
                found[instance] = (number, 1 - d)
    out = []
    for doc_id, text, base, spans in seen:
        more = [(a, b, found[text[a:b].lower()][0]) for a, b, k in spans if k is None and text[a:b].lower() in found]
        out.append((doc_id, base, sorted([*base, *more], key=lambda s: (s[0], s[2]))))
    return out


def written(spans):
    return ",".join(f"{pii.KINDS[kind]}:{start}:{stop}" for start, stop, kind in spans)


def test_query_against_a_version_in_memory(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    monkeypatch.setattr(queries, "_table", lambda *_: df)
    got = sorted(map(tuple, queries.op12_pii(spark, "").collect()), key=repr)
    want = []
    for doc_id, base, spans in found_by_hand(rows):
        counts = [sum(kind == k for _, _, kind in base) for k in range(4)]
        want.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
    assert got == sorted(want, key=repr)


def test_bootstrap_finds_what_stands_in_the_same_places(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    by_id = {row.doc_id: row for row in pii.personal_data(df, "doc_id", "text").collect()}
    texts_of = dict(rows)

    def more(doc_id):
        row = by_id[doc_id]
        base = {tuple(s) for s in row.base}
        return [(texts_of[doc_id][s.start : s.stop], pii.KINDS[s.kind]) for s in row.spans if tuple(s) not in base]

    for doc_id in range(60, 64):
        assert [kind for _, kind in more(doc_id)] == ["card"]
    for k, doc_id in enumerate(range(64, 67)):
        assert more(doc_id) == [(f"user9{k}@localhost", "email")]
    for doc_id in range(67, 87):
        assert more(doc_id) == []


def test_odd_tables(docs, odd, empty):  # noqa: F811
    assert pii.personal_data(odd, "doc_id", "text").count() == odd.count()
    assert pii.personal_data(empty, "doc_id", "text").count() == 0
    clash = docs.selectExpr("*", "1 AS key", "2 AS seen", "3 AS base", "4 AS spans", "5 AS instance", "6 AS pattern")
    assert pii.personal_data(clash, "doc_id", "text").count() == docs.count()
