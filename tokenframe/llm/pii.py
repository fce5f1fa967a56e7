"""Personal data: fixed forms, and identifiers found by the contexts that known ones stand in.

Four fixed forms are found in each text: e-mail addresses, IP addresses, card numbers, phone
numbers. They are the seeds of a bootstrap. Every identifier-like word of the corpus is an
instance, and each of its occurrences is in three lexical patterns: the two words before it and the
words on both sides, each with the sort of its characters, and the word before it with its shape (runs
of digits and letters). Pairs of pattern and instance are counted over the whole corpus; that graph is scored in
rounds. A pattern's confidence in a kind is the share of its distinct instances that are of
this kind, with one instance of doubt; an instance is of a kind by the chance that not all its
trusted patterns are wrong. Instances that reach a limit are known in the next round, and
after the last round every occurrence of one is a span.

The graph is two tables of counts, joined and aggregated by Spark; a pattern or an instance that
holds a large share of it is salted. Nothing of it comes to the driver.

Defined cases: a NULL text is empty and has no spans. Equal rows (id and text) share one set of found
spans; each row comes out. A NULL id is a row like others. Spans of one kind do not overlap, and a found
span overlaps no fixed one. An instance found for two kinds is of the likelier one, ties by the
order of kinds. An empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .store import salted_join, saved

KINDS = ("email", "ip", "card", "phone")

# The base forms. Runs are possessive: what follows a run never begins with its characters,
# so giving some back cannot help, and long runs stay linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: An identifier-like word has a digit or an at sign, and so many letters and digits at least.
MIN_IDENTIFIER = 5
NUMBERS = r"[+(]?[0-9][0-9().\-/]*+(?:[\x20][(]?[0-9][0-9().\-/]*+)++(?![^\x20\x09-\x0D.,;:!?])"
CANDIDATE = re.compile(rf"(?<![^\x20\x09-\x0D])(?:{NUMBERS}|[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+)")
EDGES = " \t\n\x0b\x0c\r\"'`“”«»()[]{}<>,;:!?.*#%$&|=~^_-/\\"
#: Characters around an identifier in which its neighbouring words are looked for.
CONTEXT = 80

ROUNDS = 3
#: Distinct known instances a pattern needs, the confidence that makes it trusted, and an instance known.
SUPPORT = 3
TRUSTED = 0.6
KNOWN = 0.75

FOUND = (
    "doc_id string, key binary, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base array<struct<start:int,stop:int,kind:int>>, "
    "seen array<struct<start:int,stop:int,kind:int,instance:string,patterns:array<string>>>"
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost start is the first character of the run before an at sign."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, stop, kind)`` of the fixed forms, by start and then kind."""
    spans = [(start, stop, 0) for start, stop in _emails(text)]
    for match in IP.finditer(text):
        # Parts may be of any length; a number too long for a part is not read as one.
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            spans.append((*match.span(), 1))
    for match in CARD.finditer(text):
        if match.end() - match.start() < 12:
            continue
        digits = _digits(match[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((*match.span(), 2))
    for match in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(match[0])) <= 15:
            spans.append((*match.span(), 3))
    return sorted(spans, key=lambda span: (span[0], span[2]))


def shape(text: str) -> str:
    """Runs of digits as ``9``, of letters as ``a``; other characters as they are."""
    text = re.sub(r"[^\W\d_]+", "a", text)
    return re.sub(r"(?:9 )+9", "9 9", re.sub(r"\d+", "9", text))


def sort_of(text: str) -> str:
    """``@`` with an at sign, ``9`` of digits and marks only, else ``a9``."""
    return "@" if "@" in text else "a9" if any(map(str.isalpha, text)) else "9"


def _word(text: str) -> str:
    return re.sub(r"\d", "0", text.lower())


def patterns_at(text: str, start: int, stop: int) -> list[str]:
    """The lexical patterns an identifier stands in."""
    before = text[max(0, start - CONTEXT) : start].split()
    after = text[stop : stop + CONTEXT].split()
    sort = sort_of(text[start:stop])
    left = _word(before[-1]) if before else "^"
    left2 = _word(before[-2]) if len(before) > 1 else "^"
    right = _word(after[0]) if after else "$"
    return [f"{left2} {left} {sort}", f"{left} {sort} {right}", f"{left} : {shape(text[start:stop])}"]


def identifiers(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like spans that overlap no fixed one."""
    edges = sorted((start, stop) for start, stop, _ in base)
    k, reach = 0, 0
    for match in CANDIDATE.finditer(text):
        start, stop = match.span()
        while k < len(edges) and edges[k][0] < stop:
            reach = max(reach, edges[k][1])
            k += 1
        if reach > start:
            continue
        word = match[0]
        start += len(word) - len(word.lstrip(EDGES))
        stop -= len(word) - len(word.rstrip(EDGES))
        if stop - start >= MIN_IDENTIFIER and sum(map(str.isalnum, text[start:stop])) >= MIN_IDENTIFIER:
            yield start, stop


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.int32()
    base_type = pa.list_(pa.struct([("start", kind), ("stop", kind), ("kind", kind)]))
    seen_type = pa.list_(
        pa.struct(
            [("start", kind), ("stop", kind), ("kind", kind), ("instance", pa.string()),
             ("patterns", pa.list_(pa.string()))]
        )
    )
    for batch in batches:
        out: list[list] = [[] for _ in range(8)]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            name = b"" if doc_id is None else b"+" + doc_id.encode()
            base = base_spans(text)
            seen = [(start, stop, number) for start, stop, number in base]
            seen += [(start, stop, None) for start, stop in identifiers(text, base)]
            counts = [sum(number == k for _, _, number in base) for k in range(len(KINDS))]
            key = hashlib.blake2b(len(name).to_bytes(8) + name + text.encode(), digest_size=16).digest()
            row = [
                doc_id, key, *counts,
                [{"start": a, "stop": b, "kind": number} for a, b, number in base],
                [
                    {"start": a, "stop": b, "kind": number, "instance": text[a:b].lower(),
                     "patterns": patterns_at(text, a, b)}
                    for a, b, number in seen
                ],
            ]
            for column, value in zip(out, row, strict=True):
                column.append(value)
        types = [pa.string(), pa.binary(), *[pa.int64()] * 4, base_type, seen_type]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(out, types, strict=True)],
            names=["doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", "seen"],
        )


def known_instances(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(instances, patterns)`` after the last round: those found, those trusted, with kind and score.

    ``edges`` has ``pattern``, ``instance`` and ``kind``, NULL for those that are no seeds; a row for
    each distinct pair.
    """
    spread = F.xxhash64("pattern", "instance")
    seeds = edges.where("kind IS NOT NULL")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    known = seeds.select("instance", "kind", F.lit(1.0).alias("score")).distinct()
    found, trusted = None, None
    for _ in range(ROUNDS):
        scored = salted_join(edges.select("pattern", "instance"), known, ["instance"], spread, "inner")
        sums = scored.groupBy("pattern", "kind").agg(
            F.sum("score").alias("mass"), F.count("*").alias("support")
        )
        confidence = F.col("mass") / (F.col("n") + 1)
        trusted = saved(
            sums.where(F.col("support") >= SUPPORT).join(sizes, "pattern")
            .select("pattern", "kind", "support", confidence.alias("confidence"))
            .where(F.col("confidence") >= TRUSTED),
            "trusted",
        )
        open_edges = edges.where("kind IS NULL").select("pattern", "instance")
        met = salted_join(open_edges, trusted, ["pattern"], spread, "inner")
        # The chance that all its patterns are wrong, as a sum of logarithms.
        doubts = F.sum(F.log1p(-F.col("confidence")))
        chances = met.groupBy("instance", "kind").agg((1 - F.exp(doubts)).alias("score"))
        order = F.struct("score", (-F.col("kind")).alias("rank"))
        best = chances.where(F.col("score") >= KNOWN).groupBy("instance").agg(F.max(order).alias("b"))
        found = saved(
            best.select("instance", (-F.col("b.rank")).alias("kind"), F.col("b.score").alias("score")), "known"
        )
        known = seeds.select("instance", "kind", F.lit(1.0).alias("score")).distinct().unionByName(found)
    return found, trusted


def personal_data(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base, spans)``: spans as structs
    ``(start, stop, kind)`` in code points; ``base`` has the fixed forms, ``spans`` those found by
    context as well, both by start and then kind."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    scanned = saved(rows.mapInArrow(_scan, FOUND), "scanned")
    each = scanned.select("key", F.explode("seen").alias("s")).select("key", "s.*")
    edges = saved(
        each.select("instance", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance").agg(F.min("kind").alias("kind")),
        "edges",
    )
    instances, _ = known_instances(edges)
    places = each.where("kind IS NULL").select("key", "start", "stop", "instance")
    spread = F.xxhash64("key", "start")
    hits = salted_join(places, instances.select("instance", "kind"), ["instance"], spread, "inner")
    more = hits.groupBy("key").agg(
        F.collect_set(F.struct("start", "stop", "kind")).alias("more")
    )
    spans = F.array_sort(
        F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:int,stop:int,kind:int>>"))),
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]),
    )
    return scanned.drop("seen").join(more, "key", "left").select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone",
        "base", spans.alias("spans"),
    )


def written(spans: str) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(name) for name in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(spans, one), ",")
