"""The operators against brute force, on small tables with the awkward cases."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tokenframe.llm import (
    chat, decontaminate, katz, licenses, minhash, packing, quality, queries, sharding, substrings, tokencounts,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, h bigint"
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def made_texts():
    """Texts with copies, near copies, shared passages, repeats and odd characters."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)] + ["Été", "naïve,", "The", "the", "x\u0085y", "日本", "#tag", "a|b"]
    new = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage = new(60)
    texts = [None, "", "   \n\t", "one", "one two three", "Ends here.\n"]
    texts += [new(rng.randint(5, 120)) for _ in range(25)]
    base = new(200)
    for k in range(8):
        own = base.split(" ")
        for _ in range(k):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append("\n".join([" ".join(own[:100]), " ".join(own[100:])]))
    texts += [new(30) + "\n" + passage + "\t" + new(30) for _ in range(5)]
    texts += [texts[8], texts[8].upper(), texts[9] + " ", "spam spam " * 40, "same line\n" * 12, new(12_000)]
    texts += ["Copyright (c) 2020 Some Body. All rights reserved.", "Licensed under the GNU General Public License, v3"]
    texts += ["cc by CC-BY " + new(5), "general public license " * 3, passage]
    return texts


@pytest.fixture(scope="module")
def texts():
    return made_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(3 * k, t, "en", f"host{k % 4}" if k % 7 else None, len(t or ""), "clash", k) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """NULL ids, repeated rows, and ids that repeat with other texts."""
    rows = [(None, "a b c d e f g", None, None, None, None, None)] * 2
    rows += [(None, None, None, None, None, None, None), (1, "p q r s t u v", "x", "h", 3, "k", 1)]
    rows += [(1, "p q r s t u v", "x", "h", 3, "k", 1), (1, "z y x w v u t", "x", "h", 3, "k", 1)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality(docs, odd, empty, texts):
    got = by_id(quality.quality_report(docs, "doc_id", "text", "source"))
    for k, text in enumerate(texts):
        own, row = words(text), got[3 * k]
        lines = [line for line in (text or "").split("\n") if words(line)]
        places = defaultdict(list)
        for i in range(len(own) - 4):
            places[tuple(own[i : i + 5])].append(i)
        covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(5)}
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        want = (len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered))
        assert tuple(row)[1:6] == want, text
        failed = len(own) < 10 or 100 * len(covered) > 20 * len(own)
        assert row["base_failed"] == failed
        assert row["kept"] in ([False] if failed else [True] if not row["soft_failed"] else [True, False])
    assert quality.quality_report(odd, "doc_id", "text", "source").count() == 6
    assert quality.quality_report(empty, "doc_id", "text", "source").count() == 0
    assert quality.keep_good(docs, "doc_id", "text", "source").columns == docs.columns


def test_host_verdict(spark):
    noise = " ".join(["# word$"] * 15)
    noisy = [f"{noise} {k} q{k} r{k} s{k}" for k in range(40)]
    rng = random.Random(3)
    clean = [" ".join(f"word{rng.randrange(10_000)}" for _ in range(40)) for _ in range(10)]
    odd_one = " ".join(f"u{rng.randrange(10_000)} #" for _ in range(40))
    odd_many = [" ".join(f"u{rng.randrange(10_000)} #" for _ in range(40)) for _ in range(40)]
    rows = [(k, t, "bad") for k, t in enumerate(odd_many)] + [(100 + k, t, "bad") for k, t in enumerate(clean)]
    rows += [(200 + k, t, f"good{k % 3}") for k, t in enumerate(clean)] + [(300, odd_one, "good0"), (301, odd_one, None)]
    rows += [(400 + k, t, "bad") for k, t in enumerate(noisy)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_report(df, "doc_id", "text", "source").collect()}
    assert not any(got[k] for k in range(40)) and all(got[k] for k in range(100, 110))
    assert all(got[k] for k in range(200, 210)) and got[300] and got[301]
    assert quality.beta_prior(None, None) == (1.0, 1.0) and quality.beta_prior(0.5, 0.05) == (2.0, 2.0)


def multiset(text, size=5):
    own = lower(text).lower().split()
    return Counter(tuple(own[k : k + size]) for k in range(len(own) - size + 1))


def test_decontamination(spark, docs, odd, empty):
    rng = random.Random(9)
    items = [" ".join(f"b{rng.randrange(500)}" for _ in range(rng.randint(14, 50))) for _ in range(12)]
    items += ["too short", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    texts = []
    for k in range(60):
        own = items[k % 12].split()
        for _ in range(k // 12):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], ["new"], [own[at], "extra"]])
        before, behind = (" ".join(f"c{rng.randrange(500)}" for _ in range(rng.choice([0, 3, 40]))) for _ in "ab")
        texts.append(f"{before} {' '.join(own)} {behind}".upper() if k % 5 == 0 else f"{before} {' '.join(own)} {behind}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = by_id(decontaminate.contamination(df, "doc_id", "text", bench, "item_id", "text"))
    close = 0
    for k, text in enumerate(texts):
        own, want, unsure = text.lower().split(), set(), set()
        for i, item in enumerate(items):
            a = multiset(item)
            m = len((item or "").split())
            best = 0.0
            for at in range(max(1, len(own) - m + 1)):
                b = multiset(" ".join(own[at : at + m]))
                if a and b:
                    best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.75:
                want.add(i)
                unsure |= {i} if best < 0.8 else set()
        found = set(got[k]["item_ids"])
        assert found <= want and want - found <= unsure, (k, found, want)
        close += len(want - found)
    assert close <= 1
    clean = decontaminate.drop_contaminated(df, "doc_id", "text", bench, "item_id", "text")
    assert {r[0] for r in clean.select("doc_id").collect()} == {k for k, r in got.items() if not r["contaminated"]}
    for table in (docs, odd, empty):
        assert decontaminate.contamination(table, "doc_id", "text", bench, "item_id", "text").count() == table.count()
    none = bench.limit(0)
    assert decontaminate.drop_contaminated(odd, "doc_id", "text", none, "item_id", "text").count() == 6


def cut_by_hand(pairs):
    first = {}
    for i, text in pairs:
        own = words(text)
        for k in range(len(own) - 12):
            key = tuple(own[k : k + 13])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, text in pairs:
        own = words(text)
        gone = {k + j for k in range(len(own) - 12) if first[tuple(own[k : k + 13])] < i for j in range(13)}
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out[i] = (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


@pytest.mark.parametrize("hot", [1, 10**9])
def test_substrings(docs, odd, empty, texts, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_IN_SAMPLE", hot)
    monkeypatch.setattr(substrings, "FLUSH_BYTES", 5_000)
    want = cut_by_hand([(3 * k, t) for k, t in enumerate(texts)])
    got = by_id(substrings.substring_report(docs, "doc_id", "text"))
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: w[:3] for i, w in want.items()}
    cut = substrings.without_repeats(docs, "doc_id", "text")
    assert cut.columns == docs.columns
    for row in cut.collect():
        assert words(row["text"]) == words(want[row["doc_id"]][3])
        assert row["kept"] == "clash" and (row["text"] is None) == (texts[row["doc_id"] // 3] is None)
    assert substrings.substring_report(odd, "doc_id", "text").count() == 6
    assert substrings.substring_report(empty, "doc_id", "text").count() == 0


def test_equal_windows_of_a_document_go_once():
    """A line repeated in one long document makes no large group, and all its places are cut."""
    line = " ".join(f"a{k}" for k in range(20))
    texts = [line + " end", f"{line}\n" * 500]
    splits = substrings.Splits(np.empty((0, substrings.WINDOW), np.uint64), 4)
    columns = [pa.array([1, 2]), pa.array(texts), pa.array([7, 8])]
    batch = pa.RecordBatch.from_arrays(columns, names=["i", "t", "r"])
    dealt = pa.Table.from_batches(substrings._dealer(splits)(iter([batch])))
    assert sum(len(substrings._open(b)[0]) for b in dealt["blob"].to_pylist()) == 9 + 20
    back = pa.Table.from_batches(substrings._subtree(4)(iter(dealt.to_batches())))
    got = pa.Table.from_batches(b for x in back.to_batches() for b in substrings._gathered(iter([x]))).to_pylist()
    assert {r["__s_id"] for r in got} == {2}
    words = substrings.words_in(pa.array(texts, pa.large_string()), 0, 2)
    hashes, at = words.windows(substrings.WINDOW)
    places = np.concatenate([np.frombuffer(r["__s_places"], np.uint32) for r in got])
    found = substrings._all_like(words, hashes, at, 1, places) - words.first[1]
    assert found.tolist() == [20 * k + j for k in range(500) for j in range(8)]


def test_rows_travel_packed_and_once(spark, docs, tmp_path):
    """No join carries plain texts, and a packed row holds its text once."""
    docs.write.parquet(f"{tmp_path}/docs")
    cut = substrings.without_repeats(spark.read.parquet(f"{tmp_path}/docs"), "doc_id", "text")
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("- Exchange") == 2
    dealt = [line for line in plan.splitlines() if "MapInArrow deal" in line and "c0" in line]
    assert len(dealt) == 1 and "__s_text" not in dealt[0]
    columns = {"__s_id": pa.array([1, None]), "t": pa.array(["a b", "c"]), "__s_row": pa.array([5, 6])}
    batch = pa.RecordBatch.from_pydict(columns)
    packed = pa.Table.from_batches(substrings._packed_rows(3)(iter([batch])))
    blobs = pa.RecordBatch.from_pydict({"kind": [substrings._OF_ROWS] * len(packed), "blob": packed["blob"].combine_chunks()})
    back = [row for own, places in substrings._with_places(iter([blobs])) for row in own.to_pylist()]
    assert sorted(back, key=str) == sorted(batch.to_pylist(), key=str)


def test_splits_keep_windows_together():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    from tokenframe.llm.words import words_in

    text = " ".join(f"w{k}" for k in rng.zipf(1.3, 4_000) % 50)
    column = pa.array([text, text], pa.large_string())
    own = words_in(column, 0, 2)
    hashes, at = own.windows(13)
    table = np.stack([substrings.prefix_hash(own, at, k + 1) for k in range(13)], axis=1)
    splits = substrings.Splits(table[::7], 9)
    parts = splits.partition_of(own, at)
    together = {}
    for h, p in zip(hashes.tolist(), parts.tolist(), strict=True):
        assert together.setdefault(h, p) == p
    assert max(np.bincount(parts)) < 0.5 * len(parts) and len(splits.split[0])


def near_by_hand(pairs):
    def shingles(text):
        own = lower(text).encode().split()
        return {tuple(own[k : k + 5]) for k in range(max(1, len(own) - 4))} if own else set()

    sets = {i: shingles(t) for i, t in pairs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("limit", [10_000, 2])
def test_near_groups(docs, odd, empty, texts, monkeypatch, limit):
    monkeypatch.setattr(minhash, "BLOCK", limit)
    want = near_by_hand([(3 * k, t) for k, t in enumerate(texts)])
    got = by_id(minhash.near_groups(docs, "doc_id", "text"))
    assert {i: tuple(r)[1:] for i, r in got.items()} == want
    if limit == 2:
        return
    rows = minhash.near_groups(odd, "doc_id", "text").collect()
    assert len(rows) == 6 and all(r["kept"] for r in rows)
    assert {r["component_id"] for r in rows} == {None, 1}
    assert minhash.near_groups(empty, "doc_id", "text").count() == 0
    kept = minhash.keep_one(docs, "doc_id", "text")
    assert kept.columns == docs.columns and kept.count() == sum(w[2] for w in want.values())


def test_hot_ids_of_pairs_are_salted(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PAIRS_PER_COPY", 2)
    pairs = [(k, 100) for k in range(9)] + [(3, k) for k in range(50, 56)]
    table = spark.createDataFrame([(k, f"t{k}") for k in range(101)], "cid bigint, text string")
    found = minhash._both(spark.createDataFrame(pairs, "a bigint, b bigint"), table, "text")
    got = sorted((r["a"], r["b"], r["text_a"], r["text_b"]) for r in found.collect())
    assert got == sorted((a, b, f"t{a}", f"t{b}") for a, b in pairs)


def test_chain_of_near_copies(spark):
    """Each text is near the next only, so the group hangs on every single link."""
    rng = random.Random(11)
    own = [f"t{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(25):
        rows.append((k * 7 % 25, " ".join(own)))
        own = own[6:] + [f"t{rng.randrange(10**6)}" for _ in range(6)]
    want = near_by_hand(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(minhash.near_groups(df, "doc_id", "text"))
    assert {i: tuple(r)[1:] for i, r in got.items()} == want and {w[1] for w in want.values()} == {0}


@pytest.mark.parametrize(("size", "shift"), [(60, 8), (60, 9), (600, 250), (5_000, 600), (5_000, 3_000)])
def test_samples_keep_links_and_drop_far_pairs(size, shift):
    own = [f"v{k}" for k in range(size + shift)]
    texts = [" ".join(own[:size]), " ".join(own[shift:])]
    batch = pa.RecordBatch.from_pydict({"cid": [1, 2], "text": texts})
    (found,) = minhash._sampled([batch])
    known = minhash._Samples(found["level"].to_pylist(), found["sample"].to_pylist())
    linked = 100 * (size - 4 - shift) >= 75 * (size - 4 + shift)
    near = 100 * (size - 3 - shift) >= 75 * (size - 4 + shift)
    assert linked <= known.may_link(0, np.array([1]))[0] <= near


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(30)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    edges += [(500, k) for k in range(501, 560)] + [(9, 9)]
    found = {r[0]: r[1] for r in minhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(found.get(n, n) == r for n, r in root.items())


def test_sharding(docs, odd, empty, texts):
    rows = sharding.shard(docs, "doc_id", "text").collect()
    sizes = defaultdict(int)
    for r in rows:
        text = (texts[r["doc_id"] // 3] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "bytes", None)
        sizes[text] += r["size"]
    slots = defaultdict(list)
    where = {}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert where.setdefault(texts[r["doc_id"] // 3] or "", r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < 16
    assert sharding.shard(odd, "doc_id", "text").count() == 6
    assert sharding.shard(empty, "doc_id", "text").count() == 0


def test_smallest_capacity(spark):
    rng = random.Random(4)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.choice([1, 5, 40, 700])) for _ in range(700)]
    df = spark.createDataFrame(rows, "h bigint, bytes bigint")
    sizes = [b for _, b in sorted((h % (1 << 64), b) for h, b in rows)]

    def feasible(capacity):
        used, load = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            used, load = (used, load + s) if load + s <= capacity else (used + 1, s)
        return used <= 16

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if feasible(c))
    cuts = sharding.cut_points(df, 16)
    loads = Counter()
    for h, b in rows:
        loads[sum(h % (1 << 64) >= c for c in cuts)] += b
    assert max(loads.values()) <= best and len(cuts) < 16


def test_packing(spark, docs, odd, empty, texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, "doc_id", "text", path, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for k, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted(pieces[3 * k], key=lambda r: r["start"])
        joined = []
        for r in own:
            assert r["start"] == len(joined) and r["doc_tokens"] == len(ids)
            assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
            joined += np.frombuffer(r["ids"], "<u4").tolist()
        assert joined == ids
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= packing.CAPACITY
    assert packing.pack_documents(odd, "doc_id", "text", path).count() == 6
    assert packing.pack_documents(empty, "doc_id", "text", path).count() == 0


def test_windows_come_out_nearly_equal():
    rng = random.Random(8)
    sizes = [rng.randint(1, 1_024) for _ in range(900)]
    found = packing.deal(sizes, packing.CAPACITY)
    assert sorted(k for w in found for k in w) == list(range(900))
    loads = [sum(sizes[k] for k in w) for w in found]
    assert max(loads) <= packing.CAPACITY and max(loads) - min(loads) < 60
    assert len(found) <= -(-sum(sizes) // packing.CAPACITY) + 1
    assert packing.deal([5], 8) == [[0]] and len(packing.deal([3_000] * 3, 4_096)) == 3


def test_licenses(docs, odd, empty, texts):
    got = by_id(licenses.scan_licenses(docs, "doc_id", "text"))
    for k, text in enumerate(texts):
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(own)) if own[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        row = got[3 * k]
        want = (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert tuple(row)[1:6] == want, text
        assert labels <= set(filter(None, row["labels"].split(","))) and 0 <= row["score"] <= 1
    assert any("notice-reserved" in r["labels"] for r in got.values())
    assert licenses.scan_licenses(odd, "doc_id", "text").count() == 6
    assert licenses.scan_licenses(empty, "doc_id", "text").count() == 0


def test_usual_notices(spark):
    """The standard headers of the GNU licences, and a copyright line with many holders."""
    head = "free software: you can redistribute it and/or modify\n * it under the terms of {} as published by\n"
    head += " * the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."
    names = ["the GNU General Public License", "the GNU Lesser General Public License"]
    names += ["the GNU Library General Public License", "the GNU Affero General Public License"]
    names += ["version 2 of the GNU General Public License"]
    texts = [head.format(n) for n in names]
    texts += ["Copyright (c) 2020 " + ", ".join(f"Holder{k} Name{k}" for k in range(12)) + ". All rights reserved."]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "i bigint, t string"), "i", "t")
    got = {r["doc_id"]: r for r in rows.collect()}
    for k in range(len(names)):
        assert "notice-gpl" in got[k]["labels"].split(",")
        # All from "redistribute" to "version" stands in the notice.
        assert math.isclose(got[k]["score"], 1 - 4 / got[k]["n_words"])
    assert "notice-reserved" in got[len(names)]["labels"].split(",") and got[len(names)]["score"] == 1


@pytest.mark.parametrize(
    ("text", "length"),
    [("a b c d", 4), ("a c d", 3), ("a x d", 0), ("a c d e f", 5), ("a", 0), ("a b b c d", 0), ("a c", 0)],
)
def test_template_automaton(text, length):
    automaton = licenses.compile_template("a [[b]] c d {{rest:0-1}} [[f]]")
    assert automaton.longest(iter(text.split())) == length
    with pytest.raises(ValueError, match="balanced"):
        licenses.compile_template("a [[b")


def test_katz(spark, docs, odd, empty, texts):
    got = by_id(katz.fit_and_score(docs, "doc_id", "text"))
    tokens = {3 * k: [*words(lower(t)), None] for k, t in enumerate(texts)}
    training = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    want = score_by_hand(training, tokens)
    for i, (base, known, score) in want.items():
        row = got[i]
        assert (row["n_tokens"], row["n_known"]) == (len(tokens[i]), known)
        assert row["train_tokens"] == sum(map(len, training))
        assert row["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9) and math.isclose(row["score"], score, rel_tol=1e-9)
    rows = katz.fit_and_score(odd, "doc_id", "text").collect()
    assert len(rows) == 6 and all(math.isfinite(r["score"]) for r in rows)
    assert katz.fit_and_score(empty, "doc_id", "text").count() == 0


def test_katz_keeps_rare_words_apart(spark):
    """More words than the head has room for: each is still a word of its own, in both places of a pair."""
    rng = random.Random(12)
    texts = [" ".join(f"r{400 * k + j}" for j in range(400)) for k in range(200)]
    texts += [" ".join(f"r{rng.randrange(80_000)}" for _ in range(300)) for _ in range(60)]
    texts += [" ".join(f"r{400 * k + j} the" for j in range(0, 400, 3)) + " of the end" for k in range(60)]
    texts += [texts[k] for k in range(40)] + [f"r{400 * k} r{400 * k + 1} unseen{k} r5 unseen{k}" for k in range(80)]
    rows = [(k, t) for k, t in enumerate(texts)]
    got = by_id(katz.fit_and_score(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), "doc_id", "text"))
    tokens = {k: [*words(t), None] for k, t in rows}
    training = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    assert len({w for t in training for w in t}) > katz.VOCABULARY
    for k, (base, known, score) in score_by_hand(training, tokens).items():
        assert got[k]["n_known"] == known
        assert math.isclose(got[k]["base_score"], base, rel_tol=1e-9)
        assert math.isclose(got[k]["score"], score, rel_tol=1e-9), k


def largest_part(words, texts, partitions):
    """Pairs dealt in all, and to the partition that gets most."""
    n = len(texts)
    columns = [pa.array(range(n)), pa.array(texts), pa.array([0] * n), pa.array([True] * n)]
    parts = Counter()
    for batch in katz._dealer(words, partitions)([pa.RecordBatch.from_arrays(columns, names=list("abcd"))]):
        for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parts[part] += int(np.frombuffer(blob, np.int64, 1)[0])
    return sum(parts.values()), max(parts.values(), default=0)


def test_katz_deals_rare_words_evenly():
    """Rare words after each other and after a frequent word are not one group."""
    texts = [" ".join(f"q{300 * k + j} the" if j % 3 else f"q{300 * k + j}" for j in range(300)) for k in range(50)]
    the = katz._tokens(pa.array(["the"], pa.large_string()), 0, 1)[0]
    words = katz.Unigrams(the, np.array([10_000, 50]), 25_050, 15_002)
    total, most = largest_part(words, texts, 32)
    assert total > 20_000 and most < 1.3 * total / 32


def test_katz_hot_pairs_are_not_dealt(spark, monkeypatch):
    """Whatever its rank, a pair of more places than a task is planned for is not in one task."""
    monkeypatch.setattr(katz, "DENSE", 4)
    monkeypatch.setattr(katz, "TOKENS_PER_TASK", 600)
    rng = random.Random(13)
    texts = [" ".join(f"c{rng.randrange(8)}" for _ in range(150)) + " hot pair" * 25 for _ in range(40)]
    tokens = {k: [*words(t), None] for k, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = docs.selectExpr("text", "true AS t").mapInArrow(katz._counted, "h bigint, n bigint, every bigint")
    uni = katz._unigrams(counts.groupBy("h").sum("n", "every").toDF("h", "n", "every"))
    assert largest_part(uni, texts, 32)[1] <= 600
    got = by_id(katz.fit_and_score(docs, "doc_id", "text"))
    training = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    for k, (_, _, score) in score_by_hand(training, tokens).items():
        assert math.isclose(got[k]["score"], score, rel_tol=1e-9)


def test_katz_lists_hot_pairs(spark, monkeypatch):
    """Beyond the dense table, pairs of many places are listed, and no others; scores stay exact."""
    monkeypatch.setattr(katz, "TOKENS_PER_TASK", 700)
    monkeypatch.setattr(katz, "DENSE", 1)
    rng = random.Random(14)
    texts = [" ".join(f"c{rng.randrange(8)}" for _ in range(150)) + " hot pair" * 25 for _ in range(40)]
    tokens = {k: [*words(t), None] for k, t in enumerate(texts)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = docs.selectExpr("text", "crc32(encode(string(doc_id), 'UTF-8')) % 5 <> 1 AS train")
    counts = rows.mapInArrow(katz._counted, "h bigint, n bigint, every bigint")
    plain = katz._unigrams(counts.groupBy("h").sum("n", "every").toDF("h", "n", "every"))
    uni = katz._with_hot_pairs(rows, plain)
    assert len(uni.hot) == 2 and plain.dense == 1
    every, trained = Counter(), Counter()
    for k, t in tokens.items():
        every.update(zip(t, t[1:], strict=False))
        if zlib.crc32(str(k).encode()) % 5 != 1:
            trained.update(zip(t, t[1:], strict=False))
    hot = [p for p, n in every.items() if n > 700]
    assert sorted(uni.hot_counts) == sorted(trained[p] for p in hot)
    assert largest_part(uni, texts, 32)[1] <= 700 < largest_part(plain, texts, 32)[1]
    got = by_id(katz.fit_and_score(docs, "doc_id", "text"))
    training = [t for k, t in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1]
    for k, (_, _, score) in score_by_hand(training, tokens).items():
        assert math.isclose(got[k]["score"], score, rel_tol=1e-9)


def score_by_hand(training, tokens):
    c, pairs = Counter(), Counter()
    for t in training:
        c.update(t)
        pairs.update(zip([None, *t], t, strict=False))
    total, distinct = sum(c.values()), len(c)
    d = katz.good_turing(np.array([sum(n == r for n in pairs.values()) for r in range(1, katz.CUT + 2)], float))
    keep = lambda r: d[r - 1] * r if r <= katz.CUT else r
    p = lambda w: (c[w] + 0.5) / (total + 0.5 * (distinct + 1))
    followers = defaultdict(list)
    for (v, w), r in pairs.items():
        followers[v].append((w, r))

    def parts(v):
        kept = sum(keep(r) for _, r in followers[v])
        down = c[v] + (c[v] - kept < 1e-9 * max(c[v], 1))
        free = 1 - kept / max(down, 1) if c[v] else 1.0
        return down, free / max(1 - sum(p(w) for w, _ in followers[v]), 1e-12)

    out, cache = {}, {}
    for i, t in tokens.items():
        base = sum(math.log10(p(w)) for w in t)
        score = 0.0
        for v, w in zip([None, *t], t, strict=False):
            # What is not in the vocabulary is one word for the model.
            v = v if c[v] else "\0"
            down, alpha = cache.get(v) or cache.setdefault(v, parts(v))
            r = pairs[v, w]
            score += math.log10(keep(r) / down) if r else math.log10(alpha * p(w))
        out[i] = (base, sum(c[w] > 0 for w in t), score)
    return out


def test_followers_sum_to_one():
    """Over the vocabulary, the rest class included, each history's probabilities sum to one."""
    rng = np.random.default_rng(3)
    n = 40
    table = np.zeros((katz.DENSE, katz.DENSE), np.int64)
    table[:n, :n] = rng.poisson(0.7, (n, n))
    counts = np.maximum(table.sum(axis=1)[:n], 1)
    order = np.argsort(-counts, kind="stable")
    table[:n, :n] = table[:n, :n][order][:, order]
    uni = katz.Unigrams(np.arange(1, n + 1, dtype=np.uint64), table.sum(axis=1)[:n], int(table.sum()), n)
    model = katz.Model(uni, table.ravel(), np.zeros((katz.UNKNOWN + 1, katz.CUT + 3)))
    for v in range(n):
        r = table[v, :n]
        logs = np.where(r > 0, model.seen_logs(r) - model.log_down[v], model.log_alpha[v] + uni.log_p[:n])
        rest = 10 ** (model.log_alpha[v] + uni.log_p[katz.UNKNOWN])
        assert math.isclose((10.0**logs).sum() + rest, 1.0, rel_tol=1e-9)


def test_token_counts(spark, docs, odd, empty, texts):
    import public_tokenizers
    import tiktoken

    path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    counter = tokencounts.Counter(path, public_tokenizers.PATTERN)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    whole = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    for text in filter(None, texts):
        tree = tokencounts.Tree(text, counter)
        assert tree.tokens == len(whole.encode_ordinary(text))
        for _ in range(12):
            a = rng.randint(0, len(text) + 1)
            b = a + rng.choice([0, 0, 1, 7, 500])
            new = rng.choice(["", " ", "  ", "x", "\n\n", "'s", "été 12 ", "word " * 90])
            text = text[:a] + new + text[max(a, b) :]
            tree.replace(a, b, new)
            assert tree.text() == text and tree.chars == len(text)
            assert tree.tokens == len(whole.encode_ordinary(text))
    long = texts[-6]
    tree = tokencounts.Tree("word " * 20_000, counter)
    before = tree.encoded
    tree.replace(50_000, 50_004, "other")
    assert tree.encoded - before < 2_000 and long is not None
    got = by_id(tokencounts.count_tokens(docs, "doc_id", "text", None, path, public_tokenizers.PATTERN))
    assert all(got[3 * k]["n_tokens"] == len(whole.encode_ordinary(t or "")) for k, t in enumerate(texts))
    for table in (odd, empty):
        found = tokencounts.count_tokens(table, "doc_id", "text", None, path, public_tokenizers.PATTERN)
        assert found.count() == table.count()


def test_chat(spark):
    rng = random.Random(12)
    bits = ["a", "\\", "<|im_end|>", "<|", "|>", "\n", "[INST]", "</s>", "é", "<", "\\\\|", "{{ x }}", ""]
    rows = []
    for conv in [*range(20), None]:
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "ro\nle", "<|x"])
            rows.append((conv, turn, role, rng.choice([None, "".join(rng.choice(bits) for _ in range(8))])))
    rows += [(3, None, "user", "first"), (3, None, "user", "first")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df, "conv_id", "turn", "role", "text")).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    template = chat.Template(chat.TEMPLATE)
    for conv, own in groups.items():
        own.sort()
        turns = "".join(f"{r[3]}\n{r[5]}\n" for r in own)
        loss = "".join(r[5] for r in own if r[3] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        whole = template.render([{"role": r[3], "text": r[5]} for r in own]).text()
        row = got[conv]
        assert (row["n_turns"], row["turns_sha256"]) == (len(own), sha(turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha(loss))
        assert row["formatted_chars"] == len(whole)
    none = df.limit(0)
    assert chat.read_back(chat.format_turns(none, "conv_id", "turn", "role", "text")).count() == 0


def test_template_language():
    source = (
        "A{% for m in messages %}{% set r = m['role'] | upper %}{% if loop.first and not (r == 'X') %}[{{ 'a' + 'b' }}]"
        "{% elif 'q' in m.text %}Q{% else %}{{ m.missing }}{{ m.text | length }}{% endif %}"
        "{% generation %}{{ r }}{% endgeneration %}{% endfor %}Z"
    )
    out = chat.Template(source).render([{"role": "u", "text": "1"}, {"role": "v", "text": "q"}, {"role": "x", "text": "12"}])
    assert out.text() == "A[ab]UQV2XZ"
    assert [out.text()[a:b] for a, b in out.spans] == ["U", "V", "X"]
    assert chat.fold(chat._Expression("'a' + 'b' == 'ab' and x").tree) == ("name", "x")
    for bad in ("{% for m in messages %}", "{{ x | nothing }}", "{% run x %}", "{{ 1 + }}", "{% endif %}", "{{ f(x) }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad + "{% for m in messages %}{% endfor %}")


@pytest.mark.parametrize("bound, collide", [(32 << 20, False), (0, False), (32 << 20, True)])
def test_word_tokens(monkeypatch, bound, collide):
    """With a table that is always full, and with words that share a hash, ids stay those of the tokenizer."""
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "KNOWN_BYTES", bound)
    if collide:
        whole = packing.words_in

        def coarse(*args):
            found = whole(*args)
            found.hashes &= np.uint64(3)
            return found

        monkeypatch.setattr(packing, "words_in", coarse)
    parts = ["the", "The", "cat's", "Été!?", "x2y", "", "  ", "a\tb\n", "İΣ", "<|endoftext|>", "end.", "​"]
    texts = [" ".join(parts[k % 12] + parts[(k * j) % 12] for j in range(k % 9)) for k in range(300)]
    tokens, column = packing.WordTokens(path), packing.texts_of(pa.array([*texts, None, ""]))
    for lo, hi in [(0, 100), (100, 250), (250, 302)]:
        flat, counts = tokens.ids(column, lo, hi)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in column[lo:hi].to_pylist()]
        assert counts.tolist() == [len(w) for w in want] and flat.tolist() == [k for w in want for k in w]
