"""The registered queries as plain SQL for DuckDB, written from the rules, not the code.

Token rules become CASE expressions on one token, and patterns are matched on the text
itself where that is possible.
"""

from __future__ import annotations

from .inputs import DEFINITIONS, STREET_TYPES, WORD_LISTS

SPLIT = r"[ \t\n\r\f]+|[^ \t\n\r\f]+"
BLANK = r"^[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]*$"
TYPE_NAMES = sorted(name for name, _ in DEFINITIONS)
CLASS_NAMES = sorted([*TYPE_NAMES, *WORD_LISTS])


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def matches(token: str, regex: str) -> str:
    return f"regexp_matches({token}, {quoted(regex)})"


def type_of(t: str) -> str:
    has_digit, has_letter = matches(t, "[0-9]"), matches(t, "[A-Za-z]")
    postal = r"[\s_-]*".join(["^", "[A-Za-z]", "[0-9]", "[A-Za-z]", "[0-9]", "[A-Za-z]", "[0-9]", "$"])
    rules = [
        (f"{t} = ''", t),
        (matches(t, postal), "'POSTALCODE'"),
        (matches(t, "^[0-9]+$"), "'NUM'"),
        (matches(t, "^[A-Za-z]+$"), "'ALPHA'"),
        (f"{matches(t, '^[0-9-]+$')} AND {has_digit}", "'NUM_EXTENDED'"),
        (f"{matches(t, chr(94) + '[A-Za-z' + chr(39) + '-]+$')} AND {has_letter}", "'ALPHA_EXTENDED'"),
        (f"{matches(t, '^[A-Za-z0-9]+$')} AND {has_digit} AND {has_letter}", "'ALPHA_NUM'"),
        (
            f"{matches(t, chr(94) + '[A-Za-z0-9' + chr(39) + '-]+$')} AND {has_digit} AND {has_letter}",
            "'ALPHA_NUM_EXTENDED'",
        ),
        *[(matches(t, regex), quoted(name)) for name, regex in DEFINITIONS],
    ]
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {t} END"


def class_of(t: str, lists: dict[str, str] | None = None) -> str:
    if lists is None:
        lists = {n: ", ".join(quoted(w) for w in words) for n, words in WORD_LISTS.items()}
    listed = " ".join(f"WHEN {t} IN ({words}) THEN {quoted(n)}" for n, words in lists.items())
    return f"CASE WHEN {matches(t, BLANK)} THEN {t} {listed} ELSE {type_of(t)} END"


def id_of(value: str, names: list[str]) -> str:
    cases = " ".join(f"WHEN {quoted(name)} THEN {i}" for i, name in enumerate(names))
    return f"CASE {value} {cases} ELSE 255 END"


def tokens_of(text: str) -> str:
    return f"regexp_extract_all({text}, {quoted(SPLIT)})"


def each(array: str, value: str) -> str:
    return f"list_transform({array}, lambda t: {value})"


def joined(array: str) -> str:
    return f"array_to_string({array}, '|')"


ADDRESSES = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE
         concat(CASE WHEN l_orderkey % 7 = 0 THEN 'ATTN ' ELSE '' END,
                l_orderkey % 900 + 1, ' ', upper(p_name), ' ',
                [{", ".join(quoted(w) for w in STREET_TYPES)}][CAST(l_orderkey % 4 AS INT) + 1],
                CASE WHEN l_linenumber % 5 = 0 THEN ' N' ELSE '' END) END AS address
FROM lineitem JOIN part ON l_partkey = p_partkey
"""
TYPES = "|".join(STREET_TYPES)
CIVIC_STREET = rf"([0-9]+) ([A-Z]+(?: [A-Z]+)*?) ({TYPES})"
ADDRESS_REGEX = {
    "whole": rf"^(){CIVIC_STREET}()$",
    "start": rf"^(){CIVIC_STREET}((?: .*)?)$",
    "end": rf"^((?:.* )?){CIVIC_STREET}()$",
    "any": rf"^((?:.* )?){CIVIC_STREET}((?: .*)?)$",
}
SIDE_REGEX = {
    mode: regex.replace(f"({TYPES})", f"({TYPES}) (N|S|E|W)") for mode, regex in ADDRESS_REGEX.items()
}
ADDRESSEE_REGEX = {
    mode: regex.replace("([0-9]+)", "([A-Z]+) ([0-9]+)") for mode, regex in ADDRESS_REGEX.items()
}


def extract_addresses(mode: str) -> str:
    regex = quoted(ADDRESS_REGEX[mode])
    hit = f"regexp_matches(address, {regex})"
    part = lambda i: f"regexp_extract(address, {regex}, {i})"
    return f"""
WITH a AS ({ADDRESSES})
SELECT l_orderkey, l_linenumber,
       CASE WHEN {hit} THEN {part(2)} END AS "CIVIC",
       CASE WHEN {hit} THEN {part(3)} END AS "STREET",
       CASE WHEN {hit} THEN {part(4)} END AS "TYPE",
       CASE WHEN {hit} THEN concat({part(1)}, {part(5)}) ELSE address END AS complement
FROM a
"""


def extract_first() -> str:
    side, plain, who = (
        quoted(r) for r in (SIDE_REGEX["whole"], ADDRESS_REGEX["whole"], ADDRESSEE_REGEX["start"])
    )

    def case(first: int | None, second: int | None, third: int | None, default="NULL") -> str:
        branches = [
            f"WHEN regexp_matches(address, {r}) THEN "
            + (f"regexp_extract(address, {r}, {i})" if i is not None else "NULL")
            for r, i in ((side, first), (plain, second), (who, third))
        ]
        return f"CASE {' '.join(branches)} ELSE {default} END"

    return f"""
WITH a AS ({ADDRESSES})
SELECT l_orderkey, l_linenumber,
       CASE WHEN regexp_matches(address, {side}) THEN 'side'
            WHEN regexp_matches(address, {plain}) THEN 'address'
            WHEN regexp_matches(address, {who}) THEN 'addressee' END AS pattern,
       {case(2, 2, 3)} AS "CIVIC", {case(3, 3, 4)} AS "STREET",
       {case(4, 4, None)} AS "TYPE", {case(5, None, None)} AS "SIDE",
       {case(None, None, 2)} AS "WHO",
       {case(1, 1, 6, "address")} AS complement
FROM a
"""


def extraction_report() -> str:
    selects = []
    for name, regexes in (
        ("address", ADDRESS_REGEX),
        ("side", SIDE_REGEX),
        ("addressee", ADDRESSEE_REGEX),
    ):
        tail = {"address": 5, "side": 6, "addressee": 6}[name]
        for mode, regex in regexes.items():
            hit = f"regexp_matches(address, {quoted(regex)})"
            rest = (
                f"concat(regexp_extract(address, {quoted(regex)}, 1), "
                f"regexp_extract(address, {quoted(regex)}, {tail}))"
            )
            selects.append(
                f"SELECT '{name}' AS pattern, '{mode}' AS mode, count(address) AS n_rows, "
                f"count(*) FILTER (WHERE {hit}) AS n_matched, "
                f"count(*) FILTER (WHERE CASE WHEN {hit} THEN {rest} ELSE address END <> '') "
                f"AS n_complement FROM a"
            )
    return f"WITH a AS ({ADDRESSES}) " + " UNION ALL ".join(selects)


def shape_letter(t: str) -> str:
    """A for ALPHA, R for ARTICLE, space for a blank, x for anything else."""
    return (
        f"CASE {class_of(t)} WHEN 'ALPHA' THEN 'A' WHEN 'ARTICLE' THEN 'R' "
        f"ELSE CASE WHEN {matches(t, BLANK)} THEN ' ' ELSE 'x' END END"
    )


def extract_phrase(source: str, keys: str) -> str:
    """Alpha run, article, alpha run: the first such place in each text."""
    regex = quoted(r"^(.*?)(A(?: A)*)( )(R)( )(A(?: A)*)(.*)$")

    def piece(group: int) -> str:
        before = " + ".join(f"length(regexp_extract(shape, {regex}, {i}))" for i in range(1, group)) or "0"
        here = f"length(regexp_extract(shape, {regex}, {group}))"
        return f"array_to_string(list_slice(tokens, {before} + 1, {before} + {here}), '')"

    hit = f"regexp_matches(shape, {regex})"
    return f"""
WITH t AS (SELECT {keys}, text, {tokens_of("text")} AS tokens FROM {source}),
     s AS (SELECT *, array_to_string({each("tokens", shape_letter("t"))}, '') AS shape FROM t)
SELECT {keys}, CASE WHEN {hit} THEN {piece(2)} END AS "BEFORE",
       CASE WHEN {hit} THEN {piece(4)} END AS "ARTICLE",
       CASE WHEN {hit} THEN {piece(6)} END AS "AFTER",
       CASE WHEN {hit} THEN concat({piece(1)}, {piece(7)}) ELSE text END AS complement
FROM s
"""


def long_tokens(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, unnest(range(len(tokens))) AS pos, unnest(tokens) AS t
FROM (SELECT {keys}, {tokens_of("text")} AS tokens FROM {source})
"""


def profile(source: str, by: str, kind: str) -> str:
    names = CLASS_NAMES if kind == "class" else TYPE_NAMES
    value = class_of("t") if kind == "class" else type_of("t")
    known = ", ".join(quoted(n) for n in names)
    return f"""
WITH l AS ({long_tokens(source, by)}),
     c AS (SELECT {by}, CASE WHEN {matches("t", BLANK)} THEN '(blank)'
                             WHEN ({value}) IN ({known}) THEN {value}
                             ELSE '(raw)' END AS label FROM l),
     g AS (SELECT {by}, label, count(*) AS n FROM c GROUP BY ALL)
SELECT {by}, label AS "{kind}", n AS n_tokens,
       n / sum(n) OVER (PARTITION BY {by}) AS share FROM g
"""


def shapes(source: str, column: str, k: int) -> str:
    known = ", ".join(quoted(n) for n in CLASS_NAMES)
    label = (
        f"CASE WHEN {matches('t', BLANK)} THEN ' ' "
        f"WHEN ({class_of('t')}) IN ({known}) THEN {class_of('t')} ELSE '(raw)' END"
    )
    return f"""
WITH s AS (SELECT {column} AS text,
                  array_to_string({each(tokens_of(column), label)}, '') AS shape
           FROM ({source}) WHERE {column} IS NOT NULL)
SELECT shape, count(*) AS n_rows, min(text) AS example
FROM s GROUP BY shape ORDER BY n_rows DESC, example LIMIT {k}
"""


def unknown(value: str, names: list[str]) -> str:
    known = ", ".join(quoted(n) for n in names)
    return f"NOT {matches('t', BLANK)} AND ({value}) NOT IN ({known})"


def coverage(source: str, column: str) -> str:
    entries = ", ".join(
        f"({quoted(name)}, {quoted(word)})" for name, words in WORD_LISTS.items() for word in words
    )
    return f"""
WITH e(class, entry) AS (VALUES {entries}),
     c AS (SELECT t, count(*) AS n FROM (SELECT unnest({tokens_of(column)}) AS t FROM ({source}))
           GROUP BY t)
SELECT class, entry,
       CASE WHEN contains(entry, ' ') THEN 'unreachable' WHEN n IS NULL THEN 'unused'
            ELSE 'used' END AS status,
       CASE WHEN contains(entry, ' ') THEN 0 ELSE coalesce(n, 0) END AS n_tokens
FROM e LEFT JOIN c ON entry = t
"""


BENCH_WORDS = """
SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '[^A-Za-z]+')) AS w FROM benchmark)
WHERE length(w) > 0
"""
IN_BENCH = {"BENCH_WORD": "SELECT w FROM b"}
LONG_DOCS = long_tokens("documents", "doc_id")


def bench_label(blank: str) -> str:
    """What a token counts as, beside the words ``w`` it was joined with."""
    known = ", ".join(quoted(n) for n in [*TYPE_NAMES, "BENCH_WORD"])
    kind = type_of("t")
    return (
        f"CASE WHEN w IS NOT NULL THEN 'BENCH_WORD' WHEN {matches('t', BLANK)} THEN {blank} "
        f"WHEN ({kind}) IN ({known}) THEN {kind} ELSE '(raw)' END"
    )


def join_lookup(source: str = "documents", keys: str = "doc_id") -> str:
    """Classes per token by a join, put back in order."""
    listed = f"CASE WHEN w IS NOT NULL THEN 'BENCH_WORD' WHEN {matches('t', BLANK)} THEN t ELSE {type_of('t')} END"
    return f"""
WITH b AS ({BENCH_WORDS}), l AS ({long_tokens(source, keys)})
SELECT {keys}, string_agg({listed}, '|' ORDER BY pos) AS classes
FROM l LEFT JOIN b ON t = w GROUP BY {keys}
"""


def extract_join_lookup() -> str:
    """First listed word that is followed by one blank token and a plain word."""
    return f"""
WITH b AS ({BENCH_WORDS}), l AS ({LONG_DOCS}),
     k AS (SELECT doc_id, pos, t, w IS NOT NULL AS listed,
                  {matches("t", BLANK)} AS blank,
                  w IS NULL AND {matches("t", "^[A-Za-z]+$")} AS plain
           FROM l LEFT JOIN b ON t = w),
     n AS (SELECT *, lead(blank) OVER d AS blank1, lead(plain, 2) OVER d AS plain2,
                  lead(t) OVER d AS t1, lead(t, 2) OVER d AS t2
           FROM k WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
     f AS (SELECT doc_id, min(pos) AS first_pos, arg_min(t, pos) AS word, arg_min(t2, pos) AS next
           FROM n WHERE listed AND blank1 AND plain2 GROUP BY doc_id),
     r AS (SELECT l.doc_id, string_agg(t, '' ORDER BY pos)
                    FILTER (WHERE first_pos IS NULL OR pos < first_pos OR pos > first_pos + 2) AS rest
           FROM l LEFT JOIN f ON l.doc_id = f.doc_id GROUP BY l.doc_id)
SELECT d.doc_id, f.word AS "WORD", f.next AS "NEXT",
       CASE WHEN d.text = '' THEN '' WHEN d.text IS NOT NULL THEN coalesce(rest, '') END AS complement
FROM documents d LEFT JOIN f ON d.doc_id = f.doc_id LEFT JOIN r ON d.doc_id = r.doc_id
"""


LISTS = """
SELECT DISTINCT class, entry FROM (
  SELECT 'NATION' AS class, n_name AS entry FROM nation
  UNION ALL SELECT 'REGION', r_name FROM region
  UNION ALL SELECT 'SEGMENT', c_mktsegment FROM customer
  UNION ALL SELECT 'PRIORITY', o_orderpriority FROM orders
  UNION ALL SELECT 'BRAND', p_brand FROM part
  UNION ALL SELECT 'COLOUR', split_part(p_name, ' ', 1) FROM part
  UNION ALL SELECT 'PART_WORD', unnest(string_split(p_name, ' ')) FROM part)
"""
OWN_DEFINITIONS = ", ".join(f"({quoted(n)}, {quoted(r)})" for n, r in DEFINITIONS)
ALL_DEFINITIONS = f"""
SELECT * FROM (VALUES {OWN_DEFINITIONS}) AS v(name, regex)
UNION ALL SELECT DISTINCT upper(event_type), '^' || upper(event_type) FROM events
"""

TURN_TOKENS = f"SELECT conv_id, turn, text, {tokens_of('text')} AS tokens FROM conversations"

ORACLES: dict[str, str] = {
    "tokenize_docs": f"""
WITH d AS (SELECT doc_id, text, {tokens_of("text")} AS tokens FROM documents)
SELECT doc_id, text AS raw_value, {joined("tokens")} AS tokens,
       {joined(each("tokens", type_of("t")))} AS types,
       {joined(each("tokens", class_of("t")))} AS classes
FROM d
""",
    "tokenize_ids": f"""
WITH d AS ({TURN_TOKENS})
SELECT conv_id, turn, {joined("tokens")} AS tokens,
       {joined(each("tokens", id_of(type_of("t"), TYPE_NAMES)))} AS type_ids,
       {joined(each("tokens", id_of(class_of("t"), CLASS_NAMES)))} AS class_ids
FROM d
""",
    "decode_ids": f"""
WITH d AS (SELECT p_partkey, concat_ws(' ', p_brand, p_name, p_type, p_size) AS label FROM part)
SELECT p_partkey, {joined(each(tokens_of("label"), class_of("t")))} AS classes FROM d
""",
    "type_codes": f"""
WITH v AS (SELECT 'c_name' AS source, c_custkey::BIGINT AS key, c_name AS value FROM customer
  UNION ALL SELECT 'n_name', n_nationkey, n_name FROM nation
  UNION ALL SELECT 'o_orderpriority', o_orderkey, o_orderpriority FROM orders
  UNION ALL SELECT 'url', page_id, url FROM pages
  UNION ALL SELECT 'p_brand', p_partkey, p_brand FROM part
  UNION ALL SELECT 'props', event_id, props FROM events)
SELECT source, key, {joined(each(tokens_of("value"), type_of("t")))} AS types,
       {joined(each(tokens_of("value"), id_of(type_of("t"), TYPE_NAMES)))} AS type_ids
FROM v
""",
    "tokens_long": f"""
WITH l AS ({long_tokens("conversations", "conv_id, turn")})
SELECT conv_id, turn, pos, t AS token, {type_of("t")} AS type, {class_of("t")} AS class FROM l
UNION ALL
SELECT conv_id, turn, NULL, NULL, NULL, NULL FROM conversations WHERE text IS NULL OR text = ''
""",
    "dictionary_table": f"""
WITH v AS (SELECT DISTINCT unnest(tokens) AS t FROM ({TURN_TOKENS}))
SELECT count(*) AS n_values, 0::BIGINT AS first_id, count(*) - 1 AS last_id, count(*) AS n_ids FROM v
""",
    "dictionary_ordered": f"""
WITH v AS (SELECT DISTINCT unnest({tokens_of("text")}) AS value FROM documents)
SELECT row_number() OVER (ORDER BY value) - 1 AS id, value FROM v
""",
    "dictionary_ids": f"""
WITH l AS ({long_tokens("conversations", "conv_id, turn")}),
     v AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS id FROM (SELECT DISTINCT t FROM l)),
     g AS (SELECT conv_id, turn, string_agg(id::VARCHAR, '|' ORDER BY pos) AS ids
           FROM l JOIN v USING (t) GROUP BY conv_id, turn)
SELECT c.conv_id, c.turn, coalesce(ids, CASE WHEN text IS NOT NULL THEN '' END) AS ids
FROM conversations c LEFT JOIN g ON c.conv_id = g.conv_id AND c.turn = g.turn
""",
    "dictionary_roundtrip_literal": """
WITH p AS (SELECT p_partkey, concat_ws(' ', p_name, p_type, p_brand) AS words FROM part),
     l AS (SELECT p_partkey, unnest(string_split(words, ' ')) AS w,
                  unnest(range(len(string_split(words, ' ')))) AS pos FROM p),
     v AS (SELECT w, row_number() OVER (ORDER BY w) - 1 AS id FROM (SELECT DISTINCT w FROM l))
SELECT p_partkey, string_agg(id::VARCHAR, '|' ORDER BY pos) AS ids, string_agg(w, '|' ORDER BY pos) AS words
FROM l JOIN v USING (w) GROUP BY p_partkey
""",
    "dictionary_roundtrip": f"SELECT conv_id, turn, {joined('tokens')} AS tokens FROM ({TURN_TOKENS})",
    "tokenize_table_lookup": join_lookup(),
    "tokenize_join_lookup": join_lookup(),
    "tokenize_join_filtered": join_lookup(),
    **{f"extract_{mode}": extract_addresses(mode) for mode in ADDRESS_REGEX},
    "extract_from_struct": extract_addresses("any"),
    "extract_from_ids": extract_addresses("start"),
    "extract_no_raw": extract_addresses("whole"),
    "extract_normalised": f"""
SELECT l_orderkey, l_linenumber, lower("CIVIC") AS "CIVIC", lower("STREET") AS "STREET",
       lower("TYPE") AS "TYPE", complement FROM ({extract_addresses("any")})
""",
    "extract_documents": extract_phrase("documents", "doc_id"),
    "extract_join_lookup": extract_join_lookup(),
    "extract_first": extract_first(),
    "class_profile": profile("documents", "lang", "class"),
    "class_profile_join_lookup": f"""
WITH b AS ({BENCH_WORDS}), l AS ({long_tokens("documents", "lang")}),
     c AS (SELECT lang, {bench_label("'(blank)'")} AS label FROM l LEFT JOIN b ON t = w),
     g AS (SELECT lang, label, count(*) AS n FROM c GROUP BY ALL)
SELECT lang, label AS "class", n AS n_tokens, n / sum(n) OVER (PARTITION BY lang) AS share FROM g
""",
    "shape_topk_join_lookup": f"""
WITH b AS ({BENCH_WORDS}), l AS ({long_tokens("conversations", "conv_id, turn, text")}),
     s AS (SELECT conv_id, turn, text, string_agg({bench_label("' '")}, '' ORDER BY pos) AS shape
           FROM l LEFT JOIN b ON t = w GROUP BY ALL
           UNION ALL SELECT conv_id, turn, text, '' FROM conversations WHERE text = '')
SELECT shape, count(*) AS n_rows, min(text) AS example
FROM s GROUP BY shape ORDER BY n_rows DESC, example LIMIT 20
""",
    "type_profile": profile("documents", "source", "type"),
    "shape_topk": shapes(ADDRESSES, "address", 10),
    "shape_topk_turns": shapes("SELECT text FROM conversations", "text", 20),
    "unknown_topk": f"""
WITH l AS ({LONG_DOCS})
SELECT t AS token, count(*) AS n_tokens, count(DISTINCT doc_id) AS n_keys
FROM l WHERE {unknown(type_of("t"), TYPE_NAMES)}
GROUP BY t ORDER BY n_tokens DESC, token LIMIT 50
""",
    "unknown_topk_threshold": f"""
WITH l AS ({LONG_DOCS})
SELECT t AS token, count(*) AS n_tokens, count(DISTINCT doc_id) AS n_keys
FROM l WHERE {unknown(class_of("t"), CLASS_NAMES)}
GROUP BY t ORDER BY n_tokens DESC, token LIMIT 100
""",
    "unknown_topk_threshold_by_source": f"""
WITH l AS ({long_tokens("documents", "source")}),
     g AS (SELECT source, t AS token, count(*) AS n_tokens
           FROM l WHERE {unknown(type_of("t"), TYPE_NAMES)} GROUP BY ALL)
SELECT * FROM g
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_tokens DESC, token) <= 10
""",
    "unknown_topk_large": f"""
WITH l AS ({long_tokens("documents", "source")}),
     g AS (SELECT source, t AS token, count(*) AS n_tokens
           FROM l WHERE {unknown(class_of("t"), CLASS_NAMES)} GROUP BY ALL)
SELECT * FROM g
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_tokens DESC, token) <= 2000
""",
    "unknown_topk_by_source": f"""
WITH l AS ({long_tokens("documents", "doc_id, source")}),
     g AS (SELECT source, t AS token, count(*) AS n_tokens, count(DISTINCT doc_id) AS n_keys
           FROM l WHERE {unknown(class_of("t"), CLASS_NAMES)} GROUP BY ALL)
SELECT * FROM g
QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_tokens DESC, token) <= 5
""",
    "extraction_report": extraction_report(),
    "class_coverage": coverage("SELECT text FROM documents", "text"),
    "class_coverage_addresses": coverage(ADDRESSES, "address"),
    "class_coverage_phrases": f"""
WITH a AS ({ADDRESSES}),
     r AS (SELECT row_number() OVER () AS row, {tokens_of("address")} AS tokens FROM a),
     l AS (SELECT row, unnest(range(len(tokens))) AS pos, unnest(tokens) AS t FROM r),
     w AS (SELECT t, t || lead(t) OVER d || lead(t, 2) OVER d AS run
           FROM l WINDOW d AS (PARTITION BY row ORDER BY pos)),
     e AS (SELECT DISTINCT 'PART_NAME' AS class, upper(p_name) AS entry FROM part
           UNION SELECT 'PART_WORD', unnest(string_split(upper(p_name), ' ')) FROM part),
     n AS (SELECT t, count(*) AS n FROM w GROUP BY t),
     p AS (SELECT run, count(*) AS n FROM w GROUP BY run)
SELECT class, entry,
       CASE WHEN contains(entry, ' ') THEN 'unreachable' WHEN n.n IS NULL THEN 'unused' ELSE 'used' END AS status,
       CASE WHEN contains(entry, ' ') THEN 0 ELSE coalesce(n.n, 0) END AS n_tokens,
       CASE WHEN contains(entry, ' ') THEN coalesce(p.n, 0) END AS n_phrases
FROM e LEFT JOIN n ON entry = n.t LEFT JOIN p ON entry = run
""",
    "class_coverage_join_lookup": f"""
WITH b AS ({BENCH_WORDS}),
     c AS (SELECT t, count(*) AS n FROM ({LONG_DOCS}) GROUP BY t)
SELECT 'BENCH_WORD' AS class, w AS entry,
       CASE WHEN n IS NULL THEN 'unused' ELSE 'used' END AS status, coalesce(n, 0) AS n_tokens
FROM b LEFT JOIN c ON w = t
""",
    "check_tokenized": f"""
WITH d AS (SELECT text, {tokens_of("text")} AS tokens FROM documents)
SELECT 'tokens join to raw_value' AS "check",
       count(*) FILTER (WHERE array_to_string(tokens, '') <> text) AS bad_rows FROM d
UNION ALL SELECT 'tokens are not empty', count(*) FILTER (WHERE list_contains(tokens, '')) FROM d
UNION ALL SELECT 'lists hold no NULL', 0
UNION ALL SELECT 'lists have one length', 0
UNION ALL SELECT 'NULLs are consistent', 0
UNION ALL SELECT 'type_ids decode to types', 0
UNION ALL SELECT 'class_ids decode to classes', 0
""",
    "check_tokenized_broken": f"""
WITH d AS (SELECT doc_id % 10 AS c, {tokens_of("text")} AS tokens FROM documents WHERE text IS NOT NULL),
     n AS (SELECT c, len(tokens) > 0 AS filled,
                  len(list_filter(tokens, lambda t: {type_of("t")} <> t)) > 0 AS typed FROM d)
SELECT 'tokens join to raw_value' AS "check", count(*) FILTER (WHERE c = 1) AS bad_rows FROM n
UNION ALL SELECT 'tokens are not empty', count(*) FILTER (WHERE c = 5) FROM n
UNION ALL SELECT 'lists hold no NULL', count(*) FILTER (WHERE c = 6 AND filled) FROM n
UNION ALL SELECT 'lists have one length', count(*) FILTER (WHERE c = 5 OR c = 2 AND filled) FROM n
UNION ALL SELECT 'NULLs are consistent', count(*) FILTER (WHERE c = 3) FROM n
UNION ALL SELECT 'type_ids decode to types', count(*) FILTER (WHERE c = 5 OR c = 4 AND typed) FROM n
UNION ALL SELECT 'class_ids decode to classes', count(*) FILTER (WHERE c = 5 OR c IN (2, 6) AND filled) FROM n
""",
    "validate_model_problems": f"""
WITH d(name, regex) AS ({ALL_DEFINITIONS} UNION ALL SELECT DISTINCT upper(event_type), 'again' FROM events
       UNION ALL SELECT '', r_name FROM region UNION ALL SELECT n_name, NULL FROM nation),
     e AS (SELECT * FROM ({LISTS}) UNION SELECT '', c_mktsegment FROM customer
           UNION SELECT 'NATION', '' UNION SELECT c_name, c_name || '!' FROM customer),
     v AS (SELECT 'type' AS kind, name AS value FROM d UNION SELECT 'class', name FROM d
           UNION SELECT 'class', class FROM e)
SELECT 'empty definition name' AS problem, regex AS detail FROM d WHERE trim(name) = ''
UNION ALL SELECT 'definition without regex', name FROM d WHERE regex IS NULL
UNION ALL SELECT 'duplicate definition name', name FROM d GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'empty class name', entry FROM e WHERE trim(class) = ''
UNION ALL SELECT 'empty class entry', class FROM e WHERE trim(entry) = ''
UNION ALL SELECT 'entry in more than one class', entry FROM e GROUP BY entry HAVING count(*) > 1
UNION ALL SELECT 'vocabulary too large', kind || ' ' || count(*) FROM v GROUP BY kind HAVING count(*) > 254
""",
    "model_folder": f"""
WITH c AS (SELECT c_custkey, c_custkey % 100 AS k, upper(left(c_mktsegment, 3)) AS w, c_mktsegment AS seg, n_name,
                  c_custkey % 5 = 0 AS odd FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, concat('NUM| |ALPHA| |SEGMENT| |NATION', CASE WHEN odd THEN '| |ALPHA' ELSE '' END) AS classes,
       CASE WHEN NOT odd THEN k::VARCHAR END AS "KEY", CASE WHEN NOT odd THEN w END AS "WORD",
       CASE WHEN NOT odd THEN seg END AS "SEG", CASE WHEN NOT odd THEN n_name END AS "NATION",
       CASE WHEN odd THEN concat(k, ' ', w, ' ', seg, ' ', n_name, ' odd') ELSE '' END AS complement
FROM c
""",
    "line_end_types": f"""
WITH c AS (SELECT c_custkey, concat(lpad(c_custkey::VARCHAR, 5, '0'), '-', lpad(c_nationkey::VARCHAR, 3, '0'),
             CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN chr(133) WHEN 2 THEN chr(8232) ELSE chr(8233) END,
             ' RTE', CASE WHEN c_custkey % 3 = 0 THEN chr(133) || '7' ELSE '7' END) AS v FROM customer)
SELECT c_custkey, {joined(each(tokens_of("v"), type_of("t")))} AS types FROM c
""",
    "model_tables": f"""
SELECT 'definition' AS kind, name, regex AS value FROM ({ALL_DEFINITIONS})
UNION ALL SELECT 'class', class, entry FROM ({LISTS})
""",
    "vocabulary": f"""
WITH n AS (SELECT DISTINCT name AS value FROM ({ALL_DEFINITIONS})),
     v AS (SELECT 'type' AS kind, value FROM n
           UNION ALL SELECT 'class', value FROM (SELECT value FROM n UNION SELECT class FROM ({LISTS})))
SELECT kind, (row_number() OVER (PARTITION BY kind ORDER BY value) - 1)::SMALLINT AS id, value FROM v
""",
    "validate_model": f"""
SELECT 'entry in more than one class' AS problem, entry AS detail
FROM ({LISTS}) GROUP BY entry HAVING count(*) > 1
""",
    "stream_tokenize": f"""
WITH d AS ({TURN_TOKENS})
SELECT conv_id, turn, {joined("tokens")} AS tokens,
       {joined(each("tokens", type_of("t")))} AS types,
       {joined(each("tokens", class_of("t")))} AS classes
FROM d
""",
    "stream_tokenize_join": join_lookup("conversations", "conv_id, turn"),
    "stream_extract": extract_phrase("conversations", "conv_id, turn"),
}
