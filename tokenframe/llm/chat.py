"""Format conversations by templates.

A template is compiled once per task: parsed into a syntax tree, its constants folded, and
turned into nested Python closures. The language is a sandbox: literals, names, fields of a
message, ``+``, comparisons, ``and or not``, ``in``, and a fixed list of filters; statements are
``for``, ``if``, ``set`` and ``generation``. It has no calls and no attributes of Python objects.
What stands inside ``generation`` is marked for the loss.

A template that is one loop over the messages is rendered turn by turn, so a conversation of
any length needs the memory of one turn. Control strings inside texts are escaped by backslashes
and can be read back exactly.

Defined cases: a NULL role or text is empty. Rows are ordered by turn, NULL first, then by role
and text, so ties and repeated rows have one order. Rows without a conversation id are one
conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import tasks_for

CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}{{ '<|im_start|>' + (m.role | escape_line) + '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}{{ '<|im_end|>' + '\\n' }}{% endfor %}"
)
TURN = re.compile(r"<\|im_start\|>((?:\\.|[^\\\n])*)\n((?:\\.|[^\\])*?)<\|im_end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


FILTERS: dict[str, Callable] = {
    "escape": escape, "escape_line": escape_line, "trim": str.strip, "upper": str.upper, "lower": str.lower,
    "length": len,
}

_PARTS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(\d+)|(\w+)|(==|!=|[-+()|.\[\],]))")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


class _Expression:
    """Recursive descent; a node is ("const", value) or (kind, child nodes or names…)."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            text, number, name, sign = m.groups()
            if text is not None:
                own = re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.DOTALL)
                self.tokens.append(("const", own))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0
        self.tree = self._or()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {source!r}")

    def _is(self, *values: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def _next(self) -> tuple:
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def _or(self) -> tuple:
        left = self._and()
        while self._is("or"):
            left = ("or", left, self._and())
        return left

    def _and(self) -> tuple:
        left = self._not()
        while self._is("and"):
            left = ("and", left, self._not())
        return left

    def _not(self) -> tuple:
        return ("not", self._not()) if self._is("not") else self._compare()

    def _compare(self) -> tuple:
        left = self._sum()
        while sign := self._is("==", "!=", "in"):
            left = (sign, left, self._sum())
        return left

    def _sum(self) -> tuple:
        left = self._filtered()
        while sign := self._is("+", "-"):
            left = (sign, left, self._filtered())
        return left

    def _filtered(self) -> tuple:
        node = self._atom()
        while True:
            if self._is("|"):
                kind, name = self._next()
                if kind != "name" or name not in FILTERS:
                    raise TemplateError(f"unknown filter {name!r}")
                node = ("filter", name, node)
            elif self._is("."):
                node = ("field", node, ("const", self._next()[1]))
            elif self._is("["):
                node = ("field", node, self._or())
                if not self._is("]"):
                    raise TemplateError("missing ]")
            else:
                return node

    def _atom(self) -> tuple:
        kind, value = self._next()
        if kind == "const":
            return ("const", value)
        if kind == "name":
            return ("const", value == "true") if value in ("true", "false") else ("name", value)
        if value == "(":
            node = self._or()
            if not self._is(")"):
                raise TemplateError("missing )")
            return node
        raise TemplateError(f"unexpected {value!r}")


_TWO: dict[str, Callable] = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b,
    "in": lambda a, b: a in b,
}


def fold(node: tuple) -> tuple:
    """Replace what has only constants below it by its value."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        inner = fold(node[2])
        return ("const", FILTERS[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    children = tuple(fold(n) for n in node[1:])
    if kind in _TWO and all(c[0] == "const" for c in children):
        return ("const", _TWO[kind](children[0][1], children[1][1]))
    if kind == "not" and children[0][0] == "const":
        return ("const", not children[0][1])
    if kind in ("and", "or") and children[0][0] == "const":
        return children[1] if bool(children[0][1]) == (kind == "and") else children[0]
    return (kind, *children)


def _closure(node: tuple) -> Callable[[dict], object]:
    kind = node[0]
    if kind == "const":
        return lambda env, value=node[1]: value
    if kind == "name":
        return lambda env, name=node[1]: env.get(name, "")
    if kind == "filter":
        return lambda env, use=FILTERS[node[1]], inner=_closure(node[2]): use(inner(env))
    if kind == "not":
        return lambda env, inner=_closure(node[1]): not inner(env)
    left, right = _closure(node[1]), _closure(node[2])
    if kind == "field":

        def field(env: dict) -> object:
            owner, key = left(env), right(env)
            return owner.get(key, "") if isinstance(owner, dict) else ""

        return field
    if kind == "and":
        return lambda env: left(env) and right(env)
    if kind == "or":
        return lambda env: left(env) or right(env)
    return lambda env, use=_TWO[kind]: use(left(env), right(env))


class Output:
    """Text as it grows, and the spans under generation."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def text(self) -> str:
        return "".join(self.parts)


def _parse(source: str) -> list[tuple]:
    """Statements: ("text", s), ("show", e), ("set", name, e), ("for", name, e, body),
    ("if", [(e, body), …]), ("generation", body)."""
    root: list[tuple] = []
    stack: list[tuple[str, list, object]] = [("", root, None)]
    at = 0

    def close(*kinds: str) -> tuple[str, list, object]:
        if stack[-1][0] not in kinds:
            raise TemplateError(f"{kinds[0]} is not open")
        return stack.pop()

    for m in _PARTS.finditer(source):
        if m.start() > at:
            stack[-1][1].append(("text", source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][1].append(("show", fold(_Expression(m[1]).tree)))
            continue
        word, _, rest = m[2].strip().partition(" ")
        if word == "for":
            got = re.fullmatch(r"(\w+)\s+in\s+(.*)", rest.strip(), re.DOTALL)
            if not got:
                raise TemplateError(f"cannot read for {rest!r}")
            stack.append(("for", [], (got[1], fold(_Expression(got[2]).tree))))
        elif word == "endfor":
            _, body, (name, over) = close("for")
            stack[-1][1].append(("for", name, over, body))
        elif word == "if":
            stack.append(("if", [], [(fold(_Expression(rest).tree), [])]))
            stack[-1] = ("if", stack[-1][2][-1][1], stack[-1][2])
        elif word in ("elif", "else"):
            _, _, arms = close("if")
            arms.append((fold(_Expression(rest).tree) if word == "elif" else ("const", True), []))
            stack.append(("if", arms[-1][1], arms))
        elif word == "endif":
            _, _, arms = close("if")
            stack[-1][1].append(("if", arms))
        elif word == "set":
            name, _, value = rest.partition("=")
            stack[-1][1].append(("set", name.strip(), fold(_Expression(value).tree)))
        elif word == "generation":
            stack.append(("generation", [], None))
        elif word == "endgeneration":
            _, body, _ = close("generation")
            stack[-1][1].append(("generation", body))
        else:
            raise TemplateError(f"unknown statement {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    if at < len(source):
        root.append(("text", source[at:]))
    return root


def _block(body: list[tuple]) -> Callable[[dict, Output], None]:
    steps = [_step(s) for s in body]

    def run(env: dict, out: Output) -> None:
        for step in steps:
            step(env, out)

    return run


def _step(statement: tuple) -> Callable[[dict, Output], None]:
    kind = statement[0]
    if kind == "text":
        return lambda env, out, text=statement[1]: out.write(text)
    if kind == "show":
        if statement[1][0] == "const":
            return lambda env, out, text=str(statement[1][1]): out.write(text)
        return lambda env, out, value=_closure(statement[1]): out.write(str(value(env)))
    if kind == "set":

        def set_(env: dict, out: Output, name=statement[1], value=_closure(statement[2])) -> None:
            env[name] = value(env)

        return set_
    if kind == "for":

        def for_(env: dict, out: Output, name=statement[1], over=_closure(statement[2]), body=_block(statement[3])):
            for k, item in enumerate(over(env) or ()):
                body({**env, name: item, "loop": {"index": k + 1, "first": k == 0}}, out)

        return for_
    if kind == "if":
        arms = [(_closure(test), _block(body)) for test, body in statement[1]]

        def if_(env: dict, out: Output) -> None:
            for test, body in arms:
                if test(env):
                    return body(env, out)

        return if_

    def generation(env: dict, out: Output, body=_block(statement[1])) -> None:
        start = out.size
        body(env, out)
        out.spans.append((start, out.size))

    return generation


class Template:
    def __init__(self, source: str) -> None:
        tree = _parse(source)
        self.whole = _block(tree)
        loops = [k for k, s in enumerate(tree) if s[0] == "for" and s[2] == ("name", "messages")]
        if len(loops) != 1 or any(s[0] not in ("text", "for") for s in tree):
            raise TemplateError("a template is one loop over the messages, with plain text around it")
        self.name = tree[loops[0]][1]
        self.head, self.body, self.tail = (
            _block(tree[: loops[0]]), _block(tree[loops[0]][3]), _block(tree[loops[0] + 1 :]),
        )

    def render(self, messages: list[dict]) -> Output:
        out = Output()
        self.whole({"messages": messages}, out)
        return out

    def turn(self, message: dict, number: int) -> Output:
        """One turn, without what stands around the loop."""
        out = Output()
        self.body({self.name: message, "loop": {"index": number + 1, "first": number == 0}}, out)
        return out

    def around(self) -> tuple[str, str]:
        head, tail = Output(), Output()
        self.head({}, head)
        self.tail({}, tail)
        return head.text(), tail.text()


def _formatter(source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        nobody = object()
        last, number = nobody, 0
        for batch in batches:
            texts, starts, ends, numbers = [], [], [], []
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                number = number + 1 if last is not nobody and conv == last else 0
                last = conv
                out = template.turn({"role": role or "", "text": text or ""}, number)
                texts.append(out.text())
                starts.append([a for a, _ in out.spans])
                ends.append([b for _, b in out.spans])
                numbers.append(number)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(numbers, pa.int64()), pa.array(texts, pa.string()),
                    pa.array(starts, kind), pa.array(ends, kind),
                ],
                names=["conv_id", "number", "formatted", "loss_starts", "loss_ends"],
            )

    return run


def format_turns(
    rows: DataFrame, conv: str, turn: str, role: str, text: str, template: str = TEMPLATE
) -> DataFrame:
    """A row per turn: its place, its formatted text, and the spans under the loss, in characters.

    The rows of a conversation lie one behind the other in one partition. Its id is taken as a bigint.
    """
    Template(template)
    named = rows.select(
        F.col(f"`{conv}`").cast("bigint").alias("__c0"),
        *[F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate((role, text, turn), start=1)],
    )
    ordered = named.repartition(tasks_for(rows.sparkSession), "__c0").sortWithinPartitions(
        "__c0", "__c3", "__c1", "__c2"
    )
    return ordered.select("__c0", "__c1", "__c2").mapInArrow(
        _formatter(template),
        "conv_id bigint, number bigint, formatted string, loss_starts array<bigint>, loss_ends array<bigint>",
    )


def _reader(head: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, rows = None, []

        def close() -> None:
            if state:
                conv, n, turns, chars, loss, size = state
                rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size + head))

        for batch in batches:
            for conv, number, formatted, starts, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number == 0:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                got = TURN.fullmatch(formatted)
                if not got:
                    raise ValueError("a formatted turn cannot be read back")
                state[1] += 1
                state[2].update(f"{unescape(got[1])}\n{unescape(got[2])}\n".encode())
                for a, b in zip(starts, ends, strict=True):
                    own = unescape(formatted[a:b])
                    state[3] += len(own)
                    state[4].update(own.encode())
                state[5] += len(formatted)
            if len(rows) >= 1_000:
                yield _digest(rows)
                rows = []
        close()
        if rows:
            yield _digest(rows)

    return read


def _digest(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_back(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation, read from what ``format_turns`` gave, in its partitions."""
    around = sum(map(len, Template(template).around()))
    return turns.mapInArrow(
        _reader(around),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )
