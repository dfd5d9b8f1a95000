"""Chat formatting by a compiled template.

A template is text with ``{{ expression }}`` and ``{% tag %}``. Tags are ``for name in expression``,
``if``/``elif``/``else``, ``set name = expression``, ``generation`` ... ``endgeneration``, and the
matching ends. Expressions have strings, integers, ``true``/``false``/``none``, names, ``.field`` and
``["field"]`` of mappings, ``loop.first``/``last``/``index0``, ``==``, ``!=``, ``and``, ``or``, ``not``,
``~`` (joining text), brackets and the filters ``trim``, ``upper``, ``lower``, ``escape``, ``escape_line``. There are no calls,
attributes of Python objects or unbounded loops, so a template cannot reach anything but its data.

``compile_template`` parses into a syntax tree, folds what is constant, and builds Python closures. They
write pieces of text to a sink; text inside ``generation`` is marked for the loss. ``escape`` makes control
strings inside a text harmless and can be undone by ``unescape``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradepanel.llm.common import map_batches

CHATML = (
    "{% for message in messages %}<|im_start|>{{ message.role | escape_line }}\n"
    '{% if message.role == "assistant" %}{% generation %}{{ message.text | escape }}{% endgeneration %}'
    "{% else %}{{ message.text | escape }}{% endif %}<|im_end|>\n{% endfor %}"
)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

Node = tuple
Env = dict[str, Any]


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    """The text without any ``<|``, so that no control string is left in it."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    """As ``escape``, and on one line."""
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


FILTERS: dict[str, Callable[[str], str]] = {
    "trim": str.strip, "upper": str.upper, "lower": str.lower, "escape": escape, "escape_line": escape_line,
}

# ---------------------------------------------------------------- parsing

_SCAN = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
_WORD = re.compile(r"""\s*(?:(?P<str>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[~|.()\[\]]))""", re.S)


class _Expression:
    """Recursive descent over the words of one expression."""

    def __init__(self, source: str):
        self.words, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = _WORD.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.words.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def next_is(self, *values: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] in ("op", "name") and self.words[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.next_is(*values):
            self.at += 1
            return self.words[self.at - 1][1]
        return None

    def need(self, kind: str) -> str:
        if self.at >= len(self.words) or self.words[self.at][0] != kind:
            raise TemplateError(f"expected a {kind}")
        self.at += 1
        return self.words[self.at - 1][1]

    def whole(self) -> Node:
        node = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return node

    def either(self) -> Node:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> Node:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> Node:
        if self.take("not"):
            return ("not", self.negated())
        node = self.joined()
        while op := self.take("==", "!="):
            node = (op, node, self.joined())
        return node

    def joined(self) -> Node:
        node = self.filtered()
        while self.take("~"):
            node = ("~", node, self.filtered())
        return node

    def filtered(self) -> Node:
        node = self.member()
        while self.take("|"):
            name = self.need("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            node = ("filter", node, name)
        return node

    def member(self) -> Node:
        node = self.atom()
        while True:
            if self.take("."):
                node = ("item", node, self.need("name"))
            elif self.take("["):
                node = ("item", node, _text(self.need("str")))
                if not self.take("]"):
                    raise TemplateError("missing ]")
            else:
                return node

    def atom(self) -> Node:
        if self.take("("):
            node = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return node
        if self.at >= len(self.words):
            raise TemplateError("expression ends early")
        kind, value = self.words[self.at]
        self.at += 1
        if kind == "str":
            return ("const", _text(value))
        if kind == "int":
            return ("const", int(value))
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None}
            return ("const", fixed[value]) if value in fixed else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def _text(literal: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), literal[1:-1], flags=re.S)


def parse(source: str) -> Node:
    """Syntax tree of a template."""
    words: list[tuple[str, str]] = []
    at = 0
    for m in _SCAN.finditer(source):
        words.append(("text", source[at : m.start()]))
        if m[1] is not None:
            words.append(("show", m[1]))
        elif m[2] is not None:
            words.append(("tag", m[2].strip()))
        at = m.end()
    words.append(("text", source[at:]))
    place = 0

    def block(*ends: str) -> tuple[Node, str]:
        nonlocal place
        body: list[Node] = []
        while place < len(words):
            kind, value = words[place]
            place += 1
            if kind == "text":
                if "{{" in value or "{%" in value:
                    raise TemplateError("a tag is not closed")
                if value:
                    body.append(("const", value))
                continue
            if kind == "show":
                body.append(("show", _Expression(value).whole()))
                continue
            tag, _, rest = value.partition(" ")
            if tag in ends:
                return ("block", body), value
            if tag == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                if not m:
                    raise TemplateError(f"cannot read for {rest!r}")
                body.append(("for", m[1], _Expression(m[2]).whole(), block("endfor")[0]))
            elif tag == "if":
                body.append(branch(rest))
            elif tag == "set":
                name, _, value = rest.partition("=")
                if not re.fullmatch(r"[A-Za-z_]\w*", name.strip()):
                    raise TemplateError(f"cannot set {name!r}")
                body.append(("set", name.strip(), _Expression(value).whole()))
            elif tag == "generation":
                body.append(("generation", block("endgeneration")[0]))
            else:
                raise TemplateError(f"unexpected tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return ("block", body), ""

    def branch(condition: str) -> Node:
        test = _Expression(condition).whole()
        then, end = block("elif", "else", "endif")
        if end.startswith("elif"):
            return ("if", test, then, branch(end.partition(" ")[2]))
        other = block("endif")[0] if end == "else" else ("block", [])
        return ("if", test, then, other)

    return block()[0]


# ---------------------------------------------------------------- folding


def _shown(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


_BINARY: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: _shown(a) + _shown(b),
}


def fold(node: Node) -> Node:
    """The same tree with constant parts worked out, dead branches dropped and neighbouring text joined."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind in _BINARY:
        a, b = fold(node[1]), fold(node[2])
        return ("const", _BINARY[kind](a[1], b[1])) if a[0] == b[0] == "const" else (kind, a, b)
    if kind in ("and", "or"):
        a, b = fold(node[1]), fold(node[2])
        if a[0] == "const":
            return b if bool(a[1]) == (kind == "and") else a
        return (kind, a, b)
    if kind == "not":
        a = fold(node[1])
        return ("const", not a[1]) if a[0] == "const" else ("not", a)
    if kind == "filter":
        a = fold(node[1])
        return ("const", FILTERS[node[2]](_shown(a[1]))) if a[0] == "const" else ("filter", a, node[2])
    if kind == "item":
        return ("item", fold(node[1]), node[2])
    if kind == "show":
        a = fold(node[1])
        return ("const", _shown(a[1])) if a[0] == "const" else ("show", a)
    if kind == "set":
        return ("set", node[1], fold(node[2]))
    if kind == "for":
        return ("for", node[1], fold(node[2]), fold(node[3]))
    if kind == "generation":
        return ("generation", fold(node[1]))
    if kind == "if":
        test = fold(node[1])
        return fold(node[2] if test[1] else node[3]) if test[0] == "const" else ("if", test, fold(node[2]), fold(node[3]))
    body: list[Node] = []
    for part in map(fold, node[1]):
        for one in part[1] if part[0] == "block" else [part]:
            if one[0] == "const" and body and body[-1][0] == "const":
                body[-1] = ("const", body[-1][1] + one[1])
            elif one != ("const", ""):
                body.append(one)
    return ("block", body)


# ---------------------------------------------------------------- closures


class Sink:
    """Takes the pieces of a rendering; spans are the marked stretches as [start, end) in code points."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.spans: list[tuple[int, int]] = []
        self.length = 0

    def add(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _value(node: Node) -> Callable[[Env], Any]:
    kind = node[0]
    if kind == "const":
        constant = node[1]
        return lambda env: constant
    if kind == "name":
        name = node[1]

        def look(env: Env) -> Any:
            if name not in env:
                raise TemplateError(f"no value {name}")
            return env[name]

        return look
    if kind == "item":
        of, key = _value(node[1]), node[2]

        def item(env: Env) -> Any:
            holder = of(env)
            if not isinstance(holder, dict) or key not in holder:
                raise TemplateError(f"no field {key}")
            return holder[key]

        return item
    if kind == "filter":
        of, run = _value(node[1]), FILTERS[node[2]]
        return lambda env: run(_shown(of(env)))
    if kind == "not":
        of = _value(node[1])
        return lambda env: not of(env)
    a, b = _value(node[1]), _value(node[2])
    if kind == "and":
        return lambda env: a(env) and b(env)
    if kind == "or":
        return lambda env: a(env) or b(env)
    both = _BINARY[kind]
    return lambda env: both(a(env), b(env))


def _writer(node: Node) -> Callable[[Env, Sink], None]:
    kind = node[0]
    if kind == "const":
        text = node[1]
        return lambda env, sink: sink.add(text)
    if kind == "show":
        of = _value(node[1])
        return lambda env, sink: sink.add(_shown(of(env)))
    if kind == "set":
        name, of = node[1], _value(node[2])

        def put(env: Env, sink: Sink) -> None:
            env[name] = of(env)

        return put
    if kind == "generation":
        inner = _writer(node[1])

        def mark(env: Env, sink: Sink) -> None:
            start = sink.length
            inner(env, sink)
            sink.spans.append((start, sink.length))

        return mark
    if kind == "if":
        test, then, other = _value(node[1]), _writer(node[2]), _writer(node[3])
        return lambda env, sink: then(env, sink) if test(env) else other(env, sink)
    if kind == "for":
        name, of, body = node[1], _value(node[2]), _writer(node[3])

        def loop(env: Env, sink: Sink) -> None:
            items = list(of(env))
            for i, item in enumerate(items):
                body(env | {name: item, "loop": {"first": i == 0, "last": i == len(items) - 1, "index0": i}}, sink)

        return loop
    parts = [_writer(x) for x in node[1]]

    def block(env: Env, sink: Sink) -> None:
        for part in parts:
            part(env, sink)

    return block


def compile_template(source: str) -> Callable[[list[dict[str, str]]], tuple[str, list[tuple[int, int]]]]:
    """A function from messages (role, text) to the formatted text and its marked spans."""
    write = _writer(fold(parse(source)))

    def render(messages: list[dict[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        sink = Sink()
        write({"messages": messages}, sink)
        return "".join(sink.pieces), sink.spans

    return render


# ---------------------------------------------------------------- Spark

FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


def format_conversations(turns: DataFrame, template: str = CHATML) -> DataFrame:
    """One row per ``conv_id`` with its ``formatted`` text and the ``spans`` (code points) under the loss mask.

    Turns are in order of ``turn`` (null first), then role and text, so ties and repeated rows all stay,
    in a fixed order. A null role or text counts as empty; rows without conv_id form one conversation.
    An empty table gives no rows; other columns are not read.

    Turns are sorted within hash partitions and streamed, so a task holds one conversation at a time,
    which its formatted row needs anyway, and never a group of conversations.
    """
    render_source = template
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions(*order)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(FORMATTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(render_source)
        none = object()
        now: Any = none
        messages: list[dict[str, str]] = []
        out: list[dict[str, Any]] = []
        size = 0

        def close() -> None:
            nonlocal size
            text, spans = render(messages)
            out.append({"conv_id": now, "formatted": text, "spans": [{"start": a, "end": b} for a, b in spans]})
            size += len(text)

        for batch in batches:
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                if now is none or conv != now:
                    if now is not none:
                        close()
                    now, messages = conv, []
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                messages.append({"role": role, "text": text})
        if now is not none:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return rows.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, from nothing but the formatted text and its spans."""
    schema = T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {f.name: [] for f in schema}
        for row in batch.to_pylist():
            text, at, turns, n = row["formatted"], 0, hashlib.sha256(), 0
            while at < len(text):
                line = text.find("\n", at)
                end = text.find("<|", line)
                if not text.startswith(OPEN, at) or line < 0 or not text.startswith(CLOSE, end):
                    raise ValueError(f"conversation {row['conv_id']}: no turn at {at}")
                turns.update(f"{unescape(text[at + len(OPEN) : line])}\n{unescape(text[line + 1 : end])}\n".encode())
                n, at = n + 1, end + len(CLOSE)
            loss, chars = hashlib.sha256(), 0
            for span in row["spans"]:
                part = unescape(text[span["start"] : span["end"]])
                loss.update(part.encode())
                chars += len(part)
            values = (row["conv_id"], n, turns.hexdigest(), chars, loss.hexdigest(), len(text))
            for name, value in zip(out, values):
                out[name].append(value)
        yield out

    return map_batches(formatted, run, schema)
