"""Chat formatting by a small template language that compiles to Python closures.

A template is parsed into a tree, constant parts of the tree are computed once, and each node
becomes a closure that yields pieces of text. ``{% generation %}`` marks the text that a model has to
learn. The language is closed: values are texts, numbers, booleans, none, lists and dictionaries;
there are no calls, no attributes of Python objects and no names but those that are passed in.

``{{ x }}``, ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for x in xs %} {% endfor %}`` (with
``loop.index``, ``loop.index0``, ``loop.first``, ``loop.last``), ``{% set x = ... %}``,
``{% generation %} {% endgeneration %}``, ``{# comment #}``; a ``-`` inside a tag's bounds (``{%- -%}``) takes away
the template's white space on that side; operators ``or and not == != < <= > >= in
~ +``, subscripts ``x.name`` and ``x['name']``, filters ``trim upper lower length default(x) guard line``. Values
that an operator or a filter can't take (none below a number, say) are a ``TemplateError``.

Spark sorts the turns of a conversation, and a task renders them as they come, so a conversation of
any length needs the memory of one part. Text goes out in parts of bounded length (one turn may be
longer). Hot conversations are streamed, not split, as their digests depend on the order of all turns.

Defined results: rows of a conversation go by turn (null first), then role, then text; a null role or
text is empty; repeated rows are repeated turns; a null conversation is one of its own; an empty table has
no rows; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelane.llm._common import table

#: Strings that steer the format; ``guard`` keeps them out of texts.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for message in messages %}"
    "{% if message.role == 'assistant' %}"
    "{{ '[/INST]' }}{% generation %}{{ message.text | guard }}{% endgeneration %}{{ '</' ~ 's>' }}"
    "{% else %}"
    "{{ '<s>' ~ '[INST]' }}{{ message.role | line | guard }}\n{{ message.text | guard }}"
    "{% endif %}{% endfor %}"
)
#: Characters after which a part of a conversation's text goes out.
PART_CHARS = 1_000_000

# -- reversible escapes ------------------------------------------------------------
_GUARD = re.compile("|".join(rf"({re.escape(c[0])})(\\*)({re.escape(c[1:])})" for c in CONTROLS))
_UNGUARD = re.compile("|".join(rf"({re.escape(c[0])})\\(\\*)({re.escape(c[1:])})" for c in CONTROLS))


def _joined(groups: tuple, more: str) -> str:
    first, slashes, rest = (g for g in groups if g is not None)
    return first + more + slashes + rest


def guard(text: str) -> str:
    r"""Put one more ``\`` behind the first character of control strings: ``<s>`` is ``<\s>``, ``<\s>`` is ``<\\s>``."""
    return _GUARD.sub(lambda m: _joined(m.groups(), "\\"), text)


def unguard(text: str) -> str:
    return _UNGUARD.sub(lambda m: _joined(m.groups(), ""), text)


def line(text: str) -> str:
    return text.replace("\\", "\\\\").replace("\n", "\\n")


def unline(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text)


# -- syntax tree -------------------------------------------------------------------
class Node(NamedTuple):
    kind: str
    value: object = None
    children: tuple = ()


class TemplateError(ValueError):
    pass


_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_LEXEMES = re.compile(r"""\s*(?:(\d+)|'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)"|([A-Za-z_]\w*)|(==|!=|<=|>=|[<>~+.|()\[\],=]))""", re.S)
_COMPARE: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b,
}
_FILTERS: dict[str, Callable] = {
    "trim": lambda x: shown(x).strip(), "upper": lambda x: shown(x).upper(), "lower": lambda x: shown(x).lower(),
    "length": len, "default": lambda x, other="": other if x is None else x, "guard": lambda x: guard(shown(x)), "line": lambda x: line(shown(x)),
}
_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}


def shown(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, (str, int, float)):
        return str(value)
    raise TemplateError("only texts, numbers and booleans can be shown")


class Expression:
    """Recursive descent over the lexemes of one expression."""

    def __init__(self, source: str):
        self.lexemes: list[tuple[str, object]] = []
        at = 0
        while at < len(source.rstrip()):
            found = _LEXEMES.match(source, at)
            if not found:
                raise TemplateError(f"unexpected {source[at : at + 10]!r}")
            at = found.end()
            number, single, double, name, sign = found.groups()
            if number:
                self.lexemes.append(("const", int(number)))
            elif name:
                self.lexemes.append(("const", _CONSTANTS[name]) if name in _CONSTANTS else ("name", name))
            elif sign:
                self.lexemes.append(("sign", sign))
            else:
                text = single if single is not None else double
                self.lexemes.append(("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text)))
        self.at = 0

    def peek(self, *values: object) -> bool:
        return self.at < len(self.lexemes) and self.lexemes[self.at][0] != "const" and self.lexemes[self.at][1] in values

    def take(self, *values: object) -> object:
        if self.at >= len(self.lexemes) or (values and not self.peek(*values)):
            raise TemplateError(f"expected {values or 'an expression'}")
        self.at += 1
        return self.lexemes[self.at - 1][1]

    def whole(self) -> Node:
        found = self.either()
        if self.at < len(self.lexemes):
            raise TemplateError(f"unexpected {self.lexemes[self.at][1]!r}")
        return found

    def chain(self, below: Callable[[], Node], kind: str, *signs: str) -> Node:
        found = below()
        while self.peek(*signs):
            found = Node(kind, self.take(), (found, below()))
        return found

    def either(self) -> Node:
        return self.chain(self.both, "or", "or")

    def both(self) -> Node:
        return self.chain(self.negated, "and", "and")

    def negated(self) -> Node:
        if self.peek("not"):
            self.take()
            return Node("not", None, (self.negated(),))
        return self.compared()

    def compared(self) -> Node:
        return self.chain(self.added, "compare", *_COMPARE)

    def added(self) -> Node:
        return self.chain(self.filtered, "join", "~", "+")

    def filtered(self) -> Node:
        found = self.atom()
        while self.peek("|"):
            self.take()
            name, more = self.take(), []
            if name not in _FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.peek("("):
                self.take()
                while not self.peek(")"):
                    more.append(self.either())
                    if not self.peek(")"):
                        self.take(",")
                self.take(")")
            found = Node("filter", name, (found, *more))
        return found

    def atom(self) -> Node:
        if self.peek("("):
            self.take()
            found = self.either()
            self.take(")")
        else:
            kind, value = self.lexemes[self.at] if self.at < len(self.lexemes) else ("sign", None)
            if kind == "sign":
                raise TemplateError("expected an expression")
            self.at += 1
            found = Node(kind, value)
        while self.peek(".", "["):
            if self.take() == ".":
                found = Node("item", None, (found, Node("const", self.take())))
            else:
                found = Node("item", None, (found, self.either()))
                self.take("]")
        return found


def parse(source: str) -> Node:
    """The syntax tree of a template: a ``list`` node of texts, expressions and blocks."""
    parts = _TAGS.split(source)  # texts and tags by turns
    for k in range(1, len(parts), 2):
        opening, inner, closing = parts[k][:2], parts[k][2:-2], parts[k][-2:]
        if inner.startswith("-"):
            inner, parts[k - 1] = inner[1:], parts[k - 1].rstrip()
        if inner.endswith("-"):
            inner, parts[k + 1] = inner[:-1], parts[k + 1].lstrip()
        parts[k] = opening + inner + closing
    parts = [p for p in parts if p]
    at = 0

    def block(*ends: str) -> tuple[Node, str]:
        nonlocal at
        children: list[Node] = []
        while at < len(parts):
            part = parts[at]
            at += 1
            if part.startswith("{#"):
                continue
            if part.startswith("{{"):
                children.append(Node("show", None, (Expression(part[2:-2]).whole(),)))
                continue
            if not part.startswith("{%"):
                children.append(Node("text", part))
                continue
            word, _, rest = part[2:-2].strip().partition(" ")
            if word in ends:
                return Node("list", None, tuple(children)), f"{word} {rest}"
            if word == "if":
                cases, test = [], rest
                while True:
                    body, end = block("elif", "else", "endif")
                    cases.append(Node("case", None, (Expression(test).whole(), body)))
                    if end.startswith("elif"):
                        test = end[5:]
                        continue
                    if end.startswith("else"):
                        cases.append(Node("case", None, (Node("const", True), block("endif")[0])))
                    break
                children.append(Node("if", None, tuple(cases)))
            elif word == "for":
                name, _, items = rest.partition(" in ")
                children.append(Node("for", name.strip(), (Expression(items).whole(), block("endfor")[0])))
            elif word == "set":
                name, _, value = rest.partition("=")
                children.append(Node("set", name.strip(), (Expression(value).whole(),)))
            elif word == "generation":
                children.append(Node("generation", None, (block("endgeneration")[0],)))
            else:
                raise TemplateError(f"unexpected {word!r}")
        if ends:
            raise TemplateError(f"no {ends[-1]!r}")
        return Node("list", None, tuple(children)), ""

    return block()[0]


def fold(node: Node) -> Node:
    """The same tree with constant expressions computed, dead branches cut and texts joined."""
    children = tuple(map(fold, node.children))
    node = node._replace(children=children)
    if node.kind in ("or", "and", "not", "compare", "join", "filter", "item") and all(c.kind == "const" for c in children):
        return Node("const", value_of(node)({}))
    if node.kind == "show" and children[0].kind == "const":
        return Node("text", shown(children[0].value))
    if node.kind == "if":
        cases = []
        for case in children:
            test = case.children[0]
            if test.kind == "const" and not test.value:
                continue
            cases.append(case)
            if test.kind == "const":
                break
        if not cases or cases[0].children[0].kind == "const":
            return cases[0].children[1] if cases else Node("list")
        return node._replace(children=tuple(cases))
    if node.kind == "list":
        flat = [c for child in children for c in (child.children if child.kind == "list" else (child,))]
        joined = []
        for kind, group in groupby(flat, lambda c: c.kind):
            joined.extend([Node("text", "".join(c.value for c in group))] if kind == "text" else group)
        return node._replace(children=tuple(c for c in joined if c != Node("text", "")))
    return node


# -- closures ----------------------------------------------------------------------
def _applied(name: str, use: Callable, *values: object) -> object:
    try:
        return use(*values)
    except (TypeError, AttributeError) as error:
        raise TemplateError(f"{name!r} can't take {', '.join(type(v).__name__ for v in values)}") from error


def value_of(node: Node) -> Callable[[dict], object]:
    """A closure from names to the value of an expression."""
    kids = [value_of(c) for c in node.children]
    if node.kind == "const":
        return lambda names, value=node.value: value
    if node.kind == "name":
        return lambda names, name=node.value: names.get(name)
    if node.kind == "or":
        return lambda names: kids[0](names) or kids[1](names)
    if node.kind == "and":
        return lambda names: kids[0](names) and kids[1](names)
    if node.kind == "not":
        return lambda names: not kids[0](names)
    if node.kind == "compare":
        return lambda names, name=node.value: _applied(name, _COMPARE[name], kids[0](names), kids[1](names))
    if node.kind == "join":
        if node.value == "~":
            return lambda names: shown(kids[0](names)) + shown(kids[1](names))
        return lambda names: _applied("+", lambda a, b: a + b, kids[0](names), kids[1](names))
    if node.kind == "filter":
        return lambda names, name=node.value: _applied(name, _FILTERS[name], *(kid(names) for kid in kids))
    if node.kind == "item":

        def item(names: dict) -> object:
            holder, key = kids[0](names), kids[1](names)
            if isinstance(holder, dict):
                return holder.get(key)
            return holder[key] if isinstance(holder, list) and isinstance(key, int) and -len(holder) <= key < len(holder) else None

        return item
    raise TemplateError(f"no value: {node.kind}")


Piece = tuple[str, bool]
Render = Callable[[dict, bool], Iterator[Piece]]


def closure(node: Node) -> Render:
    """A closure that yields (text, whether it is generation text)."""
    if node.kind == "text":
        return lambda names, learn, text=node.value: iter(((text, learn),))
    if node.kind == "show":
        value = value_of(node.children[0])
        return lambda names, learn: iter(((shown(value(names)), learn),))
    if node.kind == "list":
        parts = [closure(c) for c in node.children]

        def run(names: dict, learn: bool) -> Iterator[Piece]:
            for part in parts:
                yield from part(names, learn)

        return run
    if node.kind == "if":
        cases = [(value_of(c.children[0]), closure(c.children[1])) for c in node.children]

        def choose(names: dict, learn: bool) -> Iterator[Piece]:
            for test, body in cases:
                if test(names):
                    return body(names, learn)
            return iter(())

        return choose
    if node.kind == "for":
        items, body, name = value_of(node.children[0]), closure(node.children[1]), node.value

        def repeat(names: dict, learn: bool) -> Iterator[Piece]:
            rest = iter(items(names) or ())  # one item ahead, so any one-way source will do
            here = next(rest, None)
            at = 0
            while here is not None:
                after = next(rest, None)
                loop = {"index": at + 1, "index0": at, "first": at == 0, "last": after is None}
                yield from body({**names, name: here, "loop": loop}, learn)
                here, at = after, at + 1

        return repeat
    if node.kind == "set":
        value = value_of(node.children[0])

        def keep(names: dict, learn: bool) -> Iterator[Piece]:
            names[node.value] = value(names)
            return iter(())

        return keep
    if node.kind == "generation":
        body = closure(node.children[0])
        return lambda names, learn: body(names, True)
    raise TemplateError(f"unexpected node {node.kind}")


def compiled(source: str) -> Callable[..., Iterator[Piece]]:
    """``render(messages, **names)``: pieces of the formatted conversation, as they come."""
    render = closure(fold(parse(source)))
    return lambda messages, **names: render({"messages": messages, **names}, False)


# -- Spark -------------------------------------------------------------------------
PARTS = "conv_id {kind}, part long, last boolean, text string, learn array<struct<start:int,end:int>>"


def _messages(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, dict]]:
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            yield conv, {"role": role, "text": text}


def format_conversations(turns: DataFrame, template: str = TEMPLATE, part_chars: int = PART_CHARS) -> DataFrame:
    """``conv_id, part, last, text, learn``: formatted text in parts, with the places of generation text.

    Parts of a conversation stay together and in order inside their partition.
    """
    fold(parse(template))  # a wrong template fails here, not in a task
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template)
        learn_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        ready: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*ready))
            types = (conv_type, pa.int64(), pa.bool_(), pa.string(), learn_type)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["conv_id", "part", "last", "text", "learn"])

        first = next(batches, None)
        if first is None:
            return
        conv_type = first.schema.field("conv_id").type

        def every() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for conv, group in groupby(_messages(every()), key=lambda x: x[0]):
            pieces: list[str] = []
            learn: list[dict] = []
            length = part = 0
            for text, learned in render(m for _, m in group):
                if length >= part_chars:
                    ready.append((conv, part, False, "".join(pieces), learn))
                    yield out()
                    ready.clear()
                    size = length = 0
                    part, pieces, learn = part + 1, [], []
                if learned:
                    learn.append({"start": length, "end": length + len(text)})
                pieces.append(text)
                length += len(text)
            ready.append((conv, part, True, "".join(pieces), learn))
            size += length
            if size >= part_chars or len(ready) >= 5000:
                yield out()
                ready.clear()
                size = 0
        if ready:
            yield out()

    return dealt.mapInArrow(run, PARTS.format(kind=kind))


_MARK = re.compile(r"<s>\[INST\]|\[/INST\]")


def read_turns(buffer: str, done: bool) -> tuple[list[tuple[str, str]], str]:
    """(role, text) of the turns that ``buffer`` holds whole, and the rest of it."""
    marks = list(_MARK.finditer(buffer))
    if not marks:
        return [], buffer
    edges = [*(m.start() for m in marks), len(buffer)]
    whole = len(marks) if done else len(marks) - 1
    turns = []
    for m, end in zip(marks[:whole], edges[1:]):
        body = buffer[m.end() : end]
        if m[0] == "[/INST]":
            turns.append(("assistant", unguard(body.removesuffix("</s>"))))
        else:
            role, _, text = body.partition("\n")
            turns.append((unline(unguard(role)), unguard(text)))
    return turns, buffer[edges[whole] :]


DIGESTS = "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of the turns and of the generation text, read from the parts alone, in one pass over them."""
    kind = dict(parts.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, n_turns, loss_chars, chars = "", 0, 0, 0
        turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                text = row["text"]
                for span in row["learn"]:
                    learned = unguard(text[span["start"] : span["end"]])
                    loss_chars += len(learned)
                    loss_hash.update(learned.encode())
                chars += len(text)
                turns, buffer = read_turns(buffer + text, row["last"])
                n_turns += len(turns)
                for role, said in turns:
                    turns_hash.update(f"{role}\n{said}\n".encode())
                if row["last"]:
                    rows.append((row["conv_id"], n_turns, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars))
                    buffer, n_turns, loss_chars, chars = "", 0, 0, 0
                    turns_hash, loss_hash = hashlib.sha256(), hashlib.sha256()
            if rows:
                types = (batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return parts.mapInArrow(run, DIGESTS.format(kind=kind))


def op6_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast(dict(turns.dtypes)["conv_id"]).alias("conv_id"), F.col("id").cast(dict(turns.dtypes)["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return read_back(format_conversations(turns.unionByName(extra)))
