"""A small template language for conversations, compiled to Python closures.

    {{ m.text | escape }}              a value, through filters
    {% for m in messages %} ... {% endfor %}      with loop.index0, loop.first and loop.last
    {% if m.role == 'user' %} ... {% elif ... %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}      what a model is trained to write

Expressions have names, fields of mappings, text and whole-number literals, true,
false, none, ==, !=, +, and, or, not, parentheses and filters. Nothing else: no
calls, no Python attributes, no imports. A template cannot reach anything that it is
not given.

Compiling makes a tree, folds what is constant, and turns each node into a closure
that yields pieces of text, each marked as generated or not.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Piece = tuple[str, bool]

TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
WORDS = re.compile(
    r"\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"
    r"|(?P<sign>==|!=|[|.()+\[\]]))")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """A template that cannot be read, or that asks for what it is not given."""


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    base: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or filter over its operands."""

    what: str
    operands: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Loop:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Branch:
    condition: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _plus(a, b):
    if type(a) is not type(b) or not isinstance(a, (str, int)):
        raise TemplateError(f"cannot add {a!r} and {b!r}")
    return a + b


OPERATORS: dict[str, Callable] = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": _plus, "not": lambda a: not a}
FILTERS: dict[str, Callable] = {"trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(),
                                "lower": lambda x: _text(x).lower(), "length": len}


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


class _Expression:
    """Recursive descent over the words of one expression; ``or`` binds least, fields and filters most."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.source, self.filters, self.words, self.at = source, filters, [], 0
        end, source = 0, source.rstrip()
        while end < len(source):
            m = WORDS.match(source, end)
            if not m:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.words.append((m.lastgroup, m[m.lastgroup]))
            end = m.end()

    def next_is(self, *wanted: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] != "text" and self.words[self.at][1] in wanted

    def take(self, *wanted: str) -> str:
        if self.at >= len(self.words) or (wanted and not self.next_is(*wanted)):
            raise TemplateError(f"{' or '.join(wanted) or 'a value'} is missing in {self.source!r}")
        self.at += 1
        return self.words[self.at - 1][1]

    def whole(self):
        out = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"{self.words[self.at][1]!r} is not expected in {self.source!r}")
        return out

    def either(self):
        out = self.both()
        while self.next_is("or"):
            self.take()
            out = Apply("or", (out, self.both()))
        return out

    def both(self):
        out = self.negated()
        while self.next_is("and"):
            self.take()
            out = Apply("and", (out, self.negated()))
        return out

    def negated(self):
        if self.next_is("not"):
            self.take()
            return Apply("not", (self.negated(),))
        out = self.sum()
        while self.next_is("==", "!="):
            out = Apply(self.take(), (out, self.sum()))
        return out

    def sum(self):
        out = self.filtered()
        while self.next_is("+"):
            self.take()
            out = Apply("+", (out, self.filtered()))
        return out

    def filtered(self):
        out = self.single()
        while self.next_is(".", "[", "|"):
            sign = self.take()
            if sign == ".":
                out = Field(out, Constant(self.take()))
            elif sign == "[":
                out = Field(out, self.either())
                self.take("]")
            else:
                name = self.take()
                if name not in self.filters:
                    raise TemplateError(f"there is no filter {name!r}")
                out = Apply("|" + name, (out,))
        return out

    def single(self):
        if self.next_is("("):
            self.take()
            out = self.either()
            self.take(")")
            return out
        kind = self.words[self.at][0] if self.at < len(self.words) else None
        word = self.take()
        if kind == "text":
            return Constant(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.DOTALL))
        if kind == "number":
            return Constant(int(word))
        if kind != "name":
            raise TemplateError(f"{word!r} is not expected in {self.source!r}")
        return Constant({"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else Name(word)


def parse(source: str, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    """The tree of a template."""
    tags = [t for t in TAGS.split(source) if t]
    at = 0

    def read(tag: str):
        return _Expression(tag, filters).whole()

    def body(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes: list = []
        while at < len(tags):
            tag = tags[at]
            at += 1
            if tag.startswith("{{"):
                nodes.append(Output(read(tag[2:-2])))
                continue
            if not tag.startswith("{%"):
                nodes.append(Text(tag))
                continue
            word, _, rest = tag[2:-2].strip().partition(" ")
            if word in ends:
                return tuple(nodes), tag[2:-2].strip()
            if word == "for":
                m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.DOTALL)
                if not m:
                    raise TemplateError(f"cannot read {tag!r}")
                nodes.append(Loop(m[1], read(m[2]), body("endfor")[0]))
            elif word == "if":
                nodes.append(branch(rest))
            elif word == "generation":
                nodes.append(Generation(body("endgeneration")[0]))
            else:
                raise TemplateError(f"{tag!r} is not expected")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), ""

    def branch(condition: str) -> Branch:
        yes, end = body("elif", "else", "endif")
        if end.startswith("elif"):
            return Branch(read(condition), yes, (branch(end[4:]),))
        return Branch(read(condition), yes, body("endif")[0] if end == "else" else ())

    return body()[0]


def fold(node, filters: Mapping[str, Callable] = FILTERS):
    """The same tree with all that is constant worked out: values, branches, neighbouring texts."""
    if isinstance(node, Apply):
        operands = tuple(fold(x, filters) for x in node.operands)
        if node.what in ("and", "or") and isinstance(operands[0], Constant):
            return operands[1] if bool(operands[0].value) == (node.what == "and") else operands[0]
        if node.what not in ("and", "or") and all(isinstance(x, Constant) for x in operands):
            fn = filters[node.what[1:]] if node.what[0] == "|" else OPERATORS[node.what]
            return Constant(fn(*[x.value for x in operands]))
        return Apply(node.what, operands)
    if isinstance(node, Field):
        return Field(fold(node.base, filters), fold(node.key, filters))
    if isinstance(node, tuple):
        out: list = []
        for child in node:
            if isinstance(child, Output):
                value = fold(child.value, filters)
                child = Text(_text(value.value)) if isinstance(value, Constant) else Output(value)
            elif isinstance(child, Loop):
                child = Loop(child.name, fold(child.over, filters), fold(child.body, filters))
            elif isinstance(child, Generation):
                child = Generation(fold(child.body, filters))
            elif isinstance(child, Branch):
                condition = fold(child.condition, filters)
                yes, no = fold(child.yes, filters), fold(child.no, filters)
                child = Branch(condition, yes, no)
                if isinstance(condition, Constant):
                    child = yes if condition.value else no
            for c in child if isinstance(child, tuple) else (child,):
                if isinstance(c, Text) and out and isinstance(out[-1], Text):
                    out[-1] = Text(out[-1].value + c.value)
                elif not (isinstance(c, Text) and not c.value):
                    out.append(c)
        return tuple(out)
    return node


def _value(node, filters) -> Callable[[dict], Any]:
    if isinstance(node, Constant):
        return lambda scope, v=node.value: v
    if isinstance(node, Name):
        def name(scope, key=node.name):
            if key not in scope:
                raise TemplateError(f"{key} is not given")
            return scope[key]
        return name
    if isinstance(node, Field):
        base, key = _value(node.base, filters), _value(node.key, filters)

        def field(scope):
            holder = base(scope)
            if not isinstance(holder, Mapping):
                raise TemplateError(f"{type(holder).__name__} has no fields")
            return holder.get(key(scope))
        return field
    parts = [_value(x, filters) for x in node.operands]
    if node.what == "and":
        return lambda scope: parts[0](scope) and parts[1](scope)
    if node.what == "or":
        return lambda scope: parts[0](scope) or parts[1](scope)
    fn = filters[node.what[1:]] if node.what[0] == "|" else OPERATORS[node.what]
    if len(parts) == 1:
        return lambda scope, a=parts[0]: fn(a(scope))
    return lambda scope, a=parts[0], b=parts[1]: fn(a(scope), b(scope))


def _with_last(items: Iterable) -> Iterator[tuple[Any, bool]]:
    """Each item and whether it is the last, one item ahead."""
    items = iter(items)
    for held in items:
        for item in items:
            yield held, False
            held = item
        yield held, True


def _render(nodes: tuple, filters, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    steps = [_step(n, filters, generated) for n in nodes]

    def run(scope):
        for step in steps:
            yield from step(scope)
    return run if len(steps) != 1 else steps[0]


def _step(node, filters, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, Text):
        return lambda scope, pieces=((node.value, generated),): pieces
    if isinstance(node, Output):
        value = _value(node.value, filters)
        return lambda scope: ((_text(value(scope)), generated),)
    if isinstance(node, Generation):
        return _render(node.body, filters, True)
    if isinstance(node, Branch):
        condition = _value(node.condition, filters)
        yes, no = _render(node.yes, filters, generated), _render(node.no, filters, generated)
        return lambda scope: yes(scope) if condition(scope) else no(scope)
    over, body = _value(node.over, filters), _render(node.body, filters, generated)

    def loop(scope, name=node.name):
        for i, (item, last) in enumerate(_with_last(over(scope))):
            yield from body({**scope, name: item, "loop": {"index0": i, "first": i == 0, "last": last}})
    return loop


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[..., Iterator[Piece]]:
    """A function from named values to the pieces of the rendered text, made as they are asked for.

    ``filters`` adds to those of the language. Iterables are read once and one item
    ahead, so a conversation may be longer than memory.
    """
    known = {**FILTERS, **(filters or {})}
    run = _render(fold(parse(source, known), known), known, False)
    return lambda **values: iter(run(values))
