"""A small, sandboxed template language: parsed into a tree, folded, and compiled to closures.

    {{ expression }}
    {% for x in messages %} ... {% endfor %}        with loop.first, loop.last, loop.index
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}        what a model is to learn to write

Expressions: strings, integers, true, false, none, names, a.b, a['b'], filters a|trim, + (join or add), ==, !=, in, not,
and, or, parentheses. There are no calls, no assignments and no attributes of Python objects: a.b looks up a key. A
template renders as a stream of (text, marked) pieces, so a loop over an iterator holds one message and the next.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

Piece = tuple[str, bool]
Evaluate = Callable[[dict], Any]
Render = Callable[[dict, bool], Iterator[Piece]]


class TemplateError(ValueError):
    pass


# -- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or a filter on its operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


def show(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _plus(a: Any, b: Any) -> Any:
    numbers = all(isinstance(x, int) and not isinstance(x, bool) for x in (a, b))
    return a + b if numbers else show(a) + show(b)


OPERATORS: dict[str, Callable] = {
    "+": _plus, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: show(a) in show(b), "not": lambda a: not a,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: show(x).strip(), "upper": lambda x: show(x).upper(), "lower": lambda x: show(x).lower(), "length": lambda x: len(show(x)),
}

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([0-9]+)|([A-Za-z][A-Za-z0-9_]*)|(==|!=|[-+|.()\[\]]))", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.filters, self.tokens, at = filters, [], 0
        source = source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastindex, found.group(found.lastindex)))
            at = found.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (0, None)
        return text if kind in (3, 4) else None

    def take(self, *texts: str) -> str | None:
        if self.peek() in texts and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def whole(self) -> Any:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def either(self) -> Any:
        tree = self.both()
        while self.take("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self) -> Any:
        tree = self.negated()
        while self.take("and"):
            tree = Apply("and", (tree, self.negated()))
        return tree

    def negated(self) -> Any:
        return Apply("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> Any:
        tree = self.joined()
        while sign := self.take("==", "!=", "in"):
            tree = Apply(sign, (tree, self.joined()))
        return tree

    def joined(self) -> Any:
        tree = self.filtered()
        while self.take("+"):
            tree = Apply("+", (tree, self.filtered()))
        return tree

    def filtered(self) -> Any:
        tree = self.atom()
        while self.take("|"):
            name = self.word()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            tree = Apply("|" + name, (tree,))
        return tree

    def word(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (0, "")
        if kind != 3 or text in _WORDS:
            raise TemplateError(f"a name is missing at {text!r}")
        self.at += 1
        return text

    def atom(self) -> Any:
        if self.take("("):
            tree = self.either()
            self.need(")")
        else:
            if self.at >= len(self.tokens):
                raise TemplateError("an expression is missing")
            kind, text = self.tokens[self.at]
            self.at += 1
            if kind == 1:
                tree = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[0]), text[1:-1], flags=re.S))
            elif kind == 2:
                tree = Const(int(text))
            elif kind == 3 and text in ("true", "false", "none"):
                tree = Const({"true": True, "false": False, "none": None}[text])
            elif kind == 3 and text not in _WORDS:
                tree = Name(text)
            else:
                raise TemplateError(f"unexpected {text!r}")
        while sign := self.take(".", "["):
            if sign == ".":
                tree = Get(tree, Const(self.word()))
            else:
                tree = Get(tree, self.either())
                self.need("]")
        return tree


def parse(source: str, filters: dict[str, Callable] = FILTERS) -> tuple:
    """The tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for tag in _TAG.finditer(source):
        parts.append(("text", source[at : tag.start()]))
        parts.append(("output", tag[1]) if tag[1] is not None else ("tag", tag[2].strip()))
        at = tag.end()
    parts.append(("text", source[at:]))
    position = 0

    def expression(text: str) -> Any:
        return _Expression(text, filters).whole()

    def body(*ends: str) -> tuple[tuple, str]:
        """Nodes up to one of the closing tags, and that tag."""
        nonlocal position
        nodes: list = []
        while position < len(parts):
            kind, text = parts[position]
            position += 1
            if kind == "text":
                if text:
                    nodes.append(Text(text))
            elif kind == "output":
                nodes.append(Output(expression(text)))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return tuple(nodes), text
                nodes.append(statement(word, rest.strip()))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(nodes), ""

    def statement(word: str, rest: str) -> Any:
        if word == "for":
            found = re.fullmatch(r"([A-Za-z][A-Za-z0-9_]*)\s+in\s+(.+)", rest, re.S)
            if not found or found[1] in _WORDS:
                raise TemplateError(f"cannot read 'for {rest}'")
            inner, _ = body("endfor")
            return For(found[1], expression(found[2]), inner)
        if word == "generation":
            inner, _ = body("endgeneration")
            return Generation(inner)
        if word == "if":
            arms, condition = [], expression(rest)
            while True:
                inner, end = body("elif", "else", "endif")
                arms.append((condition, inner))
                if end == "endif":
                    return If(tuple(arms))
                if end == "else":
                    inner, _ = body("endif")
                    return If((*arms, (Const(True), inner)))
                condition = expression(end.partition(" ")[2])
        raise TemplateError(f"unknown tag {word!r}")

    return body()[0]


# -- folding


def fold(node: Any, filters: dict[str, Callable] = FILTERS) -> Any:
    """The tree with constant expressions evaluated, dead arms removed and neighbouring texts joined."""
    if isinstance(node, tuple):
        nodes: list = []
        for part in node:
            part = fold(part, filters)
            for piece in part if isinstance(part, tuple) else (part,):
                if isinstance(piece, Text) and nodes and isinstance(nodes[-1], Text):
                    nodes[-1] = Text(nodes[-1].text + piece.text)
                elif not (isinstance(piece, Text) and not piece.text):
                    nodes.append(piece)
        return tuple(nodes)
    if isinstance(node, Get):
        return Get(fold(node.of, filters), fold(node.key, filters))
    if isinstance(node, Apply):
        args = tuple(fold(x, filters) for x in node.args)
        if node.name in ("and", "or") and isinstance(args[0], Const):
            return args[0] if bool(args[0].value) == (node.name == "or") else args[1]
        if all(isinstance(x, Const) for x in args):
            return Const(_function(node.name, filters)(*(x.value for x in args)))
        return Apply(node.name, args)
    if isinstance(node, Output):
        value = fold(node.value, filters)
        if isinstance(value, Const):
            return Text(show(value.value))
        if isinstance(value, Apply) and value.name == "+" and any(isinstance(x, Const) and isinstance(x.value, str) for x in value.args):
            return fold(tuple(Output(x) for x in value.args), filters)  # a text beside it makes + a join
        return Output(value)
    if isinstance(node, For):
        return For(node.name, fold(node.over, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    if isinstance(node, If):
        arms = []
        for condition, inner in node.arms:
            condition = fold(condition, filters)
            if isinstance(condition, Const):
                if not condition.value:
                    continue
                arms.append((Const(True), fold(inner, filters)))
                break
            arms.append((condition, fold(inner, filters)))
        if not arms:
            return ()
        return arms[0][1] if isinstance(arms[0][0], Const) else If(tuple(arms))
    return node


# -- closures


def _function(name: str, filters: dict[str, Callable]) -> Callable:
    return filters[name[1:]] if name[0] == "|" else OPERATORS[name]


def _evaluator(node: Any, filters: dict[str, Callable]) -> Evaluate:
    if isinstance(node, Const):
        return lambda names, value=node.value: value
    if isinstance(node, Name):
        return lambda names, name=node.name: names.get(name)
    if isinstance(node, Get):
        of, key = _evaluator(node.of, filters), _evaluator(node.key, filters)

        def get(names: dict) -> Any:
            holder = of(names)
            return holder.get(key(names)) if isinstance(holder, dict) else None

        return get
    args = [_evaluator(x, filters) for x in node.args]
    if node.name == "and":
        return lambda names: args[0](names) and args[1](names)
    if node.name == "or":
        return lambda names: args[0](names) or args[1](names)
    function = _function(node.name, filters)
    if len(args) == 1:
        return lambda names: function(args[0](names))
    return lambda names: function(args[0](names), args[1](names))


def _renderer(node: Any, filters: dict[str, Callable]) -> Render:
    if isinstance(node, tuple):
        parts = [_renderer(x, filters) for x in node]

        def sequence(names: dict, marked: bool) -> Iterator[Piece]:
            for part in parts:
                yield from part(names, marked)

        return sequence
    if isinstance(node, Text):
        return lambda names, marked, text=node.text: iter(((text, marked),))
    if isinstance(node, Output):
        value = _evaluator(node.value, filters)
        return lambda names, marked: iter(((show(value(names)), marked),))
    if isinstance(node, Generation):
        inner = _renderer(node.body, filters)
        return lambda names, marked: inner(names, True)
    if isinstance(node, If):
        arms = [(_evaluator(c, filters), _renderer(b, filters)) for c, b in node.arms]

        def choose(names: dict, marked: bool) -> Iterator[Piece]:
            for condition, inner in arms:
                if condition(names):
                    yield from inner(names, marked)
                    return

        return choose
    over, inner, name = _evaluator(node.over, filters), _renderer(node.body, filters), node.name

    def loop(names: dict, marked: bool) -> Iterator[Piece]:
        values = over(names)
        if not isinstance(values, Iterable) or isinstance(values, (str, dict)):
            return
        index, none = 0, object()
        values = iter(values)
        value = next(values, none)
        while value is not none:
            following = next(values, none)
            index += 1
            state = {"first": index == 1, "last": following is none, "index": index}
            yield from inner({**names, name: value, "loop": state}, marked)
            value = following

    return loop


def compiled(source: str, extra_filters: dict[str, Callable] | None = None) -> Callable[[dict], Iterator[Piece]]:
    """A template as a function from names to (text, marked) pieces."""
    filters = {**FILTERS, **(extra_filters or {})}
    render = _renderer(fold(parse(source, filters), filters), filters)
    return lambda names: render(names, False)
