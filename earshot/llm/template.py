"""A small sandboxed template language for conversations, compiled to Python closures.

    {{ expression }}                     print a value
    {% for m in messages %} ... {% endfor %}
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}    what is printed inside is under the loss mask

Expressions: names, ``m.role``, string and integer literals, ``true false none``, ``+``, ``== !=``,
``not and or``, parentheses and the filters ``escape``, ``lower``, ``upper``, ``trim``. Inside a
loop ``loop.index0``, ``loop.first`` and ``loop.last`` are known. A dot reads a field of a message
or of ``loop`` and nothing else: no Python attribute, call or index is reachable.

``compile_template`` parses the source into a syntax tree, folds what is constant (operators on
literals, branches with constant conditions, neighbouring texts) and turns each node into a
closure that yields (text, masked) pieces. Messages are taken from an iterator, one ahead, so a
conversation of any length is rendered as a stream.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

Piece = tuple[str, bool | None]
BETWEEN = ("", None)  # after each round of a loop that stands in nothing else
Env = dict[str, object]

ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h"}
_ESCAPED = {v: k for k, v in ESCAPES.items()}


def escape(text: str) -> str:
    """No ``<`` or ``#`` is left, so no control string of a template built on them can appear."""
    return re.sub(r"[\\<#]", lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lh]", lambda m: _ESCAPED[m[0]], text)


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "lower": str.lower, "upper": str.upper, "trim": str.strip}


class TemplateError(ValueError):
    pass


# Syntax tree


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Literal:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    base: object
    name: str


@dataclass(frozen=True)
class Operation:
    symbol: str
    parts: tuple


@dataclass(frozen=True)
class Filter:
    name: str
    value: object


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


TAGS = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}", re.S)
TOKENS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+().|=]))")
SIMPLE = {"\\n": "\n", "\\t": "\t"}


def _tokens(source: str) -> list[tuple[str, object]]:
    found, at = [], 0
    source = source.strip()
    while at < len(source):
        m = TOKENS.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        if m[1] is not None:
            found.append(("literal", re.sub(r"\\.", lambda e: SIMPLE.get(e[0], e[0][1]), m[1][1:-1])))
        elif m[2] is not None:
            found.append(("literal", int(m[2])))
        else:
            found.append(("name", m[3]) if m[3] else ("symbol", m[4]))
        at = m.end()
    return found


class _Expression:
    """Recursive descent: or < and < not < comparison < + < filter < field."""

    def __init__(self, source: str):
        self.left = _tokens(source)[::-1]

    def parse(self):
        value = self.either()
        if self.left:
            raise TemplateError(f"unexpected {self.left[-1][1]!r}")
        return value

    def take(self, *wanted: str) -> str | None:
        if self.left and self.left[-1][0] != "literal" and self.left[-1][1] in wanted:
            return self.left.pop()[1]
        return None

    def chain(self, symbols: tuple[str, ...], below):
        value = below()
        while symbol := self.take(*symbols):
            value = Operation(symbol, (value, below()))
        return value

    def either(self):
        return self.chain(("or",), lambda: self.chain(("and",), self.negated))

    def negated(self):
        if self.take("not"):
            return Operation("not", (self.negated(),))
        return self.chain(("==", "!="), lambda: self.chain(("+",), self.filtered))

    def filtered(self):
        value = self.atom()
        while self.take("|"):
            kind, name = self.left.pop() if self.left else ("", None)
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            value = Filter(name, value)
        return value

    def atom(self):
        if not self.left:
            raise TemplateError("expression ends early")
        if self.take("("):
            value = self.either()
            if not self.take(")"):
                raise TemplateError("no closing parenthesis")
        else:
            kind, found = self.left.pop()
            if kind == "literal":
                value = Literal(found)
            elif kind == "name":
                value = Literal({"true": True, "false": False, "none": None}[found]) if found in ("true", "false", "none") else Name(found)
            else:
                raise TemplateError(f"unexpected {found!r}")
        while self.take("."):
            kind, name = self.left.pop() if self.left else ("", None)
            if kind != "name" or name.startswith("_"):
                raise TemplateError(f"no field {name!r}")
            value = Field(value, name)
        return value


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    pieces: list[tuple[str, str]] = []
    at = 0
    for m in TAGS.finditer(source):
        pieces += [("text", source[at : m.start()]), ("print", m[1]) if m[1] is not None else ("tag", m[2].strip())]
        at = m.end()
    pieces.append(("text", source[at:]))
    pieces = [p for p in pieces if p != ("text", "")][::-1]

    def body(*ends: str) -> tuple[tuple, str, str]:
        nodes = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                nodes.append(Text(value))
            elif kind == "print":
                nodes.append(Print(_Expression(value).parse()))
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return tuple(nodes), word, rest
                nodes.append(tag(word, rest))
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(nodes), "", ""

    def tag(word: str, rest: str):
        if word == "for":
            m = re.fullmatch(r"([A-Za-z]\w*) in (.*)", rest.strip(), re.S)
            if not m:
                raise TemplateError(f"for {rest}")
            return For(m[1], _Expression(m[2]).parse(), body("endfor")[0])
        if word == "set":
            name, _, value = rest.partition("=")
            if not re.fullmatch(r"\s*[A-Za-z]\w*\s*", name):
                raise TemplateError(f"set {rest}")
            return Set(name.strip(), _Expression(value).parse())
        if word == "generation":
            return Generation(body("endgeneration")[0])
        if word == "if":
            branches, end = [], "if"
            while end != "endif":
                condition = Literal(True) if end == "else" else _Expression(rest).parse()
                nodes, end, rest = body(*(("endif",) if end == "else" else ("elif", "else", "endif")))
                branches.append((condition, nodes))
            return If(tuple(branches))
        raise TemplateError(f"no tag {word!r}")

    return body()[0]


# Constant folding


def _printed(value: object) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def _apply(symbol: str, values: list) -> object:
    if symbol == "+":
        a, b = values
        return a + b if isinstance(a, int) and isinstance(b, int) else _printed(a) + _printed(b)
    if symbol == "not":
        return not values[0]
    return (values[0] == values[1]) == (symbol == "==")


def _fold_value(node):
    if isinstance(node, Field):
        return Field(_fold_value(node.base), node.name)
    if isinstance(node, Filter):
        value = _fold_value(node.value)
        return Literal(FILTERS[node.name](_printed(value.value))) if isinstance(value, Literal) else Filter(node.name, value)
    if isinstance(node, Operation):
        parts = tuple(map(_fold_value, node.parts))
        if node.symbol in ("and", "or"):
            if isinstance(parts[0], Literal):
                return parts[1] if bool(parts[0].value) == (node.symbol == "and") else parts[0]
        elif all(isinstance(p, Literal) for p in parts):
            return Literal(_apply(node.symbol, [p.value for p in parts]))
        return Operation(node.symbol, parts)
    return node


def fold(nodes: tuple) -> tuple:
    """The same template with constant parts evaluated."""
    out: list = []
    for node in nodes:
        if isinstance(node, Print):
            value = _fold_value(node.value)
            node = Text(_printed(value.value)) if isinstance(value, Literal) else Print(value)
        elif isinstance(node, Set):
            node = Set(node.name, _fold_value(node.value))
        elif isinstance(node, For):
            node = For(node.name, _fold_value(node.items), fold(node.body))
        elif isinstance(node, Generation):
            node = Generation(fold(node.body))
        elif isinstance(node, If):
            branches = []
            for condition, body in node.branches:
                condition = _fold_value(condition)
                if isinstance(condition, Literal) and not condition.value:
                    continue
                branches.append((condition, fold(body)))
                if isinstance(condition, Literal):
                    break
            if not branches:
                continue
            if isinstance(branches[0][0], Literal):
                for inner in branches[0][1]:
                    _append(out, inner)
                continue
            node = If(tuple(branches))
        _append(out, node)
    return tuple(out)


def _append(out: list, node) -> None:
    if isinstance(node, Text):
        if not node.value:
            return
        if out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
            return
    out.append(node)


# Closures


def _value(node) -> Callable[[Env], object]:
    if isinstance(node, Literal):
        constant = node.value
        return lambda env: constant
    if isinstance(node, Name):
        name = node.name

        def read(env: Env):
            if name not in env:
                raise TemplateError(f"no name {name!r}")
            return env[name]

        return read
    if isinstance(node, Field):
        base, field = _value(node.base), node.name

        def field_of(env: Env):
            found = base(env)
            if type(found) is not dict or field not in found:
                raise TemplateError(f"no field {field!r}")
            return found[field]

        return field_of
    if isinstance(node, Filter):
        inner, change = _value(node.value), FILTERS[node.name]
        return lambda env: change(_printed(inner(env)))
    parts = [_value(p) for p in node.parts]
    if node.symbol == "and":
        return lambda env: parts[0](env) and parts[1](env)
    if node.symbol == "or":
        return lambda env: parts[0](env) or parts[1](env)
    symbol = node.symbol
    return lambda env: _apply(symbol, [p(env) for p in parts])


Render = Callable[[Env], Iterator[Piece]]


def _body(nodes: tuple, masked: bool, top: bool = False) -> Render:
    parts = [_node(n, masked, top) for n in nodes]

    def run(env: Env) -> Iterator[Piece]:
        for part in parts:
            yield from part(env)

    return run


def _node(node, masked: bool, top: bool) -> Render:
    if isinstance(node, Text):
        piece = ((node.value, masked),)
        return lambda env: iter(piece)
    if isinstance(node, Print):
        value = _value(node.value)
        return lambda env: iter(((_printed(value(env)), masked),))
    if isinstance(node, Set):
        assigned, name = _value(node.value), node.name

        def assign(env: Env) -> Iterator[Piece]:
            env[name] = assigned(env)
            return iter(())

        return assign
    if isinstance(node, Generation):
        return _body(node.body, True)
    if isinstance(node, If):
        branches = [(_value(c), _body(b, masked)) for c, b in node.branches]

        def choose(env: Env) -> Iterator[Piece]:
            for condition, body in branches:
                if condition(env):
                    return body(env)
            return iter(())

        return choose
    items, body, name = _value(node.items), _body(node.body, masked), node.name

    def loop(env: Env) -> Iterator[Piece]:
        outer = {k: env[k] for k in (name, "loop") if k in env}
        rest = iter(items(env))
        index, item = 0, next(rest, loop)
        while item is not loop:
            following = next(rest, loop)
            env[name] = item
            env["loop"] = {"index0": index, "first": index == 0, "last": following is loop}
            yield from body(env)
            if top:
                yield BETWEEN
            index, item = index + 1, following
        for k in (name, "loop"):
            env.pop(k, None)
        env.update(outer)

    return loop


class Template:
    def __init__(self, source: str):
        self.source = source
        self.tree = fold(parse(source))
        self._render = _body(self.tree, False, top=True)

    def stream(self, messages: Iterable[dict]) -> Iterator[Piece]:
        """(text, masked) pieces, in order; messages are read as they are needed."""
        return self._render({"messages": messages})

    def render(self, messages: Iterable[dict]) -> tuple[str, list[tuple[int, int]]]:
        """The text and its loss spans in characters; spans that touch stay apart."""
        texts, spans, at = [], [], 0
        for text, masked in self.stream(messages):
            texts.append(text)
            if masked and text:
                spans.append((at, at + len(text)))
            at += len(text)
        return "".join(texts), spans


def compile_template(source: str) -> Template:
    return Template(source)
