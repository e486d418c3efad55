"""A small sandboxed template language, compiled to Python closures.

Texts with ``{{ value }}``, ``{% if %} {% elif %} {% else %} {% endif %}``, ``{% for x in list %}``
(with ``loop.index0``, ``loop.first``, ``loop.last``), ``{% set x = value %}``, ``{# remarks #}`` and
``{% generation %} ... {% endgeneration %}`` around what a model is to learn. ``{%-`` and ``-%}`` take
white space off the text beside them. Values are texts, whole numbers, booleans, none, lists and
dictionaries; a dot reads a dictionary's entry and nothing else, filters are those the
caller gives, and nothing can be called, so a template cannot reach the interpreter.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass, field

Value = object
Env = dict[str, Value]

_TAG = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
                    r"""|(?P<op>==|!=|<=|>=|//|[-+*%~<>|.,()\[\]=]))""", re.DOTALL)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"true": True, "false": False, "none": None}
_KEYWORDS = {"and", "or", "not", "in", "is", "if", "else"}


class TemplateError(ValueError):
    """The template is malformed, or asks for something a value does not have."""


@dataclass(frozen=True)
class Const:
    value: Value


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """A function over the values of its parts; ``lazy`` ones get the parts' closures and the names instead."""
    work: Callable
    parts: tuple
    lazy: bool = False


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    branches: tuple  # of (test, body); the last may have the test Const(True)


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _entry(of: Value, key: Value) -> Value:
    if isinstance(of, dict):
        return of.get(key)
    if isinstance(of, (list, str)) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else None
    raise TemplateError(f"no entry {key!r} in a {type(of).__name__}")


def _text(value: Value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _arithmetic(work: Callable) -> Callable:
    def run(a: Value, b: Value) -> Value:
        if type(a) is not int or type(b) is not int:
            raise TemplateError("arithmetic needs whole numbers")
        return work(a, b)
    return run


def _plus(a: Value, b: Value) -> Value:
    if isinstance(a, str) and isinstance(b, str):
        return a + b
    return _arithmetic(operator.add)(a, b)


_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_SUM = {"+": _plus, "-": _arithmetic(operator.sub), "~": lambda a, b: _text(a) + _text(b)}
_PRODUCT = {"*": _arithmetic(operator.mul), "//": _arithmetic(operator.floordiv), "%": _arithmetic(operator.mod)}


def _apply(work: Callable, *parts: object, lazy: bool = False) -> object:
    """An application, worked out at once where all parts are constants."""
    node = Apply(work, parts, lazy)
    if all(isinstance(p, Const) for p in parts):
        return Const(_closure(node)({}))
    return node


class _Expression:
    """Parses one tag's expression by precedence climbing."""

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.filters, self.at, self.tokens = filters, 0, []
        end = 0
        source = source.strip()
        while end < len(source):
            found = _TOKEN.match(source, end)
            if not found:
                raise TemplateError(f"cannot read {source[end:end + 20]!r}")
            self.tokens.append((found.lastgroup, found.group(found.lastgroup)))
            end = found.end()

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} is missing")

    def word(self) -> str:
        if self.at == len(self.tokens) or self.tokens[self.at][0] != "name" or self.tokens[self.at][1] in _KEYWORDS:
            raise TemplateError("a name is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")

    def value(self) -> object:
        node = self.either()
        if self.take("if"):
            test = self.either()
            other = self.value() if self.take("else") else Const(None)
            if isinstance(test, Const):
                return node if test.value else other
            return _apply(lambda env, t, a, b: a(env) if t(env) else b(env), test, node, other, lazy=True)
        return node

    def either(self) -> object:
        node = self.both()
        while self.take("or"):
            node = _apply(lambda env, a, b: a(env) or b(env), node, self.both(), lazy=True)
        return node

    def both(self) -> object:
        node = self.negation()
        while self.take("and"):
            node = _apply(lambda env, a, b: a(env) and b(env), node, self.negation(), lazy=True)
        return node

    def negation(self) -> object:
        return _apply(operator.not_, self.negation()) if self.take("not") else self.comparison()

    def comparison(self) -> object:
        node = self.binary(_SUM, lambda: self.binary(_PRODUCT, self.negative))
        while True:
            if sign := self.take(*_COMPARE):
                node = _apply(_COMPARE[sign], node, self.binary(_SUM, lambda: self.binary(_PRODUCT, self.negative)))
            elif self.take("in"):
                node = _apply(lambda a, b: a in b, node, self.binary(_SUM, self.negative))
            elif self.peek("not"):
                self.at += 1
                self.need("in")
                node = _apply(lambda a, b: a not in b, node, self.binary(_SUM, self.negative))
            elif self.take("is"):
                wanted = not self.take("not")
                if self.word() not in ("none", "defined"):
                    raise TemplateError("only 'is none' and 'is defined' can be asked")
                absent = self.tokens[self.at - 1][1] == "none"
                node = _apply(lambda a, yes=(wanted == absent): (a is None) == yes, node)
            else:
                return node

    def binary(self, signs: dict[str, Callable], inner: Callable) -> object:
        node = inner()
        while sign := self.take(*signs):
            node = _apply(signs[sign], node, inner())
        return node

    def negative(self) -> object:
        return _apply(_arithmetic(lambda zero, a: -a), Const(0), self.negative()) if self.take("-") else self.filtered()

    def filtered(self) -> object:
        node = self.reading()
        while self.take("|"):
            name = self.word()
            if name not in self.filters:
                raise TemplateError(f"there is no filter {name!r}")
            node = _apply(self.filters[name], node, *(self.listed(")") if self.take("(") else ()))
        return node

    def reading(self) -> object:
        node = self.simple()
        while True:
            if self.take("."):
                node = _apply(_entry, node, Const(self.word()))
            elif self.take("["):
                node = _apply(_entry, node, self.value())
                self.need("]")
            else:
                return node

    def listed(self, close: str) -> list:
        parts = []
        while not self.take(close):
            parts.append(self.value())
            if not self.peek(close):
                self.need(",")
        return parts

    def simple(self) -> object:
        if self.take("("):
            node = self.value()
            self.need(")")
            return node
        if self.take("["):
            return _apply(lambda *values: list(values), *self.listed("]"))
        if self.at < len(self.tokens):
            kind, token = self.tokens[self.at]
            if kind == "number":
                self.at += 1
                return Const(int(token))
            if kind == "text":
                self.at += 1
                return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.DOTALL))
        name = self.word()
        return Const(_WORDS[name]) if name in _WORDS else Name(name)


class _Parser:
    def __init__(self, source: str, filters: dict[str, Callable]):
        self.filters, self.at = filters, 0
        self.pieces = [p for p in self._split(source) if p[1] or p[0] != "text"]

    @staticmethod
    def _split(source: str) -> list[tuple[str, str]]:
        found = [[("tag" if k % 2 else "text"), piece] for k, piece in enumerate(_TAG.split(source))]
        for k in range(1, len(found), 2):
            tag = found[k][1]
            found[k][0] = {"%": "do", "{": "print", "#": "remark"}[tag[1]]
            if found[k][0] != "remark":
                if tag[2] == "-":
                    found[k - 1][1] = found[k - 1][1].rstrip()
                if tag[-3] == "-":
                    found[k + 1][1] = found[k + 1][1].lstrip()
                found[k][1] = tag[2:-2].strip("-").strip()
        return [(kind, piece) for kind, piece in found if kind != "remark"]

    def body(self, *ends: str) -> tuple[tuple, str]:
        """Statements up to one of the tags ``ends``, and that tag; adjacent texts become one."""
        out: list = []
        def text(value: str) -> None:
            if out and isinstance(out[-1], Text):
                value = out.pop().value + value
            if value:
                out.append(Text(value))

        while self.at < len(self.pieces):
            kind, piece = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                text(piece)
                continue
            if kind == "print":
                node = self.expression(piece)
                text(_text(node.value)) if isinstance(node, Const) else out.append(Print(node))
                continue
            word, _, rest = piece.partition(" ")
            if word in ends:
                return tuple(out), piece
            for node in self.statement(word, rest):
                text(node.value) if isinstance(node, Text) else out.append(node)
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), ""

    def expression(self, source: str) -> object:
        parser = _Expression(source, self.filters)
        node = parser.value()
        parser.end()
        return node

    def statement(self, word: str, rest: str) -> tuple:
        if word == "generation":
            return (Generation(self.body("endgeneration")[0]),)
        if word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError("a set tag needs a name and a value")
            return (Set(name.strip(), self.expression(value)),)
        if word == "for":
            head = _Expression(rest, self.filters)
            name = head.word()
            head.need("in")
            items = head.value()
            head.end()
            return (For(name, items, self.body("endfor")[0]),)
        if word == "if":
            branches, tag = [], "if " + rest
            while tag != "endif":
                test = Const(True) if tag == "else" else self.expression(tag.partition(" ")[2])
                ends = ("endif",) if tag == "else" else ("elif", "else", "endif")
                body, tag = self.body(*ends)
                branches.append((test, body))
            # branches that cannot be taken go; one that always is ends the list
            live = [b for b in branches if not (isinstance(b[0], Const) and not b[0].value)]
            sure = next((k for k, b in enumerate(live) if isinstance(b[0], Const)), len(live))
            live = live[:sure + 1]
            return live[0][1] if sure == 0 and live else (If(tuple(live)),) if live else ()
        raise TemplateError(f"there is no tag {word!r}")


@dataclass
class _Output:
    parts: list[str] = field(default_factory=list)
    size: int = 0
    marks: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def _closure(node: object) -> Callable[[Env], Value]:
    """An expression as a function of the names' values."""
    if isinstance(node, Const):
        return lambda env, value=node.value: value
    if isinstance(node, Name):
        return lambda env, name=node.name: env.get(name)
    work, parts = node.work, [_closure(p) for p in node.parts]
    if node.lazy:
        return lambda env: work(env, *parts)
    if len(parts) == 1:
        one, = parts
        return lambda env: work(one(env))
    if len(parts) == 2:
        a, b = parts
        return lambda env: work(a(env), b(env))
    return lambda env: work(*[p(env) for p in parts])


def _statement(node: object) -> Callable[[Env, _Output], None]:
    if isinstance(node, Text):
        return lambda env, out, text=node.value: out.add(text)
    if isinstance(node, Print):
        value = _closure(node.value)
        return lambda env, out: out.add(_text(value(env)))
    if isinstance(node, Set):
        value = _closure(node.value)
        return lambda env, out, name=node.name: env.__setitem__(name, value(env))
    if isinstance(node, Generation):
        inside = _block(node.body)

        def marked(env: Env, out: _Output) -> None:
            start = out.size
            inside(env, out)
            out.marks.append((start, out.size))
        return marked
    if isinstance(node, If):
        branches = [(_closure(test), _block(body)) for test, body in node.branches]

        def choose(env: Env, out: _Output) -> None:
            for test, run in branches:
                if test(env):
                    return run(env, out)
        return choose
    items, run, name = _closure(node.items), _block(node.body), node.name

    def loop(env: Env, out: _Output) -> None:
        values = items(env)
        if not isinstance(values, list):
            raise TemplateError("only lists can be gone through")
        outer = dict(env)
        for k, value in enumerate(values):
            # names set inside a round end with it
            run({**outer, name: value, "loop": {"index0": k, "first": k == 0, "last": k + 1 == len(values)}}, out)
    return loop


def _block(body: tuple) -> Callable[[Env, _Output], None]:
    steps = [_statement(node) for node in body]
    if len(steps) == 1:
        return steps[0]

    def run(env: Env, out: _Output) -> None:
        for step in steps:
            step(env, out)
    return run


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The syntax tree, constants folded."""
    return _Parser(source, filters).body()[0]


def compile_template(source: str, filters: dict[str, Callable]) -> Callable[..., tuple[str, list[tuple[int, int]]]]:
    """A function of the template's names: the text, and where (from, to) its generated parts stand."""
    run = _block(parse(source, filters))

    def render(**names: Value) -> tuple[str, list[tuple[int, int]]]:
        out = _Output()
        run(dict(names), out)
        return "".join(out.parts), out.marks
    return render
