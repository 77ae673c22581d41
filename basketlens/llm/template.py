"""A small template language for conversations, compiled to Python closures.

    {{ expression }}                                    output
    {% for name in expression %} ... {% endfor %}
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}            text that a model should learn to say
    {# comment #}

Expressions have strings, integers, true, false, none, names, ``a.b``, ``a[b]``, ``loop.first``, ``loop.last``,
``loop.index``, ``not``, ``and``, ``or``, comparisons, ``in``, ``~`` (joins as text), ``+`` and
filters behind ``|``. Names and attributes are looked up in dictionaries alone, filters in the
table given to ``compile``; there are no calls, so a template reaches nothing else.

``compile`` parses into a syntax tree of tuples, folds constants and joins literal output,
then turns every node into a closure. A program is a generator of (text, is_generation)
pieces, so that a conversation of any length can be rendered piece by piece.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

Piece = tuple[str, bool]
Program = Callable[[dict], Iterator[Piece]]

_TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_TOKENS = re.compile(
    r"""\s*(?:(?P<string>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)"""
    r"""|(?P<sign>==|!=|<=|>=|[-<>~+|.\[\]()]))"""
)
_ESCAPES = {"n": "\n", "t": "\t"}
_WORDS = {"true": True, "false": False, "none": None}
_COMPARE: dict[str, Callable[[Any, Any], bool]] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
}


class TemplateError(ValueError):
    """The template cannot be parsed, or asks for something that is not there."""


# expressions: ("const", value), ("name", n), ("item", a, b), ("not", a), ("and" | "or" | "compare" | "join" | "add", ...), ("filter", name, a)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            match = _TOKENS.match(source, at)
            if not match:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((match.lastgroup, match.group(match.lastgroup)))
            at = match.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str:
        if not self.peek(*values):
            raise TemplateError(f"expected {' or '.join(values)} at token {self.at}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> tuple:
        tree = self.any_of()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def any_of(self) -> tuple:
        tree = self.all_of()
        while self.peek("or"):
            self.take("or")
            tree = ("or", tree, self.all_of())
        return tree

    def all_of(self) -> tuple:
        tree = self.negated()
        while self.peek("and"):
            self.take("and")
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        if self.peek("not"):
            self.take("not")
            return ("not", self.negated())
        tree = self.joined()
        while self.peek(*_COMPARE):
            sign = self.take(*_COMPARE)
            tree = ("compare", sign, tree, self.joined())
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self.peek("~", "+"):
            kind = "join" if self.take("~", "+") == "~" else "add"
            tree = (kind, tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.item()
        while self.peek("|"):
            self.take("|")
            tree = ("filter", self.word(), tree)
        return tree

    def word(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError(f"expected a name at token {self.at}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def item(self) -> tuple:
        tree = self.atom()
        while self.peek(".", "["):
            if self.take(".", "[") == ".":
                tree = ("item", tree, ("const", self.word()))
            else:
                tree = ("item", tree, self.any_of())
                self.take("]")
        return tree

    def atom(self) -> tuple:
        if self.peek("("):
            self.take("(")
            tree = self.any_of()
            self.take(")")
            return tree
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return ("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return ("const", int(value))
        if kind == "name":
            return ("const", _WORDS[value]) if value in _WORDS else ("name", value)
        raise TemplateError(f"unexpected {value!r}")


# statements: ("text", s), ("output", e), ("for", name, e, body), ("if", [(e, body)...]), ("set", name, e), ("generation", body)


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of statements."""
    parts: list[tuple[str, str]] = []
    at = 0
    for match in _TAGS.finditer(source):
        parts.append(("text", source[at : match.start()]))
        if match[1] is not None:
            parts.append(("output", match[1]))
        elif match[2] is not None:
            parts.append(("tag", match[2].strip()))
        at = match.end()
    parts.append(("text", source[at:]))
    place = 0

    def body(*ends: str) -> tuple[list[tuple], str]:
        """Statements up to a tag whose first word is one of ``ends``, and that tag."""
        nonlocal place
        found: list[tuple] = []
        while place < len(parts):
            kind, value = parts[place]
            place += 1
            if kind == "text":
                found += [("text", value)] if value else []
                continue
            if kind == "output":
                found.append(("output", _Expression(value).whole()))
                continue
            word = value.split(None, 1)[0] if value else ""
            if word in ends:
                return found, value
            if word == "for":
                match = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(.+)", value, re.S)
                if not match:
                    raise TemplateError(f"cannot read {value!r}")
                inner, _ = body("endfor")
                found.append(("for", match[1], _Expression(match[2]).whole(), inner))
            elif word == "if":
                branches, test = [], _Expression(value[2:]).whole()
                while True:
                    inner, end = body("elif", "else", "endif")
                    branches.append((test, inner))
                    if end == "endif":
                        break
                    test = _Expression(end[4:]).whole() if end.startswith("elif") else ("const", True)
                found.append(("if", branches))
            elif word == "set":
                match = re.fullmatch(r"set\s+([A-Za-z_]\w*)\s*=(.+)", value, re.S)
                if not match:
                    raise TemplateError(f"cannot read {value!r}")
                found.append(("set", match[1], _Expression(match[2]).whole()))
            elif word == "generation":
                found.append(("generation", body("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown or misplaced tag {value!r}")
        if ends:
            raise TemplateError(f"{' or '.join(ends)} is missing")
        return found, ""

    return body()[0]


def fold_expression(tree: tuple, filters: dict[str, Callable]) -> tuple:
    """``tree`` with every part that depends on no name replaced by its value."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    folded = tuple(fold_expression(x, filters) if isinstance(x, tuple) else x for x in tree)
    if all(x[0] == "const" for x in folded[1:] if isinstance(x, tuple)):
        return ("const", evaluator(folded, filters)({}))
    return folded


def fold(statements: list[tuple], filters: dict[str, Callable]) -> list[tuple]:
    """Constant expressions evaluated, constant output turned into text, dead branches dropped,
    neighbouring texts joined."""
    out: list[tuple] = []
    for statement in statements:
        kind = statement[0]
        if kind == "output":
            tree = fold_expression(statement[1], filters)
            new = [("text", _text(tree[1]))] if tree[0] == "const" else [("output", tree)]
        elif kind == "for":
            new = [("for", statement[1], fold_expression(statement[2], filters), fold(statement[3], filters))]
        elif kind == "set":
            new = [("set", statement[1], fold_expression(statement[2], filters))]
        elif kind == "generation":
            new = [("generation", fold(statement[1], filters))]
        elif kind == "if":
            branches = []
            for test, inner in statement[1]:
                test = fold_expression(test, filters)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold(inner, filters)))
                if test[0] == "const":
                    break
            always = branches and branches[0][0][0] == "const"
            new = branches[0][1] if always else [("if", branches)] if branches else []
        else:
            new = [statement]
        for piece in new:
            if piece[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + piece[1])
            else:
                out.append(piece)
    return out


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def _item(holder: Any, key: Any) -> Any:
    if isinstance(holder, dict) and key in holder:
        return holder[key]
    if isinstance(holder, (list, tuple)) and isinstance(key, int) and -len(holder) <= key < len(holder):
        return holder[key]
    raise TemplateError(f"there is no {key!r}")


def evaluator(tree: tuple, filters: dict[str, Callable]) -> Callable[[dict], Any]:
    """The closure that computes an expression from the names in scope."""
    kind, *parts = tree
    made = [evaluator(x, filters) if isinstance(x, tuple) else x for x in parts] if kind != "const" else parts
    if kind == "const":
        value = parts[0]
        return lambda scope: value
    if kind == "name":
        name = parts[0]
        return lambda scope: _item(scope, name)
    if kind == "item":
        holder, key = made
        return lambda scope: _item(holder(scope), key(scope))
    if kind == "not":
        inner = made[0]
        return lambda scope: not inner(scope)
    if kind == "filter":
        if parts[0] not in filters:
            raise TemplateError(f"there is no filter {parts[0]!r}")
        call, inner = filters[parts[0]], made[1]
        return lambda scope: call(inner(scope))
    if kind == "compare":
        sign, a, b = _COMPARE[parts[0]], made[1], made[2]
        return lambda scope: sign(a(scope), b(scope))
    a, b = made
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "join":
        return lambda scope: _text(a(scope)) + _text(b(scope))
    return lambda scope: a(scope) + b(scope)


def _with_last(items: Iterable) -> Iterator[tuple[Any, bool]]:
    """Items with whether each is the last, one ahead of what is used."""
    items = iter(items)
    for item in items:
        for following in items:
            yield item, False
            item = following
        yield item, True


def _sequence(statements: list[tuple], filters: dict[str, Callable]) -> Callable[[dict, bool], Iterator[Piece]]:
    runs = [_statement(s, filters) for s in statements]

    def run(scope: dict, said: bool) -> Iterator[Piece]:
        for each in runs:
            yield from each(scope, said)

    return run


def _statement(statement: tuple, filters: dict[str, Callable]) -> Callable[[dict, bool], Iterator[Piece]]:
    kind = statement[0]
    if kind == "text":
        text = statement[1]
        return lambda scope, said: iter(((text, said),))
    if kind == "output":
        value = evaluator(statement[1], filters)
        return lambda scope, said: iter(((_text(value(scope)), said),))
    if kind == "generation":
        inner = _sequence(statement[1], filters)
        return lambda scope, said: inner(scope, True)
    if kind == "set":
        name, value = statement[1], evaluator(statement[2], filters)

        def assign(scope: dict, said: bool) -> Iterator[Piece]:
            scope[name] = value(scope)
            return iter(())

        return assign
    if kind == "if":
        branches = [(evaluator(test, filters), _sequence(inner, filters)) for test, inner in statement[1]]

        def choose(scope: dict, said: bool) -> Iterator[Piece]:
            for test, inner in branches:
                if test(scope):
                    return inner(scope, said)
            return iter(())

        return choose
    name, items, inner = statement[1], evaluator(statement[2], filters), _sequence(statement[3], filters)

    def repeat(scope: dict, said: bool) -> Iterator[Piece]:
        for index, (item, last) in enumerate(_with_last(items(scope))):
            here = {**scope, name: item, "loop": {"index": index + 1, "first": index == 0, "last": last}}
            yield from inner(here, said)

    return repeat


def compile(source: str, filters: dict[str, Callable] | None = None) -> Program:  # noqa: A001
    """The program of a template: names in scope to pieces of text, in order."""
    filters = filters or {}
    run = _sequence(fold(parse(source), filters), filters)
    return lambda scope: run(dict(scope), False)
