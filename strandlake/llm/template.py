"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                       output
    {% for x in expression %} … {% endfor %}   with loop.index, loop.index0, loop.first, loop.last
    {% if a %} … {% elif b %} … {% else %} … {% endif %}
    {% set name = expression %}
    {% generation %} … {% endgeneration %}     output inside is under the loss mask

Expressions: strings, integers, true, false, none, names, a.b and a['b'] (keys of mappings and loop
fields only), + ~ == != < <= > >= in, and, or, not, filters `a | name`. No Python attribute, call or
import can be reached. A template is parsed to a syntax tree, constants are folded (operators, filters and
branches on constants, joined literals), and closures are made of what is left.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping

TOKEN = re.compile(r"\s*(?:(?P<number>\d+)|(?P<string>'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[-+~<>.|()\[\]]))")
PART = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}", re.S)
CONSTANTS = {"true": True, "false": False, "none": None}
COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "in": lambda a, b: a in b}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


def text_of(value) -> str:
    return "" if value is None else value if isinstance(value, str) else "true" if value is True else "false" if value is False else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: text_of(v).strip(),
    "upper": lambda v: text_of(v).upper(),
    "lower": lambda v: text_of(v).lower(),
    "length": lambda v: len(v),
    "string": text_of,
}


class Expressions:
    """Recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        while source[at:].strip():
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:].strip()[:10]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def accept(self, *texts: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("op", "name") and self.peek() in texts:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, text: str) -> None:
        if not self.accept(text):
            raise TemplateError(f"expected {text!r}, found {self.peek()!r}")

    def whole(self):
        node = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r}")
        return node

    def either(self):
        node = self.both()
        while self.accept("or"):
            node = ("or", node, self.both())
        return node

    def both(self):
        node = self.negation()
        while self.accept("and"):
            node = ("and", node, self.negation())
        return node

    def negation(self):
        return ("not", self.negation()) if self.accept("not") else self.comparison()

    def comparison(self):
        node = self.joined()
        while op := self.accept(*COMPARE):
            node = ("compare", op, node, self.joined())
        return node

    def joined(self):
        node = self.filtered()
        while op := self.accept("+", "~"):
            node = ("join", op, node, self.filtered())
        return node

    def filtered(self):
        node = self.primary()
        while self.accept("|"):
            node = ("filter", self.name(), node)
        return node

    def name(self) -> str:
        kind, text = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        if kind != "name":
            raise TemplateError(f"expected a name, found {text!r}")
        self.at += 1
        return text

    def primary(self):
        if self.accept("("):
            node = self.either()
            self.expect(")")
        else:
            if self.at >= len(self.tokens):
                raise TemplateError("expression ends early")
            kind, text = self.tokens[self.at]
            self.at += 1
            if kind == "number":
                node = ("const", int(text))
            elif kind == "string":
                node = ("const", re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), text[1:-1], flags=re.S))
            elif kind == "name":
                node = ("const", CONSTANTS[text]) if text in CONSTANTS else ("name", text)
            else:
                raise TemplateError(f"unexpected {text!r}")
        while True:
            if self.accept("."):
                node = ("item", node, ("const", self.name()))
            elif self.accept("["):
                node = ("item", node, self.either())
                self.expect("]")
            else:
                return node


def parse(source: str) -> list:
    """Syntax tree: a list of ("text", s), ("out", e), ("for", name, e, body), ("if", [(e, body)…], rest),
    ("set", name, e), ("generation", body)."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in PART.finditer(source):
        parts.append(("text", source[at : m.start()]))
        parts.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    parts.append(("text", source[at:]))
    place = 0

    def body(*ends: str) -> tuple[list, str]:
        nonlocal place
        nodes: list = []
        while place < len(parts):
            kind, content = parts[place]
            place += 1
            if kind == "text":
                nodes.append(("text", content))
            elif kind == "out":
                nodes.append(("out", Expressions(content).whole()))
            else:
                word, _, rest = content.partition(" ")
                if word in ends:
                    return nodes, content
                if word == "for":
                    m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"malformed for: {content!r}")
                    inner, _ = body("endfor")
                    nodes.append(("for", m[1], Expressions(m[2]).whole(), inner))
                elif word == "if":
                    branches, otherwise, condition = [], [], rest
                    while True:
                        inner, end = body("elif", "else", "endif")
                        branches.append((Expressions(condition).whole(), inner))
                        if end.startswith("elif"):
                            condition = end[4:]
                            continue
                        if end == "else":
                            otherwise, _ = body("endif")
                        break
                    nodes.append(("if", branches, otherwise))
                elif word == "set":
                    m = re.fullmatch(r"(\w+)\s*=(?!=)\s*(.+)", rest.strip(), re.S)
                    if not m:
                        raise TemplateError(f"malformed set: {content!r}")
                    nodes.append(("set", m[1], Expressions(m[2]).whole()))
                elif word == "generation":
                    inner, _ = body("endgeneration")
                    nodes.append(("generation", inner))
                else:
                    raise TemplateError(f"unknown tag {word!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return nodes, ""

    return body()[0]


def fold(node, filters: Mapping[str, Callable]):
    """The expression with every constant part computed."""
    kind = node[0]
    if kind in ("const", "name"):
        return node
    if kind == "filter":
        if node[1] not in filters:
            raise TemplateError(f"unknown filter {node[1]!r}")
        inner = fold(node[2], filters)
        return ("const", filters[node[1]](inner[1])) if inner[0] == "const" else ("filter", node[1], inner)
    inner = [fold(x, filters) if isinstance(x, tuple) else x for x in node[1:]]
    if kind in ("and", "or") and inner[0][0] == "const":
        return inner[1] if bool(inner[0][1]) == (kind == "and") else inner[0]
    out = (kind, *inner)
    if all(x[0] == "const" for x in inner if isinstance(x, tuple)):
        return ("const", evaluate(out, filters)({}))
    return out


def fold_body(nodes: list, filters: Mapping[str, Callable]) -> list:
    out: list = []

    def add(node):
        if node[0] == "text":
            if not node[1]:
                return
            if out and out[-1][0] == "text":
                node = ("text", out.pop()[1] + node[1])
        out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = fold(node[1], filters)
            add(("text", text_of(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "for":
            add(("for", node[1], fold(node[2], filters), fold_body(node[3], filters)))
        elif node[0] == "set":
            add(("set", node[1], fold(node[2], filters)))
        elif node[0] == "generation":
            add(("generation", fold_body(node[1], filters)))
        elif node[0] == "if":
            branches, rest = [], fold_body(node[2], filters)
            for condition, inner in node[1]:
                e = fold(condition, filters)
                if e[0] == "const" and not e[1]:
                    continue
                if e[0] == "const":
                    rest = fold_body(inner, filters)
                    break
                branches.append((e, fold_body(inner, filters)))
            if branches:
                add(("if", branches, rest))
            else:
                for x in rest:
                    add(x)
        else:
            add(node)
    return out


def evaluate(node, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    """Closure from a scope to the expression's value. Unknown names and keys are none."""
    kind = node[0]
    if kind == "const":
        value = node[1]
        return lambda scope: value
    if kind == "name":
        name = node[1]
        return lambda scope: scope.get(name)
    if kind == "item":
        whole, key = evaluate(node[1], filters), evaluate(node[2], filters)

        def item(scope):
            held = whole(scope)
            return held.get(key(scope)) if isinstance(held, Mapping) else None

        return item
    if kind == "filter":
        run, inner = filters[node[1]], evaluate(node[2], filters)
        return lambda scope: run(inner(scope))
    if kind == "not":
        inner = evaluate(node[1], filters)
        return lambda scope: not inner(scope)
    if kind in ("and", "or"):
        left, right = evaluate(node[1], filters), evaluate(node[2], filters)
        return (lambda scope: left(scope) and right(scope)) if kind == "and" else (lambda scope: left(scope) or right(scope))
    left, right = evaluate(node[2], filters), evaluate(node[3], filters)
    if kind == "compare":
        run = COMPARE[node[1]]
        return lambda scope: run(left(scope), right(scope))
    if node[1] == "~":
        return lambda scope: text_of(left(scope)) + text_of(right(scope))
    return lambda scope: left(scope) + right(scope)


#: A rendering: pieces of text, each with whether it is under the loss mask.
Pieces = Iterator[tuple[str, bool]]


def generate(nodes: list, filters: Mapping[str, Callable], masked: bool = False) -> Callable[[dict], Pieces]:
    """Closure that renders a body piece by piece, so that a loop over a stream is a stream itself."""
    steps: list[Callable[[dict], Iterable[tuple[str, bool]]]] = []
    for node in nodes:
        kind = node[0]
        if kind == "text":
            steps.append(lambda scope, piece=((node[1], masked),): piece)
        elif kind == "out":
            steps.append(lambda scope, value=evaluate(node[1], filters): ((text_of(value(scope)), masked),))
        elif kind == "set":
            steps.append(lambda scope, name=node[1], value=evaluate(node[2], filters): scope.__setitem__(name, value(scope)) or ())
        elif kind == "generation":
            steps.append(generate(node[1], filters, True))
        elif kind == "if":
            branches = [(evaluate(e, filters), generate(b, filters, masked)) for e, b in node[1]]

            def choose(scope, branches=branches, rest=generate(node[2], filters, masked)):
                return next((run for condition, run in branches if condition(scope)), rest)(scope)

            steps.append(choose)
        elif kind == "for":

            def loop(scope, name=node[1], items=evaluate(node[2], filters), run=generate(node[3], filters, masked)):
                inner = dict(scope)
                for place, item, last in with_last(items(scope) or ()):
                    inner[name] = item
                    inner["loop"] = {"index": place + 1, "index0": place, "first": place == 0, "last": last}
                    yield from run(inner)

            steps.append(loop)

    def run_all(scope):
        for step in steps:
            yield from step(scope)

    return run_all


def with_last(items: Iterable) -> Iterator[tuple[int, object, bool]]:
    """(index, item, is it the last), reading one item ahead, so that items may be a stream."""
    held, place = [], 0
    for item in items:
        if held:
            yield place, held[0], False
            place += 1
        held = [item]
    if held:
        yield place, held[0], True


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[dict], Pieces]:
    """render(scope) of a template; filters are added to the built-in ones."""
    known = FILTERS | dict(filters or {})
    return generate(fold_body(parse(source), known), known)
