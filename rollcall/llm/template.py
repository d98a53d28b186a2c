"""Template compiler for chat formatting.

A template is text with ``{{ expression }}`` and the statements ``for``, ``if``/``elif``/``else``, ``set`` and ``generation``. It is parsed into a syntax
tree, constants are folded, and each node becomes a Python closure. Templates are sandboxed: they reach the given values by name and by key, the listed
filters and operators, and nothing else (no attributes, calls or imports).

A loop pulls its items one by one, so an output of any length is rendered in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from enum import Enum
from typing import Any


class Mark(Enum):
    """Where text under the loss mask begins and ends in a stream of pieces."""

    BEGIN, END = 1, 2


BEGIN, END = Mark.BEGIN, Mark.END


def escape(text: str) -> str:
    """Control strings begin with ``<|``, which the result does not hold; reversible."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "escape_line": escape_line, "trim": str.strip, "lower": str.lower, "upper": str.upper}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Op:
    """An operator or filter over its operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    expression: Any


@dataclass(frozen=True)
class Set:
    name: str
    expression: Any


@dataclass(frozen=True)
class If:
    branches: tuple[tuple[Any, tuple], ...]


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


OPERATORS: dict[str, Callable] = {
    "+": lambda a, b: a + b,
    "~": lambda a, b: f"{a}{b}",
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "not": lambda a: not a,
}
PART = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
WORD = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|[+~|().]))""")


class Expression:
    """Recursive descent over one expression: or, and, not, comparison, sum, filters, value."""

    def __init__(self, source: str) -> None:
        self.words: list[tuple[str, str]] = []
        at = 0
        source = source.rstrip()
        while at < len(source):
            m = WORD.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.words.append((("string", "number", "name", "sign")[m.lastindex - 1], m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.words) and self.words[self.at][0] != "string" and self.words[self.at][1] in values

    def take(self) -> tuple[str, str]:
        if self.at >= len(self.words):
            raise TemplateError("the expression ends too early")
        self.at += 1
        return self.words[self.at - 1]

    def whole(self):
        tree = self.either()
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")
        return tree

    def chain(self, lower: Callable, *signs: str):
        tree = lower()
        while self.peek(*signs):
            sign = self.take()[1]
            tree = fold(Op(sign, (tree, lower())))
        return tree

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negation, "and")

    def negation(self):
        if self.peek("not"):
            self.take()
            return fold(Op("not", (self.negation(),)))
        return self.chain(self.total, "==", "!=")

    def total(self):
        return self.chain(self.filtered, "+", "~")

    def filtered(self):
        tree = self.value()
        while self.peek("|"):
            self.take()
            name = self.take()[1]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = fold(Op("|" + name, (tree,)))
        return tree

    def value(self):
        kind, word = self.take()
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), word[1:-1]))
        if kind == "number":
            return Const(int(word))
        if word == "(":
            tree = self.either()
            if self.take()[1] != ")":
                raise TemplateError("a bracket is open")
            return tree
        if kind != "name":
            raise TemplateError(f"unexpected {word!r}")
        path = [word]
        while self.peek("."):
            self.take()
            path.append(self.take()[1])
        return {"true": Const(True), "false": Const(False), "none": Const(None)}.get(word) or Name(tuple(path))


def fold(op: Op):
    """A constant, if all operands are; and a known left side of and/or decides."""
    if op.name in ("and", "or"):
        left, right = op.args
        if isinstance(left, Const):
            return right if bool(left.value) == (op.name == "and") else left
        return op
    if all(isinstance(x, Const) for x in op.args):
        values = [x.value for x in op.args]
        return Const(FILTERS[op.name[1:]](str(*values)) if op.name[0] == "|" else OPERATORS[op.name](*values))
    return op


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at = 0
    for m in PART.finditer(source):
        parts += [("text", source[at : m.start()]), ("value", m[1]) if m[1] is not None else ("statement", m[2].strip())]
        at = m.end()
    parts.append(("text", source[at:]))
    body, rest, stop = block(parts, 0, ())
    if stop:
        raise TemplateError(f"unexpected {stop!r}")
    return body


def block(parts: list, at: int, stops: tuple[str, ...]) -> tuple[tuple, int, str]:
    """Nodes up to a statement that begins with one of ``stops``; that statement and the place after it."""
    nodes: list = []
    while at < len(parts):
        kind, source = parts[at]
        at += 1
        if kind == "text":
            nodes += [Emit(Const(source))] if source else []
            continue
        if kind == "value":
            nodes.append(Emit(Expression(source).whole()))
            continue
        word, _, rest = source.partition(" ")
        if word in stops:
            return joined(nodes), at, source
        if word == "set":
            name, sign, value = rest.partition("=")
            if not sign or not name.strip().isidentifier():
                raise TemplateError(f"cannot read {source!r}")
            nodes.append(Set(name.strip(), Expression(value).whole()))
        elif word == "generation":
            body, at, _ = block(parts, at, ("endgeneration",))
            nodes.append(Generation(body))
        elif word == "for":
            m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)
            if not m:
                raise TemplateError(f"cannot read {source!r}")
            body, at, _ = block(parts, at, ("endfor",))
            nodes.append(For(m[1], Expression(m[2]).whole(), body))
        elif word == "if":
            branches, condition = [], Expression(rest).whole()
            while True:
                body, at, stop = block(parts, at, ("elif", "else", "endif"))
                branches.append((condition, body))
                if stop == "endif":
                    break
                condition = Const(True) if stop == "else" else Expression(stop[4:]).whole()
            nodes += decided(branches)
        else:
            raise TemplateError(f"no statement {word!r}")
    if stops:
        raise TemplateError(f"{stops[-1]} is missing")
    return joined(nodes), at, ""


def decided(branches: list) -> list:
    """Branches that constants rule out go; a branch that always holds ends the choice, and is put in its place if it is the first."""
    left = []
    for condition, body in branches:
        if isinstance(condition, Const) and not condition.value:
            continue
        left.append((condition, body))
        if isinstance(condition, Const):
            break
    if left and isinstance(left[0][0], Const):
        return list(left[0][1])
    return [If(tuple(left))] if left else []


def joined(nodes: list) -> tuple:
    """Neighbouring constant texts become one."""
    out: list = []
    for node in nodes:
        constant = isinstance(node, Emit) and isinstance(node.expression, Const)
        if constant and out and isinstance(out[-1], Emit) and isinstance(out[-1].expression, Const):
            out[-1] = Emit(Const(f"{out[-1].expression.value}{node.expression.value}"))
        else:
            out.append(node)
    return tuple(out)


Run = Callable[[dict], Iterator]


def value_of(tree) -> Callable[[dict], Any]:
    """The closure of an expression."""
    if isinstance(tree, Const):
        return lambda env, v=tree.value: v
    if isinstance(tree, Name):
        first, *keys = tree.path

        def look(env: dict):
            x = env.get(first)
            for k in keys:
                x = x.get(k) if isinstance(x, dict) else None
            return x

        return look
    args = [value_of(a) for a in tree.args]
    if tree.name == "and":
        return lambda env: args[0](env) and args[1](env)
    if tree.name == "or":
        return lambda env: args[0](env) or args[1](env)
    if tree.name[0] == "|":
        return lambda env, f=FILTERS[tree.name[1:]]: f("" if (x := args[0](env)) is None else str(x))
    return lambda env, f=OPERATORS[tree.name]: f(*[a(env) for a in args])


def run_of(nodes: tuple) -> Run:
    """The closure of some nodes: yields the pieces of the output."""
    steps = [step_of(n) for n in nodes]

    def run(env: dict) -> Iterator:
        for step in steps:
            yield from step(env)

    return run


def step_of(node) -> Run:
    if isinstance(node, Emit):
        value = value_of(node.expression)

        def emit(env: dict) -> Iterator:
            x = value(env)
            if x is not None and x != "":
                yield str(x)

        return emit
    if isinstance(node, Set):
        value = value_of(node.expression)

        def assign(env: dict) -> Iterator:
            env[node.name] = value(env)
            return iter(())

        return assign
    if isinstance(node, Generation):
        inner = run_of(node.body)

        def generation(env: dict) -> Iterator:
            yield BEGIN
            yield from inner(env)
            yield END

        return generation
    if isinstance(node, If):
        branches = [(value_of(c), run_of(b)) for c, b in node.branches]

        def choose(env: dict) -> Iterator:
            for condition, body in branches:
                if condition(env):
                    yield from body(env)
                    return

        return choose
    items, body = value_of(node.items), run_of(node.body)

    def loop(env: dict) -> Iterator:
        outer = dict(env)
        rest = iter(items(env) or ())
        item, k = next(rest, None), 0
        while item is not None:
            after = next(rest, None)
            env[node.name], env["loop"] = item, {"index": k + 1, "index0": k, "first": k == 0, "last": after is None}
            yield from body(env)
            item, k = after, k + 1
        for name in (node.name, "loop"):
            env.pop(name, None)
            env.update({name: outer[name]} if name in outer else {})

    return loop


class Template:
    """A compiled template; pickled by its source."""

    def __init__(self, source: str) -> None:
        self.source = source
        self.tree = parse(source)
        self.run = run_of(self.tree)

    def __reduce__(self):
        return Template, (self.source,)

    def pieces(self, messages: Iterable[dict], **values: Any) -> Iterator:
        """Texts, BEGIN and END, in order; ``messages`` is read as it is needed."""
        return self.run({**values, "messages": messages})

    def render(self, messages: Iterable[dict], **values: Any) -> tuple[str, list[tuple[int, int]]]:
        """The whole output and the spans under the loss mask."""
        out, spans, at, since = [], [], 0, 0
        for piece in self.pieces(messages, **values):
            if piece is BEGIN:
                since = at
            elif piece is END:
                spans.append((since, at))
            else:
                out.append(piece)
                at += len(piece)
        return "".join(out), spans
