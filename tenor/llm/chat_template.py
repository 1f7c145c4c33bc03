"""Chat formatting by a template compiler.

A small sandboxed template language is parsed into a syntax tree, constants are
folded, and the tree becomes Python closures that yield pieces of text with a
flag: inside ``generation`` or not. The language has no attribute access
beyond the fields of a message, no calls beyond the listed filters, and no
assignment, so a template can neither reach Python objects nor run without end.

    {{ expr }}                                  text of an expression
    {% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}
    {% for name in messages %} .. {% endfor %}  the messages, one by one
    {% generation %} .. {% endgeneration %}     marks what the model is trained on
    {# comment #}

Expressions: string and integer literals, ``true`` / ``false`` / ``none``, variables,
``message.field``, ``loop.first`` / ``loop.index``, ``==``, ``!=``, ``and``, ``or``,
``not``, ``in`` (a literal list), ``+`` (text), parentheses, and the filters
``escape``, ``trim``, ``upper``, ``lower``, ``length``, ``default('x')``.

Rendering is lazy: messages are drawn from an iterator and pieces leave one by
one, so a conversation of any length needs the memory of one message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

MAX_DEPTH = 50
ESCAPE = "\\"
MARKS = {"<": "l", ">": "g"}


class TemplateError(ValueError):
    """The template does not parse, or asks for something the sandbox lacks."""


def escape(text: str) -> str:
    """Text in which no control string can occur: the escape sign, ``<`` and ``>`` are escaped."""
    text = text.replace(ESCAPE, ESCAPE + ESCAPE)
    for sign, letter in MARKS.items():
        text = text.replace(sign, ESCAPE + letter)
    return text


_SIGNS = {letter: sign for sign, letter in MARKS.items()}
_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _SIGNS.get(m[1], m[1]), text)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(_text(v)), "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(), "length": lambda v: len(_text(v)),
    "default": lambda v, other: other if v is None else v,
}


def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else str(v)


# --- syntax tree -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str
    attr: str | None = None


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass
class If:
    branches: list = field(default_factory=list)  # (condition, body)


@dataclass
class For:
    var: str
    body: list


@dataclass
class Generation:
    body: list


_PART = re.compile(r"\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[-+().,|\[\]]))""")
_STRING_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "\\": "\\", "'": "'", '"': '"'}


class Expression:
    """Recursive-descent parser of one expression."""

    def __init__(self, source: str):
        self.tokens, at = [], 0
        source = source.rstrip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected sign at: {source[at:at + 20]!r}")
            kind = next(i for i in range(1, 5) if m[i] is not None)
            self.tokens.append((kind, m[kind]))
            at = m.end()
        self.at = self.depth = 0

    def peek(self):
        return self.tokens[self.at][1] if self.at < len(self.tokens) else None

    def take(self, *wanted):
        if self.at < len(self.tokens) and self.tokens[self.at][0] > 2 and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, sign):
        if not self.take(sign):
            raise TemplateError(f"expected {sign!r}, found {self.peek()!r}")

    def whole(self):
        node = self.either()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()!r}")
        return node

    def either(self):
        self.depth += 1
        if self.depth > MAX_DEPTH:
            raise TemplateError("expression nested too deeply")
        node = self.both()
        while self.take("or"):
            node = Op("or", (node, self.both()))
        self.depth -= 1
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        many = 0
        while self.take("not"):
            many += 1
        node = self.compared()
        for _ in range(many):
            node = Op("not", (node,))
        return node

    def compared(self):
        node = self.sum()
        while op := self.take("==", "!=", "in"):
            node = Op(op, (node, self.sum()))
        return node

    def sum(self):
        node = self.filtered()
        while self.take("+"):
            node = Op("+", (node, self.filtered()))
        return node

    def filtered(self):
        node = self.atom()
        while self.take("|"):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else None
            self.at += 1
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            args = [node]
            if self.take("("):
                args.append(self.either())
                self.need(")")
            if len(args) != (2 if name == "default" else 1):
                raise TemplateError(f"filter {name!r}: wrong number of arguments")
            node = Op("|" + name, tuple(args))
        return node

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError("expression ends early")
        if self.take("("):
            node = self.either()
            self.need(")")
            return node
        if self.take("["):
            items = []
            while not self.take("]"):
                items.append(self.either())
                if self.peek() != "]":
                    self.need(",")
            return Op("list", tuple(items))
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == 1:
            return Const(re.sub(r"\\(.)", lambda m: _STRING_ESCAPES.get(m[1], m[0]), value[1:-1], flags=re.S))
        if kind == 2:
            return Const(int(value))
        if kind == 3 and value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        if kind == 3 and value not in ("and", "or", "not", "in"):
            if not self.take("."):
                return Name(value)
            kind, attr = self.tokens[self.at] if self.at < len(self.tokens) else (0, "")
            self.at += 1
            if kind != 3 or attr.startswith("_"):
                raise TemplateError(f"no field {attr!r}")
            return Name(value, attr)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> list:
    """Syntax tree of a template: a list of Const, expression, If, For and Generation nodes."""
    parts, at = [], 0
    for m in _PART.finditer(source):
        if m.start() > at:
            parts.append(("text", source[at:m.start()]))
        kind = m[0][1]
        if kind != "#":
            parts.append((kind, m[0][2:-2].strip()))
        at = m.end()
    if at < len(source):
        parts.append(("text", source[at:]))
    pos = 0

    def body(ends: tuple[str, ...], depth: int) -> tuple[list, str]:
        nonlocal pos
        if depth > MAX_DEPTH:
            raise TemplateError("blocks nested too deeply")
        out = []
        while pos < len(parts):
            kind, value = parts[pos]
            pos += 1
            if kind == "text":
                out.append(Const(value))
            elif kind == "{":
                out.append(Expression(value).whole())
            else:
                word, _, rest = value.partition(" ")
                if word in ends:
                    return out, value
                if word == "if":
                    node, cond = If(), Expression(rest).whole()
                    while True:
                        inner, end = body(("elif", "else", "endif"), depth + 1)
                        node.branches.append((cond, inner))
                        if end == "endif":
                            break
                        cond = Const(True) if end == "else" else Expression(end.partition(" ")[2]).whole()
                    out.append(node)
                elif word == "for":
                    m = re.fullmatch(r"([A-Za-z]\w*)\s+in\s+messages", rest.strip())
                    if not m:
                        raise TemplateError(f"only 'for name in messages': {rest!r}")
                    out.append(For(m[1], body(("endfor",), depth + 1)[0]))
                elif word == "generation":
                    out.append(Generation(body(("endgeneration",), depth + 1)[0]))
                else:
                    raise TemplateError(f"unexpected tag {word!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ""

    return body((), 0)[0]


_PURE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "+": lambda a, b: _text(a) + _text(b),
         "in": lambda a, b: a in b, "not": lambda a: not a, "list": lambda *a: a} | {"|" + k: f for k, f in FILTERS.items()}


def fold(node):
    """The node with constant parts computed."""
    if isinstance(node, Op):
        args = tuple(fold(a) for a in node.args)
        if node.op in ("and", "or"):
            left = args[0]
            if isinstance(left, Const):
                return args[1] if bool(left.value) == (node.op == "and") else left
        elif all(isinstance(a, Const) for a in args):
            return Const(_PURE[node.op](*(a.value for a in args)))
        return Op(node.op, args)
    if isinstance(node, If):
        kept = []
        for cond, inner in node.branches:
            cond = fold(cond)
            if isinstance(cond, Const) and not cond.value:
                continue
            kept.append((cond, fold_body(inner)))
            if isinstance(cond, Const):
                break
        return If(kept)
    if isinstance(node, For):
        return For(node.var, fold_body(node.body))
    if isinstance(node, Generation):
        return Generation(fold_body(node.body))
    return node


def fold_body(nodes: list) -> list:
    """Folded nodes with neighbouring texts joined and settled branches spliced in."""
    out: list = []
    for node in map(fold, nodes):
        spliced = [node]
        if isinstance(node, If):
            if not node.branches:
                continue
            if isinstance(node.branches[0][0], Const):
                spliced = node.branches[0][1]
        for n in spliced:
            if isinstance(n, Const):
                text = _text(n.value)
                if not text:
                    continue
                if out and isinstance(out[-1], Const):
                    out[-1] = Const(_text(out[-1].value) + text)
                    continue
                n = Const(text)
            out.append(n)
    return out


Piece = tuple[str, bool]


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        v = node.value
        return lambda env: v
    if isinstance(node, Name):
        name, attr = node.name, node.attr
        if attr is None:
            return lambda env: env.get(name)
        return lambda env: (env.get(name) or {}).get(attr)
    args = [_value(a) for a in node.args]
    if node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    f = _PURE[node.op]
    return lambda env: f(*(a(env) for a in args))


def _closure(nodes: list, inside: bool) -> Callable[[dict], Iterator[Piece]]:
    steps: list[Callable[[dict], Iterator[Piece]]] = []
    for node in nodes:
        if isinstance(node, If):
            arms = [(_value(c), _closure(b, inside)) for c, b in node.branches]

            def run(env, arms=arms):
                for cond, arm in arms:
                    if cond(env):
                        yield from arm(env)
                        return
        elif isinstance(node, For):
            inner = _closure(node.body, inside)

            def run(env, inner=inner, var=node.var):
                for i, m in enumerate(env["messages"]):
                    yield from inner(env | {var: m, "loop": {"first": i == 0, "index": i + 1}})
        elif isinstance(node, Generation):
            run = _closure(node.body, True)
        else:
            value = _value(node)

            def run(env, value=value):
                text = _text(value(env))
                if text:
                    yield text, inside
        steps.append(run)

    def render(env: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)
    return render


def compile_template(source: str) -> Callable[..., Iterator[Piece]]:
    """``render(messages, **variables)``: lazy (text, in generation) pieces."""
    run = _closure(fold_body(parse(source)), False)

    def render(messages: Iterable[dict], **variables) -> Iterator[Piece]:
        return run({"messages": messages} | variables)
    return render
