"""Chat formatting: a small sandboxed template language compiled to closures.

The language has literal text, ``{{ expression }}``, ``{% if %}`` with ``elif``
and ``else``, ``{% for message in messages %}`` and ``{% generation %}``, which
marks what a model is to learn. Expressions are names, the attributes of the
loop, strings, integers, ``== != and or not + ~ in``, parentheses and filters.
Nothing else exists: no calls, no attribute access to Python objects, no
imports. A template is parsed into a tree, constants are folded, and the tree
becomes closures that yield pieces of text with a flag for the mask.

The loop over messages looks one message ahead and keeps nothing behind, so a
conversation of any length is rendered from a stream in bounded memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple


class TemplateError(ValueError):
    """A template that is not in the language."""


# --- escaping -----------------------------------------------------------------
# A control string starts with "<|". Within texts one backslash more is put
# between the two characters, so that no text holds a control string and the
# reverse takes exactly one backslash away.

_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """Escaped and on one line, for roles."""
    return escape(text.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_line(text: str) -> str:
    parts = unescape(text).split("\\\\")
    return "\\".join(part.replace("\\n", "\n") for part in parts)


FILTERS: dict[str, Callable[[str], str]] = {
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
    "escape": escape,
    "escape_line": escape_line,
}

# --- tree ---------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    path: tuple[str, ...]


@dataclass(frozen=True)
class Apply:
    operator: str
    operands: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Show:
    expression: Any


@dataclass(frozen=True)
class If:
    branches: tuple  # of (condition, nodes)


@dataclass(frozen=True)
class For:
    variable: str
    nodes: tuple


@dataclass(frozen=True)
class Generation:
    nodes: tuple


class Piece(NamedTuple):
    text: str
    masked: bool


# --- parsing ------------------------------------------------------------------

_PARTS = re.compile(r"(\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\})", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|[().|+~]))""")
_WORDS = {"and", "or", "not", "in", "true", "false"}
_LOOP = ("first", "last", "index", "index0")
_QUOTED = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
# Names that a template may read, besides the variable of a loop.
GLOBALS = {"add_generation_prompt"}


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, scope: frozenset[str]) -> None:
        self.tokens: list[tuple[str, str]] = []
        self.scope = scope
        at, source = 0, source.strip()
        while at < len(source):
            found = _TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            number, string, word, sign = found.groups()
            if number:
                self.tokens.append(("number", number))
            elif string:
                self.tokens.append(("string", string))
            elif word:
                self.tokens.append(("sign" if word in _WORDS else "name", word))
            else:
                self.tokens.append(("sign", sign))
            at = found.end()
        self.at = 0

    def tree(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def sign(self, *signs: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def take(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"expected a {kind}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def either(self):
        tree = self.both()
        while self.sign("or"):
            tree = Apply("or", (tree, self.both()))
        return tree

    def both(self):
        tree = self.negation()
        while self.sign("and"):
            tree = Apply("and", (tree, self.negation()))
        return tree

    def negation(self):
        return Apply("not", (self.negation(),)) if self.sign("not") else self.comparison()

    def comparison(self):
        tree = self.joined()
        while operator := self.sign("==", "!=", "in"):
            tree = Apply(operator, (tree, self.joined()))
        return tree

    def joined(self):
        tree = self.filtered()
        while operator := self.sign("+", "~"):
            tree = Apply(operator, (tree, self.filtered()))
        return tree

    def filtered(self):
        tree = self.atom()
        while self.sign("|"):
            name = self.take("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            tree = Apply(f"|{name}", (tree,))
        return tree

    def atom(self):
        if self.sign("("):
            tree = self.either()
            if not self.sign(")"):
                raise TemplateError("expected )")
            return tree
        if self.sign("true"):
            return Const(True)
        if self.sign("false"):
            return Const(False)
        if self.at >= len(self.tokens):
            raise TemplateError("expected a value")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Const(int(value))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _QUOTED.get(m[1], m[0]), value[1:-1]))
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        path = [value]
        while self.sign("."):
            path.append(self.take("name"))
        return self.named(tuple(path))

    def named(self, path: tuple[str, ...]) -> Name:
        first, rest = path[0], path[1:]
        if first == "loop" and "loop" in self.scope:
            allowed = len(rest) == 1 and rest[0] in _LOOP
        elif first in self.scope:
            allowed = len(rest) == 1 and rest[0] in ("role", "content", "turn")
        else:
            allowed = first in GLOBALS and not rest
        if not allowed:
            raise TemplateError(f"unknown name {'.'.join(path)}")
        return Name(path)


def parse(source: str) -> tuple:
    """The tree of a template; raises TemplateError for anything outside the language."""
    parts = _PARTS.split(source)
    for at in range(1, len(parts), 2):  # a dash takes white space off its side
        tag = parts[at]
        if tag[2:3] == "-":
            parts[at - 1] = parts[at - 1].rstrip()
        if tag[-3:-2] == "-":
            parts[at + 1] = parts[at + 1].lstrip()
    position = 0

    def block(ends: tuple[str, ...], scope: frozenset[str]) -> tuple[tuple, str]:
        nonlocal position
        nodes: list = []
        while position < len(parts):
            part = parts[position]
            literal = position % 2 == 0
            position += 1
            if literal:
                if part:
                    nodes.append(Text(part))
            elif part.startswith("{{"):
                nodes.append(Show(_Expression(part[2:-2].strip("-"), scope).tree()))
            elif part.startswith("{%"):
                tag = part[2:-2].strip("-").strip()
                word = tag.split(None, 1)[0] if tag else ""
                if word in ends:
                    return tuple(nodes), tag
                nodes.append(statement(word, tag, scope))
        if ends:
            raise TemplateError(f"expected {' or '.join(ends)}")
        return tuple(nodes), ""

    def statement(word: str, tag: str, scope: frozenset[str]):
        if word == "if":
            branches, condition = [], _Expression(tag[2:], scope).tree()
            while True:
                nodes, end = block(("elif", "else", "endif"), scope)
                branches.append((condition, nodes))
                if end == "endif":
                    return If(tuple(branches))
                if end == "else":
                    condition = Const(True)
                elif end.startswith("elif"):
                    condition = _Expression(end[4:], scope).tree()
        if word == "for":
            found = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", tag)
            if not found or found[1] in _WORDS | GLOBALS | {"loop", "messages"}:
                raise TemplateError(f"cannot read {tag!r}")
            if "loop" in scope:
                raise TemplateError("loops do not nest")
            nodes, _ = block(("endfor",), scope | {found[1], "loop"})
            return For(found[1], nodes)
        if word == "generation":
            nodes, _ = block(("endgeneration",), scope)
            return Generation(nodes)
        raise TemplateError(f"unknown tag {tag!r}")

    return block((), frozenset())[0]


# --- constant folding -----------------------------------------------------------

_APPLY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": lambda a, b: str(a) in str(b),
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
    "not": lambda a: not a,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else str(a) + str(b),
    "~": lambda a, b: str(a) + str(b),
    **{f"|{name}": (lambda f: lambda a: f(str(a)))(f) for name, f in FILTERS.items()},
}


def _fold_expression(tree):
    if not isinstance(tree, Apply):
        return tree
    operands = tuple(map(_fold_expression, tree.operands))
    if all(isinstance(x, Const) for x in operands):
        return Const(_APPLY[tree.operator](*(x.value for x in operands)))
    if tree.operator in ("and", "or") and isinstance(operands[0], Const):
        decided = bool(operands[0].value) == (tree.operator == "or")
        return operands[0] if decided else operands[1]
    return Apply(tree.operator, operands)


def fold(nodes: tuple) -> tuple:
    """The same template with constants computed, dead branches gone, texts joined."""
    out: list = []
    for node in nodes:
        made: tuple = (node,)
        if isinstance(node, Show):
            tree = _fold_expression(node.expression)
            made = (Text(_text(tree.value)),) if isinstance(tree, Const) else (Show(tree),)
        elif isinstance(node, If):
            branches = []
            for condition, inner in node.branches:
                condition = _fold_expression(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner)))
                if isinstance(condition, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                made = branches[0][1]
            else:
                made = (If(tuple(branches)),) if branches else ()
        elif isinstance(node, For):
            made = (For(node.variable, fold(node.nodes)),)
        elif isinstance(node, Generation):
            made = (Generation(fold(node.nodes)),)
        for x in made:
            if isinstance(x, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].value + x.value)
            elif not (isinstance(x, Text) and not x.value):
                out.append(x)
    return tuple(out)


# --- code generation ------------------------------------------------------------


def _text(value) -> str:
    return "" if value is None else str(value)


def _expression(tree) -> Callable[[dict], Any]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda scope: value
    if isinstance(tree, Name):
        if len(tree.path) == 1:
            [name] = tree.path
            return lambda scope: scope[name]
        name, field = tree.path
        return lambda scope: scope[name][field]
    operands = tuple(map(_expression, tree.operands))
    if tree.operator in ("and", "or"):
        one, other = operands
        if tree.operator == "and":
            return lambda scope: one(scope) and other(scope)
        return lambda scope: one(scope) or other(scope)
    apply = _APPLY[tree.operator]
    if len(operands) == 1:
        [one] = operands
        return lambda scope: apply(one(scope))
    one, other = operands
    return lambda scope: apply(one(scope), other(scope))


Renderer = Callable[[dict, Iterable[dict], bool], Iterator[Piece]]


def _node(node) -> Renderer:
    if isinstance(node, Text):
        value = node.value
        return lambda scope, messages, masked: iter((Piece(value, masked),))
    if isinstance(node, Show):
        value_of = _expression(node.expression)
        return lambda scope, messages, masked: iter((Piece(_text(value_of(scope)), masked),))
    if isinstance(node, If):
        branches = tuple((_expression(condition), _nodes(nodes)) for condition, nodes in node.branches)

        def chosen(scope, messages, masked):
            for condition, inner in branches:
                if condition(scope):
                    yield from inner(scope, messages, masked)
                    return

        return chosen
    if isinstance(node, Generation):
        inside = _nodes(node.nodes)
        return lambda scope, messages, masked: inside(scope, messages, True)
    body, variable = _nodes(node.nodes), node.variable

    def loop(scope, messages, masked):
        stream = iter(messages)
        message = next(stream, None)
        index = 0
        while message is not None:
            following = next(stream, None)
            place = {"first": index == 0, "last": following is None, "index0": index, "index": index + 1}
            yield from body({**scope, variable: message, "loop": place}, (), masked)
            message, index = following, index + 1

    return loop


def _nodes(nodes: tuple) -> Renderer:
    parts = tuple(map(_node, nodes))

    def run(scope, messages, masked):
        for part in parts:
            yield from part(scope, messages, masked)

    return run


def compile_template(source: str) -> Callable[..., Iterator[Piece]]:
    """A function from messages (dicts of role, content, turn) to pieces of text."""
    tree = fold(parse(source))
    if sum(isinstance(node, For) for node in _walk(tree)) > 1:
        raise TemplateError("messages are a stream: one loop over them at most")
    body = _nodes(tree)

    def render(messages: Iterable[dict], add_generation_prompt: bool = False) -> Iterator[Piece]:
        scope = {"add_generation_prompt": add_generation_prompt}
        return (piece for piece in body(scope, messages, False) if piece.text)

    return render


def _walk(nodes: tuple) -> Iterator:
    for node in nodes:
        yield node
        if isinstance(node, If):
            for _, inner in node.branches:
                yield from _walk(inner)
        elif isinstance(node, (For, Generation)):
            yield from _walk(node.nodes)


# --- the turn format and its reader ---------------------------------------------

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"

TURNS = """
{%- for message in messages -%}
{{ '<|im_start|>' ~ (message.role | escape_line) ~ '\\n' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.content | escape }}{% endgeneration %}
{%- else -%}
{{ message.content | escape }}
{%- endif -%}
{{ '<|im_end|>\\n' }}
{%- endfor -%}
"""


def read_turns(pieces: Iterable[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn in formatted text that comes in pieces."""
    held = ""
    for piece in pieces:
        held += piece
        while (end := held.find(TURN_END)) >= 0:
            role, _, text = held[len(TURN_START) : end].partition("\n")
            yield unescape_line(role), unescape(text)
            held = held[end + len(TURN_END) :]
