"""Chat templates, as models publish them, compiled to one Column.

The subset: ``{{ expression }}``, ``for`` over a list, ``if`` / ``elif`` / ``else``, ``set``, and trimming by ``-``.  Expressions have text,
numbers, names, ``a['b']``, ``a.b``, ``a[0]``, ``a[1:]``, ``loop.index0`` / ``index`` / ``first`` / ``last``, ``+``, comparisons, ``and`` / ``or`` /
``not``, ``in`` for texts, ``| trim`` and ``| length``.  Everything else is refused when the template is compiled.  White space is treated as
is usual for chat templates: a newline after a statement goes, and so does the indentation before one.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_PIECE = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
_QUOTED = re.compile(r"('(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")", re.S)
#: What Jinja trims.
_SPACE = " \t\n\r\x0b\x0c"


class TemplateError(ValueError):
    """The template needs something that is not compiled."""


@dataclass
class Loop:
    index: Column
    size: Column


@dataclass
class Node:
    kind: str
    value: Any = None
    body: list[Node] = field(default_factory=list)
    other: list[Node] = field(default_factory=list)


def compile_template(template: str, **names: Column | str | bool | int) -> Column:
    """The text of a template; ``names`` are its variables: columns, or fixed texts, numbers and truth values.

    ``compile_template(t, messages=F.col("messages"), bos_token="<s>", add_generation_prompt=False)``
    """
    nodes, rest = _parse(_pieces(template), 0, ())
    assert rest is None
    text, _ = _emit(nodes, dict(names))
    return text


def _pieces(template: str) -> list[tuple[str, str]]:
    """``(kind, text)`` with white space control applied."""
    raw = _PIECE.split(template)
    out: list[tuple[str, str]] = []
    for i, piece in enumerate(raw):
        if i % 2 == 0:
            before = raw[i - 1] if i else ""
            after = raw[i + 1] if i + 1 < len(raw) else ""
            fresh = i == 0  # whether the piece begins a line
            if before.endswith(("-}}", "-%}")):
                piece = piece.lstrip(_SPACE)
            elif before.startswith(("{%", "{#")):
                fresh = piece.startswith("\n")
                piece = piece.removeprefix("\n")
            if after.startswith(("{{-", "{%-")):
                piece = piece.rstrip(_SPACE)
            elif after.startswith(("{%", "{#")):
                line = re.search(r"(?:\A|(?<=\n))[ \t]*\Z", piece) if piece.endswith((" ", "\t")) else None
                if line and (line.start() > 0 or fresh):
                    piece = piece[: line.start()]
            if piece:
                out.append(("text", piece))
        elif not piece.startswith("{#"):
            out.append(("out" if piece.startswith("{{") else "do", piece[2:-2].strip("-").strip()))
    return out


def _parse(pieces: list[tuple[str, str]], depth: int, until: tuple[str, ...]) -> tuple[list[Node], str | None]:
    """Nodes up to a statement that begins with one of ``until``; consumes ``pieces``."""
    nodes: list[Node] = []
    while pieces:
        kind, text = pieces.pop(0)
        if kind != "do":
            nodes.append(Node(kind, text if kind == "text" else _expression(text)))
            continue
        word, _, rest = text.partition(" ")
        if word in until:
            return nodes, text
        if word == "for":
            m = re.fullmatch(r"(\w+)\s+in\s+(.+)", rest, re.S)
            if not m or re.search(r"\b(if|recursive)\b", _QUOTED.sub("", m[2])):
                raise TemplateError(f"not compiled: {text}")
            body, _ = _parse(pieces, depth + 1, ("endfor",))
            nodes.append(Node("for", (m[1], _expression(m[2])), body))
        elif word == "if":
            nodes.append(_branch(pieces, depth, rest))
        elif word == "set":
            m = re.fullmatch(r"(\w+)\s*=(?!=)\s*(.+)", rest, re.S)
            if not m:
                raise TemplateError(f"not compiled: {text}")
            nodes.append(Node("set", (m[1], _expression(m[2]))))
        else:
            raise TemplateError(f"not compiled: {text}")
    if until:
        raise TemplateError(f"no {' or '.join(until)}")
    return nodes, None


def _branch(pieces: list[tuple[str, str]], depth: int, condition: str) -> Node:
    body, end = _parse(pieces, depth + 1, ("elif", "else", "endif"))
    node = Node("if", _expression(condition), body)
    if end.startswith("elif"):
        node.other = [_branch(pieces, depth, end[4:].strip())]
    elif end == "else":
        node.other, _ = _parse(pieces, depth + 1, ("endif",))
    return node


def _expression(text: str) -> ast.expr:
    """Parsed as Python, which has the same operators but for filters; these bind more tightly than ``+``, as powers do."""
    parts = _QUOTED.split(text)
    words = {"none": "None", "true": "True", "false": "False", "|": "**"}
    outside = lambda p: re.sub(r"\b(?:none|true|false)\b|\|", lambda m: words[m[0]], p)
    # Texts may hold line breaks.
    marked = "".join(repr(_text(p)) if i % 2 else outside(p).replace("\n", " ") for i, p in enumerate(parts))
    try:
        return ast.parse(marked.strip(), mode="eval").body
    except SyntaxError as e:
        raise TemplateError(f"not compiled: {text}") from e


def _text(quoted: str) -> str:
    named = {"n": "\n", "t": "\t", "r": "\r"}
    return re.sub(r"\\(.)", lambda m: named.get(m[1], m[1]), quoted[1:-1], flags=re.S)


# --- evaluation over columns ---------------------------------------------------


def _emit(nodes: list[Node], names: dict) -> tuple[Column, dict]:
    """The text of some nodes and the variables after them."""
    out: list[Column] = []
    for node in nodes:
        if node.kind == "text":
            out.append(F.lit(node.value))
        elif node.kind == "out":
            out.append(F.coalesce(_column(_value(node.value, names)).cast("string"), F.lit("")))
        elif node.kind == "set":
            names = names | {node.value[0]: _value(node.value[1], names)}
        elif node.kind == "if":
            condition = _truth(_value(node.value, names))
            if isinstance(condition, bool):  # known now: the other branch is not compiled
                text, names = _emit(node.body if condition else node.other, names)
            else:
                (yes, then), (no, otherwise) = _emit(node.body, names), _emit(node.other, names)
                text = F.when(condition, yes).otherwise(no)
                names = {k: _either(condition, then.get(k), otherwise.get(k)) for k in names | then | otherwise}
            out.append(text)
        else:
            out.append(_for(node, names))
    return (F.concat(*out) if len(out) > 1 else out[0] if out else F.lit("")), names


def _either(condition: Column, a: Any, b: Any) -> Any:
    if a is b:
        return a
    if isinstance(a, Loop) or isinstance(b, Loop):
        raise TemplateError("a loop variable may not be set")
    return F.when(condition, F.lit(None) if a is None else _column(a)).otherwise(F.lit(None) if b is None else _column(b))


def _for(node: Node, names: dict) -> Column:
    (name, over), items = node.value, _column(_value(node.value[1], names))

    def one(item: Column, i: Column) -> Column:
        # What is set in a loop is forgotten after its turn.
        return _emit(node.body, names | {name: item, "loop": Loop(i, F.size(items))})[0]

    return F.array_join(F.transform(items, one), "")


def _column(value: Any) -> Column:
    if isinstance(value, Loop):
        raise TemplateError("loop is no value")
    return value if isinstance(value, Column) else F.lit(value)


def _truth(value: Any) -> Column | bool:
    if isinstance(value, Truth):
        return value.column
    if isinstance(value, Column):
        return F.coalesce(F.length(value.cast("string")) > 0, F.lit(False))  # a text, or a list written as one
    return bool(value)


@dataclass
class Truth:
    """A truth value, which unlike a text is no output."""

    column: Column


_COMPARED: dict[type, Callable] = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
}


def _value(e: ast.expr, names: dict) -> Any:
    match e:
        case ast.Constant(value=str() | int() | bool() | None as v):
            return v
        case ast.Name(id=name):
            if name not in names:
                raise TemplateError(f"no variable {name}")
            return names[name]
        case ast.Attribute(value=ast.Name(id="loop"), attr=attr) if isinstance(names.get("loop"), Loop):
            return _loop(names["loop"], attr)
        case ast.Attribute(value=of, attr=attr):
            return _column(_value(of, names))[attr]
        case ast.Subscript(value=of, slice=ast.Constant(value=str() as key)):
            return _column(_value(of, names))[key]
        case ast.Subscript(value=of, slice=ast.Constant(value=int() as at)):
            return F.get(_column(_value(of, names)), F.lit(at))
        case ast.Subscript(value=of, slice=ast.UnaryOp(op=ast.USub(), operand=ast.Constant(value=int() as at))):
            return F.try_element_at(_column(_value(of, names)), F.lit(-at))
        case ast.Subscript(value=of, slice=ast.Slice(lower=ast.Constant(value=int() as low), upper=None, step=None)):
            whole = _column(_value(of, names))
            return F.slice(whole, F.lit(low + 1), F.greatest(F.size(whole), F.lit(1)))
        case ast.BinOp(left=left, op=ast.Add(), right=right):
            a, b = _value(left, names), _value(right, names)
            if not isinstance(a, Column) and not isinstance(b, Column):
                return a + b
            return F.concat(_column(a).cast("string"), _column(b).cast("string"))
        case ast.BinOp(left=left, op=ast.Mod(), right=right):
            return _column(_value(left, names)) % _column(_value(right, names))
        case ast.BinOp(left=left, op=ast.Pow(), right=ast.Name(id=name)):
            return _filtered(_value(left, names), name)
        case ast.UnaryOp(op=ast.Not(), operand=of):
            truth = _truth(_value(of, names))
            return not truth if isinstance(truth, bool) else Truth(~truth)
        case ast.BoolOp(op=op, values=values):
            return _joined([_truth(_value(v, names)) for v in values], isinstance(op, ast.And))
        case ast.Compare(left=left, ops=[op], comparators=[right]):
            return _compared(_value(left, names), op, _value(right, names))
    raise TemplateError(f"not compiled: {ast.unparse(e)}")


def _loop(loop: Loop, attr: str) -> Any:
    known = {
        "index0": loop.index, "index": loop.index + 1, "length": loop.size,
        "first": Truth(loop.index == 0), "last": Truth(loop.index == loop.size - 1),
    }
    if attr not in known:
        raise TemplateError(f"not compiled: loop.{attr}")
    return known[attr]


def _filtered(value: Any, name: str) -> Any:
    if name == "trim":
        return F.trim(_column(value), F.lit(_SPACE))
    if name == "length":
        return F.size(_column(value))
    raise TemplateError(f"no filter {name}")


def _joined(parts: list[Column | bool], every: bool) -> Any:
    if any(isinstance(p, bool) and p is not every for p in parts):
        return not every  # decided by a fixed value
    open_ = [p for p in parts if not isinstance(p, bool)]
    if not open_:
        return every
    whole = open_[0]
    for p in open_[1:]:
        whole = whole & p if every else whole | p
    return Truth(whole)


def _compared(a: Any, op: ast.cmpop, b: Any) -> Any:
    fixed = not isinstance(a, (Column, Truth)) and not isinstance(b, (Column, Truth))
    if isinstance(a, Truth) or isinstance(b, Truth):
        a, b = (x.column if isinstance(x, Truth) else x for x in (a, b))
    if isinstance(op, (ast.In, ast.NotIn)):
        found = F.coalesce(_column(b).contains(_column(a)), F.lit(False))
        return Truth(found if isinstance(op, ast.In) else ~found)
    if type(op) not in _COMPARED:
        raise TemplateError(f"not compiled: {type(op).__name__}")
    if fixed:
        return _COMPARED[type(op)](a, b)
    return Truth(F.coalesce(_COMPARED[type(op)](_column(a), _column(b)), F.lit(isinstance(op, ast.NotEq))))
