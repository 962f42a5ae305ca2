"""Chat templates given as text, compiled to one Column expression.

The language is the part of the usual chat-template notation that templates need: text,
``{{ expression }}``, ``{% for m in messages %}``, ``{% if %}`` / ``elif`` / ``else``, ``{% set %}``
and comments, with ``-`` for trimming; a block's line leaves no white space of its own, nor does the text's last line
end. Expressions
know strings, whole numbers, ``true`` / ``false`` / ``none``, ``and`` / ``or`` / ``not``, comparisons, ``in``,
``+`` and ``~``, ``a if c else b``, ``is defined`` / ``is none``, indexes and slices of the messages, the loop's
``first``, ``last``, ``index`` and ``index0``, and the filters ``trim``, ``upper``, ``lower``, ``length`` and
``default``. Names are ``messages``, ``add_generation_prompt``, ``reasoning_effort``, what the template sets,
and constants given with it (``bos_token``, ...); other names and missing fields are undefined: false, and empty
where they are printed. ``raise_exception(text)`` fails the row's task with that text.

A template is compiled once on the driver. A loop over messages is a ``transform`` joined to a string,
branches are ``CASE WHEN``: rendering stays a narrow projection in the JVM, whatever the template says.
What the language lacks is an error by line when the template is compiled, never a wrong text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import py_strip
from quire.operators.template import ChatTemplate

_TAG = re.compile(r"\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<num>\d+)|(?P<name>\w+)|(?P<op>==|!=|<=|>=|[<>+~|()\[\],.:=-]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    """A template that does not compile."""


@dataclass
class _Value:
    """A typed expression: ``text``, ``int``, ``bool``, ``message`` (a struct), ``messages`` (an array) or ``list`` (of values)."""

    kind: str
    col: Column | None = None
    items: list["_Value"] = field(default_factory=list)

    def text(self) -> Column:
        """What printing it gives."""
        if self.kind == "bool":
            return F.when(self.col, F.lit("True")).otherwise(F.lit("False"))
        if self.kind not in ("text", "int"):
            raise TemplateError(f"a {self.kind} cannot be printed")
        return F.coalesce(self.col.cast("string"), F.lit(""))

    def true(self) -> Column:
        if self.kind == "bool":
            return F.coalesce(self.col, F.lit(False))
        if self.kind in ("text", "int"):
            return F.coalesce(self.col != (F.lit("") if self.kind == "text" else F.lit(0)), F.lit(False))
        if self.kind == "messages":
            return F.coalesce(F.size(self.col) > 0, F.lit(False))
        if self.kind == "message":
            return self.col.isNotNull()
        return F.lit(bool(self.items))


def _nothing() -> _Value:
    return _Value("text", F.lit(None).cast("string"))


class _Scope(dict):
    """Values by name; ``fields`` are those a message has, ``loop`` those of the innermost loop."""

    def __init__(self, names, fields, loop=None):
        super().__init__(names)
        self.fields, self.loop = fields, loop

    def copy(self) -> "_Scope":
        return _Scope(self, self.fields, self.loop)


class _Expression:
    """A recursive-descent reader of one expression, which makes its value on the way."""

    def __init__(self, source: str, scope: _Scope):
        self.scope, self.at, self.tokens = scope, 0, []
        pos, source = 0, source.strip()
        while pos < len(source):
            m = _TOKEN.match(source, pos)
            if not m:
                raise TemplateError(f"cannot read {source[pos:pos + 20]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            pos = m.end()

    def peek(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens):
            kind, text = self.tokens[self.at]
            if kind != "str" and text in wanted:
                return text
        return None

    def take(self, *wanted: str) -> str | None:
        got = self.peek(*wanted)
        self.at += got is not None
        return got

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}")

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> _Value:
        v = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return v

    def choice(self) -> _Value:
        v = self.either()
        if self.take("if"):
            c = self.either().true()
            self.need("else")
            return _chosen(c, v, self.choice())
        return v

    def either(self) -> _Value:
        v = self.both()
        while self.take("or"):
            w = self.both()
            v = _Value("bool", v.true() | w.true()) if "bool" in (v.kind, w.kind) else _chosen(v.true(), v, w)
        return v

    def both(self) -> _Value:
        v = self.negated()
        while self.take("and"):
            w = self.negated()
            v = _Value("bool", v.true() & w.true())
        return v

    def negated(self) -> _Value:
        return _Value("bool", ~self.negated().true()) if self.take("not") else self.compared()

    def compared(self) -> _Value:
        v = self.joined()
        while True:
            if op := self.take("==", "!=", "<", ">", "<=", ">="):
                v = _Value("bool", _compare(op, v, self.joined()))
            elif self.peek("in") or (self.peek("not") and self.tokens[self.at + 1:self.at + 2] == [("name", "in")]):
                negative = bool(self.take("not"))
                self.need("in")
                found = _contained(v, self.joined())
                v = _Value("bool", ~found if negative else found)
            elif self.take("is"):
                negative = bool(self.take("not"))
                test = self.name()
                if test not in ("defined", "none", "undefined"):
                    raise TemplateError(f"no test {test!r}")
                there = F.lit(True) if v.col is None else v.col.isNotNull()
                v = _Value("bool", there if (test == "defined") != negative else ~there)
            else:
                return v

    def joined(self) -> _Value:
        v = self.filtered()
        while op := self.take("+", "~", "-"):
            w = self.filtered()
            if op != "~" and v.kind == w.kind == "int":
                v = _Value("int", v.col + w.col if op == "+" else v.col - w.col)
            elif op == "-" or (op == "+" and "int" in (v.kind, w.kind)):
                raise TemplateError(f"{v.kind} {op} {w.kind}")
            else:
                v = _Value("text", F.concat(v.text(), w.text()))
        return v

    def filtered(self) -> _Value:
        v = self.reached()
        while self.take("|"):
            f = self.name()
            if f == "trim":
                v = _Value("text", py_strip(v.text()))
            elif f in ("upper", "lower"):
                v = _Value("text", getattr(F, f)(v.text()))
            elif f == "length":
                v = _Value("int", F.size(v.col) if v.kind == "messages" else F.length(v.text()))
            elif f == "default":
                self.need("(")
                other = self.choice()
                self.need(")")
                v = _chosen(v.col.isNotNull(), v, other)
            elif f != "string" and f != "safe":
                raise TemplateError(f"no filter {f!r}")
        return v

    def reached(self) -> _Value:
        v = self.atom()
        while op := self.take(".", "["):
            if op == ".":
                name = self.name()
                if name in ("strip", "upper", "lower") and self.take("("):
                    self.need(")")
                    v = _Value("text", py_strip(v.text()) if name == "strip" else getattr(F, name)(v.text()))
                elif name == "startswith" and self.take("("):
                    v = _Value("bool", F.startswith(v.text(), self.choice().text()))
                    self.need(")")
                else:
                    v = self.field(v, name)
            elif self.at < len(self.tokens) and self.tokens[self.at][0] == "str":
                v = self.field(v, self.atom_text())
                self.need("]")
            else:
                v = self.item(v)
        return v

    def item(self, v: _Value) -> _Value:
        if v.kind != "messages":
            raise TemplateError(f"a {v.kind} has no items")
        first = self.whole_number() if not self.peek(":") else 0
        if self.take(":"):
            last = None if self.peek("]") else self.whole_number()
            self.need("]")
            n = F.size(v.col)
            place = lambda i: F.greatest(F.lit(0), n + i) if i < 0 else F.least(n, F.lit(i))
            a, z = place(first), n if last is None else place(last)
            return _Value("messages", F.slice(v.col, a + 1, F.greatest(F.lit(0), z - a)))
        self.need("]")
        return _Value("message", F.get(v.col, F.lit(first) if first >= 0 else F.size(v.col) + first))

    def whole_number(self) -> int:
        negative = self.take("-")
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "num":
            raise TemplateError("expected a number")
        self.at += 1
        return int(self.tokens[self.at - 1][1]) * (-1 if negative else 1)

    def field(self, v: _Value, name: str) -> _Value:
        if v.kind == "loop":
            if name not in self.scope.loop:
                raise TemplateError(f"a loop has no {name!r}")
            return self.scope.loop[name]
        if v.kind == "message":
            return _Value("text", v.col[name].cast("string")) if name in self.scope.fields else _nothing()
        raise TemplateError(f"a {v.kind} has no field {name!r}")

    def atom_text(self) -> str:
        raw = self.tokens[self.at][1][1:-1]
        self.at += 1
        return re.sub(r"\\(.)", lambda m: _ESCAPES.get(m.group(1), m.group(1)), raw, flags=re.S)

    def atom(self) -> _Value:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends early")
        kind, text = self.tokens[self.at]
        if kind == "str":
            return _Value("text", F.lit(self.atom_text()))
        if kind == "num":
            return _Value("int", F.lit(self.whole_number()))
        if self.take("("):
            v = self.choice()
            self.need(")")
            return v
        if self.take("["):
            items = []
            while not self.take("]"):
                items.append(self.choice())
                if not self.peek("]"):
                    self.need(",")
            return _Value("list", items=items)
        name = self.name()
        if name.lower() in ("true", "false"):
            return _Value("bool", F.lit(name.lower() == "true"))
        if name.lower() == "none":
            return _nothing()
        if name == "raise_exception":
            self.need("(")
            said = self.choice().text()
            self.need(")")
            return _Value("text", F.raise_error(said).cast("string"))
        if name == "loop" and self.scope.loop is not None:
            return _Value("loop")
        if self.peek("("):
            raise TemplateError(f"no function {name!r}")
        return self.scope.get(name) or _nothing()


def _compare(op: str, v: _Value, w: _Value) -> Column:
    if {v.kind, w.kind} - {"text", "int", "bool"}:
        raise TemplateError(f"cannot compare a {v.kind} with a {w.kind}")
    a, b = v.col, w.col
    if v.kind != w.kind:
        if op not in ("==", "!="):
            raise TemplateError(f"{v.kind} {op} {w.kind}")
        nothing = a.isNull() & b.isNull()  # values of different types are equal only where both are undefined
        return nothing if op == "==" else ~nothing
    if op in ("==", "!="):
        return a.eqNullSafe(b) if op == "==" else ~a.eqNullSafe(b)
    return F.coalesce({"<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[op], F.lit(False))


def _contained(v: _Value, w: _Value) -> Column:
    if w.kind == "list":
        out = F.lit(False)
        for x in w.items:
            out = out | _compare("==", v, x)
        return out
    return F.contains(w.text(), v.text())


def _chosen(c: Column, v: _Value, w: _Value) -> _Value:
    if v.kind != w.kind:
        if {v.kind, w.kind} <= {"text", "int", "bool"}:
            return _Value("text", F.when(c, v.text()).otherwise(w.text()))
        raise TemplateError(f"a choice between a {v.kind} and a {w.kind}")
    return _Value(v.kind, F.when(c, v.col).otherwise(w.col))


def _pieces(source: str) -> list[tuple[str, str, int]]:
    """``("text" | "print" | "block", content, line)``, with white space trimmed."""
    out: list[tuple[str, str, int]] = []
    at, trim, source = 0, False, source.removesuffix("\n")
    for m in [*_TAG.finditer(source), None]:
        text = source[at:m.start() if m else len(source)]
        if trim == "all":
            text = text.lstrip()
        elif trim == "line":
            text = text[1:] if text.startswith("\n") else text
        if m:
            tag = m.group()
            if tag[2] == "-":
                text = text.rstrip()
            elif tag[1] != "{":  # a block that stands alone at the start of a line takes the line's indent
                head, sep, tail = text.rpartition("\n")
                if (sep or at == 0) and not tail.strip(" \t"):
                    text = head + sep
            at = m.end()
            trim = "all" if tag[-3] == "-" else "line" if tag[1] != "{" else False
        if text:
            out.append(("text", text, 0))
        if m and tag[1] != "#":
            out.append(("print" if tag[1] == "{" else "block", tag[2:-2].strip("-").strip(), source.count("\n", 0, m.start()) + 1))
    return out


class _Compiler:
    def __init__(self, pieces):
        self.pieces, self.at = pieces, 0

    def body(self, scope: _Scope, *ends: str) -> tuple[list[Column], str]:
        """The parts up to one of the ``ends`` (whose block is returned); sets change ``scope``."""
        parts: list[Column] = []
        while self.at < len(self.pieces):
            kind, content, line = self.pieces[self.at]
            self.at += 1
            if kind == "text":
                parts.append(F.lit(content))
                continue
            word = content.split(None, 1)[0] if kind == "block" and content else ""
            try:
                if kind == "print":
                    parts.append(_Expression(content, scope).whole().text())
                elif word in ends:
                    return parts, content
                elif word == "set":
                    name, _, value = content[3:].partition("=")
                    if not name.strip().isidentifier():
                        raise TemplateError("only plain names can be set")
                    scope[name.strip()] = _Expression(value, scope).whole()
                elif word == "if":
                    parts.append(self.branches(content[2:], scope))
                elif word == "for":
                    parts.append(self.loop(content, scope))
                elif word != "generation" and word != "endgeneration":
                    raise TemplateError(f"no block {word!r}")
            except TemplateError as e:
                raise e if str(e).startswith("line ") else TemplateError(f"line {line}: {e}") from None
        if ends:
            raise TemplateError(f"missing {ends[-1]!r}")
        return parts, ""

    def branches(self, condition: str, scope: _Scope) -> Column:
        """An if with its branches. What the branches set is chosen by the same conditions."""
        made: list[tuple[Column | None, Column, _Scope]] = []
        while True:
            c = None if condition is None else _Expression(condition, scope).whole().true()
            own = scope.copy()
            parts, end = self.body(own, "elif", "else", "endif")
            made.append((c, _concat(parts), own))
            if end.startswith("endif"):
                break
            condition = end[4:] if end.startswith("elif") else None
        if made[-1][0] is not None:
            made.append((None, F.lit(""), scope.copy()))
        for name in {n for _, _, own in made for n in own}:
            value = made[-1][2].get(name) or _nothing()
            for c, _, own in made[-2::-1]:
                here = own.get(name) or _nothing()
                if here is not value:
                    other = value if value.kind == here.kind else _Value(here.kind, F.lit(None)) if name not in scope and value.kind == "text" else value
                    value = _chosen(c, here, other)
            scope[name] = value
        text = made[-1][1]
        for c, t, _ in made[-2::-1]:
            text = F.when(c, t).otherwise(text)
        return text

    def loop(self, content: str, scope: _Scope) -> Column:
        m = re.fullmatch(r"for\s+(\w+)\s+in\s+(.+)", content, re.S)
        if not m:
            raise TemplateError("a loop is 'for NAME in MESSAGES'")
        over = _Expression(m.group(2), scope).whole()
        if over.kind != "messages":
            raise TemplateError(f"a loop runs over messages, not over a {over.kind}")
        start, n = self.at, F.size(over.col)

        def one(x: Column, i: Column) -> Column:
            own = scope.copy()
            own[m.group(1)] = _Value("message", x)
            own.loop = {"index": _Value("int", i + 1), "index0": _Value("int", i), "first": _Value("bool", i == 0),
                        "last": _Value("bool", i == n - 1), "length": _Value("int", n)}
            self.at = start
            parts, _ = self.body(own, "endfor")
            return _concat(parts)

        return F.coalesce(F.array_join(F.transform(over.col, one), ""), F.lit(""))


def _concat(parts: list[Column]) -> Column:
    return F.concat(*parts) if parts else F.lit("")


@dataclass(frozen=True)
class TextTemplate(ChatTemplate):
    """A template from its text; ``constants`` are names with strings, such as ``(("bos_token", "<s>"),)``."""

    source: str
    constants: tuple[tuple[str, str], ...] = ()

    def render(self, messages: Column, *, add_generation_prompt: bool = False, effort: Column | None = None, has_thinking: bool = False) -> Column:
        fields = ("role", "content", "thinking") if has_thinking else ("role", "content")

        def checked(m: Column) -> Column:
            role = F.coalesce(m["role"], F.raise_error(F.lit("a message has no role")).cast("string"))
            return F.struct(role.alias("role"), *(m[f].alias(f) for f in fields[1:]))

        names = {n: _Value("text", F.lit(v)) for n, v in self.constants}
        names |= {"messages": _Value("messages", F.transform(messages, checked)), "add_generation_prompt": _Value("bool", F.lit(add_generation_prompt))}
        if effort is not None:
            names["reasoning_effort"] = _Value("text", effort)
        return _concat(_Compiler(_pieces(self.source)).body(_Scope(names, fields))[0])
