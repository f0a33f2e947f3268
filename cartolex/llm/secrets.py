"""Scans for secrets: fixed patterns, and an assignment-aware lexer of source and configuration syntax.

The lexer reads statements of many languages alike (``name = "x"``, ``name: x``, ``"name": "x"``, ``name := x``, ``name => x``,
``env["NAME"] = x``, ``NAME=x``) as pairs of a name and a value. A value is its own literals, joined, and the names it refers to.
Names keep their last value, so a literal reaches every name that it is passed on to; it is scored by the most sensitive of them
and by its own strength.

What a text needs grows with its length: patterns are possessive, and a value is visited once for each weight of a name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cartolex.llm.scratch import fresh
from cartolex.llm.words import slices

#: The kinds of spans, in the order of equal starts. Fixed patterns find the first three, the lexer the last.
KINDS = ("assign", "access", "hex", "literal")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_STEMS, LEAST_ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key"), 6
#: A run of fewer signs fails, and what follows within it is shorter still; so the least length may be part of the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Words of names, with their weight; words that follow one another also count as one.
WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "apikey": 1.0, "accesskey": 1.0, "secretkey": 1.0, "privatekey": 1.0, "authtoken": 1.0,
    "token": 0.9, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "pass": 0.7, "auth": 0.6, "signingkey": 0.9, "encryptionkey": 0.9, "key": 0.5, "salt": 0.5, "pin": 0.5, "dsn": 0.5,
}
#: A text without any of these has no name with a weight.
STEMS = ("pass", "pwd", "secret", "key", "token", "credential", "bearer", "auth", "salt", "pin", "dsn")
#: A literal's bits at which its strength is full, and the score from which it counts.
FULL_BITS, LEAST_SCORE = 40.0, 0.5
#: Values that stand for a secret, not one.
PLACEHOLDER = re.compile(r"(?i)^(?:x{3,}|\*{3,}|\.{3,}|<[^<>]*>|\{\{?[^{}]*\}\}?|\$\{[^{}]*\}|%\w*%?|(?:your|my|enter|insert|replace|change)[-_ ]?\w*(?:[-_ ]\w*)*|(?:example|sample|dummy|test|placeholder|todo|none|null|nil|true|false|undefined|redacted)[-_ ]?\w*)$")

_PATH = r"[A-Za-z_$][\w$]*+(?:(?:->|::|[.-])[A-Za-z_$][\w$]*+)*+"
#: A name and the sign after it. A comparison, an arrow and a scheme (``http://``) are none.
_NAME = re.compile(
    rf"""(?:(?P<quote>["'`])(?P<quoted>[^"'`\n]++)(?P=quote)|(?<![\w$.-])(?P<path>{_PATH})(?:\[[ \t]*+["'](?P<item>[^"'\n\[\]]++)["'][ \t]*+\])?+)[ \t]*+(?::=|=>|=(?![=~>])|:(?![:/=]))"""
)
_TYPE = re.compile(r"[ \t]*+[A-Za-z_][\w.|?]*+(?:\[[\w., |]*+\])?+[ \t]*+=(?![=~>])")
_STRING = re.compile(r"""(?:[rRbBuUfF@]{1,2})?+(?:(?P<long>\"\"\"|''')(?P<text>(?:\\.|(?!(?P=long)).)*+)(?P=long)|(?P<short>["'])(?P<line>(?:\\[^\n]|(?!(?P=short))[^\\\n])*+)(?P=short)|`(?P<tick>[^`]*+)`)""", re.S)
_LOOKUP = re.compile(r"\$\{\{?[ \t]*+(?P<a>[\w.-]++)[ \t]*+\}?\}|#\{[ \t]*+(?P<b>[\w.]++)[ \t]*+\}|\{\{[ \t]*+(?P<c>[\w.]++)[ \t]*+\}\}|\$(?P<d>\w++)|%(?P<e>\w++)%")
_CALL = re.compile(rf"(?:new[ \t]++)?+{_PATH}\(")
_WORD = re.compile(_PATH)
_BARE = re.compile(r"""[^\s,;()\[\]{}"'`<>#]++""")
_JOIN = re.compile(r"[ \t]*+(?:\+(?!=)|\.\.|\.(?=[ \t]*+[\"'$])|\|\||\?\?|&(?!&))[ \t]*+(?:\\?\r?\n[ \t]*+)?+")
_ARGUMENT = re.compile(r"""[^\s,;()\[\]{}"'`<>#=:+]++""")
_SPACE = re.compile(r"\s*+")
_GAP = re.compile(r"[ \t]*+(?:\\\r?\n[ \t]*+)?+")
_HUMPS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


@dataclass
class Value:
    """A value's own literals as (start, end, text without look-ups), the values it refers to, and the largest weight that has reached it."""

    own: list[tuple[int, int, str]] = field(default_factory=list)
    refers: list[Value] = field(default_factory=list)
    weight: float = 0.0


def sensitivity(name: str) -> float:
    """The largest weight of a name's words, or of two that follow one another: ``dbPassword``, ``API_KEY``, ``app.auth.token``."""
    words = [w.lower() for w in _HUMPS.findall(name)]
    return max([WEIGHTS.get(w, 0.0) for w in words] + [WEIGHTS.get(a + b, 0.0) for a, b in zip(words, words[1:], strict=False)], default=0.0)


def strength(value: str, quoted: bool = True) -> float:
    """How much a value looks like a secret, from 0 to 1: its bits by the frequency of its signs; less for plain words and places.

    Values of under 6 signs, placeholders, and those with line breaks are none.
    """
    if len(value) < 6 or "\n" in value or PLACEHOLDER.match(value):
        return 0.0
    bits = sum(n * math.log2(len(value) / n) for n in Counter(value).values())
    factor = 1.0
    if re.match(r"(?:[a-z][a-z0-9+.-]*://(?![^/\s]*:[^/\s]*@)|/|\./|~/)", value):
        factor = 0.2  # a place without a password in it
    elif value.isalpha():
        factor = 0.5 if quoted else 0.1
    elif " " in value.strip():
        factor = 0.4
    return min(1.0, bits / FULL_BITS) * factor


class Lexer:
    """Reads one text's statements in order; ``found`` has a score and the name that gave it for each literal."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.names: dict[str, Value] = {}
        self.found: dict[tuple[int, int], tuple[float, str]] = {}
        self.at = 0
        for m in iter(self._statement, None):
            name = m["item"] or m["quoted"] or m["path"]
            value = self._value(m.end())
            self.names[name] = value
            if m["path"] and not m["item"]:
                self.names[re.split(r"->|::|\.", name)[-1]] = value
            weight = sensitivity(name)
            if weight:
                self._reach(value, weight, name)

    def _statement(self) -> re.Match | None:
        m = _NAME.search(self.text, self.at)
        self.at = m.end() if m else len(self.text)
        return m

    def _value(self, at: int) -> Value:
        """The value that begins at a place, after a type if one is stated.

        :attr:`at` is then where the next statement is looked for: after words, but within a string or a call, since
        those may hold statements too (``"user=u;password=p"``, ``connect(password="p")``).
        """
        if m := _TYPE.match(self.text, at):
            at = m.end()
        at = _GAP.match(self.text, at).end()
        if self.text.startswith("(", at):
            at += 1
        value, inside = Value(), None
        while True:
            after, within = self._term(at, value)
            if after == at:
                break
            inside = within if inside is None else inside
            m = _JOIN.match(self.text, after)
            at = m.end() if m else _GAP.match(self.text, after).end()
            if not m and self.text[at : at + 1] not in ('"', "'"):  # literals side by side are one
                break
        self.at = max(self.at, inside or at)
        return value

    def _term(self, at: int, value: Value) -> tuple[int, int]:
        """Adds the term at a place, if there is one, to a value; returns where it ends and where further statements may begin."""
        text = self.text
        if m := _STRING.match(text, at):
            return m.end(), self._literal(m, value)
        if m := _LOOKUP.match(text, at):
            self._refer(value, [m[m.lastgroup]])
            return m.end(), m.end()
        if m := _CALL.match(text, at):
            return self._arguments(m.end(), value), m.end()
        m = _BARE.match(text, at)
        if not m:
            return at, at
        word = _WORD.match(text, at)
        if word and word.end() == m.end() and word[0] in self.names:
            self._refer(value, [word[0]])
        else:
            value.own.append((m.start(), m.end(), m[0]))
        return m.end(), m.end()

    def _literal(self, m: re.Match, value: Value) -> int:
        group = next(g for g in ("text", "line", "tick") if m[g] is not None)
        if m[group]:
            value.own.append((m.start(group), m.end(group), _LOOKUP.sub("", m[group])))
            self._refer(value, (x[x.lastgroup] for x in _LOOKUP.finditer(self.text, m.start(group), m.end(group))))
        return m.start(group)

    def _arguments(self, at: int, value: Value) -> int:
        """Passes on the literals and names among a call's arguments, each by itself, up to one that is named; returns where they end."""
        text, depth = self.text, 1
        while depth:
            at = _SPACE.match(text, at).end()
            if text.startswith(")", at):
                depth, at = depth - 1, at + 1
            elif text.startswith((",", "+"), at):
                at += 1
            elif m := _STRING.match(text, at):
                value.refers.append(one := Value())
                self._literal(m, one)
                at = m.end()
            elif m := _CALL.match(text, at):
                depth, at = depth + 1, m.end()
            elif m := _LOOKUP.match(text, at) or _ARGUMENT.match(text, at):
                self._refer(value, [m[m.lastgroup] if m.lastgroup else m[0]])
                at = m.end()
            else:
                break
        return at

    def _refer(self, value: Value, names) -> None:
        value.refers += [self.names[name] for name in names if name in self.names]

    def _reach(self, value: Value, weight: float, name: str) -> None:
        """Scores all literals that reach a name, each value once a weight."""
        todo = [value]
        while todo:
            v = todo.pop()
            if v.weight >= weight:
                continue
            v.weight = weight
            todo += v.refers
            joined = "".join(x for _, _, x in v.own)
            quoted = any(s and self.text[s - 1] in "\"'`" for s, _, _ in v.own)
            score = weight * strength(joined, quoted) if v.own else 0.0
            if score >= LEAST_SCORE:
                for start, end, _ in v.own:
                    if self.found.get((start, end), (0.0, ""))[0] < score:
                        self.found[start, end] = (score, name)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the fixed patterns' matches, of each kind the leftmost that don't overlap."""
    found = []
    low = text.lower()
    if any(stem in low for stem in ASSIGN_STEMS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def findings(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) of a whole text, by start, then kind, then end; in code points, end exclusive."""
    spans = [(s, k, e, None, 1.0) for s, k, e in base_spans(text)]
    low = text.lower()
    if (":" in text or "=" in text) and any(stem in low for stem in STEMS):
        spans += [(s, 3, e, name, round(score, 4)) for (s, e), (score, name) in Lexer(text).found.items()]
    return [(KINDS[k], s, e, name, score) for s, k, e, name, score in sorted(spans, key=lambda x: x[:3])]


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``: an array of (kind, start, end, name, score) over each whole text.

    Kinds are those of the fixed patterns (score 1, no name) and ``literal``, with the most sensitive name that the literal reached; a
    literal stays beside a fixed pattern's match that covers it. A null or empty text has an empty array; bytes that are no UTF-8
    count as one replacement sign each. Repeated rows get equal results, other columns are kept, and if the new one's name is taken, it gets leading
    underscores. Each text is read by itself, in memory of a small multiple of its length; nothing is shuffled.
    """
    (name,) = fresh(docs.columns, "secret_spans")
    fields = [("kind", T.StringType(), pa.string()), ("start", T.LongType(), pa.int64()), ("end", T.LongType(), pa.int64()), ("name", T.StringType(), pa.string()), ("score", T.DoubleType(), pa.float64())]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.StructType([T.StructField(n, t) for n, t, _ in fields])))])
    kind = pa.list_(pa.struct([(n, t) for n, _, t in fields]))
    every, at = [*docs.columns, name], docs.columns.index(text_col)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(at)):
                raw = data.tobytes()
                ends = offsets.tolist()
                found = [[dict(zip(("kind", "start", "end", "name", "score"), x, strict=True)) for x in findings(raw[a:b].decode("utf-8", "replace"))] for a, b in zip(ends, ends[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(found, kind)], names=every)

    return docs.mapInArrow(look, schema)
