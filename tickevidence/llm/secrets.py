"""Secrets in texts: fixed patterns, and literals that flow into names that sound secret."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickevidence.llm.common import map_arrow, text_or_empty

# The base patterns and least lengths of the contract.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a whole run of 16 and more
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_KINDS = ("assign", "access", "hex", "flow")

# Parts of names that point at a secret, with their weight.
_NAME_WEIGHTS = {
    "password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3, "credential": 3,
    "credentials": 3, "privatekey": 3, "accesskey": 3, "secretkey": 3, "auth": 2, "authorization": 2, "bearer": 2,
    "key": 1, "api": 1, "private": 1, "access": 1, "client": 1, "signing": 1, "encryption": 1, "session": 1, "pass": 2,
    "salt": 1, "cert": 1,
}
# Parts of names that speak of a secret without holding one.
_NAME_DENIALS = {"public", "name", "file", "path", "url", "length", "len", "count", "size", "type", "hint", "label", "field", "placeholder", "example", "id"}
# Literals that stand for "fill this in".
_BLANKS = {"none", "null", "true", "false", "changeme", "example", "placeholder", "your_password", "undefined", "xxxxxxxx"}

#: Starts of literals that are places or templates.
_NO_KEYS = ("http:", "https:", "/", "./", "${", "<", "{{", "%(")

#: A literal is a secret from this score.
THRESHOLD = 4.0

#: name, separator and the start of a value: `a.b = `, `"a": `, `export A=`, `a := `, `a => `.
_TARGET = re.compile(
    r"""(?<![\w.$-])["']?(?P<name>[A-Za-z_$][\w.$-]*+)["']?[ \t]*+(?::=|=>|=(?![=>~])|:(?![:/]))[ \t]*+(?=[\w"'`$+/({\[])""",
    re.ASCII,
)
#: One operand: a quoted literal, a name, or a bare value.
_OPERAND = re.compile(
    r"""(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*)(?P=quote)|\$\{?(?P<ref>[A-Za-z_][\w.-]*)\}?|(?P<bare>[A-Za-z0-9_+/.=~-]+)""",
    re.ASCII,
)
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.)[ \t]*")
_CALL = re.compile(r"[A-Za-z_][\w.]*\([ \t]*", re.ASCII)
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in code points, end exclusive."""
    out = []
    low = text.lower() if (":" in text or "=" in text) else ""
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """How much a target name speaks of a secret: the weights of its parts, joined neighbours included."""
    last = re.split(r"[.$]", name)[-1] or name
    parts = [p.lower() for p in _NAME_PARTS.findall(last)]
    if not parts or parts[-1] in _NAME_DENIALS:
        return 0.0
    pairs = [a + b for a, b in zip(parts, parts[1:])]
    return float(sum(_NAME_WEIGHTS.get(p, 0) for p in parts) + sum(_NAME_WEIGHTS.get(p, 0) for p in pairs))


def entropy(text: str) -> float:
    """Bits per character of a literal's own letters."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def _kinds(text: str) -> int:
    return sum(bool(re.search(k, text)) for k in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]"))


def literal_score(text: str) -> float:
    """How much a literal looks like key material: length, mixture and entropy; 0 for words, paths and blanks."""
    low = text.lower()
    if len(text) < 8 or low in _BLANKS or len(set(text)) < 5 or any(c.isspace() for c in text):
        return 0.0
    if low.startswith(_NO_KEYS):
        return 0.0
    kinds = _kinds(text)
    if kinds == 1 and not text.isdigit() and len(text) < 20:
        return 0.5
    return min(2.0, len(text) / 16) + 0.5 * (kinds - 1) + max(0.0, min(1.0, entropy(text) - 2.5))


def _long_score(letters: Counter, n: int, head: str) -> float:
    """literal_score of a literal of 32 and more characters, from how often each occurs and the first ones."""
    if len(letters) < 5 or any(c.isspace() for c in letters) or head.lower().startswith(_NO_KEYS):
        return 0.0
    bits = -sum(p * math.log2(p) for c in letters.values() if (p := c / n) > 0)
    return 2.0 + 0.5 * (_kinds("".join(letters)) - 1) + max(0.0, min(1.0, bits - 2.5))


def flow_spans(text: str) -> list[tuple[str, int, int]]:
    """Literals assigned to names that sound secret, directly or through constants.

    The text is lexed into assignments (source code, shell, INI, YAML, JSON). A value
    is a chain of operands joined by ``+`` or ``..``; an operand is a quoted literal, a bare value, or a
    name. Names assigned earlier stand for the literals they hold, chains
    included, so `a = "x" + "y"; password = a` marks both literals. The score is the
    name's weight plus that of the joined literal. Spans cover the literals
    without quotes, in code points.
    """
    if "=" not in text and ":" not in text:
        return []
    known: dict[str, _Parts] = {}
    found: set[tuple[str, int, int]] = set()
    marked: set[int] = set()
    at = 0
    while m := _TARGET.search(text, at):
        at = m.end()
        name = m["name"]
        parts, at = _value(text, at, known)
        if not parts.items:
            continue
        only = parts.items[0]
        parts = only if len(parts.items) == 1 and isinstance(only, _Parts) else parts
        known[name] = parts
        weight = name_score(name)
        if weight >= 2 and weight + _score(text, parts) >= THRESHOLD:
            _mark(parts, found)
    return sorted(found, key=lambda s: s[1:])


class _Parts:
    """A value: spans of literals and references to constants, in order, with the joined literal's length and first letters."""

    __slots__ = ("items", "size", "head", "letters", "score", "marked")

    def __init__(self) -> None:
        self.items: list[tuple[int, int] | _Parts] = []
        self.size, self.head, self.letters, self.score, self.marked = 0, "", None, None, False

    def add(self, text: str, item: tuple[int, int] | _Parts) -> None:
        if isinstance(item, _Parts):
            size, head = item.size, item.head
            if not size:  # an empty constant
                item = (0, 0)
        else:
            size, head = item[1] - item[0], text[item[0] : min(item[1], item[0] + 8)]
        if size or not self.items:
            self.items.append(item)
            self.size += size
            self.head = (self.head + head)[:8]


def _joined(text: str, parts: _Parts) -> str:
    out, stack = [], [iter(parts.items)]
    while stack:
        item = next(stack[-1], None)
        if item is None:
            stack.pop()
        elif isinstance(item, _Parts):
            stack.append(iter(item.items))
        else:
            out.append(text[item[0] : item[1]])
    return "".join(out)


def _letters(text: str, parts: _Parts) -> Counter:
    """How often each character occurs in the joined literal; counted once per constant."""
    stack = [parts]
    while stack:
        now = stack[-1]
        open_ = [x for x in now.items if isinstance(x, _Parts) and x.letters is None] if now.letters is None else []
        if open_:
            stack += open_
            continue
        stack.pop()
        if now.letters is None:
            now.letters = Counter()
            for x in now.items:
                now.letters.update(x.letters if isinstance(x, _Parts) else text[x[0] : x[1]])
    return parts.letters


def _score(text: str, parts: _Parts) -> float:
    """literal_score of the joined literal. Constants of constants may stand for one far longer than the text, so long ones are not spelled out."""
    if parts.score is None:
        long = parts.size > 1_024
        parts.score = _long_score(_letters(text, parts), parts.size, parts.head) if long else literal_score(_joined(text, parts))
    return parts.score


def _mark(parts: _Parts, found: set[tuple[str, int, int]]) -> None:
    """Adds the spans of all literals behind a value; each constant is walked once."""
    stack = [parts]
    while stack:
        now = stack.pop()
        if now.marked:
            continue
        now.marked = True
        for item in now.items:
            if isinstance(item, _Parts):
                stack.append(item)
            elif item[1] > item[0]:
                found.add(("flow", *item))


def _value(text: str, at: int, known: dict[str, _Parts]) -> tuple[_Parts, int]:
    """The value that starts at ``at``, with all its operands, and where it ends."""
    parts = _Parts()
    while True:
        call = _CALL.match(text, at)
        if call:  # a wrapped literal, as in decode("...")
            at = call.end()
        m = _OPERAND.match(text, at)
        if not m:
            break
        if m["quote"]:
            parts.add(text, m.span("text"))
        else:
            name = m["ref"] or m["bare"]
            if name in known:
                parts.add(text, known[name])
            elif m["bare"] and any(c.isdigit() for c in name):
                parts.add(text, (m.start(), m.start() + len(name.rstrip("."))))
            elif not m["ref"]:
                return parts, at
        at = m.end()
        if at < len(text) and text[at] == ")":
            at += 1
        joint = _PLUS.match(text, at)
        if not joint:
            break
        at = joint.end()
    return parts, at


def _join(spans: list[tuple[str, int, int]]) -> str:
    order = sorted(set(spans), key=lambda s: (s[1], _KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


def scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Base counts, their digest and all spans of every whole text; one scan, no shuffle.

    Added: kept columns, n_assign, n_access, n_hex, n_flow, base_sha256, spans and
    masked (the text with every span replaced by <SECRET>). A text without secrets
    has zeros, an empty span list and itself as masked text; a NULL text counts as
    empty. Each text is one string in one task; the lexer is linear in it.
    """
    keep = keep or ["doc_id"]
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names, strict=True)), text_or_empty().alias("body"))
    made = ["n_assign", "n_access", "n_hex", "n_flow", "base_sha256", "spans", "masked"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in made]
        for text in batch.column(len(names)).to_pylist():
            base = base_spans(text)
            flow = flow_spans(text)
            kinds = Counter(k for k, _, _ in base)
            values = [kinds["assign"], kinds["access"], kinds["hex"], len(flow)]
            values += [hashlib.sha256(_join(base).encode()).hexdigest(), _join(base + flow), mask(text, base + flow)]
            for col, v in zip(cols, values, strict=True):
                col.append(v)
        types = [pa.int64()] * 4 + [pa.string()] * 3
        arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *arrays], names=[*names, *made])

    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    schema += ", n_assign long, n_access long, n_hex long, n_flow long, base_sha256 string, spans string, masked string"
    out = map_arrow(rows, [*names, "body"], run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep, strict=True)), *made)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with its spans, overlaps merged, replaced by <SECRET>."""
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], "<SECRET>"]
        at = max(at, end)
    return "".join(out) + text[at:]
