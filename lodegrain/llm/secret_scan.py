"""Secret scans: fixed credential forms, and literals assigned to sensitive names.

Base spans are three fixed patterns. On top of them, an assignment-aware lexer reads
source and configuration syntax into name-literal pairs: it finds a name and its operator
(``name =``, ``name:``, ``"name":``, ``name :=``, ``name =>``, ``<name>``) and reads the value behind
it as a token of its own kind: quoted, triple-quoted and concatenated strings, lists of
strings, indented blocks, bare words, or an opening brace or indentation, whose name then
stands for the generic names inside it (``secret: {value: x}``). A name assigned from another
name takes over its literal (constants are propagated to a fixed point), so a literal is
judged by every name it reaches. The score of a literal is the weight of the
most sensitive part of those names, plus a bonus for random-looking content, with which
every listed name reaches the threshold; spaces count against a literal unless it is a
password or passphrase. Literals whose score reaches the threshold become spans of the
kind ``literal``. Scores are added in tenths, as integers.

Spans are (kind, start, end) in code points, end exclusive. Literal spans that lie within
a base span are not repeated; a concatenated literal has a span for each piece.

Defined results: null text counts as empty and has no spans; repeated rows repeat; an
empty table gives an empty result; extra columns are ignored by ``scan`` and kept by
``redact``; a very long text is scanned whole, in time in proportion to its length.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegrain.llm import common

# The base patterns and the least length of what each must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")

# Parts of names that make an assigned literal sensitive, with weights.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "privatekey": 1.0, "accesskey": 1.0, "credential": 0.8, "credentials": 0.8, "pwd": 0.9, "auth": 0.6, "bearer": 0.8, "signature": 0.5, "salt": 0.5, "key": 0.4}
#: Parts of names whose literals may well be several words.
PHRASES = {"password", "passwd", "passphrase", "pwd"}
#: Literals that stand for a value rather than being one.
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|none|null|true|false|changeme|example|placeholder|todo|<.*>|\[[A-Z_ ]+\]|\$\{.*\}|%\(.*\)s)$")

#: What a text must have for any of the names above to be in it.
_STEMS = ("pass", "secret", "token", "key", "credential", "pwd", "auth", "bearer", "signature", "salt")
#: Names that say nothing of their own: the name of what holds them counts for them.
GENERIC = {"value", "val", "data", "default", "content", "contents", "text", "raw", "string", "plain", "literal"}

# The lexer's tokens. Names start where no name goes on, and are never given back, so that finding them takes linear time.
_HEAD = re.compile(
    r"""(?:(?P<q>["'])(?P<quoted>[A-Za-z_][\w.-]*+)(?P=q)|(?<![\w.-])(?P<name>[A-Za-z_][\w.-]*+))[\x20\t]*+(?P<op>:=|=>|=(?![=~])|:(?![:/=]))[\x20\t]*+"""
    r"""|<(?P<tag>[A-Za-z_][\w.-]*+)>""",
    re.ASCII,
)
_STRING = re.compile(r"""(?:[bfru]{1,2}(?=["']))?(?:\"{3}(?P<d3>.*?)\"{3}|'{3}(?P<s3>.*?)'{3}|"(?P<dq>(?:[^"\\\n]|\\.)*+)"|'(?P<sq>(?:[^'\\\n]|\\.)*+)'|`(?P<bq>[^`\n]*+)`)""", re.DOTALL | re.IGNORECASE)
_JOINED = re.compile(r"""(?:\s*+\+\s*+|[\x20\t]*+\\\n[\x20\t]*+|[\x20\t]++)(?=[bfru]{0,2}["'`])""", re.IGNORECASE)
_WRAPPED = re.compile(r"""\s*+\+?\s*+(?=[bfru]{0,2}["'`])""", re.IGNORECASE)
_NEXT = re.compile(r"\s*+,\s*+")
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]<>]++""")
_BLOCK = re.compile(r"[|>][+-]?[0-9]?[+-]?[\x20\t]*+\n")
_INDENT = re.compile(r"[\x20\t]*+")
_BODY = re.compile(r"([^<>\n]++)</([A-Za-z_][\w.-]*+)>", re.ASCII)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*\Z", re.ASCII)


def parts_of(name: str) -> list[str]:
    """A name's parts, and neighbouring parts joined."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    return parts + [a + b for a, b in zip(parts, parts[1:])]


def sensitivity(name: str) -> float:
    """The weight of a name's most sensitive part, or of two neighbouring parts joined."""
    return max((SENSITIVE.get(p, 0.0) for p in parts_of(name)), default=0.0)


def entropy(literal: str) -> float:
    """Bits a character of the literal's own character frequencies."""
    n = len(literal)
    return -sum(c / n * math.log2(c / n) for c in Counter(literal).values()) if n else 0.0


@dataclass(frozen=True)
class Pair:
    """A name (and that of what holds it, where its own is generic) with a literal's value and pieces."""

    name: str
    holders: tuple[str, ...]
    value: str
    pieces: tuple[tuple[int, int], ...]
    quoted: bool


def _strings(text: str, at: int, between: re.Pattern) -> tuple[list[tuple[int, int]], int]:
    """The pieces of string literals from ``at`` on that ``between`` joins, and where they end."""
    pieces = []
    while m := _STRING.match(text, at):
        kind = next(k for k in ("d3", "s3", "dq", "sq", "bq") if m[k] is not None)
        pieces.append(m.span(kind))
        at = m.end()
        more = between.match(text, at)
        if not more:
            break
        at = more.end()
    return pieces, at


def _block(text: str, at: int, indent: int) -> tuple[int, int, int]:
    """(start, end, where to go on) of the lines from ``at`` that are indented more than ``indent``."""
    start, end = -1, at
    while at < len(text):
        stop = text.find("\n", at)
        stop = len(text) if stop < 0 else stop
        first = _INDENT.match(text, at, stop).end()
        if first < stop:
            if first - at <= indent:
                break
            start = first if start < 0 else start
            end = stop
        at = stop + 1
    return start, end, min(at, len(text))


def pairs(text: str) -> list[Pair]:
    """Every assignment of a literal, in one pass over the text."""
    out: list[Pair] = []
    if "=" not in text and ":" not in text and "</" not in text:
        return out
    held: list[tuple[str, int, int]] = []  # open holders: the nearest name that says something, depth of braces (or -1), indent of its line (or -1)
    depth = at = counted = line_start = searched = 0
    while m := _HEAD.search(text, at):
        begin, at = m.start(), m.end()
        depth += text.count("{", counted, begin) - text.count("}", counted, begin)
        counted = begin
        line_start = text.rfind("\n", searched, begin) + 1 or line_start
        searched = begin
        indent = _INDENT.match(text, line_start).end() - line_start
        while held and (depth < held[-1][1] if held[-1][1] >= 0 else indent <= held[-1][2]):
            held.pop()
        if m["tag"]:
            body = _BODY.match(text, at)
            if body and body[2] == m["tag"]:
                out.append(Pair(m["tag"], (), body[1], (body.span(1),), False))
                at = body.end()
            continue
        name = m["quoted"] or m["name"]
        holder = held[-1][0] if held else ""
        holders = (holder,) if holder and name.lower() in GENERIC else ()
        stands = holder or name if name.lower() in GENERIC else name
        first = text[at : at + 1]
        pieces, quoted = [], True
        if first == "{":
            held.append((stands, depth + 1, -1))
        elif first == "[":
            inside = at + 1 + len(text[at + 1 : at + 400]) - len(text[at + 1 : at + 400].lstrip())
            items, at = _strings(text, inside, _NEXT)
            out += [Pair(name, holders, text[a:b], ((a, b),), True) for a, b in items]
        elif first == "(":
            inside = _WRAPPED.match(text, at + 1)
            if inside:
                pieces, at = _strings(text, inside.end(), _WRAPPED)
        elif m["op"] == ":" and (block := _BLOCK.match(text, at)):
            start, end, at = _block(text, block.end(), indent)
            pieces = [(start, end)] if start >= 0 else []
        elif m["op"] == ":" and first in ("\n", "\r"):
            held.append((stands, -1, indent))
        elif _STRING.match(text, at):
            pieces, at = _strings(text, at, _JOINED)
        elif bare := _BARE.match(text, at):
            pieces, quoted, at = [bare.span()], False, bare.end()
        if pieces:
            out.append(Pair(name, holders, "".join(text[a:b] for a, b in pieces), tuple(pieces), quoted))
    return out


def reached(names: set[str], flows: dict[str, list[str]]) -> tuple[dict[str, int], set[str]]:
    """Each name's weight in tenths, and the names that are passwords or phrases, by all that their values flow to.

    ``flows`` leads from a name to those whose value it is taken from. Names are visited from
    the most sensitive down, each once, so cycles and long chains cost no more.
    """
    own = {n: round(10 * sensitivity(n)) for n in names}
    weight: dict[str, int] = {}
    for name in sorted(own, key=lambda n: (-own[n], n)):
        if not own[name]:
            break
        todo = [name] if name not in weight else []
        weight.setdefault(name, own[name])
        while todo:
            for source in flows.get(todo.pop(), ()):
                if source not in weight:
                    weight[source] = own[name]
                    todo.append(source)
    phrases = {n for n in weight if not PHRASES.isdisjoint(parts_of(n))}
    todo = list(phrases)
    while todo:
        for source in flows.get(todo.pop(), ()):
            if source not in phrases:
                phrases.add(source)
                todo.append(source)
    return weight, phrases


def assigned_literals(text: str, threshold: float = 0.9) -> list[tuple[int, int]]:
    """Spans of the literals that reach a sensitive name, in order."""
    low = text.lower()
    found = pairs(text) if any(x in low for x in _STEMS) else []
    if not found:
        return []
    # `b = a` passes the literals of a on to b.
    defined = {p.name for p in found}
    passed = [not p.quoted and p.value in defined and bool(_NAME.match(p.value)) for p in found]
    flows: dict[str, list[str]] = {}
    for p, is_name in zip(found, passed):
        if is_name:
            flows.setdefault(p.name, []).append(p.value)
    weight, phrases = reached(defined.union(*(p.holders for p in found)), flows)
    out = []
    for p, is_name in zip(found, passed):
        names = (p.name, *p.holders)
        most = max(weight.get(n, 0) for n in names)
        if is_name or not most or len(p.value) < 8 or PLACEHOLDERS.match(p.value):
            continue
        mixed = any(c.isdigit() for c in p.value) and any(c.isalpha() for c in p.value)
        spaced = " " in p.value and phrases.isdisjoint(names)
        score = most + (5 if mixed and entropy(p.value) >= 3 else 0) - (5 if spaced or not mixed and p.value.isalpha() and p.value.islower() else 0)
        if score >= round(10 * threshold):
            out += [x for x in p.pieces if x[0] < x[1]]
    return sorted(set(out))


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then by kind as listed."""
    spans = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    base = sorted((a, b) for _, a, b in spans)
    starts, reach = [a for a, _ in base], list(itertools.accumulate((b for _, b in base), max))
    for a, b in assigned_literals(text):
        k = bisect.bisect_right(starts, a)
        if not k or reach[k - 1] < b:
            spans.append(("literal", a, b))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, a digest of the base spans and all spans, for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = scan_text(text or "")
                n = Counter(k for k, _, _ in spans)
                base = joined([x for x in spans if x[0] != "literal"])
                rows.append((doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(base.encode()).hexdigest(), joined(spans), n["literal"]))
            yield pa.RecordBatch.from_pylist([dict(zip(NAMES, r)) for r in rows], schema=ARROW)

    return common.map_batches(common.texts(docs, id_col, text_col), run, SCHEMA)


NAMES = [f.split()[0] for f in SCHEMA.split(", ")]
ARROW = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in SCHEMA.split(", ")])


def redact_text(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every secret replaced; of an assignment, the name stays."""
    out, at = [], 0
    for kind, start, end in scan_text(text):
        if kind == "assign":
            start = start + ASSIGN.match(text, start, end).start(2) - start
        if end <= at:
            continue
        out += [text[at : max(at, start)], mark]
        at = end
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with the same columns and rows; secrets in the text are replaced, null stays null."""
    clean = lambda bodies: [x if x is None else redact_text(x, mark) for x in bodies]
    return docs.withColumn(text_col, common.map_texts(docs, text_col, clean, "string"))
