"""Secrets in source and configuration text, by reading what is assigned to which name.

Three plain patterns give the base spans. Beyond them a small lexer reads name-literal pairs, written
as assignments, mapping entries, options or elements. A value may be a chain of literals and names, may
begin on the next line, and may be a block of indented lines or a text in triple quotes, whose lines are
literals each. Names stand for what was assigned to them before, or else for the first thing assigned
to them later. So values refer to values, and a literal has the sensitivity of the most sensitive name
whose value it is reached from: the references are followed once, from the most sensitive name down. A
literal is a secret if a name that it reaches is sensitive and the literal looks like a key: score =
sensitivity of the name x strength of the literal, from its length, the kinds of its characters and their
entropy. Placeholders and references to the environment score nothing.

Names and literals have any length. Long literals that end together, as those of a run of assignments do,
are scored in one pass, so that a scan is linear in the length of a run.

Spans count code points, the end excluded. Every base span stays; a literal inside one adds nothing.

Defined results: null text is empty text and has no spans; repeated rows are scanned each; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tasks import map_batches, ship

Span = tuple[int, int]
KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5
#: Characters from which on a literal without quotes is scored together with those that end where it ends.
LONG = 4096

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run that is shorter can't begin later
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# How sensitive names are, by the words they are made of.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.7,
    "private": 0.6, "key": 0.6, "salt": 0.6, "signature": 0.6, "cookie": 0.6, "dsn": 0.6,
}
_BOOST = {("api", "key"), ("access", "key"), ("private", "key"), ("secret", "key"), ("signing", "key"), ("encryption", "key")}
_PLACEHOLDERS = ("example", "changeme", "placeholder", "redacted", "your", "dummy", "xxxx", "****", "todo", "none", "null", "true", "false")

# Longest first, so that comparisons and the like are told from assignments.
_MARK = re.compile(r"==+|::+|://|[!<>+*/|&^%~-]=|:=|=>|[:=]")
_ASSIGNS = (":=", "=>", ":", "=")
_NAME_BACKWARD = re.compile(r"[\w.$-]*+")
_NAME_FROM = re.compile(r"[A-Za-z_$]")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)(?: [^<>\n]*)?>([^<>\n]+)</\1>")
_OPTION = re.compile(r"-(?<!\S-)-?([A-Za-z][\w-]*)[ \t]+([^\s-]\S*)")
_QUOTED = re.compile(r'''"((?:[^"\\\n]++|\\.)*+)"|'((?:[^'\\\n]++|\\.)*+)'|`([^`\n]*+)`''')
_REFERENCE = re.compile(r"\$\{[\w.]++\}")
_RUN = re.compile(r"[^\s,;(){}\[\]\"'`<>]++")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*(?:\\?\r?\n[ \t]*)?")
_BLOCK = re.compile(r"[|>][+-]?[1-9]?[ \t]*\r?$", re.M)
_INDENT = re.compile(r"[ \t]*")
_TRIPLE = ('"""', "'''")
_IDENTIFIER = re.compile(r"(?:\$\{?)?([A-Za-z_][\w.]*)\}?")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found: list[tuple[str, int, int]] = []
    lowered = text.lower()
    if any(w in lowered for w in _WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in _PART.findall(name)]
    best = max([SENSITIVE.get(p, 0.0) for p in parts], default=0.0)
    if any(pair in _BOOST for pair in zip(parts, parts[1:])):
        best = 1.0
    return best


def strength(literal: str, quoted: bool) -> float:
    """0 to 1: how much a literal looks like a key."""
    lowered = literal.lower()
    if len(literal) < 6 or any(p in lowered for p in _PLACEHOLDERS) or literal[0] in "$<{%" or "(" in literal:
        return 0.0
    if not quoted and not re.search("[0-9]", literal):  # a word of a sentence
        return 0.0
    kinds = sum(bool(re.search(k, literal)) for k in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if kinds < 2 and not (quoted and len(literal) >= 8 and " " not in literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    if " " in literal.strip():  # prose rather than a key
        return 0.2
    return min(1.0, 0.25 * min(entropy, 4) / 2 + 0.1 * kinds + 0.3 * min(n, 24) / 24)


def _strengths(text: str, starts: list[int], end: int) -> dict[int, float]:
    """strength() of the literals without quotes that begin at ``starts`` and end at ``end``, from the last one on."""
    lowered = text[min(starts) : end].replace("\u0130", "i").lower()  # as long as before
    held = min(starts) + max(map(lowered.rfind, _PLACEHOLDERS)) if any(p in lowered for p in _PLACEHOLDERS) else -1
    counts: Counter[str] = Counter()
    kinds: set[int] = set()
    weight, at, out = 0.0, end, {}
    for start in sorted(starts, reverse=True):
        for c, many in Counter(text[start:at]).items():
            old = counts[c]
            counts[c] = old + many
            weight += counts[c] * math.log2(counts[c]) - (old and old * math.log2(old))
            kinds.add("a" <= c <= "z" or 2 * ("A" <= c <= "Z") or 3 * ("0" <= c <= "9") or 4)
        at, n = start, end - start
        if held >= start or text[start] in "$<{%" or 3 not in kinds or len(kinds) < 2:
            out[start] = 0.0
        else:
            entropy = math.log2(n) - weight / n
            out[start] = min(1.0, 0.25 * min(entropy, 4) / 2 + 0.1 * len(kinds) + 0.3 * min(n, 24) / 24)
    return out


class Literal:
    def __init__(self, start: int, end: int, quoted: bool):
        self.start, self.end, self.quoted = start, end, quoted
        self.sensitivity = 0.0  # of the most sensitive name that it reaches


class Value:
    """What is assigned to a name: literals, other values, and names that nothing was assigned to before."""

    def __init__(self, name: str):
        self.sensitivity = sensitivity(name)
        self.parts: list[Literal | Value] = []
        self.unknown: list[tuple[str, Span | None]] = []  # with the place, if the name may be a literal itself


def _name_before(segment: str) -> str:
    """The name that ends a piece of text, if need be before quotes, a bracket and blanks."""
    segment = segment.rstrip(" \t")
    for _ in range(2):
        if segment.endswith(('"', "'", "]")):
            segment = segment[:-1]
    run = segment[len(segment) - _NAME_BACKWARD.match(segment[::-1]).end() :]
    first = _NAME_FROM.search(run)
    return run[first.start() :] if first else ""


def _value_place(text: str, at: int) -> int:
    """Where the value behind a mark begins: on its line, or as the only word or quoted text of the next one."""
    while text[at : at + 1] in (" ", "\t", "("):
        at += 1
    line_end = at + 1 if text[at : at + 2] == "\r\n" else at
    if text[line_end : line_end + 1] != "\n":
        return at
    start = _INDENT.match(text, line_end + 1).end()
    if text[start : start + 1] in ('"', "'", "`"):
        return start
    end = text.find("\n", start)
    word = text[start : len(text) if end < 0 else end].strip()
    alone = start > line_end + 1 and len(word.split(None, 1)) == 1 and word[0] not in "-#" and ":" not in word
    return start if alone and "=" not in word.rstrip("=") else at


def _pairs(text: str) -> Iterator[tuple[int, str, int]]:
    """Place, name and beginning of the value, as the text has them."""
    if "=" in text or ":" in text:
        done = 0  # a name doesn't reach over a mark
        for m in _MARK.finditer(text):
            start, at = m.span()
            name = m[0] in _ASSIGNS and _name_before(text[done:start])
            if name:
                yield start, name, _value_place(text, at)
            done = at
    if "-" in text:
        for m in _OPTION.finditer(text):
            yield m.start(), m[1], m.start(2)


def _block_lines(text: str, at: int) -> Iterator[Span]:
    """The lines, without blanks around them, that are indented deeper than the line of a block's mark at ``at``."""
    line = text.rfind("\n", 0, at) + 1
    depth = _INDENT.match(text, line).end() - line
    line = text.find("\n", at) + 1
    while line:
        end = text.find("\n", line)
        stop = len(text) if end < 0 else end
        start = _INDENT.match(text, line).end()
        held = text[start:stop].rstrip()
        if held and start - line <= depth:
            return
        if held:
            yield start, start + len(held)
        line = end + 1


def _run_end(text: str, at: int, runs: list[Span]) -> int:
    """Where the characters of a word without quotes end; ``at`` if none begins here. ``runs`` remembers long ones."""
    place = bisect_right(runs, at, key=lambda run: run[0]) - 1
    if place >= 0 and at < runs[place][1]:
        return runs[place][1]
    run = _RUN.match(text, at)
    if not run:
        return at
    if run.end() - at > LONG:
        insort(runs, run.span())
    return run.end()


def _read_value(
    text: str, at: int, into: Value, known: dict[str, Value], literal: Callable[[int, int, bool], Literal], runs: list[Span]
) -> None:
    """Puts the literals and values that a chain of literals and names stands for ``into`` a value."""
    if _BLOCK.match(text, at):
        into.parts += [literal(start, end, False) for start, end in _block_lines(text, at)]
        return
    while True:
        if text[at : at + 3] in _TRIPLE:
            end = text.find(text[at : at + 3], at + 3)
            if end < 0:
                return
            line = at + 3
            for held in text[line:end].split("\n"):
                bare = held.strip()
                if bare:
                    start = line + held.index(bare)
                    into.parts.append(literal(start, start + len(bare), True))
                line += len(held) + 1
            at = end + 3
        elif quoted := _QUOTED.match(text, at):
            start, end = quoted.span(quoted.lastindex or 1)
            if start < end:
                into.parts.append(literal(start, end, True))
            at = quoted.end()
        else:
            reference = _REFERENCE.match(text, at)
            after = reference.end() if reference else _run_end(text, at, runs)
            if after == at:
                return
            end = after - (text[after - 1] in ".,:;!?" and after - at > 1)
            name = _IDENTIFIER.fullmatch(text, at, end)
            handed = known.get(name[1]) if name else None
            if handed is not None:
                into.parts.append(handed)
            elif name:
                into.unknown.append((name[1], (at, end) if text[at] != "$" else None))
            elif text[at] != "$":
                into.parts.append(literal(at, end, False))
            at = after
        more = _JOIN.match(text, at)
        if not more:
            return
        at = more.end()


def assigned_literals(text: str) -> list[Literal]:
    """The literals of a text, with the sensitivity of the names they are assigned to, directly or handed on."""
    known: dict[str, Value] = {}
    waiting: dict[str, list[tuple[Value, Span | None]]] = defaultdict(list)
    found: dict[Span, Literal] = {}
    values: list[Value] = []
    runs: list[Span] = []

    def literal(start: int, end: int, quoted: bool) -> Literal:
        return found.setdefault((start, end), Literal(start, end, quoted))

    for _, name, at in sorted(_pairs(text)):
        value = Value(name)
        _read_value(text, at, value, known, literal, runs)
        if not value.parts and not value.unknown:
            continue
        values.append(value)
        for unknown, span in value.unknown:
            waiting[unknown].append((value, span))
        known[name] = value
        for earlier, _ in waiting.pop(name, ()):
            earlier.parts.append(value)
    for value, span in (x for names in waiting.values() for x in names):
        if span:  # nothing is called so: the word is the literal
            value.parts.append(literal(*span, False))
    if "</" in text:
        for m in _ELEMENT.finditer(text):
            value = Value(m[1])
            value.parts.append(literal(*m.span(2), True))
            values.append(value)
    seen: set[int] = set()
    for value in sorted(values, key=lambda v: -v.sensitivity):
        reached = [value]
        while reached:
            part = reached.pop()
            if isinstance(part, Literal):
                part.sensitivity = max(part.sensitivity, value.sensitivity)
            elif id(part) not in seen:
                seen.add(id(part))
                reached += part.parts
    return list(found.values())


def secret_literals(text: str, threshold: float = THRESHOLD) -> list[Span]:
    out: list[Span] = []
    long: dict[int, dict[int, float]] = defaultdict(dict)  # sensitivities by end and start
    for x in assigned_literals(text):
        sensitive = x.sensitivity
        if sensitive < threshold:  # no literal has more than its name
            continue
        if x.end - x.start > LONG and not x.quoted:
            long[x.end][x.start] = sensitive
        elif sensitive * strength(text[x.start : x.end], x.quoted) >= threshold:
            out.append((x.start, x.end))
    for end, names in long.items():
        found = _strengths(text, list(names), end)
        out += [(start, end) for start, sensitive in names.items() if sensitive * found[start] >= threshold]
    return sorted(out)


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, by start and then kind."""
    def by_start(span: tuple[str, int, int]) -> tuple:
        return span[1], KINDS.index(span[0]), span[2]

    base = sorted(base_spans(text), key=by_start)
    more = [
        ("literal", a, b) for a, b in secret_literals(text)
        if not any(x <= a and b <= y for _, x, y in base)
    ]
    return base, sorted(base + more, key=by_start)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with its spans, overlapping ones as one, replaced by ``mark``."""
    out, done = [], 0
    for a, b in sorted((a, b) for _, a, b in spans):
        if a >= done:
            out += [text[done:a], mark]
        done = max(done, b)
    return "".join(out) + text[done:]


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, and all spans."""

    def columns(_: None, texts: pa.Array) -> list:
        found = [scan(t or "") for t in texts.to_pylist()]
        counts = [Counter(kind for kind, _, _ in base) for base, _ in found]
        return [
            *([c[kind] for c in counts] for kind in KINDS[:3]),
            [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
            [joined(spans) for _, spans in found],
        ]

    return map_batches(
        docs.select("doc_id", "text"), lambda: None, columns,
        "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with a mark in place of every secret, and n_chars of that text where there is such a column."""

    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def cleaned(texts):
        return texts.map(lambda t: t if t is None else redacted(t, scan(t)[1]))

    out = docs.withColumn("text", cleaned("text"))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast("bigint")
        out = out.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))
    return out
