"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

The patterns find assignments, access keys and long hexadecimal runs.  On top,
each run of token characters is a candidate: for its character class (hex,
lower case with digits, upper case with digits, letters with digits, base64) a window moves over it one character at a time, counts go up and down
by one, and the Shannon entropy of the window follows from the two counts
that changed.  Windows at or over the class's threshold join into spans of
kind ``entropy``.  The allow list suppresses what is known to be harmless:
candidates without both a letter and a digit (words, numbers), UUIDs,
placeholders, dotted names and paths made of words; a span inside a pattern's
span is not told twice.

Defined results: null or empty text has no spans; repeated rows give repeated
rows; an empty table gives an empty table; other columns are ignored; spans
are code points of the whole text, end exclusive.
"""

from __future__ import annotations

import bisect
import functools
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import map_texts

# Patterns of the base kinds, in the order in which they are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 or more characters; a shorter run holds no other match
HEX = re.compile(r"[0-9a-f]{24,}")         # runs are maximal, so the length can be part of the pattern


@dataclass(frozen=True)
class EntropyRule:
    """A character class, the window over its runs, and the bits a character needs.

    The bits of windows of 16 are those that 99 % of random windows of the class reach (upper case: of A-Z2-7).
    """
    name: str
    chars: str
    window: int
    bits: float


@dataclass(frozen=True)
class Scan:
    """Parameters of the entropy scan."""
    rules: tuple[EntropyRule, ...] = (
        EntropyRule("hex", "0123456789abcdefABCDEF", 24, 3.0),
        EntropyRule("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 24, 4.0),
        EntropyRule("hex16", "0123456789abcdefABCDEF", 16, 2.68),
        EntropyRule("lower16", "abcdefghijklmnopqrstuvwxyz0123456789", 16, 3.12),
        EntropyRule("upper16", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 16, 3.07),
        EntropyRule("alnum16", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 16, 3.32),
    )
    allow: tuple[str, ...] = field(default=(
        r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
        r"[A-Za-z_/=+-]*", r"[0-9_/=+-]*", r"(?:[A-Za-z]*[0-9]{0,4}[_/=+-])*[A-Za-z]*[0-9]{0,4}",
        r"(?i:.*(?:example|sample|placeholder|dummy|xxxx).*)",
    ))


def entropy_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Joined [start, end) spans of windows whose entropy is ``bits`` or more.

    With n = window, entropy is log2(n) - sum(c * log2(c)) / n over the counts c.
    """
    if len(text) < window:
        return []
    cost = [0.0, *(c * math.log2(c) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    total, most, spans = 0.0, window * (math.log2(window) - bits) + 1e-9, []
    for i, char in enumerate(text):
        if i >= window:
            old = text[i - window]
            counts[old] -= 1
            total += cost[counts[old]] - cost[counts[old] + 1]
        c = counts[char] = counts.get(char, 0) + 1
        total += cost[c] - cost[c - 1]
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


class Scanner:
    """Finds spans (start, kind, end) in one text."""

    def __init__(self, scan: Scan):
        self.rules = [(re.compile(f"[{re.escape(r.chars)}]{{{r.window},}}"), r) for r in scan.rules]
        self.allow = re.compile("|".join(f"(?:{a})" for a in scan.allow)) if scan.allow else None

    def base(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        if "=" in text or ":" in text:  # an assignment has one
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        spans: set[tuple[int, int]] = set()
        for pattern, rule in self.rules:
            for match in pattern.finditer(text):
                if self.allow and self.allow.fullmatch(match[0]):
                    continue
                spans.update((match.start() + a, match.start() + b)
                             for a, b in entropy_windows(match[0], rule.window, rule.bits))
        joined: list[tuple[int, int]] = []
        for a, b in sorted(spans):
            if joined and a < joined[-1][1]:
                joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
            else:
                joined.append((a, b))
        told = _outer(base)
        return [(a, 3, b) for a, b in joined if not _within(told, a, b)]


def _outer(base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Base spans joined where they overlap, by start."""
    out: list[tuple[int, int]] = []
    for a, _, b in base:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _within(spans: list[tuple[int, int]], a: int, b: int) -> bool:
    i = bisect.bisect_right(spans, (a, math.inf)) - 1
    return i >= 0 and spans[i][1] >= b


def _tell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(scan: Scan):
    scanner = Scanner(scan)

    def work(texts) -> list:
        out: list = [[] for _ in range(5)]
        for text in texts:
            base = scanner.base(text)
            for kind in range(3):
                out[kind].append(sum(k == kind for _, k, _ in base))
            out[3].append(_tell(base))
            out[4].append(_tell(sorted(base + scanner.added(text, base))))
        return out

    return work


def secret_spans(docs: DataFrame, scan: Scan = Scan(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_spans, spans: all spans of every
    document as kind:start:end, by start, then kind as listed, comma-joined."""
    return map_texts(docs, functools.partial(_scan, scan),
                     "n_assign long, n_access long, n_hex long, base_spans string, spans string", id_col, text_col)


def redact(docs: DataFrame, scan: Scan = Scan(), mark: str = "[secret]", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, text with every span (joined where they overlap) replaced by ``mark``."""
    return map_texts(docs, functools.partial(_redact, scan, mark), "text string", id_col, text_col)


def _redact(scan: Scan, mark: str):
    scanner = Scanner(scan)

    def one(text: str) -> str:
        base = scanner.base(text)
        for a, b in reversed(_outer(sorted(base + scanner.added(text, base)))):
            text = text[:a] + mark + text[b:]
        return text

    return lambda texts: [[one(t) for t in texts]]


def secret_digests(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """``secret_spans`` with the base spans as their digest."""
    found = secret_spans(docs, scan)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")
