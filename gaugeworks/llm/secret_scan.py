"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"
KINDS = ["assign", "access", "hex", "entropy"]

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12

#: Class: its characters, window, least entropy in bits. Random strings of the class lie above, words below.
CLASSES = {
    "hex": (re.compile(r"[0-9A-Fa-f]{20,}"), 20, 2.9),
    "alnum": (re.compile(r"[0-9A-Za-z]{20,}"), 20, 3.8),
    "base64": (re.compile(r"[0-9A-Za-z+/=_-]{24,}"), 24, 4.0),
}
CANDIDATE = re.compile(r"[0-9A-Za-z+/=_-]{20,}")
PART = re.compile(r"[0-9A-Za-z]+")
LEAST_PART = 20  # a stretch of a part that is this long is judged by itself, whatever stands beside it
#: Whole strings that look random but are no secrets: words of letters, plain numbers, identifiers in UUID form.
ALLOW = [r"[A-Za-z+/=_-]+", r"[0-9+/=_-]+", r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"]
#: Placeholders: they and the short rest of their part between separators are no secret, what they are joined to may be one.
PLACEHOLDERS = [r"(?i:example|placeholder|changeme|x{6,}|0123456789|abcdefghij)"]


def entropy_windows(text: str, window: int, least: float) -> Iterator[tuple[int, int]]:
    """Merged stretches whose windows reach the entropy; counts change by one character a step."""
    if len(text) < window:
        return
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, stretch = 0.0, None
    for i, c in enumerate(text):
        k = counts.get(c, 0)
        total += term[k + 1] - term[k]
        counts[c] = k + 1
        if i >= window:
            k = counts[text[i - window]]
            total += term[k - 1] - term[k]
            counts[text[i - window]] = k - 1
        if i >= window - 1 and math.log2(window) - total / window >= least - 1e-9:
            start = i - window + 1
            if stretch and start <= stretch[1]:
                stretch = (stretch[0], i + 1)
            else:
                if stretch:
                    yield stretch
                stretch = (start, i + 1)
    if stretch:
        yield stretch


def beside(text: str, placeholders: re.Pattern) -> Iterator[tuple[int, int]]:
    """Stretches of ``text`` without placeholders and without the ends of under ``LEAST_PART`` characters of the parts they stand in."""
    blanks: list[tuple[int, int]] = []
    for part in PART.finditer(text):
        marks = [m.span() for m in placeholders.finditer(text, *part.span()) if m[0]]
        if marks:
            edges = [part.start(), *(e for m in marks for e in m), part.end()]
            blanks += marks + [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a < LEAST_PART]
    at = 0
    for a, b in sorted(blanks):
        if at < a:
            yield at, a
        at = max(at, b)
    if at < len(text):
        yield at, len(text)


def find_spans(text: str | None, allow: re.Pattern, placeholders: re.Pattern = re.compile("|".join(PLACEHOLDERS))) -> list[tuple[str, int, int]]:
    """Spans by start, then by kind in the order of ``KINDS``."""
    if not text:
        return []
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    random: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        if allow.fullmatch(m[0]):
            continue
        for chars, window, least in CLASSES.values():
            for run in chars.finditer(m[0]):
                for first, last in beside(run[0], placeholders):
                    part = run[0][first:last]
                    if len(part) >= window and not allow.fullmatch(part):
                        at = m.start() + run.start() + first
                        random += [(at + a, at + b) for a, b in entropy_windows(part, window, least)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(random):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    found += [("entropy", a, b) for a, b in merged]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def any_of(patterns: list[str]) -> re.Pattern:
    return re.compile("|".join(f"(?:{p})" for p in patterns) or r"(?!)")


def scan(docs: DataFrame, text: str = "text", allow: list[str] | None = None, placeholders: list[str] | None = None, into: str = "spans") -> DataFrame:
    """Add ``into``: array of (kind, start, end), in code points, end exclusive; an existing column of that name is replaced.

    ``allow``: patterns of whole strings that are no secrets. ``placeholders``: words that make the part they stand in harmless, but not what is
    joined to it by ``+/=_-`` nor a stretch of ``LEAST_PART`` characters beside them. Null and empty texts have no spans. Every row is scanned on its own, so ties, repeated rows and an
    empty table need nothing special.
    """
    allowed, words = any_of(ALLOW if allow is None else allow), any_of(PLACEHOLDERS if placeholders is None else placeholders)

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t, allowed, words)] for t in texts], dtype=object)

    return docs.withColumn(into, spans(F.col(text)))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", spans: str = "spans", mark: str = "[secret]") -> DataFrame:
    """Replace every span by a mark; spans that overlap get one mark. Null text stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, f in zip(texts, found, strict=True):
            if t is None or f is None or len(f) == 0:
                out.append(t)
                continue
            parts, at = [], 0
            for a, b in sorted((s["start"], s["end"]) for s in f):
                if a >= at:
                    parts += [t[at:a], mark]
                at = max(at, b)
            out.append("".join(parts) + t[at:])
        return pd.Series(out, dtype=object)

    return docs.withColumn(text, clean(F.col(text), F.col(spans)))
