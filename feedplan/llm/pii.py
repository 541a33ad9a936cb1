"""Personal data by offset-preserving deobfuscation.

A cascade of three transducers rewrites a text: look-alike characters become
ASCII, spelled digits become digits, and disguised at and dot signs become the
signs. Each rewriting keeps the source range of every character it emits, so an
identifier found in the rewritten text is mapped back to the characters of the
source. Identifiers of the source itself are always found first, and stay.

Defined results: null is the empty text, without spans; offsets are code points,
the end is exclusive; spans of different kinds may overlap; an uncovered span
that touches one of the same kind already found in the source is left out.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.llm.words import small_batches

KINDS = ("email", "ip", "card", "phone")

# What identifiers look like.
_LOCAL, _LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
_DOMAIN = re.compile(rf"[{_LABEL}]+(?:\.[{_LABEL}]+)+")
_LOCAL_TAIL = re.compile(rf"[{_LOCAL}]*\Z")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """Every match has exactly one at sign: the local part is what stands before it, back to the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[Span]:
    """Chains of dotted numbers are cut into fours from the left."""
    for chain in _DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield "ip", at, at + size
            at += size + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for found in _CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", found.start(), found.end()


def _phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
            yield "phone", found.start(), found.end()


_ANY_DIGIT = re.compile("[0-9]")


def identifiers(text: str) -> list[Span]:
    """Identifiers of a text as it is, by kind and start."""
    out = list(_emails(text)) if "@" in text else []
    if _ANY_DIGIT.search(text):
        out += _ips(text)
        out += _cards(text)
        out += _phones(text) if "+" in text else ()
    return out


class Rewritten:
    """A text and the source range of each of its characters: copied stretches and replaced ones."""

    def __init__(self, source: str, edits: list[tuple[int, int, str]]):
        pieces: list[str] = []
        self.at: list[int] = []  # where each stretch begins in the new text
        self.of: list[tuple[int, int, bool]] = []  # its source range, and whether it is copied
        size = done = 0
        for start, end, new in [*edits, (len(source), len(source), "")]:
            for a, b, piece, copied in ((done, start, source[done:start], True), (start, end, new, False)):
                if piece:
                    self.at.append(size)
                    self.of.append((a, b, copied))
                    pieces.append(piece)
                    size += len(piece)
            done = end
        self.text = "".join(pieces)

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source range of a range of the new text, and whether something in it was replaced."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        a, _, copied = self.of[first]
        low = a + start - self.at[first] if copied else a
        c, d, copied = self.of[last]
        high = c + end - self.at[last] if copied else d
        # deleted characters leave no stretch of their own, but a longer source
        return low, high, high - low != end - start or any(not self.of[i][2] for i in range(first, last + 1))


# Letters of other scripts that look like Latin ones, each under what it looks like.
LOOKALIKES = {
    "a": "аαɑ", "b": "Ьь", "c": "сϲ", "d": "ԁ", "e": "еєҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "јϳ", "k": "к", "l": "ӏ",
    "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "т", "u": "υս", "v": "ѵν", "w": "ԝѡ", "x": "хχ",
    "y": "уγ", "z": "ᴢ", "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν",
    "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ", "@": "﹫", ".": "。․•∙", "-": "‐‑‒–—−", "+": "﬩",
    " ": "               　",
    "": "­᠎​‌‍⁠﻿",
}
ENTITIES = {"&#64;": "@", "&commat;": "@", "&#46;": ".", "&period;": ".", "&#43;": "+"}
# Digits as words, by language; words that stand for an at sign and for a dot, in pairs.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine".split(),
    "null eins zwei drei vier fünf sechs sieben acht neun".split(),
    "zéro un deux trois quatre cinq six sept huit neuf".split(),
    "cero uno dos tres cuatro cinco seis siete ocho nueve".split(),
)
AT_DOT = (("at", "dot"), ("klammeraffe", "punkt"), ("arobase", "point"), ("arroba", "punto"))
#: Last labels that end a domain whose signs are all spelled out.
TOP_LABELS = "com org net edu gov mil int info biz io co ai app dev me tv eu us uk ca au de at ch fr be es it nl pt br mx jp cn in ru example test"


@lru_cache(1)
def _lookalikes() -> tuple[re.Pattern, dict[str, str]]:
    to = {c: latin for latin, others in LOOKALIKES.items() for c in others}
    for point in range(0x80, 0x20000):
        c = chr(point)
        kind = unicodedata.category(c)
        if kind == "Nd":
            to[c] = str(unicodedata.decimal(c))
        elif c not in to and kind[0] in "LPS" and kind not in ("Lo", "Lm", "Sk") and unicodedata.combining(c) == 0:
            plain = unicodedata.normalize("NFKC", c)  # full width and mathematical letters, small and full width signs
            if len(plain) == 1 and plain.isascii():
                to[c] = plain
    chars = "".join(re.escape(c) for c in sorted(to))
    return re.compile(f"[{chars}]|" + "|".join(map(re.escape, ENTITIES))), to | ENTITIES


def plain_characters(text: str) -> list[tuple[int, int, str]]:
    """First transducer: look-alikes and entities."""
    pattern, to = _lookalikes()
    return [(m.start(), m.end(), to[m[0]]) for m in pattern.finditer(text)]


@lru_cache(1)
def _number_runs() -> list[tuple[re.Pattern, re.Pattern, dict[str, str]]]:
    out = []
    for words, (_, dot) in zip(DIGIT_WORDS, (AT_DOT[0], AT_DOT[1], AT_DOT[2], AT_DOT[3]), strict=True):
        word = "|".join(words)
        unit = rf"(?:(?:double|triple)[ -])?(?:{word}|[0-9]+)"
        gap = rf"(?:[ ,-]{{1,3}}|\s+{dot}\s+|\.)"
        run = rf"(?<![^\W_])(?:plus[ -]|\+)?(?:{word})(?:{gap}{unit}){{2,}}(?![^\W_])"
        token = rf"(plus[ -]|\+)|(double[ -]|triple[ -])?({word}|[0-9]+)|(\s+{dot}\s+|\.)|[ ,-]+"
        out.append((re.compile(run, re.I), re.compile(token, re.I), {w: str(i) for i, w in enumerate(words)}))
    return out


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Second transducer: runs of three or more digits, the first one spelled, lose what stands between them."""
    edits: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []  # runs so far, in order
    for runs, tokens, value in _number_runs():
        own: list[tuple[int, int]] = []
        for run in runs.finditer(text):
            before = bisect_left(taken, (run.end(),)) - 1
            if before >= 0 and taken[before][1] > run.start():
                continue  # the same run in another language
            own.append(run.span())
            for t in tokens.finditer(run[0]):
                at = run.start() + t.start()
                if t[1]:
                    new = "+"
                elif t[3]:
                    digit = value.get(t[3].lower(), t[3])
                    new = digit * {"d": 2, "t": 3}[t[2][0].lower()] if t[2] else digit
                else:
                    new = "." if t[4] else ""
                edits.append((at, run.start() + t.end(), new))
        taken = sorted(taken + own)
    edits.sort()
    return edits


@lru_cache(1)
def _signs() -> tuple[re.Pattern, list[re.Pattern], list[re.Pattern]]:
    """At and dot in brackets; by language a spelled at sign with the domain behind it, and the signs inside an address."""
    ats = "|".join(a for a, _ in AT_DOT)
    dots = "|".join(d for _, d in AT_DOT)
    bracketed = re.compile(
        rf"(?<=[{_LOCAL}])\s*[\[({{<]\s*(?:(?P<at>{ats}|@)|(?:{dots}|\.))\s*[\])}}>]\s*(?=[A-Za-z0-9])", re.I
    )
    top = "|".join(TOP_LABELS.split())
    behind, inner = [], []
    for at, dot in AT_DOT:
        label = rf"[{_LABEL}]+"
        sign = rf"(?:[\s_]+{dot}[\s_]+|\.)"
        last = rf"(?:[\s_]+{dot}[\s_]+(?:{top})(?![^\W_])|\.(?:{top})(?![^\W_]))"
        domain = rf"{label}(?:{sign}{label})*?{last}"
        behind.append(re.compile(rf"(?<=[A-Za-z0-9%+-])[\s_]+{at}[\s_]+(?={label}(?:{sign}{label})*[\s_]+{dot}[\s_]){domain}", re.I))
        inner.append(re.compile(rf"[\s_]+(?:(?P<at>{at})|{dot})[\s_]+", re.I))
    return bracketed, behind, inner


_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_%+-")


def _local_part(text: str, low: str, end: int, floor: int, dot: str) -> int | None:
    """Where the names that are joined by dots, spelled or not, and end here begin; None if no address can."""

    def back(at: int, inside) -> int:  # noqa: ANN001
        while at > floor and inside(text[at - 1]):
            at -= 1
        return at

    begin = back(end, _NAME.__contains__)
    while begin > floor:
        if text[begin - 1] == ".":
            before = begin - 1
        else:
            word = back(begin, lambda c: c == "_" or c.isspace())
            before = back(word - len(dot), lambda c: c == "_" or c.isspace())
            if word == begin or low[word - len(dot) : word] != dot or before >= word - len(dot):
                break
        name = back(before, _NAME.__contains__)
        if name == before:
            break
        begin = name
    return None if begin == end or (begin > 0 and text[begin - 1] == ".") else begin


def spelled_signs(text: str) -> list[tuple[int, int, str]]:
    """Third transducer: at and dot in brackets; and spelled out bare, when a known last label ends the domain.

    Bare ones are found from the at sign: the domain is read on from there, and the names before it back to the end
    of the address before, so that no part of a text is read for every word of it."""
    low = text.lower()
    if len(low) != len(text):  # a letter with a longer lower case: only ASCII is looked for
        low = "".join(c.lower() if c.isascii() else c for c in text)
    if not any(d in low for _, d in AT_DOT) and not any(a in low for a, _ in AT_DOT):
        return []
    bracketed, behind, inner = _signs()
    edits = []
    if any(b in text for b in "[({<"):
        edits += [(m.start(), m.end(), "@" if m["at"] else ".") for m in bracketed.finditer(text)]
    for (_, dot), pattern, signs in zip(AT_DOT, behind, inner, strict=True):
        floor = 0
        if dot in low:
            for m in pattern.finditer(text):
                begin = _local_part(text, low, m.start(), floor, dot)
                if begin is not None:
                    floor = m.end()
                    edits += [(s.start(), s.end(), "@" if s["at"] else ".") for s in signs.finditer(text, begin, m.end())]
    edits.sort()
    out: list[tuple[int, int, str]] = []
    for edit in edits:
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


@lru_cache(1)
def _may_hide() -> str:
    """A pattern for a linear-time engine: texts without a match are left as they are by all transducers."""
    pattern, to = _lookalikes()
    chars = "".join(f"\\x{{{ord(c):X}}}" for c in sorted(to) if len(c) == 1)
    words = "|".join(w for words in DIGIT_WORDS for w in words)
    gap = "(?:[ ,-]{1,3}|\\s+(?:" + "|".join(d for _, d in AT_DOT) + ")\\s+|\\.)"
    run = f"(?:{words})(?:{gap}(?:(?:double|triple)[ -])?(?:{words}|[0-9]+)){{2}}"
    ats, dots = ("|".join(x) for x in zip(*AT_DOT, strict=True))
    bracketed = rf"[\[({{<]\s*(?:{ats}|{dots}|@|\.)\s*[\])}}>]"
    spelled = "|".join(rf"[\s_]{a}[\s_]+[{_LABEL}]+(?:(?:[\s_]+{d}[\s_]+|\.)[{_LABEL}]+)*[\s_]+{d}[\s_]" for a, d in AT_DOT)
    return f"[{chars}]|{'|'.join(ENTITIES)}|(?i:{run}|{bracketed}|{spelled})"


def disguised(texts: pa.Array) -> list[bool]:
    """Which texts a transducer may change."""
    return pc.fill_null(pc.match_substring_regex(texts, _may_hide()), False).to_pylist()


def find(text: str, hides: bool = True) -> tuple[list[Span], list[Span]]:
    """Identifiers of the text as it is, and those that its disguises hide."""
    base = identifiers(text)
    if not hides:
        return base, []
    steps = []
    now = text
    for transducer in (plain_characters, spelled_digits, spelled_signs):
        edits = transducer(now)
        if edits:
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    more: list[Span] = []
    for kind, start, end in identifiers(now) if steps else ():
        touched = False
        for step in reversed(steps):
            start, end, replaced = step.back(start, end)
            touched |= replaced
        if touched and not any(k == kind and s < end and start < e for k, s, e in base):
            more.append((kind, start, end))
    return base, more


_SPANS = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"


def personal_data(text: Column) -> Column:
    """All spans of a text, by kind and start."""

    @F.arrow_udf(_SPANS)
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind_of = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())])
        for texts in batches:
            rows = []
            for value, hides in zip(texts, disguised(texts), strict=True):
                base, more = find(value.as_py() or "", hides)
                spans = [(KINDS.index(k), s, e, d) for found, d in ((base, False), (more, True)) for k, s, e in found]
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "disguised": d} for k, s, e, d in sorted(spans)])
            yield pa.array(rows, pa.list_(kind_of))

    return detect(text)


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: counts of the identifiers it shows, their digest, all spans, and how many were disguised."""
    small_batches(docs.sparkSession)
    found = docs.select(id_column, personal_data(F.col(text_column)).alias("__s"))
    shown = F.filter("__s", lambda s: ~s["disguised"])
    counts = [F.expr(f"cast(size(filter(__s, s -> not s.disguised and s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select(
        id_column,
        *counts,
        F.sha2(joined_spans(shown), 256).alias("base_sha256"),
        joined_spans(F.col("__s")).alias("spans"),
        F.size(F.filter("__s", lambda s: s["disguised"])).cast("bigint").alias("n_disguised"),
    )
