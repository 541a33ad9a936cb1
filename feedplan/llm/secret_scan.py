"""Secret scan in DataFrame expressions only: known forms, and entropy of candidate strings.

Known forms are found by pattern. Besides them, long strings without blanks are
candidates. A window slides over each candidate; the sum of n log n over the
counts n of its characters is kept up to date from the two characters that enter
and leave, and gives the Shannon entropy of the window. The threshold depends
on the character class of the candidate (hexadecimal digits; lower-case letters
with digits; mixed case with digits). Windows above it are united to a span,
unless the candidate is on the allow list (identifiers in UUID form, digests
announced as such, addresses, placeholders, runs of the alphabet).

Offsets are code points, the end is exclusive. The place of a match is the sum of
the lengths of the matches before it and of the pieces between them.

Defined results: null is the empty text, without spans; an entropy span that
touches a span of a known form is left out; equal rows give equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# Known forms. A key's own name and signs come before its value, the last group.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6

# What is no secret though it looks random.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)(example|sample|placeholder|dummy|changeme|redacted|your[-_]?(key|token|secret)|x{6,}|0{8,}|1234567|abcdefg|qwerty)",
    r"(?i)^(sha(1|256|384|512)|md5)[-=:]",
    r"(?i)^(src|integrity|href|data)=",
    r"^[A-Z0-9]+([_-][A-Z0-9]+)*$",
    r"^/?([a-zA-Z][a-z]+[0-9]{0,3}[/_=+-])+[a-zA-Z]?[a-z]*[0-9]{0,3}$",
)


@dataclass(frozen=True)
class Windows:
    """Characters of a window, and bits per character from which a window of each class counts."""

    size: int = 20
    hexadecimal: float = 2.9
    lower: float = 3.4
    mixed: float = 3.7
    candidate: str = "[A-Za-z0-9+/_=-]"


def _let(value: str, name: str, body: str) -> str:
    """SQL for the body with a value that is worked out once, however often lambdas in the body use it."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


#: Matches whose places are added up one after the other; texts with more have them added up by such chunks.
_CHUNK = 256


def _found(text: str, matches: str, pattern: str) -> str:
    """SQL for structs (start, size, match) of the matches in order of place; start counts from 0.

    Places are sums of the lengths of matches and of what stands between them, in chunks: the work for a text does not
    grow with the square of its matches."""
    gaps = _let(f"split({text}, {pattern}, -1)", "g", "transform(__m, (m, i) -> named_struct('gap', length(g[i]), 'size', length(m)))")
    chunks = f"transform(sequence(0, (size(d) - 1) div {_CHUNK}), k -> slice(d, cast(k * {_CHUNK} + 1 as int), {_CHUNK}))"
    sums = "aggregate(transform(c, x -> aggregate(x, 0, (n, e) -> n + e.gap + e.size)), array(0), (all, n) -> concat(all, array(element_at(all, -1) + n)))"
    inner = """aggregate(x, named_struct('at', b[k], 'all', cast(array() as array<int>)),
        (acc, e) -> named_struct('at', acc.at + e.gap + e.size, 'all', concat(acc.all, array(acc.at + e.gap))), acc -> acc.all)"""
    starts = _let(gaps, "d", _let(chunks, "c", _let(sums, "b", f"flatten(transform(c, (x, k) -> {inner}))")))
    rows = _let(starts, "s", "transform(__m, (m, i) -> named_struct('start', s[i], 'size', length(m), 'match', m))")
    none = "cast(array() as array<struct<start:int,size:int,match:string>>)"
    return f"case when size({matches}) > 0 then {rows} else {none} end".replace("__m", matches)


def _literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


def _n_log_n(n: str) -> str:
    return f"(case when {n} > 1 then {n} * log2({n}) else 0D end)"


def _window_hits(candidate: str, windows: Windows) -> str:
    """SQL for (first, last): starts of the first and the last window of a candidate above its threshold; null without one.

    State: the place of each character in the list of distinct ones, their counts in the window, and the sum of n log n."""
    w = windows.size
    threshold = f"""case when {candidate} rlike '^[0-9a-fA-F]+$' and {candidate} rlike '[0-9]' and {candidate} rlike '[a-fA-F]' then {windows.hexadecimal}D
        when {candidate} rlike '[0-9].*[0-9].*[0-9]' and {candidate} rlike '[A-Z]' and {candidate} rlike '[a-z]' then {windows.mixed}D
        when {candidate} rlike '[0-9].*[0-9].*[0-9]' and {candidate} rlike '[a-z]' then {windows.lower}D end"""
    enters, leaves = "p.codes[i]", f"(case when i >= {w} then p.codes[i - {w}] else -1 end)"
    count_in, count_out = f"coalesce(get(s.n, {enters}), 0)", f"coalesce(get(s.n, {leaves}), 0)"
    added = f"{_n_log_n(f'({count_in} + 1)')} - {_n_log_n(count_in)}"
    removed = f"(case when i >= {w} then {_n_log_n(f'({count_out} - 1)')} - {_n_log_n(count_out)} else 0D end)"
    # a character that leaves as the same one enters changes nothing
    total = f"(case when {enters} = {leaves} then s.total else s.total + {added} + {removed} end)"
    counts = f"transform(s.n, (n, j) -> n + cast(j = {enters} as int) - cast(j = {leaves} as int))"
    high = f"(i >= {w - 1} and log2({w}D) - t.total / {w} >= p.threshold)"
    codes = _let("array_distinct(cs)", "ds", f"named_struct('codes', transform(cs, c -> array_position(ds, c) - 1), 'kinds', size(ds), 'threshold', {threshold})")
    return f"""element_at(transform(array({_let(f"split({candidate}, '')", "cs", codes)}), p -> case when p.threshold is not null then
      aggregate(sequence(0, length({candidate}) - 1),
        named_struct('n', array_repeat(0, p.kinds), 'total', 0D, 'first', cast(null as int), 'last', cast(null as int)),
        (s, i) -> element_at(transform(array(named_struct('n', {counts}, 'total', {total})), t -> named_struct('n', t.n, 'total', t.total,
          'first', case when s.first is null and {high} then i - {w - 1} else s.first end,
          'last', case when {high} then i - {w - 1} else s.last end)), 1),
        s -> named_struct('first', s.first, 'last', s.last)) end), 1)"""


_SPAN = "array<struct<start:int,kind:int,end:int>>"


def with_spans(docs: DataFrame, text_column: str = "text", column: str = "secrets", windows: Windows | None = None) -> DataFrame:
    """The documents with their spans (start, kind as a place in KINDS, end), by start and kind."""
    windows = windows or Windows()
    names = [f"__{n}_{column}" for n in ("text", "assign", "access", "hex", "long", "known")]
    text, assign, access, hexes, long_, known = names
    least = f"{windows.candidate}{{{windows.size},}}"
    quick = f"lower({text}) rlike 'passw|secret|token|api'"
    none = "cast(array() as array<string>)"
    out = docs.withColumn(text, F.coalesce(F.col(text_column), F.lit("")))
    out = out.withColumns(
        {
            assign: F.expr(f"case when {quick} then regexp_extract_all({text}, {_literal(ASSIGN)}, 0) else {none} end"),
            access: F.expr(f"case when contains({text}, 'AKIA') then regexp_extract_all({text}, {_literal(ACCESS)}, 0) else {none} end"),
            hexes: F.expr(f"regexp_extract_all({text}, {_literal(HEX)}, 0)"),
            long_: F.expr(f"regexp_extract_all({text}, {_literal(least)}, 0)"),
        }
    )
    value = f"regexp_extract(m.match, {_literal(ASSIGN)}, 1)"
    kinds = [
        f"filter({_found(text, assign, _literal(ASSIGN))}, m -> length({value}) >= {LEAST_VALUE})",
        _found(text, access, _literal(ACCESS)),
        _found(text, hexes, _literal(HEX)),
    ]
    spans = [f"transform({found}, m -> named_struct('start', m.start, 'kind', {i}, 'end', m.start + m.size))" for i, found in enumerate(kinds)]
    out = out.withColumn(known, F.expr(f"array_sort(concat({', '.join(spans)}))"))
    allowed = " or ".join(f"m.match rlike {_literal(p)}" for p in ALLOWED)
    # a candidate that is a known form from end to end would be left out at last
    candidates = f"filter({_found(text, long_, _literal(least))}, m -> m.match rlike {_literal('[0-9]')} and not m.match rlike {_literal(f'^{HEX}$')} and not ({allowed}))"
    hits = f"transform({candidates}, m -> named_struct('at', m.start, 'hit', {_window_hits('m.match', windows)}))"
    touched = f"exists({known}, k -> k.start < e.end and e.start < k.end)"
    entropy = f"""filter(transform(filter({hits}, h -> h.hit.first is not null), h -> named_struct('start', h.at + h.hit.first, 'kind', 3,
        'end', h.at + h.hit.last + {windows.size})), e -> not {touched})"""
    out = out.withColumn(column, F.expr(f"cast(case when size({long_}) > 0 then array_sort(concat({known}, {entropy})) else {known} end as {_SPAN})"))
    return out.drop(*names)


def joined_spans(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", windows: Windows | None = None) -> DataFrame:
    """One row per document: counts of the known forms, their digest, and all spans. Nothing is shuffled."""
    found = with_spans(docs.select(id_column, text_column), text_column, "__s", windows).drop(text_column)
    known = F.filter("__s", lambda s: s["kind"] < 3)
    counts = [F.expr(f"cast(size(filter(__s, s -> s.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select(id_column, *counts, F.sha2(joined_spans(known), 256).alias("base_sha256"), joined_spans(F.col("__s")).alias("spans"))


def redacted(docs: DataFrame, text_column: str = "text", mark: str = "[SECRET]", windows: Windows | None = None) -> DataFrame:
    """The documents with each united span of their texts replaced by a mark; other texts, and nulls, stay as they are."""
    found = with_spans(docs, text_column, "__spans", windows)
    cut = f"""aggregate(__spans, named_struct('at', 0, 'out', ''), (s, x) -> case
        when x.start >= s.at then named_struct('at', x.end, 'out', concat(s.out, substring(`{text_column}`, s.at + 1, x.start - s.at), '{mark}'))
        else named_struct('at', greatest(s.at, x.end), 'out', s.out) end,
        s -> concat(s.out, substring(`{text_column}`, s.at + 1)))"""
    return found.withColumn(text_column, F.expr(f"case when size(__spans) > 0 then {cut} else `{text_column}` end")).drop("__spans")
