"""Typed coercion with diagnostics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from feedplan.functions import diagnostics as dx
from feedplan.functions.text import normalize_text, strict_bool, strict_int

# A parser takes a column and returns the typed value and, or None, the
# diagnostic for a bad value (SQL text).
Parser = Callable[[str], tuple[str, str | None]]


def as_text(c: str) -> tuple[str, str | None]:
    return normalize_text(c), None


def as_bool(field: str) -> Parser:
    error = dx.diagnostic(dx.NORMALIZE, "INVALID_BOOLEAN", field, f"{field} must be 'true' or 'false'")
    return lambda c: (strict_bool(c), error)


def as_int(field: str) -> Parser:
    error = dx.diagnostic(dx.NORMALIZE, "INVALID_INT", field, f"{field} must be an integer")
    return lambda c: (strict_int(c), error)


@dataclass(frozen=True)
class NormalizeRule:
    """How one column is coerced.

    ``checks`` are extra rules on the parsed value, each giving an error list.
    """

    target: str
    source: str
    parser: Parser = as_text
    required: bool = False
    checks: tuple[Callable[[str], str], ...] = ()


def normalize(rows: DataFrame, rules: Sequence[NormalizeRule]) -> DataFrame:
    """Apply every rule; errors of all fields add up.

    NULL cells are not parsed.  A row with an error keeps the values that
    could be read, but every later stage looks at clean rows only; use
    ``clean_values`` where a failed row must show no values.
    """
    replaced = {*(r.target for r in rules), *(r.source for r in rules), "errors"}
    kept = [c for c in rows.columns if c not in replaced]
    # values first, errors in a second projection: each cell is parsed once
    values, raws, failures = [], {}, []
    for rule in rules:
        value, error = rule.parser(rule.source)
        values.append(f"{value} as {rule.target}")
        raw = f"__raw_{rule.source}"
        if rule.required:
            missing = dx.diagnostic(
                dx.NORMALIZE, "REQUIRED_FIELD_MISSING", rule.source, f"{rule.source} is required"
            )
            failures.append(dx.emit(f"{raw} is null", missing))
        if error is not None:
            failures.append(dx.emit(f"{raw} is not null and {rule.target} is null", error))
        failures += [f"if({raw} is not null, {check(rule.target)}, {dx.NONE})" for check in rule.checks]
        if rule.required or error is not None or rule.checks:
            raws[rule.source] = f"{rule.source} as {raw}"
    typed = rows.selectExpr(*kept, "errors", *values, *raws.values())
    return typed.selectExpr(*kept, *[r.target for r in rules], f"{dx.gather(['errors', *failures])} as errors")


def clean_values(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The given columns as NULL on rows with errors."""
    return rows.selectExpr(
        *[f"if({dx.CLEAN}, {c}, null) as {c}" if c in columns else c for c in rows.columns]
    )
