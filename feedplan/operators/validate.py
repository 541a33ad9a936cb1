"""Validation rules that emit diagnostics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.functions.text import is_blank, is_email
from feedplan.operators.enrich import row_key
from feedplan.operators.lookup import distinct_keys, lookup, salts_of

# A check turns a column into a list of diagnostics (SQL text).
Check = Callable[[str], str]


@dataclass(frozen=True)
class FieldRule:
    """Rule of one field: ``attr`` is the column, ``field`` its public name.

    A ``secret`` field may be absent from the row when the vault candidates
    hold it or when it is going to be generated.
    """

    attr: str
    field: str
    required: bool = False
    checks: tuple[Check, ...] = ()
    text: bool = True
    secret: bool = False


def email_form(field: str) -> Check:
    error = dx.diagnostic(dx.VALIDATE, "INVALID_EMAIL", field, f"{field} has invalid format")
    return lambda c: dx.emit(f"{c} is not null and not {is_email(c)}", error)


def positive_int(field: str) -> Check:
    error = dx.diagnostic(dx.VALIDATE, "INVALID_INT", field, f"{field} must be an integer > 0")
    return lambda c: dx.emit(f"{c} <= 0", error)


def must_be_empty(field: str, code: str) -> Check:
    error = dx.diagnostic(dx.VALIDATE, code, field, f"{field} must be empty or null")
    return lambda c: dx.emit(f"not {is_blank(c)}", error)


def must_be_known(field: str, code: str, marker: str) -> Check:
    """The marker column tells whether a lookup found the value."""
    error = dx.diagnostic(dx.VALIDATE, code, field, f"{field} not found in cache")
    return lambda c: dx.emit(f"{c} is not null and {marker} is null", error)


def mark_known(rows: DataFrame, keys: DataFrame, column: str, key: str, marker: str, salts: int | None = None) -> DataFrame:
    """Add ``marker`` = true where ``column`` occurs among ``keys``.

    The key table is a dimension: it is repeated per salt, which spreads the
    rows of one popular value over several tasks.
    """
    return lookup(rows, distinct_keys(keys, key, marker=marker), {column: key}, "line_no", salts=salts or salts_of(rows.sparkSession))


def validate(rows: DataFrame, rules: Sequence[FieldRule], keep_warnings: bool = False) -> DataFrame:
    """Run the rules on rows without earlier errors.

    A missing required field stops the checks of that field, unless the vault
    candidates hold it.
    """
    parts = []
    for rule in rules:
        found = dx.gather([check(rule.attr) for check in rule.checks])
        if rule.required:
            gap = is_blank(rule.attr) if rule.text else f"{rule.attr} is null"
            if rule.secret:
                gap += f" and {is_blank(f"secrets['{rule.attr}']")}"
                gap += " and not secret_generated" if "secret_generated" in rows.columns else ""
            error = dx.diagnostic(
                dx.VALIDATE, "REQUIRED_FIELD_MISSING", rule.field, f"{rule.field} is required"
            )
            found = f"if({gap}, array({error}), {found})"
        parts.append(found)
    columns = {"errors": f"if({dx.CLEAN}, {dx.gather(parts)}, errors)"}
    if not keep_warnings:
        columns["warnings"] = dx.NONE
    return rows.selectExpr(*[f"{columns.get(c, c)} as {c}" for c in rows.columns])


def valid_rows(rows: DataFrame) -> DataFrame:
    return rows.where(dx.CLEAN)


def blocked_rows(rows: DataFrame) -> DataFrame:
    return rows.where(dx.FAILED)


def duplicate_report(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several rows of one feed share: key, value, row count and
    first line.  Counted before the shuffle, so a frequent key costs one row
    per task."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys])
    return (
        rows.select("line_no", F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count("*").alias("n_rows"), F.min("line_no").alias("first_line_no"))
        .filter("n_rows > 1")
    )


def dropped_rows(rows: DataFrame) -> DataFrame:
    """One record per error of the rows that never reach validation."""
    return error_rows(rows.where(dx.FAILED))


def error_rows(rows: DataFrame) -> DataFrame:
    """(source_id, line_no, ord, stage, code, field, message), one row per error; no source where the rows have none."""
    keys = row_key(rows)
    return rows.select(*keys, F.posexplode("errors").alias("ord", "error")).select(*keys, "ord", "error.*")
