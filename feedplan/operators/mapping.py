"""Mapping of raw feed cells to canonical columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from feedplan.functions.diagnostics import NONE
from feedplan.functions.text import is_blank, quoted, trim_to_null


@dataclass(frozen=True)
class Mapping:
    """Declarative mapping: canonical column -> SQL expression over raw cells.

    ``secrets`` lists the canonical columns that go to the vault.
    """

    columns: dict[str, str]
    raw: tuple[str, ...]
    secrets: tuple[str, ...] = ()
    carried: tuple[str, ...] = ("source_id", "line_no", "record_id")


def secret_candidates(fields: tuple[str, ...]) -> str:
    """MAP of the non-blank secret fields of a row."""
    none = "cast(array() as array<struct<key:string,value:string>>)"
    parts = [
        f"if(not {is_blank(f)}, array(named_struct('key', {quoted(f)}, 'value', {f})), {none})" for f in fields
    ]
    return f"map_from_entries(concat({', '.join([none, *parts])}))"


def map_records(raw: DataFrame, mapping: Mapping) -> DataFrame:
    """Canonical columns plus the diagnostics columns every later stage uses.

    Raw cells are trimmed first, so that the expressions of the mapping see
    either NULL or a text without outer whitespace.
    """
    trimmed = raw.selectExpr(*mapping.carried, *[f"{trim_to_null(c)} as {c}" for c in mapping.raw])
    mapped = trimmed.selectExpr(*mapping.carried, *[f"{e} as {n}" for n, e in mapping.columns.items()])
    return mapped.selectExpr(
        "*",
        f"{secret_candidates(mapping.secrets)} as secrets",
        f"{NONE} as errors",
        f"{NONE} as warnings",
    )
