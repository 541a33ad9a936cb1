"""Null-safe field-level differences."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from feedplan.functions.text import lenient_bool, normalize_whitespace, strict_int

CHANGE = "struct<field:string,from:string,to:string>"
NO_CHANGE = f"cast(array() as array<{CHANGE}>)"


def same(c: str) -> str:
    return c


def as_flag(c: str) -> str:
    """Stored flags are integers (any but 0 is true) or words."""
    text = f"cast({c} as string)"
    return f"coalesce({lenient_bool(text)}, {strict_int(text)} <> 0)"


@dataclass(frozen=True)
class FieldDiff:
    """Compare ``left`` of the record in place with ``right`` of the desired
    row, after bringing both to one form."""

    name: str
    left: str
    right: str
    left_form: Callable[[str], str] = same
    right_form: Callable[[str], str] = same


def text_diff(name: str, left: str, right: str) -> FieldDiff:
    return FieldDiff(name, left, right, normalize_whitespace, normalize_whitespace)


def diff_fields(existing: str, fields: Sequence[FieldDiff], secrets: Sequence[str] = ("password",)) -> str:
    """ARRAY<STRUCT<field, from, to>> of the fields that differ (SQL text).

    Secret fields are never compared, so no diff can hold their values.
    """
    parts = []
    for f in fields:
        if f.name in secrets:
            continue
        old, new = f.left_form(f"{existing}.{f.left}"), f.right_form(f.right)
        change = (
            f"named_struct('field', '{f.name}', 'from', cast({old} as string), 'to', cast({new} as string))"
        )
        parts.append(f"if(not ({old} <=> {new}), array({change}), {NO_CHANGE})")
    return f"if({existing} is not null, concat({', '.join(parts)}), {NO_CHANGE})"


def change_set(changes: str = "diff") -> str:
    """MAP field -> new value of a diff."""
    pairs = f"arrays_zip({changes}.field, {changes}.to)"
    return f"map_from_entries(cast({pairs} as array<struct<key:string,value:string>>))"
