"""Row diagnostics: ARRAY<STRUCT<stage, code, field, message>> (SQL text).

Lists are built with ``concat`` of conditional one-element arrays, which
stays inside generated code; ``array_compact`` would fall back to an
interpreted lambda.
"""

from __future__ import annotations

from collections.abc import Iterable

from feedplan.functions.text import quoted

DIAGNOSTIC = "struct<stage:string,code:string,field:string,message:string>"
NONE = f"cast(array() as array<{DIAGNOSTIC}>)"

# The stages a diagnostic can come from.
EXTRACT, MAP, NORMALIZE, ENRICH = "EXTRACT", "MAP", "NORMALIZE", "ENRICH"
VALIDATE, PLAN, APPLY, CACHE = "VALIDATE", "PLAN", "APPLY", "CACHE"

# A row has no error so far, or has one.
CLEAN = "size(errors) = 0"
FAILED = "size(errors) > 0"


def diagnostic(stage: str, code: str, field: str | None, message: str, message_is_sql: bool = False) -> str:
    """One diagnostic; the message is a fixed text or an expression."""
    text = message if message_is_sql else quoted(message)
    return (
        f"named_struct('stage', {quoted(stage)}, 'code', {quoted(code)}, "
        f"'field', {quoted(field)}, 'message', {text})"
    )


def emit(condition: str, item: str) -> str:
    """``[item]`` where the condition holds, ``[]`` where it is false or NULL."""
    return f"if({condition}, array({item}), {NONE})"


def gather(parts: Iterable[str]) -> str:
    """One list out of several, in order."""
    parts = list(parts)
    return f"concat({', '.join(parts)})" if parts else NONE


def code_summary(errors: str = "errors") -> str:
    """Distinct codes, sorted, joined by commas; ``none`` when there are none."""
    return f"if(size({errors}) = 0, 'none', array_join(sort_array(array_distinct({errors}.code)), ','))"
