"""Scalar text, number and flag functions (SQL text in, SQL text out).

All of them are compositions of built-in expressions that take part in
whole-stage code generation (no lambdas over arrays, no Python UDF).
"""

from __future__ import annotations

# Every character that Python's ``str.strip()`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
_WHITESPACE_LITERAL = "'" + "".join(f"\\u{ord(c):04x}" for c in WHITESPACE) + "'"

# The same set as a Java regex class body; needs the (?U) flag.
WS = r"\s\x1c-\x1f"

# Spellings accepted by the lenient flag parser.
TRUE_WORDS = ("1", "true", "yes", "y")
FALSE_WORDS = ("0", "false", "no", "n")

EMAIL_FORM = rf"(?U)^[^@{WS}]+@[^@{WS}]+\.[^@{WS}]+$"
INT_FORM = r"^[+-]?\d+(_\d+)*$"


def quoted(value: str | None) -> str:
    """String literal."""
    if value is None:
        return "cast(null as string)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def regex(pattern: str) -> str:
    """Pattern literal, backslashes as they are."""
    return f"r'{pattern}'"


def strip(c: str) -> str:
    """Trim all Unicode whitespace (Spark's ``trim`` drops blanks only)."""
    return f"btrim({c}, {_WHITESPACE_LITERAL})"


def trim_to_null(c: str) -> str:
    """Trim; an empty result becomes NULL."""
    return f"nullif({strip(c)}, '')"


def clean_null_token(c: str) -> str:
    """Trim; an empty text or the word ``null`` in any case becomes NULL."""
    return f"nullif(regexp_replace({strip(c)}, '(?i)^null$', ''), '')"


def normalize_whitespace(c: str) -> str:
    """Trim and collapse each whitespace run to one blank.

    Most texts are plain ASCII with single blanks; a short scan recognises
    them and only the others are rewritten.
    """
    odd = f"{c} rlike {regex('  |[^ -~]')}"
    collapsed = f"regexp_replace({strip(c)}, {regex(f'(?U)[{WS}]+')}, ' ')"
    return f"if({odd}, {collapsed}, trim({c}))"


def normalize_text(c: str) -> str:
    """``normalize_whitespace`` with blank texts as NULL."""
    return f"nullif({normalize_whitespace(c)}, '')"


def is_blank(c: str) -> str:
    """True for NULL and for texts that hold whitespace only."""
    return f"coalesce({strip(c)} = '', true)"


def is_email(c: str) -> str:
    return f"({c} rlike {regex(EMAIL_FORM)})"


def one_of(words: dict[str, object], c: str) -> str:
    """Value of a word in a constant table, NULL for other words."""

    def literal(v: object) -> str:
        return str(v).lower() if isinstance(v, bool) else quoted(str(v))

    return f"map({', '.join(f'{quoted(k)}, {literal(v)}' for k, v in words.items())})[{c}]"


def strict_bool(c: str) -> str:
    """``true`` / ``false`` in any case, trimmed; anything else is NULL."""
    return one_of({"true": True, "false": False}, f"lower({strip(c)})")


def strict_int(c: str) -> str:
    """Signed integer with optional ``_`` separators as BIGINT, else NULL.

    Integers beyond BIGINT are NULL too; callers report them as invalid.
    """
    return f"try_cast(replace(regexp_extract({strip(c)}, {regex(INT_FORM)}, 0), '_', '') as bigint)"


def lenient_bool(c: str) -> str:
    """Flag words in any case; anything else is NULL."""
    words = dict.fromkeys(TRUE_WORDS, True) | dict.fromkeys(FALSE_WORDS, False)
    return one_of(words, f"lower({strip(c)})")


def bad_flag(c: str) -> str:
    """True where a non-NULL text is no flag word: the raising variants of
    ``lenient_bool`` turn this into a diagnostic."""
    return f"({c} is not null and {lenient_bool(c)} is null)"


def is_deleted(status: str = "account_status", deletion_date: str = "deletion_date") -> str:
    """Deleted marker of a target record."""
    gone = f"coalesce(lower({strip(status)}) = 'deleted', false)"
    dated = f"coalesce(lower({strip(deletion_date)}) not in ('', 'null'), false)"
    return f"({gone} or {dated})"


def truncate_text(c: str, limit: int = 500) -> str:
    """Texts longer than ``limit`` are cut to ``limit`` characters, the last
    three of which are dots (no dots when ``limit`` is 3 or less)."""
    tail = "..." if limit > 3 else ""
    return f"if(length({c}) > {limit}, concat(left({c}, {limit - len(tail)}), '{tail}'), {c})"


def fingerprint(c: str) -> str:
    """SHA-256 hex digest, the identifier of a snapshot's source."""
    return f"sha2({c}, 256)"
