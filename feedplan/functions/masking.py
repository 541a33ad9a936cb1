"""Masking of secret values in nested rows and in JSON text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = "***"

# Keys whose values are secret, compared without case.
SENSITIVE_KEYS = ("password", "token", "authorization", "api_key", "secret")


def mask_value(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(MASK))


def _hides(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def mask_nested(c: Column, dtype: T.DataType, keys: Iterable[str] = SENSITIVE_KEYS) -> Column:
    """Rebuild a value with every sensitive key masked, at any depth.

    The schema is walked once on the driver; the result is a plain Column
    expression.  Branches without a sensitive key are passed through as they
    are, so untouched structs are not rebuilt.
    """
    names = {k.lower() for k in keys}

    def touched(t: T.DataType) -> bool:
        if isinstance(t, T.StructType):
            return any(f.name.lower() in names or touched(f.dataType) for f in t.fields)
        if isinstance(t, T.ArrayType):
            return touched(t.elementType)
        return isinstance(t, T.MapType)

    def rebuild(v: Column, t: T.DataType) -> Column:
        if not touched(t):
            return v
        if isinstance(t, T.StructType):
            fields = [
                (mask_value(v[f.name]) if f.name.lower() in names else rebuild(v[f.name], f.dataType)).alias(f.name)
                for f in t.fields
            ]
            return F.when(v.isNotNull(), F.struct(*fields))
        if isinstance(t, T.ArrayType):
            return F.transform(v, lambda x: rebuild(x, t.elementType))

        def entry(k: Column, x: Column) -> Column:
            inner = rebuild(x, t.valueType)
            # a mask is a text, so the other values of the map become texts
            shown = F.to_json(inner) if _hides(t.valueType) else inner.cast("string")
            return F.when(F.lower(k).isin(*names) & x.isNotNull(), F.lit(MASK)).otherwise(shown)

        if not isinstance(t.keyType, T.StringType):
            return F.transform_values(v, lambda k, x: rebuild(x, t.valueType)) if _hides(t.valueType) else v
        return F.transform_values(v, entry)

    return rebuild(c, dtype)


#: A string of JSON text, up to the end of the text where it is not closed.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+\\?+(?:"|\Z)'
_TOKEN = re.compile(rf"(?s){_STRING}|[\[\]{{}}]")
_COLON = re.compile(r"[ \t\r\n]*:[ \t\r\n]*")
_SCALAR = re.compile(r"-?\d[\d.eE+-]*+|true|false")


def _value_end(body: str, at: int) -> int:
    """End of the value that starts at ``at``; ``at`` where there is nothing to hide."""
    if body[at : at + 1] not in ("{", "[", '"'):
        scalar = _SCALAR.match(body, at)
        return scalar.end() if scalar else at
    depth = 0
    for token in _TOKEN.finditer(body, at):
        depth += {"{": 1, "[": 1, "}": -1, "]": -1}.get(token[0], 0)
        if depth <= 0:
            return token.end()
    return len(body)


def mask_body(body: str, names: frozenset[str]) -> str:
    """The body with every value of the named keys masked, read once from left to right.

    What stands under a masked key is skipped as a whole, so the work grows
    with the length of the body, however deep its values are.
    """
    shown, done, at = [], 0, 0
    while token := _TOKEN.search(body, at):
        at = token.end()
        colon = _COLON.match(body, at) if token[0][0] == '"' else None
        if colon is None:
            continue
        at = colon.end()
        name = token[0][1:-1]
        if "\\" in name:
            try:
                name = json.loads(token[0])
            except ValueError:
                continue
        if name.lower() in names:
            end = _value_end(body, at)
            if end > at:
                shown += [body[done:at], f'"{MASK}"']
                done = at = end
    return "".join([*shown, body[done:]])


def mask_json_text(c: Column, keys: Iterable[str] = SENSITIVE_KEYS) -> Column:
    """JSON text of unknown shape: every value of a sensitive key masked, the rest kept as it is.

    Null stays null, under a key too.  A value that the text breaks off in is
    masked up to the end.  Scalar values are masked inside the JVM; only texts
    in which a sensitive key holds an object or a list, or a letter is written
    as an escape, which a key may be spelled with, go through an Arrow function.
    """
    hidden = frozenset(k.lower() for k in keys)
    names = "|".join(sorted(re.escape(k) for k in hidden))
    # possessive runs: a text of any length is read without recursion
    scalar = r'(?:"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?\z)|-?\d[\d.eE+-]*+|true|false)'
    masked = F.regexp_replace(c, rf'(?is)("(?:{names})"\s*:\s*){scalar}', rf'$1"{MASK}"')
    walks = c.rlike(rf'(?i)"(?:{names})"\s*:\s*[\[{{]|\\u00[4-7]')

    @F.arrow_udf("string")
    def walked(bodies: pa.Array) -> pa.Array:
        return pa.array([None if b is None else mask_body(b, hidden) for b in bodies.to_pylist()], pa.string())

    return F.when(walks, walked(F.when(walks, c))).otherwise(masked)
