"""Classification of target responses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ID_TAKEN = "resourceexists"


def error_code(status: Column) -> Column:
    """Code of a failed response; a missing status is a general API error."""
    return (
        F.when(status.isNull(), F.lit("API_ERROR"))
        .when(status == 401, F.lit("UNAUTHORIZED"))
        .when(status == 403, F.lit("FORBIDDEN"))
        .when(status == 409, F.lit("CONFLICT"))
        .otherwise(F.lit("HTTP_ERROR"))
    )


def failure_reason(body: Column) -> Column:
    """``resourceexists`` when the body says that the id is taken."""
    text = F.lower(body)
    taken = F.contains(text, F.lit("resourceexists")) | F.contains(text, F.lit("resource exists"))
    return F.when(taken, F.lit(ID_TAKEN))


def is_retryable(status: Column) -> Column:
    """Too many requests, or a server error."""
    return F.coalesce((status == 429) | status.between(500, 599), F.lit(False))


def is_expected(status: Column, expected: tuple[int, ...] = (200, 201)) -> Column:
    return F.coalesce(status.isin(*expected), F.lit(False))
