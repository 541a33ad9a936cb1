"""Paged JSON dumps of a target system: (page, body)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.operators.lookup import lookup, salts_of

# Keys that may hold the record list, in order of preference.
LIST_KEYS = ("items", "data", "users", "organizations", "orgs", "result")

# What a page can be refused for.
BAD_JSON = "INVALID_JSON"
BAD_FORMAT = "INVALID_ITEMS_FORMAT"
TOO_MANY = "MAX_PAGES_EXCEEDED"


def page_records(doc: Column) -> Column:
    """Record list of a parsed page as ARRAY<VARIANT>; NULL if the page has none.

    The page is the list itself, or an object whose first list-valued key
    among ``LIST_KEYS`` is the list (an empty list counts).
    """
    return F.coalesce(
        F.try_variant_get(doc, "$", "array<variant>"),
        *[F.try_variant_get(doc, f"$.{k}", "array<variant>") for k in LIST_KEYS],
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Add ``records``, ``n_records`` and ``page_error``.  A body is parsed once: a
    generator over a list of one keeps the optimizer from copying the parse to every use."""
    parsed = pages.select("*", F.explode(F.array(F.struct(F.try_parse_json("body").alias("doc")))).alias("__page"))
    read = parsed.select("*", F.explode(F.array(F.struct(page_records(F.col("__page.doc")).alias("records")))).alias("__list"))
    error = F.when(F.col("__page.doc").isNull(), F.lit(BAD_JSON)).when(F.col("__list.records").isNull(), F.lit(BAD_FORMAT))
    return read.select(
        *pages.columns,
        F.col("__list.records").alias("records"),
        F.when(F.col("__list.records").isNotNull(), F.size("__list.records")).alias("n_records"),
        error.alias("page_error"),
    )


def page_sequence(counted: DataFrame, page_size: int, max_pages: int | None = None, by: str | None = None) -> DataFrame:
    """Last page of each sequence and whether reading would exceed the limit.

    Reading goes on until the first page with fewer than ``page_size``
    records.  ``counted`` has ``page`` and ``n_records``; ``by`` names the
    column that tells sequences apart.
    """
    groups = [by] if by else []
    short = F.when(F.col("n_records") < page_size, F.col("page"))
    stops = counted.groupBy(*groups).agg(F.min(short).alias("short_page"), F.max("page").alias("last_seen"))
    last = F.coalesce("short_page", "last_seen")
    over = F.lit(False) if max_pages is None else F.coalesce(F.col("short_page"), F.lit(1 << 62)) > max_pages
    if max_pages is not None:
        # without a short page the dump must go on up to the limit
        over = over & (F.col("last_seen") >= max_pages)
    return stops.select(*groups, last.alias("last_page"), over.alias("max_pages_exceeded"))


def pages_read(parsed: DataFrame, page_size: int, max_pages: int | None = None, by: str | None = None) -> DataFrame:
    """Pages that a sequential reader would have read, without the empty one.

    A sequence that needs more than ``max_pages`` keeps its pages up to the
    limit and has ``page_error`` on the last of them.
    """
    ends = page_sequence(parsed, page_size, max_pages, by)
    if by:
        joined = lookup(parsed, ends, {by: by}, "page", how="inner", salts=salts_of(parsed.sparkSession))
    else:
        row = ends.select(F.struct("last_page", "max_pages_exceeded"))
        joined = parsed.withColumn("__end", row.scalar()).select("*", "__end.*").drop("__end")
    last = F.col("last_page") if max_pages is None else F.least(F.col("last_page"), F.lit(max_pages))
    kept = joined.filter((F.col("page") <= last) & (F.coalesce("n_records", F.lit(1)) > 0))
    error = F.when(F.col("max_pages_exceeded") & (F.col("page") == last), F.lit(TOO_MANY))
    return kept.withColumn("page_error", F.coalesce("page_error", error)).drop("last_page", "max_pages_exceeded")


def require_good_pages(parsed: DataFrame) -> DataFrame:
    """Fail the job on the first bad page: a refresh is all or nothing.

    The check is part of the plan, so it runs before anything is committed.
    """
    message = F.concat(F.lit("page "), F.col("page"), F.lit(": "), F.col("page_error"))
    checked = F.when(F.col("page_error").isNull(), F.col("records")).otherwise(
        F.raise_error(message).cast("array<variant>")
    )
    return parsed.withColumn("records", checked)


def explode_records(parsed: DataFrame, *carried: str) -> DataFrame:
    """One row per record: ``page``, ``pos`` (0-based), ``item`` and ``ingest_pos``,
    the position in reading order."""
    # an outer generator keeps the optimizer from parsing the body twice to
    # pre-filter empty lists
    exploded = parsed.select(*carried, "page", F.posexplode_outer("records").alias("pos", "item"))
    room = 1 << 24
    too_long = F.raise_error(F.concat(F.lit("page "), F.col("page"), F.lit(f" has more than {room} records")))
    order = F.when(F.col("pos") < room, F.shiftleft(F.col("page").cast("bigint"), 24) + F.col("pos")).otherwise(too_long.cast("bigint"))
    return exploded.filter(F.col("pos").isNotNull()).withColumn("ingest_pos", order)
