"""End-to-end flows over DataFrames.

Flows that read a feed several times stage it: the normalised rows are
written once to the shared folder, so that the feed is parsed once and each
narrow lookup reads its own columns of the staged table; the enriched rows
are written again before validation and matching.  ``stage=in_place`` keeps
everything in one lazy plan, which is fine for a stream of small batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedplan.operators.apply import (
    apply_report_rows,
    apply_to_target,
    first_actions,
    request_rows,
    retry_ids,
    stop_at_first_error,
    table_outcome,
)
from feedplan.operators.enrich import EnrichSpec, enrich, require_unique, row_key, survivors, with_source
from feedplan.operators.mapping import map_records
from feedplan.operators.matching import match_target
from feedplan.operators.normalize import normalize
from feedplan.operators.planning import decide, plan_items, plan_summary
from feedplan.operators.snapshot import (
    ORG_COLUMNS,
    USER_COLUMNS,
    diagnostics,
    differing,
    last_records,
    map_orgs,
    map_users,
    refresh_counters,
    refresh_meta,
    refresh_outcome,
    stale_rows,
    upsert,
)
from feedplan.operators.validate import mark_known, validate
from feedplan.operators.vault import attach_secrets, hide_secrets, latest_secrets, store_secrets
from feedplan.plans import employees
from feedplan.sources.pages import explode_records, pages_read, parse_pages, require_good_pages
from feedplan.sources.snapshot_store import Changes, SnapshotStore
from feedplan.sources.staging import staged

Stage = Callable[[DataFrame, str], DataFrame]


def in_place(df: DataFrame, name: str) -> DataFrame:
    """Stage hook that leaves the plan lazy."""
    return df


def mapped(raw: DataFrame) -> DataFrame:
    """Canonical rows with their secrets: not to be staged."""
    return map_records(with_source(raw), employees.mapping())


def feed_secrets(raw: DataFrame) -> DataFrame:
    """(row key, secrets) of a feed, read again from its cells: secret values are written to the vault only."""
    return mapped(raw).select("source_id", "line_no", "secrets")


def normalized(raw: DataFrame) -> DataFrame:
    """Typed rows; of secrets only the names are left."""
    return hide_secrets(normalize(mapped(raw), employees.normalize_rules()), employees.mapping().secrets)


def enriched(raw: DataFrame, target: DataFrame, spec: EnrichSpec | None = None, stage: Stage = staged) -> DataFrame:
    rows = require_unique(stage(normalized(raw), "normalized"))
    return stage(enrich(rows, target, spec or employees.enrich_spec()), "enriched")


def stored(rows: DataFrame, raw: DataFrame, vault: str, spec: EnrichSpec, stage: Stage = staged, batch: str | None = None) -> DataFrame:
    """Enriched rows whose secrets have been appended to the vault; rows whose secrets could not be stored have an error."""
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    return stage(store_secrets(rows, feed_secrets(raw), vault, spec.dataset, spec.run_id, now, (spec.secret,), batch), "stored")


def validated(
    raw: DataFrame,
    target: DataFrame,
    orgs: DataFrame,
    spec: EnrichSpec | None = None,
    stage: Stage = staged,
    vault: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Rows that survived enrichment, with their validation errors."""
    rows = enriched(raw, target, spec, stage)
    if vault is not None:
        rows = stored(rows, raw, vault, spec or employees.enrich_spec(), stage, batch)
    rows = survivors(rows)
    known = mark_known(rows, orgs, "organization_id", "_ouid", "org_known")
    return validate(known, employees.validation_rules()).drop("org_known")


def decided(
    raw: DataFrame,
    target: DataFrame,
    orgs: DataFrame,
    spec: EnrichSpec | None = None,
    include_deleted: bool = False,
    stage: Stage = staged,
    vault: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """One decision per row that reached validation."""
    rows = validated(raw, target, orgs, spec, stage, vault, batch)
    matched = match_target(rows, target, employees.CANDIDATE, include_deleted)
    return decide(matched, employees.diff_rules())


@dataclass(frozen=True)
class ImportPlan:
    decided: DataFrame
    items: DataFrame
    summary: DataFrame


def plan_import(
    raw: DataFrame,
    target: DataFrame,
    orgs: DataFrame,
    spec: EnrichSpec | None = None,
    include_deleted: bool = False,
    stage: Stage = staged,
    vault: str | None = None,
    batch: str | None = None,
) -> ImportPlan:
    """Plan and summary.  The decided rows are staged by default, because both
    results read them.  With ``vault``, the path of the vault table, the
    secrets of the feed are appended to it, and missing ones are drawn; those of
    a ``batch`` of the run are stored once, however often it is planned."""
    rows = stage(decided(raw, target, orgs, spec, include_deleted, stage, vault, batch), "decided")
    return ImportPlan(rows, plan_items(rows, employees.DESIRED), plan_summary(rows))


@dataclass(frozen=True)
class Applied:
    outcome: DataFrame
    table: DataFrame
    report: DataFrame


def apply_plan(
    items: DataFrame,
    target: DataFrame,
    stored: DataFrame,
    spec: EnrichSpec | None = None,
    run_id: str | None = None,
    retries: int = 3,
    max_actions: int | None = None,
    stop_on_first_error: bool = False,
    dry_run: bool = False,
    strict: bool = True,
    stage: Stage = staged,
) -> Applied:
    """Apply plan items to a target table.

    ``stored`` is the vault.  A create whose id is in use gets a new one, up to
    ``retries`` times, and fails with CONFLICT after that.  Only items that
    succeed change the table; a dry run changes nothing.
    """
    spec = spec or employees.enrich_spec()
    chosen = stage(retry_ids(first_actions(items, max_actions), target, spec, retries), "actions")
    latest = latest_secrets(stored, run_id)
    keys = row_key(chosen)
    # passwords are looked up twice rather than staged: to see that they are there, and by whoever sends the payload
    ready = attach_secrets(chosen, latest, spec.dataset, [spec.secret])
    refused = chosen.where("id_attempt is null")
    outcome = stage(table_outcome(request_rows(ready, strict=strict), refused, dry_run), "outcome")
    if stop_on_first_error:
        outcome = stop_at_first_error(outcome)
    report = apply_report_rows(outcome)
    if dry_run:
        return Applied(outcome, target, report)
    done = outcome.where("code is null").select(*keys)
    return Applied(outcome, apply_to_target(chosen.join(done, keys, "left_semi"), target).drop("op"), report)


# dataset -> (columns, key, unique columns, record mapping), in refresh order:
# organisations come first, users refer to them
CACHE_DATASETS = {
    "organizations": (ORG_COLUMNS, "_ouid", (), map_orgs),
    "employees": (USER_COLUMNS, "_id", ("_ouid", "match_key"), map_users),
}


def cache_schema(dataset: str) -> str:
    columns = CACHE_DATASETS[dataset][0]
    return ", ".join(f"`{c}` {t}" for c, t in columns.items())


@dataclass(frozen=True)
class Refresh:
    outcome: DataFrame
    table: DataFrame
    counters: DataFrame
    report: DataFrame


def refresh(
    dataset: str,
    pages: DataFrame,
    existing: DataFrame,
    page_size: int = 200,
    max_pages: int | None = None,
    include_deleted: bool = False,
    stage: Stage = staged,
) -> Refresh:
    """Read page dumps of one dataset into a new state of its snapshot.

    A bad page fails the whole refresh before anything is published.
    """
    columns, key, unique, mapper = CACHE_DATASETS[dataset]
    # parsed once: the end of the sequence is found on the staged counts
    parsed = stage(parse_pages(pages).select("page", "records", "n_records", "page_error"), "pages")
    read = require_good_pages(pages_read(parsed, page_size, max_pages))
    records = stage(mapper(explode_records(read)), "records")
    outcome = stage(refresh_outcome(records, existing, key, unique, include_deleted), "outcome")
    table = upsert(existing, last_records(outcome, list(columns), key), key)
    return Refresh(outcome, table, refresh_counters(outcome, dataset), diagnostics(outcome))


def refresh_snapshot(
    store: SnapshotStore,
    dumps: dict[str, DataFrame],
    run_id: str,
    datasets: Sequence[str] | None = None,
    remove_stale: bool = False,
    **options,
) -> dict[str, int]:
    """Refresh several datasets and publish them in one commit.

    Only records that differ from the snapshot are written, into their buckets.
    ``remove_stale`` takes out the records that the dump did not bring.
    """
    changes, meta = {}, {}
    for dataset in datasets or CACHE_DATASETS:
        if dataset not in CACHE_DATASETS:
            raise ValueError(f"Unsupported cache dataset: {dataset}")
        if dataset not in dumps:
            continue
        columns, key = CACHE_DATASETS[dataset][:2]
        existing = store.read(dataset, T.StructType.fromDDL(cache_schema(dataset)))
        done = refresh(dataset, dumps[dataset], existing, **options)
        incoming = last_records(done.outcome, list(columns), key)
        # a record that was brought but refused is not stale
        brought = done.outcome.where(f"{key} is not null").select(key)
        stale = staged(stale_rows(existing, brought, key).select(key), "stale") if remove_stale else None
        changes[dataset] = Changes(staged(differing(incoming, existing, key), "changed"), stale)
        known = existing.count() - (stale.count() if remove_stale else 0)
        total = F.lit(known) + F.col("inserted")
        entries = refresh_meta(done.counters, total, run_id).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))))
        meta[dataset] = dict(entries.first()[0])  # a handful
        meta[dataset]["last_refresh_at"] = datetime.now(timezone.utc).isoformat(timespec="seconds")
    return store.merge(changes, run_id, meta)
