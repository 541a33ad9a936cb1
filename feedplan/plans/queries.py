"""One query per operator, over feeds derived from the test tables.

``stages`` keeps the staged artefacts of a session (normalised feed, enriched
feed, plan), the way a plan file is written once and then read by reports and
by the apply run.  ``forget`` drops them, so that a benchmark pays in full, and
has to be called when the tables below a path have changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedplan.functions import diagnostics as dx
from feedplan.functions import masking, parse, text
from feedplan.operators import apply, enrich, matching, planning, report, snapshot, validate, vault
from feedplan.operators.diff import FieldDiff, change_set, diff_fields, text_diff
from feedplan.operators.normalize import NormalizeRule, as_int, clean_values, normalize
from feedplan.plans import employees, feeds, sync
from feedplan.session import configure
from feedplan.sources import artifacts, feed_csv, pages
from feedplan.sources.snapshot_store import Changes, SnapshotStore
from feedplan.sources.staging import new_folder, staged
from feedplan.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

RUN = "run"
SPEC = employees.enrich_spec(RUN)
_stages: dict[tuple, tuple[str, T.StructType]] = {}


def forget() -> None:
    _stages.clear()


def _stage(spark: SparkSession, sf: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, name, sf)
    if key in _stages:
        path, schema = _stages[key]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            pass  # the folder was cleared meanwhile
    rows = make()
    path = new_folder(spark, name)
    rows.write.parquet(path)
    _stages[key] = (path, rows.schema)
    return spark.read.schema(rows.schema).parquet(path)


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return _stage(spark, sf, "normalized", lambda: sync.normalized(feeds.raw_feed(spark, sf)))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return _stage(
        spark, sf, "enriched", lambda: enrich.enrich(normalized(spark, sf), feeds.target(spark, sf), SPEC)
    )


def validated(spark: SparkSession, sf: str) -> DataFrame:
    rows = enrich.survivors(enriched(spark, sf))
    known = validate.mark_known(rows, feeds.orgs(spark, sf), "organization_id", "_ouid", "org_known")
    return validate.validate(known, employees.validation_rules()).drop("org_known")


def decided(spark: SparkSession, sf: str) -> DataFrame:
    def make() -> DataFrame:
        matched = matching.match_target(validated(spark, sf), feeds.target(spark, sf), employees.CANDIDATE)
        return planning.decide(matched, employees.diff_rules())

    return _stage(spark, sf, "decided", make)


def items(spark: SparkSession, sf: str) -> DataFrame:
    return planning.plan_items(decided(spark, sf), employees.DESIRED)


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return sync.mapped(feeds.raw_feed(spark, sf))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- sources ---------------------------------------------------------------


def _written(spark: SparkSession, cells: DataFrame, *options: tuple[str, str]) -> str:
    """Folder with the cells as a delimited file, in order of line, the number in a cell of its own."""
    folder = new_folder(spark, "feed")
    writer = cells.orderBy("line_no").select(F.col("line_no").alias("key"), *employees.RAW_COLUMNS).write
    writer.options(header=True, escape='"', **dict(options)).csv(folder)
    return folder


def csv_record_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Feed written as a delimited file, all cells quoted, some with separators and quotes inside, and read back."""
    cells = feeds.raw_cells(spark, sf).withColumn("contacts", F.regexp_replace("contacts", ",", ',"x"'))
    folder = _written(spark, cells, ("quoteAll", "true"), ("emptyValue", ""))
    read = feed_csv.read_feed(spark, folder, ("key", *employees.RAW_COLUMNS))
    return read.selectExpr("cast(key as bigint) as line_no", *employees.RAW_COLUMNS)


def csv_torn_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Records over several lines, quotes in the middle of plain cells, and blank lines between records."""
    record = "concat(line_no, ',n', line_no, '\" x,\"', replace(coalesce(full_name, ''), '\"', '\"\"'), '\n\n', '\"\" , ', line_no, '\"\n')"
    folder = new_folder(spark, "torn")
    feeds.raw_cells(spark, sf).orderBy("line_no").selectExpr(f"{record} as record").write.text(folder)
    return feed_csv.read_cells(spark, folder, ("key", "note", "body"), has_header=False)


def record_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a delimited file get dense numbers in file order."""
    # a first cell that is never blank keeps every record in the file
    folder = _written(spark, feeds.raw_cells(spark, sf))
    read = feed_csv.read_feed(spark, folder, ("key", *employees.RAW_COLUMNS))
    return read.selectExpr("line_no", "record_id", "cast(key as bigint) as key_no", "full_name")


def header_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The columns that a file lacks, one feed for each column left out."""
    folder = _written(spark, feeds.raw_cells(spark, sf))
    found = spark.read.option("header", True).csv(folder).columns
    rows = []
    for left_out in employees.RAW_COLUMNS:
        try:
            feed_csv.check_header([c for c in found if c != left_out], employees.RAW_COLUMNS)
            rows.append((left_out, "accepted"))
        except feed_csv.CsvFormatError as error:
            rows.append((left_out, str(error)))
    n = feed_csv.read_feed(spark, folder, ("key", *employees.RAW_COLUMNS)).agg(F.count("*").alias("n_records"))
    verdicts = F.array(*[F.struct(F.lit(c).alias("left_out"), F.lit(v).alias("verdict")) for c, v in rows])
    return n.select("n_records", F.inline(verdicts))


def null_token_clean(spark: SparkSession, sf: str) -> DataFrame:
    cells = feeds.raw_cells(spark, sf)
    return cells.selectExpr("line_no", *[f"{text.clean_null_token(c)} as {c}" for c in ("raw_id", "login", "manager")])


def page_dump(spark: SparkSession, sf: str) -> DataFrame:
    """Target user pages of 20 records in three body forms."""
    records = spark.sql(feeds.items_sql("{customer}"), **feeds.load(spark, sf, "customer"))
    return feeds.as_pages(records)


def target_items(spark: SparkSession, sf: str) -> DataFrame:
    return pages.explode_records(pages.parse_pages(page_dump(spark, sf)))


def paged_json_items(spark: SparkSession, sf: str) -> DataFrame:
    return target_items(spark, sf).selectExpr(
        "page", "cast(pos as bigint) as pos", "try_variant_get(item, '$._ouid', 'bigint') as ouid"
    )


def paged_stop_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences of 50 pages; one record of each comes a page late, which makes
    page 49 the short one."""
    records = spark.sql(feeds.items_sql("{customer}", moved=feeds.LATE), **feeds.load(spark, sf, "customer"))
    dump = feeds.as_pages(records).selectExpr("cast(floor((page - 1) / 50) as bigint) as shard", "(page - 1) % 50 + 1 as page", "body")
    read = pages.pages_read(pages.parse_pages(dump), page_size=20, max_pages=49, by="shard")
    return read.selectExpr("shard", "page", "cast(n_records as bigint) as n_records", "page_error")


def page_failure(spark: SparkSession, sf: str) -> DataFrame:
    """Error of each page when some pages are no JSON and others hold no list; a
    refresh of such a dump fails as a whole."""
    damage = "case page % 7 when 3 then concat('<html>', body) when 5 then '{\"items\":{},\"total\":1}' else body end"
    dump = page_dump(spark, sf).withColumn("body", F.expr(damage))
    return pages.parse_pages(dump).select("page", "page_error")


def plan_read_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Plan documents, one per order: an item, a text, a null and an item
    without maps whose password is masked."""
    docs = spark.sql(feeds.PLAN_DOCUMENTS, **feeds.load(spark, sf, "orders"))
    read = artifacts.plan_document_items(docs, "doc_id")
    return read.selectExpr(
        "doc_id", "cast(pos as bigint) as pos", "row_id", "op", "resource_id",
        "desired_state['email'] as email", "desired_state['password'] as password",
        "cast(size(desired_state) as bigint) as n_state", "cast(size(changes) as bigint) as n_changes",
        "source_ref['match_key'] as match_key", "array_join(secret_fields, ',') as secrets",
    )


# --- mapping ---------------------------------------------------------------

MAPPED = tuple(c for c in employees.mapping().columns if c not in ("avatar_id", "resource_id"))


def map_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return mapped(spark, sf).selectExpr("line_no", *[c for c in MAPPED if c != "password"], "avatar_id", "resource_id")


def name_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = parse.split_full_name("full_name")
    return feeds.raw_feed(spark, sf).selectExpr("line_no", *[f"{e} as {n}" for n, e in parts.items()])


def contact_extract(spark: SparkSession, sf: str) -> DataFrame:
    found = parse.pick_contacts("email_or_phone", "contacts")
    return feeds.raw_feed(spark, sf).selectExpr("line_no", *[f"{e} as {n}" for n, e in found.items()])


def contact_extract_documents(spark: SparkSession, sf: str) -> DataFrame:
    """First e-mail and phone token of whole document texts."""
    found = parse.pick_contacts("text")
    return table(spark, sf, "documents").selectExpr("doc_id", *[f"{e} as {n}" for n, e in found.items()])


def kv_parse(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.raw_feed(spark, sf).selectExpr("line_no", f"{parse.kv_pairs('extra')} as pairs")
    return rows.select("line_no", F.explode("pairs").alias("key", "value"))


def manager_ref_parse(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_feed(spark, sf).selectExpr("line_no", f"{parse.manager_ref('manager')} as manager_id")


def flag_parse(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_feed(spark, sf).selectExpr("line_no", f"{parse.logon_flag('flags')} as is_logon_disable")


def role_parse(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.raw_feed(spark, sf).selectExpr("line_no", f"{parse.role_name('employment')} as position")


def secret_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Names of the secret fields of each row, never their values."""
    return mapped(spark, sf).select("line_no", F.explode(F.map_keys("secrets")).alias("field"))


def desired_state(spark: SparkSession, sf: str) -> DataFrame:
    rows = enrich.survivors(enriched(spark, sf)).selectExpr(
        "line_no", f"{planning.desired_state(employees.DESIRED)} as s", "match_key"
    )
    return rows.selectExpr("line_no", *[f"s.{c} as {c}" for c in employees.DESIRED], "match_key")


def upsert_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Payload fields, or why there is none; the password is only counted."""
    source = {a: a for a in apply.PAYLOAD.values() if a} | {"password": "secrets['password']"}
    rows = enrich.survivors(enriched(spark, sf)).selectExpr(
        "line_no", f"{apply.payload_error(source)} as error", f"{apply.upsert_payload(source)} as p"
    )
    names = [n for n in apply.PAYLOAD if n != "password"]
    return rows.selectExpr(
        "line_no", "error", *[f"if(error is null, p.{n}, null) as {n}" for n in names], "error is null and p.password is not null as has_password"
    )


def payload_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of complete rows whose flag or numbers may be unreadable."""
    texts = {a: "'x'" for a in apply.PAYLOAD.values() if a}
    forms = {
        "is_logon_disable": "element_at(array('yes', 'perhaps', '0'), cast(o_orderkey % 3 as int) + 1)",
        "manager_id": "element_at(array('5', '', 'x5', null), cast(o_orderkey % 4 as int) + 1)",
        "organization_id": "element_at(array(' 7 ', 'seven', '1_0', '', '8.5'), cast(o_orderkey % 5 as int) + 1)",
    }
    rows = table(spark, sf, "orders").selectExpr("o_orderkey as line_no", *[f"{e} as {a}" for a, e in (texts | forms).items()])
    source = {a: a for a in texts}
    found = rows.selectExpr("line_no", f"{apply.payload_error(source)} as error", f"{apply.upsert_payload(source)} as p")
    return found.selectExpr(
        "line_no", "error", "if(error is null, p.isLogonDisabled, null) as disabled", "if(error is null, p.managerId, null) as manager_id",
        "if(error is null, p.organization_id, null) as organization_id",
    )


def snapshot_map_users(spark: SparkSession, sf: str) -> DataFrame:
    users = snapshot.map_users(target_items(spark, sf))
    return users.selectExpr("ingest_pos", "item_key", "is_deleted", "map_error", *snapshot.USER_COLUMNS)


def org_items(spark: SparkSession, sf: str) -> DataFrame:
    """Organisation records, one per supplier, under changing names."""
    records = spark.sql(feeds.ORG_ITEMS, **feeds.load(spark, sf, "supplier"))
    return records.select("k", F.try_parse_json("item").alias("item"))


def snapshot_map_orgs(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.map_orgs(org_items(spark, sf)).select("k", "item_key", "map_error", *snapshot.ORG_COLUMNS)


# --- scalar functions --------------------------------------------------------


def whitespace_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr("doc_id", f"md5({text.normalize_whitespace('text')}) as text_md5")


def email_check(spark: SparkSession, sf: str) -> DataFrame:
    cells = feeds.raw_feed(spark, sf)
    return cells.selectExpr("line_no", f"{text.is_email('email_or_phone')} as is_email")


def strict_bool(spark: SparkSession, sf: str) -> DataFrame:
    words = "element_at(array(' TRUE ', 'false', 'yes', '1', 't', ''), cast(o_orderkey % 6 as int) + 1)"
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{words} as w").selectExpr(
        "o_orderkey", f"{text.strict_bool('w')} as flag"
    )


def strict_int(spark: SparkSession, sf: str) -> DataFrame:
    forms = (
        "element_at(array(concat(' +', o_orderkey, ' '), concat('-', o_orderkey), concat('1_0', o_orderkey), "
        "concat(o_orderkey, '.5'), '', concat('__', o_orderkey), '99999999999999999999'), cast(o_orderkey % 7 as int) + 1)"
    )
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{forms} as w").selectExpr(
        "o_orderkey", f"{text.strict_int('w')} as number"
    )


def lenient_bool(spark: SparkSession, sf: str) -> DataFrame:
    words = "element_at(array(' Y ', '0', 'No', 'TRUE', 'maybe', '1', 'false', null), cast(o_orderkey % 8 as int) + 1)"
    return table(spark, sf, "orders").selectExpr("o_orderkey", f"{words} as w").selectExpr(
        "o_orderkey", f"{text.lenient_bool('w')} as flag", f"{text.bad_flag('w')} as bad"
    )


def deleted_filter(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.target(spark, sf).selectExpr("_id", f"{text.is_deleted()} as deleted")


def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").selectExpr(
        "doc_id", f"{text.truncate_text('text')} as short", f"{text.truncate_text('text', 3)} as tiny"
    )


def mask_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets at several depths of a row built from events."""
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "named_struct('Token', event_type, 'user', user_id, 'list', array(named_struct('api_key', props, 'n', event_id)), "
        "'extra', map('SECRET', event_type, 'kind', event_type, 'password', cast(null as string))) as doc",
    )
    masked = masking.mask_nested(F.col("doc"), rows.schema["doc"].dataType)
    return rows.select("event_id", masked.alias("d")).selectExpr(
        "event_id", "d.Token as token", "d.user as user_id", "d.list[0].api_key as api_key", "d.list[0].n as n",
        "d.extra['SECRET'] as secret", "d.extra['kind'] as kind", "d.extra['password'] as password",
    )


def redact_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies that quote the whole text of a document twice, once as a token: digests of the masked bodies."""
    return spark.sql(feeds.BODIES, **feeds.load(spark, sf, "documents")).select(
        "doc_id", F.md5(masking.mask_json_text(F.col("body"))).alias("masked_md5"), F.length("body").cast("bigint").alias("n_body")
    )


def redact_nested_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies that hold the whole text of a document below a secret key and beside it: digests of the masked bodies."""
    return spark.sql(feeds.NESTED_BODIES, **feeds.load(spark, sf, "documents")).select(
        "doc_id", F.md5(masking.mask_json_text(F.col("body"))).alias("masked_md5"), F.length("body").cast("bigint").alias("n_body")
    )


def source_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").selectExpr("page_id", f"{text.fingerprint('url')} as source_id")


# --- normalisation, lookups, enrichment ---------------------------------------

TYPED = (
    "email", "last_name", "first_name", "middle_name", "is_logon_disable", "user_name", "phone",
    "personnel_number", "manager_key", "organization_id", "position", "usr_org_tab_num",
)


def normalize_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = sync.normalized(feeds.raw_feed(spark, sf))
    return clean_values(rows, TYPED).selectExpr("line_no", *TYPED, f"{dx.CLEAN} as ok")


def normalize_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Rules with a required field and with a check of their own; errors of one row add up."""
    large = dx.diagnostic(dx.NORMALIZE, "TOO_LARGE", "organization_id", "organization_id is too large")
    rules = [
        NormalizeRule("user_name", "user_name", required=True),
        NormalizeRule("phone", "email", required=True),
        NormalizeRule("organization_id", "organization_id", as_int("organization_id"), checks=(lambda c: dx.emit(f"{c} > 10", large),)),
    ]
    return validate.error_rows(normalize(mapped(spark, sf), rules)).selectExpr("line_no", "cast(ord as bigint) as ord", "stage", "code", "field")


def normalize_errors(spark: SparkSession, sf: str) -> DataFrame:
    return validate.error_rows(sync.normalized(feeds.raw_feed(spark, sf))).drop("source_id")


def _keyed(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.add_match_key(normalized(spark, sf), SPEC)


def match_key(spark: SparkSession, sf: str) -> DataFrame:
    return _keyed(spark, sf).select("line_no", "match_key")


def identity_match(spark: SparkSession, sf: str) -> DataFrame:
    keys = _keyed(spark, sf).select("line_no", "match_key")
    matched = matching.match_target(keys, feeds.target(spark, sf), ("_id", "_ouid"))
    return matched.selectExpr("line_no", "n_candidates", "match_status", "candidate._id as _id")


def org_exists(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalized(spark, sf).where("organization_id is not null").select("line_no", "organization_id")
    marked = validate.mark_known(rows, feeds.orgs(spark, sf), "organization_id", "_ouid", "known")
    return marked.selectExpr("line_no", "organization_id", "coalesce(known, false) as known")


def manager_resolve(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric manager references resolved by number."""
    rows = normalized(spark, sf)
    spec = employees.enrich_spec(RUN, manager_mode="ouid")
    return enrich.resolve_managers(rows, feeds.target(spark, sf), spec).drop("source_id")


def id_collision(spark: SparkSession, sf: str) -> DataFrame:
    rows = feeds.raw_feed(spark, sf).selectExpr("line_no", "concat('id-', line_no) as wanted")
    return matching.probe_ids(rows, feeds.target(spark, sf), "wanted")


def code_collision(spark: SparkSession, sf: str) -> DataFrame:
    rows = _keyed(spark, sf).select("line_no", "match_key", "usr_org_tab_num")
    probed = matching.probe_codes(rows, feeds.target(spark, sf), "usr_org_tab_num", "usr_org_tab_num")
    return probed.selectExpr("line_no", "usr_org_tab_num as code", "code_held", "code_mine")


def enrich_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = enriched(spark, sf)
    return rows.selectExpr(
        "line_no", "match_key", "manager_id", "resource_id", "usr_org_tab_num", "code_generated", "secret_generated",
        f"{dx.code_summary()} as codes",
    )


def _enriched_files(spark: SparkSession, sf: str) -> DataFrame:
    raw = feeds.raw_feed(spark, sf).selectExpr(
        "concat('file-', line_no % 4) as source_id", "cast(floor(line_no / 4) as bigint) + 2 as line_no", "record_id", *employees.RAW_COLUMNS
    )
    return _stage(spark, sf, "enriched_files", lambda: sync.enriched(raw, feeds.target(spark, sf), SPEC))


def enrich_rows_files(spark: SparkSession, sf: str) -> DataFrame:
    """The feed as four files that number their records alike."""
    return _enriched_files(spark, sf).selectExpr(
        "source_id", "line_no", "match_key", "manager_id", "resource_id", "usr_org_tab_num", "code_generated", f"{dx.code_summary()} as codes"
    )


def id_allocate(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that ask for an id; every third id is in use."""
    rows = feeds.raw_feed(spark, sf).selectExpr("line_no", "concat('id-', line_no) as resource_id", f"{dx.NONE} as errors")
    picks = enrich.allocate_ids(rows, feeds.target(spark, sf), SPEC)
    joined = rows.join(picks, "line_no", "left")
    first = enrich.first_id(SPEC, rows)
    drawn = enrich.new_id(SPEC, "id_pick")
    return joined.selectExpr("line_no", f"case when id_pick is null then {first} when id_pick > 0 then {drawn} end as resource_id", "id_pick")


def code_allocate(spark: SparkSession, sf: str) -> DataFrame:
    picks = enrich.allocate_codes(_keyed(spark, sf), feeds.target(spark, sf), SPEC)
    return picks.selectExpr("line_no", "code_pick", f"if(code_pick > 0, {enrich.new_code(SPEC, 'code_pick')}, null) as code")


def code_allocate_narrow(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of three digits only: many rows draw the same, and some are left without one."""
    spec = employees.enrich_spec(RUN, code_width=3)
    rows = _keyed(spark, sf).withColumn("usr_org_tab_num", F.expr("if(line_no % 3 = 0, usr_org_tab_num, null)"))
    picks = enrich.allocate_codes(rows.drop("source_id"), feeds.target(spark, sf), spec)
    return picks.selectExpr("line_no", "code_pick", f"if(code_pick > 0, {enrich.new_code(spec, 'code_pick')}, null) as code")


def code_allocate_permuted(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of three digits by a keyed permutation: every row gets one while there are free ones."""
    spec = employees.enrich_spec(RUN, code_width=3, code_draws="permutation")
    rows = _keyed(spark, sf).withColumn("usr_org_tab_num", F.expr("if(line_no % 3 = 0, usr_org_tab_num, null)"))
    picks = enrich.allocate_codes(rows.drop("source_id"), feeds.target(spark, sf), spec)
    return picks.selectExpr("line_no", "code_pick", f"if(code_pick > 0, {enrich.picked_code(spec)}, null) as code")


def _vault_rows(spark: SparkSession, sf: str, generate: tuple[str, ...]) -> DataFrame:
    rows, raw = enrich.survivors(enriched(spark, sf)), feeds.raw_feed(spark, sf)
    return vault.vault_rows(rows, sync.feed_secrets(raw), employees.DATASET, RUN, "2024-01-01", generate)


def secret_default(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows get a generated secret; the values stay in the vault."""
    drawn = staged(_vault_rows(spark, sf, ("password",)).drop("value"), "drawn")
    return drawn.selectExpr("seq as line_no", "field", "generated")


def vault_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of a feed stored by the flow, read back from the vault; drawn ones show their length only."""
    path = new_folder(spark, "vault")
    rows, raw = enriched(spark, sf), feeds.raw_feed(spark, sf)
    kept = sync.stored(rows, raw, path, SPEC).select("line_no", "match_key", F.expr(dx.code_summary()).alias("codes"))
    found = vault.read_vault(spark, path).selectExpr("match_key", "seq as line_no", "field", "length(value) as n_value", "run_id")
    return kept.join(found, ["line_no", "match_key"], "left")


def vault_replay(spark: SparkSession, sf: str) -> DataFrame:
    """What the vault holds after one batch has been stored twice."""
    path = new_folder(spark, "vault")
    for _ in range(2):
        sync.stored(enriched(spark, sf), feeds.raw_feed(spark, sf), path, SPEC, batch="1")
    return vault.read_vault(spark, path).groupBy("match_key", "field").agg(F.count("*").alias("n_rows"), F.countDistinct("append").alias("n_appends"))


# --- vault ---------------------------------------------------------------------


def event_vault(spark: SparkSession, sf: str) -> DataFrame:
    """Vault history: one password per event, kept by user."""
    return table(spark, sf, "events").selectExpr(
        "event_type as dataset", "'password' as field", "concat('', user_id) as match_key",
        "concat('v', event_id) as value", "concat('r', day(ts)) as run_id", "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') as updated_at",
        "event_id as seq",
    )


def vault_put(spark: SparkSession, sf: str) -> DataFrame:
    """Vault rows of a run without their values."""
    rows = _vault_rows(spark, sf, ())
    return rows.selectExpr("dataset", "field", "match_key", "run_id", "seq as line_no", "length(value) as n_value")


def vault_latest(spark: SparkSession, sf: str) -> DataFrame:
    return vault.latest_secrets(event_vault(spark, sf))


def vault_of_run(spark: SparkSession, sf: str) -> DataFrame:
    return vault.latest_secrets(event_vault(spark, sf), "r2")


def keyed_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Requests from orders against a table of specific and general entries."""
    orders = table(spark, sf, "orders")
    wanted = orders.selectExpr(
        "o_orderkey as request_no", "'orders' as dataset", "o_orderstatus as field",
        "concat('c', o_custkey) as row_id", "o_orderkey as line_no",
    )
    both = orders.where("o_orderkey % 11 = 0").selectExpr(
        "'orders' as dataset", "o_orderstatus as field", "concat('c', o_custkey) as row_id", "o_orderkey as line_no",
        "concat('both', o_orderkey) as value",
    )
    rows = orders.where("o_custkey % 5 = 0").groupBy("o_orderstatus", "o_custkey").agg(F.min("o_orderkey").alias("k"))
    by_row = rows.selectExpr("'orders'", "o_orderstatus", "concat('c', o_custkey)", "cast(null as bigint)", "concat('row', k)")
    by_line = orders.where("o_orderkey % 7 = 0").selectExpr(
        "'orders'", "o_orderstatus", "cast(null as string)", "o_orderkey", "concat('line', o_orderkey)"
    )
    general = orders.where("o_orderstatus <> 'P'").groupBy("o_orderstatus").agg(F.min("o_orderkey").alias("k"))
    default = general.selectExpr("'orders'", "o_orderstatus", "cast(null as string)", "cast(null as bigint)", "concat('any', k)")
    entries = both.union(by_row).union(by_line).union(default)
    found = vault.keyed_fallback(wanted, entries)
    return found.select("request_no", F.coalesce("value", F.lit("none")).alias("value"))


def secret_required(spark: SparkSession, sf: str) -> DataFrame:
    """Creates whose password is not in the vault."""
    requests = _requests(spark, sf)
    return requests.where("error_code = 'SECRET_REQUIRED'").select("line_no", "error_code", "error_field")


# --- validation ------------------------------------------------------------------


def validate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return validated(spark, sf).selectExpr("line_no", f"{dx.CLEAN} as valid", "cast(size(errors) as bigint) as n_errors")


def validate_codes(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.error_rows(validate.blocked_rows(validated(spark, sf)))
    return rows.selectExpr("line_no", "cast(ord as bigint) as ord", "stage", "code", "field", "message")


def valid_split(spark: SparkSession, sf: str) -> DataFrame:
    # both parts read the verdicts, so they are staged: each row is looked up and checked once
    rows = staged(validated(spark, sf).select("line_no", "errors"), "verdicts")
    good = validate.valid_rows(rows).selectExpr("line_no", "'valid' as part")
    return good.unionByName(validate.blocked_rows(rows).selectExpr("line_no", "'blocked' as part"))


def error_code_summary(spark: SparkSession, sf: str) -> DataFrame:
    return validate.blocked_rows(validated(spark, sf)).selectExpr("line_no", f"{dx.code_summary()} as codes")


def duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    """Shared keys among orders: customers and priorities with several rows."""
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey as line_no", "concat('', o_custkey) as customer", "o_orderpriority as priority"
    )
    return validate.duplicate_report(rows, ("customer", "priority"))


def dropped_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = validate.dropped_rows(enriched(spark, sf))
    return rows.selectExpr("line_no", "cast(ord as bigint) as ord", "stage", "code", "field", "message")


# --- diff and plan -----------------------------------------------------------------


def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    rows = decided(spark, sf).where("match_status = 'matched'").select("match_key", F.inline("diff"))
    return rows.selectExpr("match_key", "field", "`from` as old_value", "to as new_value")


def snapshot_diff_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders against a perturbed copy of themselves."""
    orders = table(spark, sf, "orders")
    copy = orders.selectExpr(
        "if(o_orderkey % 10 = 0, -1 - o_orderkey, o_orderkey) as match_key",
        "if(o_orderkey % 7 = 0, o_totalprice + 1, o_totalprice) as o_totalprice",
        "if(o_orderkey % 3 = 0, replace(o_orderpriority, ' ', '  '), o_orderpriority) as o_orderpriority",
        "o_orderstatus", "concat('', o_orderkey) as _id", "'active' as account_status", "cast(null as string) as deletion_date",
    )
    rows = orders.selectExpr("o_orderkey as line_no", "o_orderkey as match_key", "o_totalprice", "o_orderpriority", "o_orderstatus")
    matched = matching.match_target(rows, copy, ("_id", "o_totalprice", "o_orderpriority", "o_orderstatus"), include_deleted=True)
    fields = [
        FieldDiff("total", "o_totalprice", "o_totalprice"),
        text_diff("priority", "o_orderpriority", "o_orderpriority"),
        FieldDiff("status", "o_orderstatus", "o_orderstatus"),
    ]
    compared = matched.selectExpr("line_no", "match_status", f"{diff_fields('candidate', fields)} as diff")
    return compared.selectExpr(
        "line_no",
        "case when match_status = 'not_found' then 'create' when size(diff) = 0 then 'skip' else 'update' end as decision",
        "array_join(diff.field, ',') as fields",
    )


def change_set_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = decided(spark, sf).where("decision = 'update'").selectExpr("line_no", f"{change_set('diff')} as changes")
    return rows.select("line_no", F.explode("changes").alias("field", "value"))


def plan_decision(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).selectExpr("line_no", "match_key", "decision", "reason", "resource_id")


def plan_items(spark: SparkSession, sf: str) -> DataFrame:
    return items(spark, sf).selectExpr(
        "row_id", "line_no", "op", "resource_id", "desired_state.email as email", "desired_state.organization_id as organization_id",
        "cast(size(changes) as bigint) as n_changes", "source_ref['match_key'] as match_key", "array_join(secret_fields, ',') as secrets",
    )


def plan_file(spark: SparkSession, sf: str) -> DataFrame:
    """The plan written to a folder, secrets masked, and read back."""
    path = new_folder(spark, "plan")
    artifacts.write_plan(items(spark, sf), planning.plan_summary(decided(spark, sf)), {"dataset": employees.DATASET, "run_id": RUN}, path)
    return artifacts.read_plan(spark, path).selectExpr(
        "row_id", "line_no", "op", "resource_id", "desired_state['email'] as email", "cast(size(changes) as bigint) as n_changes",
        "source_ref['match_key'] as match_key", "array_join(secret_fields, ',') as secrets",
    )


def plan_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The whole flow from raw cells: one row per decision."""
    rows = sync.decided(feeds.raw_feed(spark, sf), feeds.target(spark, sf), feeds.orgs(spark, sf), SPEC)
    return rows.selectExpr("line_no", "decision", "status", f"{dx.code_summary()} as codes")


def plan_summary(spark: SparkSession, sf: str) -> DataFrame:
    return planning.plan_summary(decided(spark, sf))


# --- reports --------------------------------------------------------------------------


def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_summary(decided(spark, sf))


def run_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status of one run per organisation."""
    rows = decided(spark, sf).groupBy("organization_id").agg(
        F.sum(F.size("errors")).alias("errors_total"), F.count_if(F.col("status") == "OK").alias("rows_passed")
    )
    return rows.select("organization_id", report.run_status(F.col("errors_total"), F.col("rows_passed")).alias("status"))


def diagnostics_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Stages of all diagnostics, of dropped rows and of planned rows."""
    lost = enriched(spark, sf).where(dx.FAILED).select("errors", "warnings")
    return report.diagnostics_by_stage(lost.unionByName(decided(spark, sf).select("errors", "warnings")))


def ops_counters(spark: SparkSession, sf: str) -> DataFrame:
    rows = outcomes(spark, sf).selectExpr(
        "op", "if(code is null, 1, 0) as ok", "if(code is null, 0, 1) as failed", "1 as count"
    )
    return report.ops_counters(rows).withColumnRenamed("count", "n")


def report_items(spark: SparkSession, sf: str) -> DataFrame:
    rows = decided(spark, sf)
    first = report.report_items(rows, 200, include_skipped=True)
    cut = report.items_truncated(rows, 200, include_skipped=True)
    return first.select("line_no", "status", F.expr(dx.code_summary()).alias("codes"), cut.scalar().alias("truncated"))


def report_file(spark: SparkSession, sf: str) -> DataFrame:
    """The report written as one document and read back: counters, items and what their diagnostics say."""
    path = new_folder(spark, "report")
    artifacts.write_report(decided(spark, sf), {"run_id": RUN}, path)
    shape = (
        "status string, meta struct<run_id:string,items_limit:int,items_truncated:boolean>, summary struct<rows_total:bigint,rows_blocked:bigint>, "
        "items array<struct<status:string,row_ref:struct<line_no:bigint>,diagnostics:array<struct<severity:string,code:string>>>>"
    )
    doc = spark.read.schema(shape).json(path)
    return doc.selectExpr("status", "meta.run_id", "meta.items_truncated", "summary.rows_total", "summary.rows_blocked", "explode(items) as item").selectExpr(
        "status", "run_id", "items_truncated", "rows_total", "rows_blocked", "item.row_ref.line_no as line_no",
        "cast(size(item.diagnostics) as bigint) as n_diagnostics", "array_join(array_distinct(item.diagnostics.severity), ',') as severity",
    )


def warnings_report(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of rows that carry warnings: short names are worth one."""
    short = dx.diagnostic(dx.VALIDATE, "SHORT_NAME", "userName", "user name is short")
    rows = decided(spark, sf).withColumn("warnings", F.expr(dx.emit("length(user_name) < 4", short)))
    totals = report.report_summary(rows).select("rows_with_warnings", "warnings_total")
    stages = report.diagnostics_by_stage(rows).where("stage = 'VALIDATE'").select(F.col("warnings_total").alias("stage_warnings"))
    return totals.withColumn("stage_warnings", stages.scalar())


def stage_report(spark: SparkSession, sf: str) -> DataFrame:
    stages = {
        "mapping": mapped(spark, sf),
        "normalize": normalized(spark, sf),
        "enrich": enriched(spark, sf),
    }
    parts = [report.stage_report(rows).withColumn("stage", F.lit(name)) for name, rows in stages.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def validate_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.validate_report(validated(spark, sf))


def error_histogram(spark: SparkSession, sf: str) -> DataFrame:
    lost = enriched(spark, sf).where(dx.FAILED).select("errors")
    return report.error_histogram(lost.unionByName(decided(spark, sf).select("errors")))


# --- snapshot ---------------------------------------------------------------------------


def known_users(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot before a refresh: a third of the records, and others that are gone."""
    columns = [c if c in feeds.KNOWN_USERS else f"cast(null as {t}) as {c}" for c, t in snapshot.USER_COLUMNS.items()]
    rows = table(spark, sf, "customer")
    return rows.selectExpr(*[f"{e} as {c}" for c, e in feeds.KNOWN_USERS.items()]).selectExpr(*columns)


def refreshed(spark: SparkSession, sf: str) -> DataFrame:
    def make() -> DataFrame:
        return sync.refresh("employees", page_dump(spark, sf), known_users(spark, sf), page_size=20).outcome

    return _stage(spark, sf, "refreshed", make)


def refresh_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return refreshed(spark, sf).select("ingest_pos", "item_key", "outcome", "message")


def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    users = staged(snapshot.map_users(target_items(spark, sf)), "records")
    good = users.where("not is_deleted and map_error is null")
    return snapshot.unique_violations(good, known_users(spark, sf))


def refresh_counters(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.refresh_counters(refreshed(spark, sf), "employees")


def refresh_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals over the user refresh and an organisation refresh."""
    users = snapshot.refresh_counters(refreshed(spark, sf), "employees")
    return snapshot.refresh_totals(users.unionByName(snapshot.refresh_counters(_org_outcome(spark, sf), "organizations")))


def _org_outcome(spark: SparkSession, sf: str) -> DataFrame:
    records = org_items(spark, sf).selectExpr("item", "k as ingest_pos", "cast(floor(k / 20) as bigint) + 1 as page")
    known = feeds.orgs(spark, sf).selectExpr("_ouid", "code", "name", "parent_id", "cast(null as string) as updated_at")
    return snapshot.refresh_outcome(snapshot.map_orgs(records), known, "_ouid", ())


def _user_table(spark: SparkSession, sf: str) -> DataFrame:
    last = snapshot.last_records(refreshed(spark, sf), list(snapshot.USER_COLUMNS))
    return snapshot.upsert(known_users(spark, sf), last)


def refresh_meta(spark: SparkSession, sf: str) -> DataFrame:
    counters = snapshot.refresh_counters(refreshed(spark, sf), "employees")
    total = _user_table(spark, sf).agg(F.count("*"))
    return snapshot.refresh_meta(counters, total.scalar(), RUN)


def snapshot_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _user_table(spark, sf).select("_id", "_ouid", "match_key", "mail", "op")


def snapshot_upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert of changed orders, some of them under new keys, into all orders."""
    known = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    arriving = known.selectExpr(
        "if(o_orderkey % 10 = 0, -1 - o_orderkey, o_orderkey) as o_orderkey", "o_totalprice + 1 as o_totalprice", "o_orderstatus"
    )
    return snapshot.upsert(known, arriving, "o_orderkey")


def snapshot_merge_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as a snapshot in buckets, of which one lot is changed and another is removed."""
    known = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    store = SnapshotStore(spark, new_folder(spark, "orders"))
    store.commit({"orders": known}, RUN)
    changed = known.where("o_orderkey % 100 = 0").withColumn("o_totalprice", F.expr("o_totalprice + 1"))
    store.merge({"orders": Changes(changed, known.where("o_orderkey % 250 = 2").select("o_orderkey"))}, RUN)
    return store.read("orders", known.schema)


def stale_removed(spark: SparkSession, sf: str) -> DataFrame:
    """The users that are left when a full read takes the stale ones out."""
    store = _committed(spark, sf)
    sync.refresh_snapshot(store, {"employees": page_dump(spark, sf)}, RUN, page_size=20, remove_stale=True)
    return store.read("employees", _schema("employees")).select("_id", "_ouid", "match_key", "mail")


def _schema(dataset: str) -> T.StructType:
    return T.StructType.fromDDL(sync.cache_schema(dataset))


def _committed(spark: SparkSession, sf: str) -> SnapshotStore:
    store = SnapshotStore(spark, new_folder(spark, "snapshots"))
    known = feeds.orgs(spark, sf).selectExpr("_ouid", "code", "name", "parent_id", "cast(null as string) as updated_at")
    store.commit({"organizations": known, "employees": known_users(spark, sf)}, RUN)
    return store


def snapshot_status(spark: SparkSession, sf: str) -> DataFrame:
    store = _committed(spark, sf)
    status = store.status({d: _schema(d) for d in sync.CACHE_DATASETS})
    return status.select("dataset", "n_rows")


def snapshot_clear(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that a clear has removed, and rows that are left."""
    store = _committed(spark, sf)
    schemas = {d: _schema(d) for d in sync.CACHE_DATASETS}
    removed = store.clear(schemas, RUN)
    counts = F.create_map(*[c for d, n in removed.items() for c in (F.lit(d), F.lit(n).cast("bigint"))])
    return store.status(schemas).select("dataset", F.col("n_rows").alias("n_left"), F.element_at(counts, F.col("dataset")).alias("n_removed"))


def stale_rows(spark: SparkSession, sf: str) -> DataFrame:
    read = snapshot.map_users(target_items(spark, sf)).where("_id is not null")
    return snapshot.stale_rows(known_users(spark, sf), read).select("_id")


# --- apply --------------------------------------------------------------------------------


def _filed(rows: DataFrame) -> DataFrame:
    """Rows of one source as rows of three that number theirs alike."""
    rest = [c for c in rows.columns if c != "line_no"]
    return rows.selectExpr("concat('f', line_no % 3) as source_id", "cast(floor(line_no / 3) as bigint) as line_no", *rest)


def _outcomes_files(spark: SparkSession, sf: str) -> DataFrame:
    return apply.apply_outcome(_filed(order_requests(spark, sf)), _filed(response_log(spark, sf)))


def dropped_rows_files(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the rows of four files that never reach validation."""
    return validate.dropped_rows(_enriched_files(spark, sf)).selectExpr("source_id", "line_no", "cast(ord as bigint) as ord", "stage", "code", "field", "message")


def apply_stop_files(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes of three sources up to the first failure of any kind."""
    return apply.stop_at_first_error(_outcomes_files(spark, sf)).select("source_id", "line_no", "outcome", "code")


def apply_max_files(spark: SparkSession, sf: str) -> DataFrame:
    """The first actions of three sources."""
    first = apply.first_actions(_filed(order_requests(spark, sf)), 600)
    return apply.apply_outcome(first, _filed(response_log(spark, sf))).select("source_id", "line_no", "outcome", "code")


def report_items_files(spark: SparkSession, sf: str) -> DataFrame:
    """The first failed items of three sources, and whether any was cut."""
    rows = apply.apply_report_rows(_outcomes_files(spark, sf)).withColumn("match_key", F.lit(None).cast("string"))
    items = report.item_rows(report.report_items(rows, 200))
    cut = report.items_truncated(rows, 200)
    return items.select("status", "row_ref.source_id", "row_ref.line_no", "row_ref.row_id", F.expr("diagnostics[0].code").alias("code"), cut.scalar().alias("truncated"))


def diagnostic_samples(spark: SparkSession, sf: str) -> DataFrame:
    """The first failed rows of three sources for each stage and code, and how many there are."""
    rows = apply.apply_report_rows(_outcomes_files(spark, sf))
    return report.diagnostic_samples(rows, 20).select("stage", "code", "place", "source_id", "line_no", "n_rows", "truncated")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of the plan; the vault holds the passwords of the feed."""
    latest = vault.latest_secrets(_vault_rows(spark, sf, ()))
    return apply.request_rows(vault.attach_secrets(items(spark, sf), latest, employees.DATASET, ["password"]))


def request_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Requests without their payload values."""
    return _requests(spark, sf).selectExpr(
        "line_no", "op", "method", "path", "query['decrypt'] as decrypt", "payload.mail as mail",
        "payload.isLogonDisabled as disabled", "payload.organization_id as organization_id", "error_code", "error_message",
    )


def response_log(spark: SparkSession, sf: str) -> DataFrame:
    """Responses, one per order."""
    return spark.sql(feeds.RESPONSES, **feeds.load(spark, sf, "orders"))


def outcome_classify(spark: SparkSession, sf: str) -> DataFrame:
    return apply.classify_outcomes(response_log(spark, sf)).select(
        "line_no", "status", "ok", "error_code", "error_reason", "error_message", "retryable", "body_snippet"
    )


def order_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared requests, one per order; some have no id."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey as line_no",
        "if(o_orderkey % 3 = 0, 'update', 'create') as op",
        "if(o_orderkey % 50 = 7, '', concat('id-', o_orderkey)) as resource_id",
        "if(o_orderkey % 50 = 7, 'RESOURCE_ID_MISSING', null) as error_code",
    )


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return apply.apply_outcome(order_requests(spark, sf), response_log(spark, sf))


def apply_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes(spark, sf).select("line_no", "op", "outcome", "code")


def apply_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report rows of the outcomes: what failed, at which stage, with the operation as context."""
    rows = apply.apply_report_rows(outcomes(spark, sf))
    return rows.selectExpr(
        "line_no", "status", "array_join(errors.stage, ',') as stages", f"{dx.code_summary()} as codes", "context['op'] as op", "context['resource_id'] as resource_id"
    )


def apply_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The plan applied to the target table, with the vault of the feed; a retry finds free ids."""
    done = sync.apply_plan(items(spark, sf), feeds.target(spark, sf), _vault_rows(spark, sf, ()), SPEC)
    return done.outcome.select("line_no", "op", "outcome", "code")


def apply_max_actions(spark: SparkSession, sf: str) -> DataFrame:
    first = apply.first_actions(order_requests(spark, sf), 25)
    return apply.apply_outcome(first, response_log(spark, sf)).select("line_no", "outcome", "code")


def apply_stop_first(spark: SparkSession, sf: str) -> DataFrame:
    """Responses that fail for one order in 4999 only."""
    rare = response_log(spark, sf).withColumn("status", F.expr("if(line_no % 4999 = 4998, 500, 200)"))
    requests = order_requests(spark, sf).withColumn("error_code", F.lit(None).cast("string"))
    rows = apply.apply_outcome(requests, rare)
    return apply.stop_at_first_error(rows).select("line_no", "outcome", "code")


def apply_id_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Creates whose id is taken by a record of the target."""
    wanted = feeds.raw_feed(spark, sf).selectExpr("line_no", "'create' as op", "concat('id-', line_no) as resource_id")
    return apply.retry_ids(wanted, feeds.target(spark, sf), SPEC).select("line_no", "resource_id", "id_attempt")


def apply_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    rows = apply.apply_outcome(order_requests(spark, sf), response_log(spark, sf), dry_run=True)
    return rows.groupBy("outcome", "code").agg(F.count("*").alias("n"))


def apply_counters(spark: SparkSession, sf: str) -> DataFrame:
    skipped = table(spark, sf, "customer").agg(F.count("*"))
    return apply.apply_counters(outcomes(spark, sf), skipped.scalar())


def apply_to_target(spark: SparkSession, sf: str) -> DataFrame:
    merged = apply.apply_to_target(items(spark, sf), feeds.target(spark, sf))
    return merged.select("_id", "_ouid", "match_key", "mail", "phone", "usr_org_tab_num", "organization_id", "is_logon_disabled", "op")


# --- streaming ------------------------------------------------------------------------------


def incremental_sync(spark: SparkSession, sf: str) -> DataFrame:
    """The feed arrives in five lots, a batch of files each, that all number their records from 2; the final snapshot.

    New records show no id, because it is drawn from the file's path, but how many share it; the code of a record
    may depend on the batch in which it arrives."""
    folder = new_folder(spark, "arrivals")
    arriving = staged(feeds.raw_cells(spark, sf).selectExpr("line_no % 5 as part", "cast(floor(line_no / 5) as bigint) + 2 as line_no", *employees.RAW_COLUMNS), "cells")
    store = SnapshotStore(spark, f"{folder}/store")
    store.commit({incremental.DATASET: feeds.target(spark, sf)}, RUN, version=1)
    for part in range(5):
        one = arriving.where(F.col("part") == part).drop("part")
        one.write.mode("append").option("header", True).option("escape", '"').csv(f"{folder}/in")
        stream = incremental.read_arrivals(spark, f"{folder}/in")
        incremental.incremental_sync(stream, store, feeds.orgs(spark, sf), f"{folder}/progress", RUN, 2).awaitTermination()
    final = store.read(incremental.DATASET, incremental.snapshot_schema())
    shared = final.groupBy("_id").agg(F.count("*").alias("n_same_id"))
    return final.join(shared, "_id").selectExpr(
        "if(_ouid is null, 'new', _id) as _id", "n_same_id", "_ouid", "match_key", "mail", "phone", "organization_id", "is_logon_disabled"
    )


_NAMES = (
    csv_record_parse, csv_torn_lines, record_numbering, normalize_checks, payload_errors, header_contract, plan_file, report_file, warnings_report, enrich_rows_files,
    code_allocate_narrow, code_allocate_permuted, diagnostic_samples, vault_flow, vault_replay, apply_report, apply_plan, null_token_clean, paged_json_items, paged_stop_rule, page_failure,
    plan_items, plan_read_clean, report_summary, vault_put, map_canonical, name_split, contact_extract,
    contact_extract_documents, kv_parse, manager_ref_parse, flag_parse, role_parse, secret_candidates,
    desired_state, upsert_payload, snapshot_map_users, snapshot_map_orgs, whitespace_norm, email_check,
    strict_bool, strict_int, lenient_bool, deleted_filter, truncate_text, mask_nested, redact_documents, redact_nested_documents,
    source_fingerprint, normalize_rows, normalize_errors, match_key, identity_match, org_exists,
    manager_resolve, id_collision, code_collision, enrich_rows, id_allocate, code_allocate, secret_default,
    vault_latest, vault_of_run, keyed_fallback, secret_required, validate_rows, validate_codes, valid_split,
    error_code_summary, duplicate_report, dropped_rows, snapshot_diff, snapshot_diff_orders, plan_decision,
    plan_rows, plan_summary, run_status, diagnostics_by_stage, ops_counters, report_items, stage_report,
    validate_report, error_histogram, refresh_outcome, unique_violations, refresh_counters, refresh_totals,
    refresh_meta, snapshot_upsert, snapshot_upsert_orders, snapshot_merge_orders, stale_removed, snapshot_status, snapshot_clear, stale_rows,
    dropped_rows_files, apply_stop_files, apply_max_files, report_items_files, request_rows, outcome_classify, apply_outcome, apply_max_actions, apply_stop_first, apply_id_retry,
    apply_dry_run, apply_counters, apply_to_target, incremental_sync,
)


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir.rstrip("/"))

    run.__doc__ = query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    named = {q.__name__: _configured(q) for q in _NAMES}
    named["change_set"] = _configured(change_set_rows)
    return named
