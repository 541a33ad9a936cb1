"""Feeds derived from the test tables, as SQL that Spark and DuckDB share.

Each statement is a plain projection of one table (``{customer}`` and the like
stand for the table); the operators under test see nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.functions.text import clean_null_token

RAW_FEED = """
select c_custkey + 1 as line_no,
  concat('line:', c_custkey + 1) as record_id,
  case when c_custkey % 41 = 0 then '' when c_custkey % 43 = 0 then 'null' else concat('', c_custkey) end as raw_id,
  case when c_custkey % 37 = 0 then concat('Solo', c_custkey)
       when c_custkey % 10 = 0 then concat('L', c_custkey, ',', chr(9), ' F', c_custkey % 97, '  M', c_custkey % 13)
       when c_custkey % 5 = 0 then concat('L', c_custkey, ', F', c_custkey % 97, '  M', c_custkey % 13)
       else concat('L', c_custkey, ' F', c_custkey % 97, ' M', c_custkey % 13) end as full_name,
  case when c_custkey % 53 = 0 then null else concat('u', c_custkey) end as login,
  case when c_custkey % 29 = 0 then concat('u', c_custkey, '@corp')
       when c_custkey % 2 = 0 then concat('email=u', c_custkey, '@corp.example')
       else concat('u', c_custkey, '@corp.example') end as email_or_phone,
  concat(',phone=+7 555 ', lpad(concat('', c_custkey), 7, '0'), '|alt', c_custkey, '@corp.example') as contacts,
  concat('Org=N', c_nationkey) as org,
  case when c_custkey % 23 = 0 then concat('manager_id: ', lpad(concat('', c_custkey % 50), 3, '0'))
       when c_custkey % 3 = 0 then 'manager: none' else '' end as manager,
  case when c_custkey % 11 = 0 then 'disabled=maybe'
       when c_custkey % 2 = 0 then 'disabled=Yes; 2fa=on' else 'disabled: off' end as flags,
  concat('hired:2020;role=', c_mktsegment) as employment,
  concat(case when c_custkey % 7 = 0 then '' else concat('password=pw', c_custkey, ';') end,
         'org_id=', case when c_custkey % 31 = 0 then 'bad' else concat('', c_nationkey) end,
         ';noise; TAB = TAB-', c_custkey,
         case when c_custkey % 13 = 0 then concat(';tab=T-', c_custkey) else '' end) as extra
from {customer}
"""

ORGS = """
select cast(n_nationkey as bigint) as _ouid, concat('ORG-', n_nationkey) as code, n_name as name,
  cast(n_regionkey as bigint) as parent_id
from {nation} where n_nationkey between 1 and 22
"""

_TARGET = """
select {prefix} as _id, {ouid} as _ouid,
  concat('', c_custkey) as personnel_number,
  concat('L', c_custkey) as last_name, concat('F', c_custkey % 97) as first_name,
  concat('M', c_custkey % 13) as middle_name,
  concat('L', c_custkey, '|F', c_custkey % 97, '|M', c_custkey % 13, '|', c_custkey) as match_key,
  concat(case when c_custkey % 16 = 1 then 'old' else 'u' end, c_custkey, '@corp.example') as mail,
  concat('u', c_custkey) as user_name,
  concat('+7', case when c_custkey % 8 = 2 then '  ' else ' ' end, '555 ', lpad(concat('', c_custkey), 7, '0')) as phone,
  case when c_custkey % 3 = 2 and c_custkey % 17 = 4 then concat('TAB-', c_custkey + 1)
       when c_custkey % 13 = 0 then concat('T-', c_custkey)
       else concat('TAB-', c_custkey) end as usr_org_tab_num,
  cast(c_nationkey as bigint) as organization_id,
  case when c_custkey % 47 = 1 then 'Deleted' else 'active' end as account_status,
  case when c_custkey % 59 = 2 then '2024-01-01' when c_custkey % 59 = 4 then 'null' end as deletion_date,
  nullif('', '') as _rev,
  cast(null as bigint) as manager_ouid,
  case when c_custkey % 4 = 0 then 2 when c_custkey % 2 = 0 then 1 else 0 end as is_logon_disabled,
  c_mktsegment as position,
  '2024-01-01T00:00:00Z' as updated_at
from {table} where c_custkey % 3 <> 0 {extra}
"""


def _target(table: str) -> str:
    first = _TARGET.format(prefix="concat('id-', c_custkey)", ouid="c_custkey", table=table, extra="")
    copy = _TARGET.format(
        prefix="concat('dup-', c_custkey)", ouid="1000000 + c_custkey", table=table, extra="and c_custkey % 19 = 0"
    )
    return f"{first} union all {copy}"


def raw_feed_sql(customer: str = "customer") -> str:
    return RAW_FEED.replace("{customer}", customer)


def orgs_sql(nation: str = "nation") -> str:
    return ORGS.replace("{nation}", nation)


def target_sql(customer: str = "customer") -> str:
    return _target(customer)


def items_sql(
    table: str = "customer",
    key: str = "c_custkey",
    nation: str = "c_nationkey",
    keep: str = "true",
    moved: str = "0",
) -> str:
    """Target user records as JSON text, 20 per page; ``moved`` is added to
    the page number."""
    k = key
    snake = (
        f"concat('\"last_name\":\"N', {k}, '\",\"first_name\":\"F', {k}, '\",\"middle_name\":\"M', {k}, '\"')"
    )
    camel = f"concat('\"lastName\":\"N', {k}, '\",\"firstName\":\"F', {k}, '\",\"middleName\":\"M', {k}, '\"')"
    return f"""
select {k} as k, cast(floor({k} / 20) as bigint) + 1 + {moved} as page, {k} % 20 as pos,
  concat(chr(123),
    case when {k} % 19 = 7 then concat('"_id":null,"id":"S', {k}, '"')
         when {k} % 17 = 6 then concat('"_id":"S', {k} - 1, '"')
         when {k} % 4 = 0 then concat('"id":"S', {k}, '"')
         else concat('"_id":"S', {k}, '"') end,
    ',"_ouid":', {k}, ',',
    case when {k} % 2 = 0 then {camel} else {snake} end,
    ',"personnelNumber":"', {k}, '"',
    case when {k} % 13 = 5 then '' else concat(',"mail":"s', {k}, '@corp.example"') end,
    case {k} % 4 when 0 then ',"userName":"s' when 1 then ',"login":"s' when 2 then ',"username":"s' else ',"user_name":"s' end, {k},
    '","usrOrgTabNum":"T', {k}, '",', case {k} % 3 when 0 then '"orgId":"' when 1 then '"org_id":" ' else '"organizationId":"' end, {nation}, '"',
    case when {k} % 2 = 0 then ',"mobile":"' else ',"phone":" ' end, {k}, '","position":" P', {k} % 7, ' ","rev":', {k},
    case {k} % 5 when 0 then ',"isLogonDisabled":true' when 1 then ',"isLogonDisabled":"No"' when 2 then ',"is_logon_disabled":7'
      when 3 then ',"isLogonDisabled":null' else '' end,
    case when {k} % 6 = 0 then concat(',"managerId":"', {k} - 1, '"') when {k} % 6 = 1 then ',"manager_id":""' else '' end,
    ',"updatedAt":"2024-01-0', {k} % 9 + 1, '"',
    case when {k} % 11 = 3 then ',"accountStatus":"deleted"' else '' end,
    case when {k} % 11 = 4 then ',"deletionDate":"null"' else '' end,
    chr(125)) as item
from {table} where {keep}
"""


def load(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}


#: Rows of a table that one task makes a feed of and parses.
ROWS_A_TASK = 25_000


def dealt(table: DataFrame) -> DataFrame:
    """The rows of a table, dealt out over as many tasks as they are worth.

    A compact table may lie in one row group, which one task reads however
    large it is; parsing its rows takes a hundred times longer than reading
    them. Rows go round all tasks, so keys may repeat.
    """
    tasks = -(-table.count() // ROWS_A_TASK)
    return table.repartition(tasks) if tasks > 1 else table


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it would stand in a file."""
    tables = load(spark, sf_dir, "customer")
    return spark.sql(raw_feed_sql("{customer}"), customer=dealt(tables["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as the reader delivers it, with cleaned cells."""
    cells = raw_cells(spark, sf_dir)
    kept = ("line_no", "record_id")
    return cells.selectExpr(*kept, *[f"{clean_null_token(c)} as {c}" for c in cells.columns if c not in kept])


def orgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(orgs_sql("{nation}"), **load(spark, sf_dir, "nation"))


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(target_sql("{customer}"), **load(spark, sf_dir, "customer"))


def as_pages(records: DataFrame) -> DataFrame:
    """Pages of at most 20 records each, in three body forms."""
    joined = records.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("entries"))
    listed = joined.selectExpr("page", "concat('[', array_join(entries.item, ','), ']') as list")
    return listed.selectExpr(
        "page",
        "case page % 3 when 0 then list when 1 then concat('{\"items\":', list, '}') "
        "else concat('{\"users\":', list, '}') end as body",
    )


# Every 1000th record but 21 arrives one page late, which makes its page short.
LATE = "case when c_custkey % 1000 = 979 then 1 else 0 end"

# Columns of a user snapshot: a third of the records of ``items_sql`` and, for
# the others, people that the target no longer has.
_NOW = "case when c_custkey % 3 = 0 then {} else {} end"
KNOWN_USERS = {
    "_id": _NOW.format("concat('S', c_custkey)", "concat('gone-', c_custkey)"),
    "_ouid": _NOW.format("c_custkey", "1000000000000 + c_custkey"),
    "personnel_number": "concat('', c_custkey)",
    "last_name": "concat('N', c_custkey)",
    "first_name": "concat('F', c_custkey)",
    "middle_name": "concat('M', c_custkey)",
    "match_key": _NOW.format(
        "concat('N', c_custkey, '|F', c_custkey, '|M', c_custkey, '|', c_custkey)", "concat('gone|', c_custkey)"
    ),
    "mail": "concat('before', c_custkey, '@corp.example')",
}

ORG_ITEMS = """
select s_suppkey as k,
  concat(chr(123),
    case when s_suppkey % 5 = 0 then concat('"id":', s_suppkey)
         when s_suppkey % 5 = 1 then concat('"_ouid":null,"ouid":', s_suppkey)
         when s_suppkey % 5 = 2 then concat('"ouid":"', s_suppkey, '"')
         when s_suppkey % 5 = 3 then concat('"_ouid":"x', s_suppkey, '"')
         else concat('"_ouid":', s_suppkey) end,
    ',"code":" C', s_suppkey, ' ","name":"', s_name, '","parentId":', s_nationkey,
    chr(125)) as item
from {supplier}
"""

# A JSON body that holds a text twice: once under a secret key, once under a plain one.
TEXT_AS_JSON = "replace(replace(replace(replace(replace(replace(coalesce(text, ''), chr(92), concat(chr(92), chr(92))), chr(34), concat(chr(92), chr(34))), chr(10), concat(chr(92), 'n')), chr(13), concat(chr(92), 'r')), chr(9), concat(chr(92), 't')), '<', concat(chr(92), chr(34)))"
BODIES = f"""
select doc_id, concat(chr(123), '"doc_id":', doc_id, ',"Token" : "', {TEXT_AS_JSON}, '","note":"', {TEXT_AS_JSON}, '","api_key":', doc_id, chr(125)) as body
from {{documents}}
"""

# the text lies inside an object and a list under secret keys, and beside them
NESTED_BODIES = f"""
select doc_id, concat(chr(123), '"doc_id":', doc_id, ',"Secret":', chr(123), '"deep":[', chr(123), '"text":"', {TEXT_AS_JSON}, '"', chr(125), ',"', chr(125), ']"]', chr(125),
  ',"rows":[', chr(123), '"note":"', {TEXT_AS_JSON}, '","password" : [', doc_id, ',null],"token":null', chr(125), ']', chr(125)) as body
from {{documents}}
"""

PLAN_DOCUMENTS = """
select o_orderkey as doc_id,
  concat(chr(123), '"meta":', chr(123),
    case when o_orderkey % 2 = 0 then '"dataset":"orders"' else '"dataset":"","dataset_name":"orders"' end, chr(125),
    ',"summary":null,"items":[',
    chr(123), '"row_id":"line:', o_orderkey, '","line_no":', o_orderkey, ',"op":"create","resource_id":"r', o_custkey,
    '","desired_state":', chr(123), '"email":"o', o_orderkey, '@corp.example","password":"***"', chr(125),
    ',"changes":', chr(123), '"mail":"x"', chr(125), ',"source_ref":', chr(123), '"match_key":"k', o_custkey, '"', chr(125),
    ',"secret_fields":["password"]', chr(125),
    ',"junk",null,',
    chr(123), '"row_id":', o_orderkey, ',"op":"update","desired_state":',
    case when o_orderkey % 3 = 0 then '[]' else concat(chr(123), '"password":"kept"', chr(125)) end, ',"secret_fields":null',
    chr(125), ']', chr(125)) as body
from {orders}
"""

RESPONSES = """
select o_orderkey as line_no,
  case o_orderkey % 9 when 0 then 200 when 1 then 201 when 2 then 204 when 3 then 401 when 4 then 403
    when 5 then 409 when 6 then 429 when 7 then 500 else 400 end as status,
  case when o_orderkey % 9 = 5 then case when o_orderkey % 2 = 0 then 'Resource Exists' else 'conflict' end
    when o_orderkey % 9 = 8 then concat(chr(123), '"detail":"', o_orderstatus, '","Token":"t', o_orderkey, '"', chr(125))
    when o_orderkey % 9 = 7 then repeat(concat('error ', o_orderkey, ' '), 30)
    else '' end as body
from {orders}
"""
