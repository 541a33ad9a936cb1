"""The queries as DuckDB SQL over the same tables.

The statements share common table expressions, one per stage.  They follow
the rules of each operator with DuckDB's own functions and never see a Spark
expression; only the feeds are the same text.
"""

from __future__ import annotations

import hashlib
import re

from feedplan.plans import feeds

# whitespace of the fixed feeds is ASCII
_TRIM = "E' \\t\\n\\r\\x0b\\x0c'"


def _clean(c: str) -> str:
    return f"case when trim({c}) = '' or lower(trim({c})) = 'null' then null else trim({c}) end"


def _nw(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _flag(c: str) -> str:
    return (
        f"case when lower(trim({c})) in ('1', 'true', 'yes', 'y') then true "
        f"when lower(trim({c})) in ('0', 'false', 'no', 'n') then false end"
    )


_CELLS = (
    "raw_id", "full_name", "login", "email_or_phone", "contacts", "org", "manager", "flags", "employment", "extra",
)

# token lists: kind and value of every contact token
_TOKENS = r"""
list_transform(list_filter(list_transform(regexp_split_to_array({cell}, '[;|,]'), lambda t: trim(t, {ws})),
  lambda t: t <> ''), lambda t:
  case when contains(lower(t), 'email=') and regexp_matches(substr(t, strpos(t, '=') + 1), '{email}')
         then {{'k': 'email', 'v': trim(substr(t, strpos(t, '=') + 1), {ws})}}
       when contains(lower(t), 'phone=') and regexp_matches(substr(t, strpos(t, '=') + 1), '{phone}')
         then {{'k': 'phone', 'v': trim(substr(t, strpos(t, '=') + 1), {ws})}}
       when regexp_matches(t, '{email}') then {{'k': 'email', 'v': t}}
       when regexp_matches(t, '{phone}') then {{'k': 'phone', 'v': t}}
       else {{'k': 'none', 'v': t}} end)
"""


def _tokens(cell: str) -> str:
    # fixed values: what an address and a phone number look like
    return _TOKENS.format(cell=cell, ws=_TRIM, email=r"[^\s,;|]+@[^\s,;|]+", phone=r"[+\d][\d\s()\-]{5,}")


def _first(tokens: str, kind: str) -> str:
    return f"list_filter({tokens}, lambda p: p.k = '{kind}')[1].v"


def _code(attempt: str, line: str = "line_no", width: int = 8) -> str:
    return f"concat('TAB-', left(sha256(concat_ws('|', 'run|employees|code', {line}, {attempt})), {width}))"


def _allocation(name: str, need: str, draw: str) -> dict[str, str]:
    """Codes shared out attempt by attempt: a free one goes to the first of the rows that are not served yet."""
    ctes = {
        f"{name}_tries": f"select line_no, match_key, a as attempt, {draw} as code from {need}, (select unnest([1, 2, 3]) as a) where a >= start",
        f"{name}_free": f"select * from {name}_tries f where not exists (select 1 from target t where t.usr_org_tab_num = f.code and (f.match_key is null or t.match_key <> f.match_key))",
    }
    served = ""
    for attempt in (1, 2, 3):
        left = f" and line_no not in (select line_no from {served}) and code not in (select code from {served})" if served else ""
        now = f"select min(line_no) as line_no, code, {attempt} as attempt from {name}_free where attempt = {attempt}{left} group by code"
        ctes[f"{name}_served{attempt}"] = f"select * from {served} union all {now}" if served else now
        served = f"{name}_served{attempt}"
    ctes[f"{name}_pick"] = f"select n.line_no, cast(coalesce(o.attempt, 0) as integer) as code_pick from {need} n left join {served} o on n.line_no = o.line_no"
    return ctes


def _permutation(name: str, need: str, width: int) -> dict[str, str]:
    """All codes of a width in the order of the keyed permutation; rows in line order get the free ones."""
    half, ctes = 2 * width, {}
    ctes[f"{name}_round0"] = f"select o, o >> {half} as l, o & {2**half - 1} as r from (select unnest(range({16**width})) as o)"
    for i in range(4):
        drawn = hashlib.sha256(f"run|employees|code|{i}".encode()).hexdigest()
        factor, summand = (int(drawn[:8], 16) >> 1) | 1, int(drawn[8:16], 16) >> 2
        ctes[f"{name}_round{i + 1}"] = f"select o, r as l, xor(l, (((r + {summand}) * {factor}) >> 16) & {2**half - 1}) as r from {name}_round{i}"
    ctes[f"{name}_all"] = f"select o, l * {2**half} + r as x, printf('TAB-%0{width}x', l * {2**half} + r) as code from {name}_round4"
    ctes[f"{name}_own"] = f"select lo as match_key, min(x) as x from (select p.x, min(t.match_key) as lo, max(t.match_key) as hi from target t join {name}_all p on p.code = t.usr_org_tab_num group by 1) where lo = hi group by 1"
    ctes[f"{name}_kept"] = f"select min(n.line_no) as line_no, x from {need} n join {name}_own o on n.match_key = o.match_key group by 2"
    ctes[f"{name}_rest"] = f"select line_no, row_number() over (order by line_no) as k from {need} where line_no not in (select line_no from {name}_kept)"
    ctes[f"{name}_open"] = f"select x, row_number() over (order by o) as k from {name}_all where code not in (select usr_org_tab_num from target where usr_org_tab_num is not null)"
    ctes[f"{name}_pick"] = f"select line_no, x + 1 as code_pick from {name}_kept union all select r.line_no, coalesce(f.x + 1, 0) from {name}_rest r left join {name}_open f on r.k = f.k"
    return ctes


#: A feed of four files, as the source and the number of a row of the whole feed.
_FILE, _FILE_LINE = "concat('file-', {0} % 4)", "cast(floor({0} / 4) as bigint) + 2"
_BY_FILE = f"concat_ws('|', {_FILE}, {_FILE_LINE})"


def _id(attempt: str, line: str = "line_no") -> str:
    h = f"sha256(concat_ws('|', 'run|employees|id', {line}, {attempt}))"
    return (
        f"concat(substr({h}, 1, 8), '-', substr({h}, 9, 4), '-', substr({h}, 13, 4), '-', "
        f"substr({h}, 17, 4), '-', substr({h}, 21, 12))"
    )


def _error(stage: str, code: str, field: str, message: str) -> str:
    return f"{{'stage': '{stage}', 'code': '{code}', 'field': '{field}', 'message': '{message}'}}"


def _errors(*rules: tuple[str, str]) -> str:
    return "list_filter([" + ", ".join(f"case when {when} then {e} end" for when, e in rules) + "], lambda e: e is not null)"


# Required fields and their public names.
_REQUIRED = {
    "email": "email", "last_name": "lastName", "first_name": "firstName", "middle_name": "middleName",
    "is_logon_disable": "isLogonDisable", "user_name": "userName", "phone": "phone", "password": "password",
    "personnel_number": "personnelNumber", "organization_id": "organization_id", "position": "position",
    "usr_org_tab_num": "usrOrgTabNum",
}


def _validation() -> str:
    rules = []
    for attr, name in _REQUIRED.items():
        if attr == "password":
            continue  # every row that gets here has one or will get one
        missing = _error("VALIDATE", "REQUIRED_FIELD_MISSING", name, f"{name} is required")
        rules.append((f"e.{attr} is null", missing))
        if attr == "email":
            bad = _error("VALIDATE", "INVALID_EMAIL", "email", "email has invalid format")
            rules.append((r"not regexp_matches(e.email, '^[^@\s]+@[^@\s]+\.[^@\s]+$')", bad))
        if attr == "organization_id":
            small = _error("VALIDATE", "INVALID_INT", "organization_id", "organization_id must be an integer > 0")
            lost = _error("VALIDATE", "ORG_NOT_FOUND", "organization_id", "organization_id not found in cache")
            rules.append(("e.organization_id <= 0", small))
            rules.append(("e.organization_id not in (select _ouid from orgs)", lost))
    return _errors(*rules)


# Compared fields, with what they are compared as.
_DIFF = {
    "mail": (_nw("t.mail"), _nw("v.email")),
    "last_name": (_nw("t.last_name"), _nw("v.last_name")),
    "first_name": (_nw("t.first_name"), _nw("v.first_name")),
    "middle_name": (_nw("t.middle_name"), _nw("v.middle_name")),
    "is_logon_disable": ("t.is_logon_disabled <> 0", "v.is_logon_disable"),
    "user_name": (_nw("t.user_name"), _nw("v.user_name")),
    "phone": (_nw("t.phone"), _nw("v.phone")),
    "personnel_number": ("t.personnel_number", "v.personnel_number"),
    "manager_id": ("t.manager_ouid", "v.manager_id"),
    "organization_id": ("t.organization_id", "v.organization_id"),
    "position": (_nw("t.position"), _nw("v.position")),
    "usr_org_tab_num": (_nw("t.usr_org_tab_num"), _nw("v.usr_org_tab_num")),
}


def _diff() -> str:
    parts = [
        f"case when ({a}) is distinct from ({b}) then "
        f"{{'field': '{f}', 'old': cast({a} as varchar), 'new': cast({b} as varchar)}} end"
        for f, (a, b) in _DIFF.items()
    ]
    return f"case when t._id is null then [] else list_filter([{', '.join(parts)}], lambda c: c is not null) end"


_DELETED = (
    "(coalesce(lower(trim(account_status)) = 'deleted', false) or "
    "coalesce(lower(trim(deletion_date)) not in ('', 'null'), false))"
)

_CTES = {
    "cells": feeds.raw_feed_sql(),
    "feed": "select line_no, record_id, " + ", ".join(f"{_clean(c)} as {c}" for c in _CELLS) + " from cells",
    "orgs": feeds.orgs_sql(),
    "target": feeds.target_sql(),
    "parts": f"""
select *, concat_ws(',', email_or_phone, contacts) as contact_cell,
  case when contains(full_name, ',')
    then list_filter(string_split(trim(substr(full_name, strpos(full_name, ',') + 1), {_TRIM}), ' '), lambda w: w <> '')
    else list_filter(string_split(full_name, ' '), lambda w: w <> '') end as words,
  list_transform(list_filter(string_split(extra, ';'), lambda t: contains(t, '=')),
    lambda t: {{'k': lower(trim(split_part(t, '=', 1))), 'v': trim(substr(t, strpos(t, '=') + 1))}}) as pairs
from feed""",
    "contacts": f"select line_no, {_tokens('contact_cell')} as tokens from parts",
    "mapped": f"""
select p.line_no, p.record_id,
  {_first('c.tokens', 'email')} as email,
  case when contains(full_name, ',') then nullif(trim(split_part(full_name, ',', 1)), '') else words[1] end as last_name,
  case when contains(full_name, ',') then words[1] else words[2] end as first_name,
  case when contains(full_name, ',') then words[2] else words[3] end as middle_name,
  case lower(trim(regexp_extract(flags, '(?i)disabled\\s*[:=]\\s*([^;]+)', 1)))
    when 'true' then 'true' when '1' then 'true' when 'yes' then 'true' when 'y' then 'true' when 'on' then 'true'
    when 'false' then 'false' when '0' then 'false' when 'no' then 'false' when 'n' then 'false' when 'off' then 'false'
    end as is_logon_disable,
  login as user_name,
  {_first('c.tokens', 'phone')} as phone,
  list_filter(pairs, lambda p: p.k = 'password')[-1].v as password,
  raw_id as personnel_number,
  nullif(regexp_extract(case when regexp_matches(manager, '(?i)(manager_id|manager)\\s*[:=]')
    then regexp_extract(manager, '(?i)(?:manager_id|manager)\\s*[:=]\\s*([^;]+)', 1) else manager end, '\\d+'), '') as manager_id,
  list_filter(pairs, lambda p: p.k = 'org_id')[-1].v as organization_id,
  nullif(trim(regexp_extract(employment, '(?i)role\\s*[:=]\\s*([^;]+)', 1)), '') as position,
  list_filter(pairs, lambda p: p.k = 'tab')[-1].v as usr_org_tab_num
from parts p join contacts c on p.line_no = c.line_no""",
    "normal": f"""
select line_no, nullif({_nw('email')}, '') as email, nullif({_nw('last_name')}, '') as last_name,
  nullif({_nw('first_name')}, '') as first_name, nullif({_nw('middle_name')}, '') as middle_name,
  case is_logon_disable when 'true' then true when 'false' then false end as is_logon_disable,
  nullif({_nw('user_name')}, '') as user_name, nullif({_nw('phone')}, '') as phone, password,
  nullif({_nw('personnel_number')}, '') as personnel_number, nullif({_nw('manager_id')}, '') as manager_key,
  case when regexp_matches(trim(organization_id), '^[+-]?\\d+(_\\d+)*$')
    then try_cast(replace(trim(organization_id), '_', '') as bigint) end as organization_id,
  nullif({_nw('position')}, '') as position, nullif({_nw('usr_org_tab_num')}, '') as usr_org_tab_num,
  organization_id is not null and not regexp_matches(trim(organization_id), '^[+-]?\\d+(_\\d+)*$') as failed
from mapped""",
    "keyed": """
select *, case when failed or last_name is null or first_name is null or middle_name is null or personnel_number is null
  then null else concat_ws('|', last_name, first_name, middle_name, personnel_number) end as match_key
from normal""",
    "active": f"select * from target where not {_DELETED}",
    "by_key": "select match_key, count(*) as n, min(_ouid) as ouid from active group by match_key",
    "code_need": """
select line_no, match_key, case when usr_org_tab_num is null then 1 else 2 end as start from keyed k
where not failed and (usr_org_tab_num is null or (
  usr_org_tab_num in (select usr_org_tab_num from target)
  and not exists (select 1 from target t where t.usr_org_tab_num = k.usr_org_tab_num and t.match_key = k.match_key)))""",
    **_allocation("code", "code_need", _code("a")),
    "narrow_need": """
select line_no, match_key, case when line_no % 3 <> 0 then 1 else start end as start from keyed k left join (select line_no, start from code_need) n using (line_no)
where not failed and (line_no % 3 <> 0 or start is not null)""",
    **_allocation("narrow", "narrow_need", _code("a", width=3)),
    **_permutation("permuted", "narrow_need", 3),
    "files": f"select *, {_BY_FILE.format('line_no')} as drawn_by from keyed",
    **_allocation("files", "code_need", _code("a", _BY_FILE.format("line_no"))),
    "enriched": f"""
select k.* exclude (usr_org_tab_num), m.ouid as manager_id,
  case when code_pick is null then k.usr_org_tab_num when code_pick > 0 then {_code('code_pick', 'k.line_no')} end as usr_org_tab_num,
  coalesce(code_pick > 0, false) as code_generated,
  case when not k.failed then {_id('1', 'k.line_no')} end as resource_id,
  not k.failed and coalesce(k.password, '') = '' as secret_generated,
  case when k.failed then [{_error('NORMALIZE', 'INVALID_INT', 'organization_id', 'organization_id must be an integer')}]
  else {_errors(
      ("k.match_key is null", _error("ENRICH", "MATCH_KEY_MISSING", "matchKey", "match_key cannot be built")),
      ("k.manager_key is not null and m.n > 1", _error("ENRICH", "MANAGER_CONFLICT", "managerId", "multiple managers found for match_key")),
      ("k.manager_key is not null and m.n is null", _error("ENRICH", "MANAGER_NOT_FOUND", "managerId", "manager not found in cache")),
  )} end as errors
from keyed k left join code_pick c on k.line_no = c.line_no left join by_key m on m.match_key = k.manager_key""",
    "checked": f"select e.* exclude (errors), {_validation()} as errors from enriched e where len(e.errors) = 0",
    "decided": f"""
select v.* exclude (errors, resource_id), coalesce(b.n, 0) as n_candidates, {_diff()} as diff,
  case when len(v.errors) > 0 then 'invalid' when b.n > 1 then 'conflict' when b.n is null then 'create'
    when len({_diff()}) = 0 then 'skip' else 'update' end as decision,
  case when len(v.errors) > 0 then null when b.n > 1 then null when b.n is null then v.resource_id else t._id end as resource_id,
  case when len(v.errors) = 0 and b.n > 1
    then [{_error('PLAN', 'MATCH_CONFLICT', 'matchKey', 'multiple candidates found')}] else v.errors end as errors
from checked v left join by_key b on b.match_key = v.match_key
  left join active t on t.match_key = v.match_key and b.n = 1""",
    "report": """
select *, case when decision in ('create', 'update') then 'OK' when decision = 'skip' then 'SKIPPED' else 'FAILED' end as status
from decided""",
    "by_files": f"""
select {_FILE.format('k.line_no')} as source_id, {_FILE_LINE.format('k.line_no')} as line_no, match_key, manager_id,
  case when not failed then {_id('1', _BY_FILE.format('k.line_no'))} end as resource_id,
  case when p.code_pick is null then f.usr_org_tab_num when p.code_pick > 0 then {_code('p.code_pick', _BY_FILE.format('k.line_no'))} end as usr_org_tab_num,
  coalesce(p.code_pick > 0, false) as code_generated, errors
from enriched k join (select line_no, usr_org_tab_num from keyed) f on f.line_no = k.line_no left join files_pick p on p.line_no = k.line_no""",
    "records": feeds.items_sql(),
    "users": """
select page * 16777216 + pos as ingest_pos, k, page,
  case when k % 19 = 7 then '' when k % 17 = 6 then concat('S', k - 1) else concat('S', k) end as item_key,
  k % 11 = 3 as is_deleted,
  case when k % 19 = 7 then 'Missing required field: _id' when k % 13 = 5 then 'Missing required field: mail' end as map_error,
  case when k % 19 = 7 then null when k % 17 = 6 then concat('S', k - 1) else concat('S', k) end as _id,
  k as _ouid, concat('N', k) as last_name, concat('N', k, '|F', k, '|M', k, '|', k) as match_key,
  case when k % 13 <> 5 then concat('s', k, '@corp.example') end as mail,
  concat('s', k) as user_name, concat('T', k) as usr_org_tab_num,
  case when k % 11 = 4 then 'null' end as deletion_date
from records""",
    "known": "select " + ", ".join(f"{e} as {c}" for c, e in feeds.KNOWN_USERS.items()) + " from customer",
    "broken": """
select ingest_pos, '_ouid' as taken_by from users u join known x on u._ouid = x._ouid
where not is_deleted and map_error is null and u._id <> x._id""",
    "outcome": """
select u.*, case when is_deleted then 'skipped' when map_error is not null or b.taken_by is not null then 'failed'
    when u._id in (select _id from known)
      or exists (select 1 from users f left join broken g on g.ingest_pos = f.ingest_pos where f._id = u._id
        and f.ingest_pos < u.ingest_pos and not f.is_deleted and f.map_error is null and g.taken_by is null)
    then 'updated' else 'inserted' end as outcome,
  case when is_deleted then null else coalesce(map_error, 'UNIQUE constraint failed: ' || b.taken_by) end as message
from users u left join broken b on b.ingest_pos = u.ingest_pos""",
    "last_users": """
select _id, arg_max(_ouid, ingest_pos) as _ouid, arg_max(match_key, ingest_pos) as match_key, arg_max(mail, ingest_pos) as mail
from outcome where outcome in ('inserted', 'updated') group by _id""",
    "user_table": """
select coalesce(n._id, o._id) as _id, case when n._id is null then o._ouid else n._ouid end as _ouid,
  case when n._id is null then o.match_key else n.match_key end as match_key,
  case when n._id is null then o.mail else n.mail end as mail,
  case when n._id is null then 'kept' when o._id is null then 'inserted' else 'updated' end as op
from known o full outer join last_users n on o._id = n._id""",
    "org_rows": """
select s_suppkey as k, case s_suppkey % 5 when 1 then '' when 3 then concat('x', s_suppkey) else concat('', s_suppkey) end as item_key,
  case s_suppkey % 5 when 1 then 'Organization must contain _ouid' when 3 then '_ouid is no integer' end as map_error,
  case when s_suppkey % 5 in (1, 3) then null else s_suppkey end as _ouid,
  concat('C', s_suppkey) as code, s_name as name, cast(s_nationkey as bigint) as parent_id, cast(null as varchar) as updated_at
from supplier""",
    "vault": """
select event_type as dataset, 'password' as field, concat('', user_id) as match_key, concat('v', event_id) as value,
  concat('r', day(ts)) as run_id, event_id as seq from events""",
    "stored": """
select match_key, arg_max(password, line_no) as password from enriched
where len(errors) = 0 and coalesce(password, '') <> '' group by match_key""",
    "requests": """
select d.*, s.password as vault_password,
  case when decision = 'create' and s.password is null then 'SECRET_REQUIRED'
       when decision = 'update' then 'UNEXPECTED_ERROR' end as error_code
from decided d left join stored s on s.match_key = d.match_key where decision in ('create', 'update')""",
    "responses": feeds.RESPONSES.replace("{orders}", "orders"),
    "order_requests": """
select o_orderkey as line_no, case when o_orderkey % 3 = 0 then 'update' else 'create' end as op,
  o_orderkey % 50 = 7 as no_id from orders""",
    "outcomes": """
select line_no, op, case when no_id then 'RESOURCE_ID_MISSING' when status in (200, 201) then null
    when status = 401 then 'UNAUTHORIZED' when status = 403 then 'FORBIDDEN' when status = 409 then 'CONFLICT'
    else 'HTTP_ERROR' end as code
from order_requests join responses using (line_no)""",
    "applied": """
select line_no, op, case when code is not null then 'failed' when op = 'create' then 'created' else 'updated' end as outcome, code
from outcomes""",
    "merged": """
select coalesce(n._id, t._id) as _id, t._ouid as _ouid,
  case when n._id is null then t.match_key else n.match_key end as match_key,
  case when n._id is null then t.mail else n.email end as mail,
  case when n._id is null then t.phone else n.phone end as phone,
  case when n._id is null then t.usr_org_tab_num else n.usr_org_tab_num end as usr_org_tab_num,
  case when n._id is null then t.organization_id else n.organization_id end as organization_id,
  case when n._id is null then t.is_logon_disabled else cast(n.is_logon_disable as integer) end as is_logon_disabled,
  case when n._id is null then 'kept' when t._id is null then 'inserted' else 'updated' end as op
from target t full outer join (select resource_id as _id, * exclude (resource_id) from decided where decision in ('create', 'update')) n
  on t._id = n._id""",
}

# The CTEs each one reads, found by name.
_ORDER = list(_CTES)


def _with(query: str) -> str:
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"(?:from|join)\s+{name}\b", sql):
                needed.add(name)
                visit(_CTES[name])

    visit(query)
    ctes = ",\n".join(f"{n} as materialized ({_CTES[n]})" for n in _ORDER if n in needed)
    return f"with {ctes}\n{query}" if ctes else query


_CODES = "case when len({e}) = 0 then 'none' else array_to_string(list_sort(list_distinct(list_transform({e}, lambda x: x.code))), ',') end"
_CODES_ERRORS = _CODES.format(e="errors")
_ROWS = "select line_no, cast(i - 1 as {t}) as ord, e.stage as stage, e.code as code, e.field as field, e.message as message from (select line_no, unnest(errors) as e, generate_subscripts(errors, 1) as i from {src})"

_MAPPED_OUT = "email, last_name, first_name, middle_name, is_logon_disable, user_name, phone, personnel_number, manager_id, organization_id, position, usr_org_tab_num"
_TYPED = (
    "email", "last_name", "first_name", "middle_name", "is_logon_disable", "user_name", "phone",
    "personnel_number", "manager_key", "organization_id", "position", "usr_org_tab_num",
)

_PAYLOAD_GAPS = ", ".join(
    f"case when coalesce(cast({a} as varchar), '') = '' then '{a}' end" for a in _REQUIRED
)
_STAGE = "count(*) as rows_total, {ok} as ok, {failed} as failed, cast(0 as bigint) as warnings_rows, count(*) filter (where {n} > 0) as vault_candidates_rows, cast(sum({n}) as bigint) as vault_candidates_fields_total"
_HAS = "case when coalesce(password, '') <> '' then 1 else 0 end"

_WORDS = {
    "strict_bool": "[' TRUE ', 'false', 'yes', '1', 't', ''][o_orderkey % 6 + 1]",
    "strict_int": "[concat(' +', o_orderkey, ' '), concat('-', o_orderkey), concat('1_0', o_orderkey), concat(o_orderkey, '.5'), '', concat('__', o_orderkey), '99999999999999999999'][o_orderkey % 7 + 1]",
    "lenient_bool": "[' Y ', '0', 'No', 'TRUE', 'maybe', '1', 'false', null][o_orderkey % 8 + 1]",
}


def _quoted_cells() -> str:
    cells = [f"replace({c}, ',', ',\"x\"')" if c == "contacts" else c for c in _CELLS]
    return "select line_no, " + ", ".join(f"{_clean(e)} as {c}" for e, c in zip(cells, _CELLS, strict=True)) + " from cells"


_FILED = "(select concat('f', line_no % 3) as source_id, cast(floor(line_no / 3) as bigint) as line_no, outcome, code from applied)"

_SQL = {
    "csv_record_parse": _quoted_cells(),
    "csv_torn_lines": """
select row_number() over (order by line_no) as line_no, cast(line_no as varchar) as key, concat('n', line_no, '" x') as note,
  concat(coalesce(full_name, ''), chr(10), chr(10), '" , ', line_no) as body from cells""",
    "record_numbering": "select row_number() over (order by line_no) + 1 as line_no, concat('line:', row_number() over (order by line_no) + 1) as record_id, line_no as key_no, full_name from feed",
    "null_token_clean": "select line_no, raw_id, login, manager from feed",
    "paged_json_items": "select page, pos, k as ouid from records",
    "paged_stop_rule": """
with counted as (select cast(floor((p - 1) / 50) as bigint) as shard, (p - 1) % 50 + 1 as page, n as n_records from (
  select cast(floor(c_custkey / 20) as bigint) + 1 + case when c_custkey % 1000 = 979 then 1 else 0 end as p, count(*) as n from customer group by 1)),
ends as (select shard, min(page) filter (where n_records < 20) as short_page, max(page) as last_seen from counted group by shard)
select c.shard, c.page, c.n_records, case when c.page = least(coalesce(short_page, last_seen), 49)
    and coalesce(short_page, 1000000) > 49 and last_seen >= 49 then 'MAX_PAGES_EXCEEDED' end as page_error
from counted c join ends using (shard) where c.page <= least(coalesce(short_page, last_seen), 49)""",
    "page_failure": "select page, case page % 7 when 3 then 'INVALID_JSON' when 5 then 'INVALID_ITEMS_FORMAT' end as page_error from (select distinct page from records)",
    "plan_read_clean": """
select o_orderkey as doc_id, cast(0 as bigint) as pos, concat('line:', o_orderkey) as row_id, 'create' as op, concat('r', o_custkey) as resource_id,
  concat('o', o_orderkey, '@corp.example') as email, cast(null as varchar) as password, cast(1 as bigint) as n_state, cast(1 as bigint) as n_changes,
  concat('k', o_custkey) as match_key, 'password' as secrets from orders
union all
select o_orderkey, 3, concat('', o_orderkey), 'update', '', null, case when o_orderkey % 3 <> 0 then 'kept' end,
  case when o_orderkey % 3 <> 0 then 1 else 0 end, 0, null, '' from orders""",
    "map_canonical": f"select line_no, {_MAPPED_OUT}, cast(null as varchar) as avatar_id, cast(null as varchar) as resource_id from mapped",
    "name_split": "select line_no, last_name, first_name, middle_name from mapped",
    "contact_extract": "select line_no, email, phone from mapped",
    "contact_extract_documents": f"select doc_id, {_first('tokens', 'email')} as email, {_first('tokens', 'phone')} as phone from (select doc_id, {_tokens('text')} as tokens from documents)",
    "kv_parse": """
select line_no, p.k as key, arg_max(p.v, i) as value from (select line_no, unnest(pairs) as p, generate_subscripts(pairs, 1) as i from parts)
where p.k <> '' group by line_no, p.k""",
    "manager_ref_parse": "select line_no, manager_id from mapped",
    "flag_parse": "select line_no, is_logon_disable from mapped",
    "role_parse": "select line_no, position from mapped",
    "secret_candidates": "select line_no, 'password' as field from mapped where coalesce(trim(password), '') <> ''",
    "desired_state": "select line_no, email, last_name, first_name, middle_name, is_logon_disable, user_name, phone, personnel_number, manager_id, organization_id, position, cast(null as varchar) as avatar_id, usr_org_tab_num, match_key from enriched where len(errors) = 0",
    "upsert_payload": f"""
with_error as (select *, case when concat_ws(', ', {_PAYLOAD_GAPS}) <> ''
  then concat('Missing required fields for payload: ', concat_ws(', ', {_PAYLOAD_GAPS})) end as error from enriched where len(errors) = 0)
select line_no, error, case when error is null then email end as mail, case when error is null then last_name end as "lastName",
  case when error is null then first_name end as "firstName", case when error is null then middle_name end as "middleName",
  case when error is null then is_logon_disable end as "isLogonDisabled", case when error is null then user_name end as "userName",
  case when error is null then phone end as phone, case when error is null then personnel_number end as "personnelNumber",
  case when error is null then manager_id end as "managerId", case when error is null then organization_id end as organization_id,
  case when error is null then position end as position, cast(null as varchar) as "avatarId", case when error is null then usr_org_tab_num end as "usrOrgTabNum", error is null as has_password
from with_error""",
    "snapshot_map_users": """
select u.ingest_pos, item_key, is_deleted, map_error, _id, _ouid, concat('', u.k) as personnel_number, last_name, concat('F', u.k) as first_name,
  concat('M', u.k) as middle_name, match_key, mail, user_name, concat('', u.k) as phone, usr_org_tab_num,
  cast(c_nationkey as bigint) as organization_id, case when u.k % 11 = 3 then 'deleted' end as account_status, deletion_date,
  concat('', u.k) as _rev, case when u.k % 6 = 0 then u.k - 1 end as manager_ouid,
  cast(case u.k % 5 when 0 then 1 when 1 then 0 when 2 then 1 end as integer) as is_logon_disabled, concat('P', u.k % 7) as position,
  concat('2024-01-0', u.k % 9 + 1) as updated_at
from users u join customer on c_custkey = u.k""",
    "snapshot_map_orgs": "select * from org_rows",
    "whitespace_norm": r"select doc_id, md5(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) as text_md5 from documents",
    "email_check": r"select line_no, regexp_matches(email_or_phone, '^[^@\s]+@[^@\s]+\.[^@\s]+$') as is_email from feed",
    "strict_bool": f"select o_orderkey, case lower(trim(w)) when 'true' then true when 'false' then false end as flag from (select o_orderkey, {_WORDS['strict_bool']} as w from orders)",
    "strict_int": rf"select o_orderkey, case when regexp_matches(trim(w), '^[+-]?\d+(_\d+)*$') then try_cast(replace(trim(w), '_', '') as bigint) end as number from (select o_orderkey, {_WORDS['strict_int']} as w from orders)",
    "lenient_bool": f"select o_orderkey, {_flag('w')} as flag, w is not null and ({_flag('w')}) is null as bad from (select o_orderkey, {_WORDS['lenient_bool']} as w from orders)",
    "deleted_filter": f"select _id, {_DELETED} as deleted from target",
    "truncate_text": "select doc_id, case when length(text) > 500 then concat(left(text, 497), '...') else text end as short, left(text, 3) as tiny from documents",
    "mask_nested": "select event_id, '***' as token, user_id, '***' as api_key, event_id as n, '***' as secret, event_type as kind, cast(null as varchar) as password from events",
    "redact_documents": "select doc_id, md5(concat(left(body, strpos(body, ' : ') + 2), '\"***\"', ',\"note\":\"', " + feeds.TEXT_AS_JSON + ", '\",\"api_key\":\"***\"', chr(125))) as masked_md5, length(body) as n_body from (" + feeds.BODIES.replace("{documents}", "documents") + ") join documents using (doc_id)",
    "redact_nested_documents": "select doc_id, md5(concat(left(body, strpos(body, ':' || chr(123) || '\"deep\"')), '\"***\"', ',\"rows\":[', chr(123), '\"note\":\"', " + feeds.TEXT_AS_JSON + ", '\",\"password\" : \"***\",\"token\":null', chr(125), ']', chr(125))) as masked_md5, length(body) as n_body from (" + feeds.NESTED_BODIES.replace("{documents}", "documents") + ") join documents using (doc_id)",
    "source_fingerprint": "select page_id, sha256(url) as source_id from pages",
    "normalize_rows": "select line_no, " + ", ".join(f"case when not failed then {c} end as {c}" for c in _TYPED) + ", not failed as ok from normal",
    "normalize_errors": "select line_no, cast(0 as integer) as ord, 'NORMALIZE' as stage, 'INVALID_INT' as code, 'organization_id' as field, 'organization_id must be an integer' as message from normal where failed",
    "match_key": "select line_no, match_key from keyed",
    "identity_match": "select k.line_no, coalesce(b.n, 0) as n_candidates, case when b.n is null then 'not_found' when b.n = 1 then 'matched' else 'conflict' end as match_status, t._id from keyed k left join by_key b on b.match_key = k.match_key left join active t on t.match_key = k.match_key and b.n = 1",
    "org_exists": "select line_no, organization_id, organization_id in (select _ouid from orgs) as known from normal where organization_id is not null",
    "manager_resolve": "select n.line_no, a.ouid as manager_ouid, case when a.n is null then 3 when a.n > 1 then 2 else 0 end as manager_state from normal n left join (select _ouid as ouid, count(*) as n from active group by _ouid) a on a.ouid = cast(n.manager_key as bigint) where not failed and manager_key is not null",
    "id_collision": "select line_no, concat('id-', line_no) as wanted, concat('id-', line_no) in (select _id from target) as id_taken from feed",
    "code_collision": "select line_no, usr_org_tab_num as code, coalesce(usr_org_tab_num in (select usr_org_tab_num from target), false) as code_held, exists (select 1 from target t where t.usr_org_tab_num = k.usr_org_tab_num and t.match_key = k.match_key) as code_mine from keyed k",
    "enrich_rows": f"select line_no, match_key, manager_id, resource_id, usr_org_tab_num, code_generated, secret_generated, {_CODES_ERRORS} as codes from enriched",
    "id_allocate": f"select line_no, case when concat('id-', line_no) in (select _id from target) then {_id('2')} else concat('id-', line_no) end as resource_id, case when concat('id-', line_no) in (select _id from target) then 2 end as id_pick from feed",
    "code_allocate": f"select line_no, code_pick, case when code_pick > 0 then {_code('code_pick')} end as code from code_pick",
    "normalize_checks": """
select line_no, cast(row_number() over (partition by line_no order by i) - 1 as bigint) as ord, 'NORMALIZE' as stage, code, field from (
  select line_no, 1 as i, 'REQUIRED_FIELD_MISSING' as code, 'user_name' as field from mapped where user_name is null
  union all select line_no, 2, 'REQUIRED_FIELD_MISSING', 'email' from mapped where email is null
  union all select line_no, 3, 'INVALID_INT', 'organization_id' from normal where failed
  union all select line_no, 4, 'TOO_LARGE', 'organization_id' from normal where organization_id > 10)""",
    "payload_errors": """
select o_orderkey as line_no, error, case when error is null then o_orderkey % 3 = 0 end as disabled,
  case when error is null and o_orderkey % 4 = 0 then 5 end as manager_id,
  case when error is null then case o_orderkey % 5 when 0 then 7 else 10 end end as organization_id
from (select o_orderkey, case when o_orderkey % 5 = 3 then 'Missing required fields for payload: organization_id'
    when o_orderkey % 3 = 1 then 'Invalid boolean value for isLogonDisabled' when o_orderkey % 4 = 2 then 'manager_id is no integer'
    when o_orderkey % 5 in (1, 4) then 'organization_id is no integer' end as error from orders)""",
    "header_contract": "select count(*) as n_records, c as left_out, concat('Missing required columns in source CSV: ', c) as verdict from feed, (select unnest([" + ", ".join(f"'{c}'" for c in _CELLS) + "]) as c) group by c",
    "enrich_rows_files": f"select source_id, line_no, match_key, manager_id, resource_id, usr_org_tab_num, code_generated, {_CODES_ERRORS} as codes from by_files",
    "code_allocate_narrow": f"select line_no, code_pick, case when code_pick > 0 then {_code('code_pick', width=3)} end as code from narrow_pick",
    "code_allocate_permuted": "select line_no, cast(code_pick as bigint) as code_pick, case when code_pick > 0 then printf('TAB-%03x', code_pick - 1) end as code from permuted_pick",
    "secret_default": "select line_no, 'password' as field, coalesce(password, '') = '' as generated from enriched where len(errors) = 0",
    "vault_flow": f"select line_no, match_key, {_CODES_ERRORS} as codes, case when len(errors) = 0 then 'password' end as field, case when len(errors) = 0 then case when coalesce(password, '') = '' then 32 else length(password) end end as n_value, case when len(errors) = 0 then 'run' end as run_id from enriched",
    "vault_replay": "select match_key, 'password' as field, count(*) as n_rows, cast(1 as bigint) as n_appends from enriched where len(errors) = 0 group by match_key",
    "plan_file": "select concat('line:', line_no) as row_id, line_no, decision as op, resource_id, email, len(diff) as n_changes, match_key, case when decision = 'create' then 'password' else '' end as secrets from decided where decision in ('create', 'update')",
    "report_file": """
select s.status, 'run' as run_id, t.truncated as items_truncated, s.rows_total, s.rows_blocked, i.line_no, len(i.errors) as n_diagnostics, case when len(i.errors) > 0 then 'error' else '' end as severity
from (select count(*) as rows_total, count(*) filter (where status = 'FAILED') as rows_blocked,
  case when sum(len(errors)) = 0 then 'SUCCESS' when count(*) filter (where status = 'OK') > 0 then 'PARTIAL' else 'FAILED' end as status from report) s,
 (select count(*) > 200 as truncated from report where status = 'FAILED') t,
 (select line_no, errors from report where status = 'FAILED' order by line_no limit 200) i""",
    "warnings_report": "select count(*) as rows_with_warnings, count(*) as warnings_total, count(*) as stage_warnings from decided where length(user_name) < 4",
    "apply_report": "select line_no, case when code is null then 'OK' else 'FAILED' end as status, case when code is null then '' else 'APPLY' end as stages, coalesce(code, 'none') as codes, op, case when line_no % 50 = 7 then '' else concat('id-', line_no) end as resource_id from applied",
    "apply_plan": """
select d.line_no, d.decision as op, case when d.decision = 'create' and s.password is null then 'failed' when d.decision = 'create' then 'created' else 'failed' end as outcome,
  case when d.decision = 'create' and s.password is null then 'SECRET_REQUIRED' when d.decision = 'update' then 'UNEXPECTED_ERROR' end as code
from decided d left join stored s on s.match_key = d.match_key where d.decision in ('create', 'update')""",
    "vault_put": "select 'employees' as dataset, 'password' as field, match_key, 'run' as run_id, line_no, length(password) as n_value from enriched where len(errors) = 0 and coalesce(password, '') <> ''",
    "vault_latest": "select dataset, field, match_key, arg_max(value, seq) as value from vault group by all",
    "vault_of_run": "select dataset, field, match_key, coalesce(arg_min(value, seq) filter (where run_id = 'r2'), arg_max(value, seq)) as value from vault group by all",
    "keyed_fallback": """
select o.o_orderkey as request_no, case when o.o_orderkey % 11 = 0 then concat('both', o.o_orderkey)
  when o.o_custkey % 5 = 0 then concat('row', r.k) when o.o_orderkey % 7 = 0 then concat('line', o.o_orderkey)
  when o.o_orderstatus <> 'P' then concat('any', a.k) else 'none' end as value
from orders o
join (select o_orderstatus, o_custkey, min(o_orderkey) as k from orders group by all) r on r.o_orderstatus = o.o_orderstatus and r.o_custkey = o.o_custkey
join (select o_orderstatus, min(o_orderkey) as k from orders group by all) a on a.o_orderstatus = o.o_orderstatus""",
    "secret_required": "select line_no, error_code, 'password' as error_field from requests where error_code = 'SECRET_REQUIRED'",
    "validate_rows": "select line_no, len(errors) = 0 as valid, len(errors) as n_errors from checked",
    "validate_codes": _ROWS.format(t="bigint", src="checked"),
    "valid_split": "select line_no, case when len(errors) = 0 then 'valid' else 'blocked' end as part from checked",
    "error_code_summary": f"select line_no, {_CODES_ERRORS} as codes from checked where len(errors) > 0",
    "duplicate_report": """
select 'customer' as key, concat('', o_custkey) as value, count(*) as n_rows, min(o_orderkey) as first_line_no from orders group by o_custkey having count(*) > 1
union all select 'priority', o_orderpriority, count(*), min(o_orderkey) from orders where o_orderpriority is not null group by o_orderpriority having count(*) > 1""",
    "dropped_rows": _ROWS.format(t="bigint", src="enriched"),
    "snapshot_diff": "select match_key, c.field as field, c.old as old_value, c.new as new_value from (select match_key, unnest(diff) as c from decided)",
    "snapshot_diff_orders": "select o_orderkey as line_no, case when o_orderkey % 10 = 0 then 'create' when o_orderkey % 7 = 0 then 'update' else 'skip' end as decision, case when o_orderkey % 10 <> 0 and o_orderkey % 7 = 0 then 'total' else '' end as fields from orders",
    "change_set": "select line_no, c.field as field, c.new as value from (select line_no, unnest(diff) as c from decided where decision = 'update')",
    "plan_decision": "select line_no, match_key, decision, case decision when 'conflict' then 'MATCH_CONFLICT' when 'skip' then 'NO_CHANGES' end as reason, resource_id from decided",
    "plan_items": "select concat('line:', line_no) as row_id, line_no, decision as op, resource_id, email, organization_id, len(diff) as n_changes, match_key, case when decision = 'create' then 'password' else '' end as secrets from decided where decision in ('create', 'update')",
    "plan_rows": f"select line_no, decision, status, {_CODES_ERRORS} as codes from report",
    "plan_summary": "select count(*) as rows_total, count(*) filter (where decision in ('create', 'update', 'skip')) as valid_rows, count(*) filter (where decision in ('invalid', 'conflict')) as failed_rows, count(*) filter (where decision = 'create') as planned_create, count(*) filter (where decision = 'update') as planned_update, count(*) filter (where decision = 'skip') as skipped from decided",
    "report_summary": "select *, case when errors_total = 0 then 'SUCCESS' when rows_passed > 0 then 'PARTIAL' else 'FAILED' end as status from (select count(*) as rows_total, count(*) filter (where status = 'OK') as rows_passed, count(*) filter (where status = 'FAILED') as rows_blocked, cast(0 as bigint) as rows_with_warnings, cast(sum(len(errors)) as bigint) as errors_total, cast(0 as bigint) as warnings_total from report)",
    "run_status": "select organization_id, case when sum(len(errors)) = 0 then 'SUCCESS' when count(*) filter (where status = 'OK') > 0 then 'PARTIAL' else 'FAILED' end as status from report group by organization_id",
    "diagnostics_by_stage": "select e.stage as stage, count(*) as errors_total, cast(0 as bigint) as warnings_total from (select unnest(errors) as e from enriched union all select unnest(errors) from decided) group by 1",
    "ops_counters": "select op, count(*) filter (where code is null) as ok, count(*) filter (where code is not null) as failed, count(*) as n from outcomes group by op",
    "report_items": f"""
select line_no, status, {_CODES_ERRORS} as codes,
  (select max(line_no) from report where status = 'FAILED') > (select max(line_no) from (select line_no from report where status <> 'OK' order by line_no limit 200)) as truncated
from report where status <> 'OK' order by line_no limit 200""",
    "stage_report": "select 'mapping' as stage, "
    + _STAGE.format(ok="count(*)", failed="cast(0 as bigint)", n=_HAS)
    + " from mapped union all select 'normalize', "
    + _STAGE.format(ok="count(*) filter (where not failed)", failed="count(*) filter (where failed)", n=_HAS)
    + " from normal union all select 'enrich', "
    + _STAGE.format(ok="count(*) filter (where len(errors) = 0)", failed="count(*) filter (where len(errors) > 0)", n=f"({_HAS} + cast(secret_generated as integer))")
    + " from enriched",
    "validate_report": "select count(*) as rows_total, count(*) filter (where len(errors) = 0) as valid_rows, count(*) filter (where len(errors) > 0) as failed_rows, cast(0 as bigint) as warnings_rows from checked",
    "error_histogram": "select e.code as code, count(*) as n from (select unnest(errors) as e from enriched union all select unnest(errors) from decided) group by 1",
    "refresh_outcome": "select ingest_pos, item_key, outcome, message from outcome",
    "unique_violations": "select ingest_pos, taken_by from broken",
    "refresh_counters": "select 'employees' as dataset, count(*) filter (where outcome = 'inserted') as inserted, count(*) filter (where outcome = 'updated') as updated, count(*) filter (where outcome = 'failed') as failed, count(*) filter (where outcome = 'skipped') as skipped, max(page) as pages from outcome",
    "refresh_totals": """
select u.i + o.i as inserted, u.u + o.u as updated, u.f + o.f as failed, u.s as skipped from
(select count(*) filter (where outcome = 'inserted') as i, count(*) filter (where outcome = 'updated') as u, count(*) filter (where outcome = 'failed') as f, count(*) filter (where outcome = 'skipped') as s from outcome) u,
(select count(*) filter (where map_error is null and _ouid not in (select _ouid from orgs)) as i, count(*) filter (where map_error is null and _ouid in (select _ouid from orgs)) as u, count(*) filter (where map_error is not null) as f from org_rows) o""",
    "refresh_meta": """
select 'employees' as dataset, 'last_refresh_run_id' as key, 'run' as value
union all select 'employees', 'last_refresh_pages', cast(max(page) as varchar) from outcome
union all select 'employees', 'last_refresh_items', cast(count(*) as varchar) from outcome
union all select 'employees', 'count_total', cast(count(*) as varchar) from user_table""",
    "snapshot_upsert": "select _id, _ouid, match_key, mail, op from user_table",
    "snapshot_upsert_orders": """
select o_orderkey, case when o_orderkey % 10 = 0 then o_totalprice else o_totalprice + 1 end as o_totalprice, o_orderstatus,
  case when o_orderkey % 10 = 0 then 'kept' else 'updated' end as op from orders
union all select -1 - o_orderkey, o_totalprice + 1, o_orderstatus, 'inserted' from orders where o_orderkey % 10 = 0""",
    "snapshot_merge_orders": """
select o_orderkey, case when o_orderkey % 100 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice, o_orderstatus
from orders where o_orderkey % 250 <> 2""",
    "stale_removed": "select _id, _ouid, match_key, mail from user_table where _id in (select _id from users where _id is not null)",
    "snapshot_status": "select 'organizations' as dataset, count(*) as n_rows from orgs union all select 'employees', count(*) from known",
    "snapshot_clear": "select 'organizations' as dataset, cast(0 as bigint) as n_left, count(*) as n_removed from orgs union all select 'employees', 0, count(*) from known",
    "stale_rows": "select _id from known where _id not in (select _id from users where _id is not null)",
    "request_rows": """
select line_no, decision as op, 'PUT' as method, concat('/managed/user/', resource_id) as path, 'false' as decrypt,
  case when error_code is null then email end as mail, case when error_code is null then is_logon_disable end as disabled,
  case when error_code is null then organization_id end as organization_id, error_code,
  case when error_code = 'UNEXPECTED_ERROR' then 'Missing required fields for payload: password' end as error_message from requests""",
    "outcome_classify": """
select line_no, status, status in (200, 201) as ok,
  case when status in (200, 201) then null when status = 401 then 'UNAUTHORIZED' when status = 403 then 'FORBIDDEN' when status = 409 then 'CONFLICT' else 'HTTP_ERROR' end as error_code,
  case when contains(lower(body), 'resource exists') then 'resourceexists' end as error_reason,
  case when status not in (200, 201) then concat('HTTP ', status) end as error_message,
  status = 429 or status between 500 and 599 as retryable,
  case when status not in (200, 201) then nullif(left(regexp_replace(body, '"Token":"[^"]*"', '"Token":"***"'), 200), '') end as body_snippet
from responses""",
    "apply_outcome": "select line_no, op, outcome, code from applied",
    "dropped_rows_files": "select concat('file-', line_no % 4) as source_id, cast(floor(line_no / 4) as bigint) + 2 as line_no, ord, stage, code, field, message from ("
    + _ROWS.format(t="bigint", src="enriched") + ")",
    "apply_stop_files": f"""
select f.source_id, f.line_no, f.outcome, f.code from {_FILED} f
left join (select source_id as s, line_no as n from {_FILED} where outcome = 'failed' order by 1, 2 limit 1) first on true
where s is null or f.source_id < s or (f.source_id = s and f.line_no <= n)""",
    "apply_max_files": f"select source_id, line_no, outcome, code from {_FILED} order by source_id, line_no limit 600",
    "diagnostic_samples": f"""
select 'APPLY' as stage, code, cast(place as integer) as place, source_id, line_no, n_rows, n_rows > 20 as truncated from (
  select source_id, line_no, code, row_number() over (partition by code order by source_id, line_no) as place, count(*) over (partition by code) as n_rows
  from {_FILED} where outcome = 'failed') where place <= 20""",
    "report_items_files": f"""
select 'FAILED' as status, source_id, line_no, concat(source_id, '#line:', line_no) as row_id, code, (select count(*) > 200 from applied where outcome = 'failed') as truncated
from {_FILED} where outcome = 'failed' order by source_id, line_no limit 200""",
    "apply_max_actions": "select line_no, outcome, code from applied order by line_no limit 25",
    "apply_stop_first": """
select line_no, case when line_no % 4999 = 4998 then 'failed' when op = 'create' then 'created' else 'updated' end as outcome,
  case when line_no % 4999 = 4998 then 'HTTP_ERROR' end as code
from order_requests where line_no <= coalesce((select min(line_no) from order_requests where line_no % 4999 = 4998), 1000000000000)""",
    "apply_id_retry": f"select line_no, case when concat('id-', line_no) in (select _id from target) then {_id('1001')} else concat('id-', line_no) end as resource_id, case when concat('id-', line_no) in (select _id from target) then 1 else 0 end as id_attempt from feed",
    "apply_dry_run": "select case when no_id then 'failed' when op = 'create' then 'created' else 'updated' end as outcome, case when no_id then 'RESOURCE_ID_MISSING' end as code, count(*) as n from order_requests group by all",
    "apply_counters": "select count(*) filter (where outcome = 'created') as created, count(*) filter (where outcome = 'updated') as updated, (select count(*) from customer) as skipped, count(*) filter (where outcome = 'failed') as failed, case when count(*) filter (where code in ('UNAUTHORIZED', 'FORBIDDEN')) > 0 then 2 when count(*) filter (where outcome = 'failed') > 0 then 1 else 0 end as exit_status from applied",
    "apply_to_target": "select * from merged",
    "incremental_sync": "select case when _ouid is null then 'new' else _id end as _id, cast(1 as bigint) as n_same_id, _ouid, match_key, mail, phone, organization_id, is_logon_disabled from merged",
}


def _statement(query: str) -> str:
    head = query.lstrip()
    if head.startswith("with "):
        return head
    if head.startswith("with_error as"):
        body = _with(head)
        return body.replace(f"\n{head}", f",\n{head}")
    return _with(head)


def all_sql() -> dict[str, str]:
    return {name: _statement(query) for name, query in _SQL.items()}
