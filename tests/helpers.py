"""Small builders shared by the tests."""

from __future__ import annotations

from feedplan.operators.snapshot import ORG_COLUMNS, USER_COLUMNS
from feedplan.plans.employees import RAW_COLUMNS

FEED = "line_no bigint, record_id string, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)
USERS = ", ".join(f"`{c}` {t}" for c, t in USER_COLUMNS.items())
ORGS = ", ".join(f"`{c}` {t}" for c, t in ORG_COLUMNS.items())

GOOD = {
    "raw_id": "4711", "full_name": "Quint Mara Ilse", "login": "mquint", "email_or_phone": "mara.quint@lumen.example",
    "contacts": "+49 30 555123", "org": "Org=Optics", "manager": None, "flags": "disabled: no",
    "employment": "hired:2019;role=Chemist", "extra": "password=geheim;org_id=20;tab=TAB-4711",
}

USER = {
    "_id": "id-1", "_ouid": 1, "personnel_number": "4711", "last_name": "Quint", "first_name": "Mara",
    "middle_name": "Ilse", "match_key": "Quint|Mara|Ilse|4711", "mail": "mara.quint@lumen.example", "user_name": "mquint",
    "phone": "+49 30 555123", "usr_org_tab_num": "TAB-4711", "organization_id": 20, "account_status": "active",
    "is_logon_disabled": 0, "position": "Chemist",
}


def feed(spark, *rows):
    data = [
        (i + 2, f"line:{i + 2}", *[{**GOOD, **row}[c] for c in RAW_COLUMNS]) for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, FEED)


def users(spark, *rows):
    data = [tuple({**USER, **row}.get(c) for c in USER_COLUMNS) for row in rows]
    return spark.createDataFrame(data, USERS)


def orgs(spark, *ids):
    return spark.createDataFrame([(i, f"ORG-{i}", f"Org {i}", None, None) for i in ids], ORGS)
