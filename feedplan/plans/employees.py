"""The employees dataset: columns, mapping and rules."""

from __future__ import annotations

from feedplan.functions import parse
from feedplan.operators.diff import FieldDiff, as_flag, text_diff
from feedplan.operators.enrich import EnrichSpec
from feedplan.operators.mapping import Mapping
from feedplan.operators.normalize import NormalizeRule, as_bool, as_int
from feedplan.operators.validate import FieldRule, email_form, must_be_empty, must_be_known, positive_int

DATASET = "employees"

# Columns of a feed, and the parts of a business key in order.
RAW_COLUMNS = (
    "raw_id", "full_name", "login", "email_or_phone", "contacts",
    "org", "manager", "flags", "employment", "extra",
)

KEY_PARTS = ("last_name", "first_name", "middle_name", "personnel_number")

# Canonical columns in the order of the desired state.
DESIRED = (
    "email", "last_name", "first_name", "middle_name", "is_logon_disable", "user_name", "phone",
    "personnel_number", "manager_id", "organization_id", "position", "avatar_id", "usr_org_tab_num",
)


def mapping() -> Mapping:
    """Canonical columns out of the ten raw cells (``org`` is not used)."""
    contacts = parse.pick_contacts("email_or_phone", "contacts")
    return Mapping(
        columns={
            "email": contacts["email"],
            **parse.split_full_name("full_name"),
            "is_logon_disable": parse.logon_flag("flags"),
            "user_name": "login",
            "phone": contacts["phone"],
            "password": parse.kv_value("extra", "password"),
            "personnel_number": "raw_id",
            "manager_id": parse.manager_ref("manager"),
            "organization_id": parse.kv_value("extra", "org_id"),
            "position": parse.role_name("employment"),
            "avatar_id": "cast(null as string)",
            "usr_org_tab_num": parse.kv_value("extra", "tab"),
            "resource_id": "cast(null as string)",
        },
        secrets=("password",),
        raw=RAW_COLUMNS,
    )


def normalize_rules() -> list[NormalizeRule]:
    texts = ("user_name", "phone", "password", "personnel_number")
    return [
        *[NormalizeRule(c, c) for c in ("email", "last_name", "first_name", "middle_name")],
        NormalizeRule("is_logon_disable", "is_logon_disable", as_bool("isLogonDisable")),
        *[NormalizeRule(c, c) for c in texts],
        NormalizeRule("manager_key", "manager_id"),
        NormalizeRule("organization_id", "organization_id", as_int("organization_id")),
        *[NormalizeRule(c, c) for c in ("position", "avatar_id", "usr_org_tab_num")],
    ]


def validation_rules() -> list[FieldRule]:
    """Required fields in report order under their public names, then the avatar."""
    email = (email_form("email"),)
    org = (
        positive_int("organization_id"),
        must_be_known("organization_id", "ORG_NOT_FOUND", "org_known"),
    )
    return [
        FieldRule("email", "email", True, email),
        FieldRule("last_name", "lastName", True),
        FieldRule("first_name", "firstName", True),
        FieldRule("middle_name", "middleName", True),
        FieldRule("is_logon_disable", "isLogonDisable", True, text=False),
        FieldRule("user_name", "userName", True),
        FieldRule("phone", "phone", True),
        FieldRule("password", "password", True, secret=True),
        FieldRule("personnel_number", "personnelNumber", True),
        FieldRule("organization_id", "organization_id", True, org, text=False),
        FieldRule("position", "position", True),
        FieldRule("usr_org_tab_num", "usrOrgTabNum", True),
        FieldRule("avatar_id", "avatarId", checks=(must_be_empty("avatarId", "INVALID_AVATAR_ID"),)),
    ]


def diff_rules() -> list[FieldDiff]:
    """Names of compared fields, columns of the target and of the desired row."""
    return [
        text_diff("mail", "mail", "email"),
        text_diff("last_name", "last_name", "last_name"),
        text_diff("first_name", "first_name", "first_name"),
        text_diff("middle_name", "middle_name", "middle_name"),
        FieldDiff("is_logon_disable", "is_logon_disabled", "is_logon_disable", as_flag),
        text_diff("user_name", "user_name", "user_name"),
        text_diff("phone", "phone", "phone"),
        FieldDiff("personnel_number", "personnel_number", "personnel_number"),
        FieldDiff("manager_id", "manager_ouid", "manager_id"),
        FieldDiff("organization_id", "organization_id", "organization_id"),
        text_diff("position", "position", "position"),
        text_diff("usr_org_tab_num", "usr_org_tab_num", "usr_org_tab_num"),
    ]


# Target columns that the match has to carry for the diff and the decision.
CANDIDATE = (
    "_id", "mail", "last_name", "first_name", "middle_name", "is_logon_disabled", "user_name", "phone",
    "personnel_number", "manager_ouid", "organization_id", "position", "usr_org_tab_num",
)


def enrich_spec(run_id: str = "run", manager_mode: str = "match_key", **options) -> EnrichSpec:
    return EnrichSpec(DATASET, run_id, KEY_PARTS, manager_mode=manager_mode, **options)
