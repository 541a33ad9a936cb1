from feedplan.functions import parse, text
from feedplan.functions.text import WHITESPACE


def values(spark, rows, *expressions, columns=("c",)):
    schema = ", ".join(f"{c} string" for c in columns)
    data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"i int, {schema}")
    out = df.selectExpr("i", *[f"{e} as e{n}" for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [tuple(r)[1] if len(expressions) == 1 else tuple(r)[1:] for r in out]


TEXTS = [None, "", " ", "a", " a  b ", "\ta  b\x1c", "x　", "a\nb", "NULL", " null ", "nullx", "ä  ö", *WHITESPACE]


def test_strip_and_collapse_follow_python(spark):
    assert values(spark, TEXTS, text.strip("c")) == [None if t is None else t.strip() for t in TEXTS]
    expected = [None if t is None else " ".join(t.split()) for t in TEXTS]
    assert values(spark, TEXTS, text.normalize_whitespace("c")) == expected


def test_null_tokens(spark):
    def clean(t):
        return None if t is None or t.strip() == "" or t.strip().lower() == "null" else t.strip()

    assert values(spark, TEXTS, text.clean_null_token("c")) == [clean(t) for t in TEXTS]


def test_strict_int(spark):
    cases = {"5": 5, " +7 ": 7, "-3": -3, "1_000": 1000, "1__0": None, "_1": None, "1.5": None, "": None, "x": None,
             "9223372036854775807": 2**63 - 1, "9223372036854775808": None}
    assert values(spark, list(cases), text.strict_int("c")) == list(cases.values())


def test_flags(spark):
    words = [" TRUE ", "false", "yes", "1", "N", "0", "maybe", "", None]
    assert values(spark, words, text.strict_bool("c")) == [True, False] + [None] * 7
    assert values(spark, words, text.lenient_bool("c")) == [True, False, True, True, False, False, None, None, None]
    assert values(spark, words, text.bad_flag("c")) == [False] * 6 + [True, True, False]


def test_email_form(spark):
    cases = {"a@b.c": True, "john.doe@example": False, "a b@c.d": False, "@b.c": False, "a@@b.c": False, "a@b.c.d": True}
    assert values(spark, list(cases), text.is_email("c")) == list(cases.values())


def test_deleted_marker(spark):
    rows = [("Deleted ", None), ("active", None), (None, "2024-01-01"), (None, " NULL "), (None, ""), ("active", "x")]
    assert values(spark, rows, text.is_deleted("c", "d"), columns=("c", "d")) == [True, False, True, False, False, True]


def test_truncate(spark):
    rows = ["x" * 500, "x" * 501, "abcd", None]
    assert values(spark, rows, text.truncate_text("c")) == ["x" * 500, "x" * 497 + "...", "abcd", None]
    assert values(spark, rows[2:], text.truncate_text("c", 3)) == ["abc", None]


def test_name_split(spark):
    cases = {
        "Doe John M": ("Doe", "John", "M"),
        "Doe, John M.": ("Doe", "John", "M."),
        "Doe,John  Q  Extra": ("Doe", "John", "Q"),
        "Smith; Jane": ("Smith;", "Jane", None),
        " , Jane": (None, "Jane", None),
        "Doe,": ("Doe", None, None),
        "a b, c": ("a b", "c", None),
        "One   Two": ("One", "Two", None),
        "A\tB C": ("A\tB", "C", None),
        "Last, \tFirst\tX Y": ("Last", "First\tX", "Y"),
        "Last,\t A": ("Last", "A", None),
        "Last,\t  A  B": ("Last", "A", "B"),
        "": (None, None, None),
        None: (None, None, None),
    }
    parts = parse.split_full_name("c")
    got = values(spark, list(cases), parts["last_name"], parts["first_name"], parts["middle_name"])
    assert got == list(cases.values())


def test_kv_cells(spark):
    rows = ["password=a=b; TAB = x ;tab=y;noise;=z;org_id=", "tab=1;TAB=2;Tab =", None, "xtab=1", "tab"]
    assert values(spark, rows, parse.kv_value("c", "tab")) == ["y", "", None, None, None]
    assert values(spark, rows, parse.kv_value("c", "password"))[0] == "a=b"
    assert values(spark, rows, parse.kv_value("c", "org_id"))[0] == ""
    pairs = values(spark, rows, parse.kv_pairs("c"))
    assert pairs[:2] == [{"password": "a=b", "tab": "y", "org_id": ""}, {"tab": ""}]


def test_manager_flag_and_role(spark):
    managers = {"manager: 42": "42", "manager_id=001": "001", "manager: none": None, "7 x 8": "7",
                "boss 5; manager = a9b": "9", "manager:;12": "12", "manager: ;12": None, "MANAGER_ID: 3;4": "3"}
    assert values(spark, list(managers), parse.manager_ref("c")) == list(managers.values())
    flags = {"disabled=Yes; 2fa=on": "true", "disabled: off": "false", "disabled=maybe": None, "DISABLED = 0": "false",
             "x": None, "disabled=no": "false"}
    assert values(spark, list(flags), parse.logon_flag("c")) == list(flags.values())
    roles = {"role=Engineer": "Engineer", "hired:2020;Role :  Lead Dev ;x": "Lead Dev", "role= ;": None, "none": None}
    assert values(spark, list(roles), parse.role_name("c")) == list(roles.values())
