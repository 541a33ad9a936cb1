"""The contact picker: cells with the answer worked out by hand, and what holds for any cell."""

import random

import pytest

from feedplan.functions import parse

# first cell, second cell, e-mail, phone
CELLS = [
    (None, None, None, None),
    ("", " ;|, ", None, None),
    ("ida@moor.example", None, "ida@moor.example", None),
    ("  ida@moor.example  ", None, "ida@moor.example", None),
    (None, "ida@moor.example", "ida@moor.example", None),
    ("first@a.example;second@b.example", "third@c.example", "first@a.example", None),
    ("none;second@b.example", "third@c.example", "second@b.example", None),
    # the whole token is kept, not the part that looks like an address
    ("write to ida@moor.example please", None, "write to ida@moor.example please", None),
    ("a@b", None, "a@b", None),
    ("@b.example", None, None, None),
    ("ida@", None, None, None),
    # a label: the text after the first equals sign
    ("email=ida@moor.example", None, "ida@moor.example", None),
    ("EMail= ida@moor.example", None, "ida@moor.example", None),
    ("work email=ida@moor.example=x", None, "ida@moor.example=x", None),
    # a label without an address after it falls through to the other forms
    ("email=unknown", None, None, None),
    ("email=555-12345", None, None, "email=555-12345"),
    ("x@y email=none", None, "x@y email=none", None),
    ("phone=+43 1 5550000", None, None, "+43 1 5550000"),
    ("PHONE=555 0199", None, None, "555 0199"),
    ("phone=12", "phone=5550123", None, "5550123"),
    ("phone=ida@moor.example", None, "phone=ida@moor.example", None),
    # six characters from a digit or a plus sign on
    ("55501", None, None, None),
    ("555012", None, None, "555012"),
    ("+55501", None, None, "+55501"),
    ("+5 (55)-1", None, None, "+5 (55)-1"),
    ("(555) 0123", None, None, "(555) 0123"),
    ("55501 ", "x", None, None),
    ("room 5550123 b", None, None, "room 5550123 b"),
    # both kinds, in either order; an address wins inside a token
    ("ida@moor.example,+43 1 5550000", None, "ida@moor.example", "+43 1 5550000"),
    ("+43 1 5550000|ida@moor.example", None, "ida@moor.example", "+43 1 5550000"),
    ("5550123 ida@moor.example", "5550199", "5550123 ida@moor.example", "5550199"),
    ("phone=5550123;email=ida@moor.example", "late@c.example", "ida@moor.example", "5550123"),
    ("\tida@moor.example\n;\t5550123", None, "ida@moor.example", "5550123"),
    ("ünal@größe.example", None, "ünal@größe.example", None),
]


def picked(spark, cells):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, a string, b string")
    found = parse.pick_contacts("a", "b")
    return [(r.email, r.phone) for r in df.selectExpr("i", *[f"{e} as {n}" for n, e in found.items()]).orderBy("i").collect()]


def test_cells(spark):
    got = picked(spark, [c[:2] for c in CELLS])
    assert [(c[0], c[1], *g) for c, g in zip(CELLS, got, strict=True)] == CELLS


@pytest.fixture(scope="module")
def random_cells():
    rng = random.Random(7)
    pieces = ["email=", "phone=", "=", "a@b.c", "x@y", "@", "+7 (999) 111", "12345", "123456", "1 2  ", ";", ",", "|", " ", "\t", "name", "+1"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 7))) for _ in range(1500)]


def test_two_cells_read_like_one(spark, random_cells):
    pairs = list(zip(random_cells[::2], random_cells[1::2], strict=True))
    assert picked(spark, pairs) == picked(spark, [(f"{a};{b}", None) for a, b in pairs])


def test_an_earlier_hit_is_not_changed_by_later_tokens(spark, random_cells):
    alone = picked(spark, [(c, None) for c in random_cells])
    followed = picked(spark, [(c, "late@z.example;+99 999 9999") for c in random_cells])
    for (email, phone), (email2, phone2) in zip(alone, followed, strict=True):
        assert email2 == (email or "late@z.example") and phone2 == (phone or "+99 999 9999")


def test_an_answer_is_a_token_or_what_follows_its_first_equals_sign(spark, random_cells):
    for cell, found in zip(random_cells, picked(spark, [(c, None) for c in random_cells]), strict=True):
        tokens = [t.strip() for t in cell.replace("|", ";").replace(",", ";").split(";")]
        allowed = {None, *tokens, *(t.partition("=")[2].strip() for t in tokens)}
        assert set(found) <= allowed
        assert found[0] is None or "@" in found[0]


def test_long_text_is_read_to_its_end(spark):
    body = "word " * 20000
    df = spark.createDataFrame([(body + ", last@example.com",)], "t string")
    found = parse.pick_contacts("t")
    assert df.selectExpr(f"{found['email']} as e").first().e == "last@example.com"
