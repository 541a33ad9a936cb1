from __future__ import annotations

import time
import random
import re

import pyarrow as pa
import pytest

from feedplan.llm.pii import Rewritten, disguised, find, identifiers, span_digests


def by_hand(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
        if 13 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in doubled) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_plain_identifiers_equal_the_patterns():
    draw = random.Random(1)
    for _ in range(20_000):
        text = "".join(draw.choice("a.@-b1 2+5()é%0") for _ in range(draw.randint(0, 60)))
        assert identifiers(text) == by_hand(text)


DISGUISES = [
    ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("é mail jane.doe (at) mail(dot)example.org!", "email", "jane.doe (at) mail(dot)example.org"),
    ("john dot doe at example dot com", "email", "john dot doe at example dot com"),
    ("me_at_example_dot_com", "email", "me_at_example_dot_com"),
    ("max klammeraffe beispiel punkt de", "email", "max klammeraffe beispiel punkt de"),
    ("luc arobase exemple point fr", "email", "luc arobase exemple point fr"),
    ("ana arroba correo punto es", "email", "ana arroba correo punto es"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("j​ohn@exam​ple․com", "email", "j​ohn@exam​ple․com"),
    ("a&#64;example&period;com", "email", "a&#64;example&period;com"),
    ("call plus four nine one seven six one two three four", "phone", "plus four nine one seven six one two three four"),
    ("+1 (555) five five five 0123", "phone", "+1 (555) five five five 0123"),
    ("four one one one " + "one " * 12, "card", "four one one one " + ("one " * 12).strip()),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("eins neun zwei punkt eins sechs acht punkt eins punkt eins", "ip", "eins neun zwei punkt eins sechs acht punkt eins punkt eins"),
    ("٥٥.١.٢.٣", "ip", "٥٥.١.٢.٣"),
]


@pytest.mark.parametrize(("text", "kind", "span"), DISGUISES)
def test_disguises_map_back_to_the_source(text, kind, span):
    base, more = find(text)
    assert base == by_hand(text)
    assert [(k, text[s:e]) for k, s, e in more if k == kind] == [(kind, span)]
    assert disguised(pa.array([text])) == [True]


@pytest.mark.parametrize(
    "text",
    [
        "look at the dot on the map", "we arrived at that point when he left at noon", "one two three four", "it is one of the two at home",
        "un deux trois, nous irons au bois", "he ate at noon. dot com was down", "plus one two", "Москва и Киев", "a [at] the gate", "meet at 5 [dot]",
    ],
)
def test_clean_texts_have_none(text):
    assert find(text) == ([], [])


def test_rewriting_maps_every_range():
    made = Rewritten("abcdef", [(1, 3, "X"), (4, 5, "")])
    assert made.text == "aXdf"
    assert made.back(0, 1) == (0, 1, False) and made.back(1, 2) == (1, 3, True) and made.back(2, 4) == (3, 6, True)


def test_texts_without_disguise_are_not_rewritten():
    draw = random.Random(2)
    words = "the at dot one two three [ ] ( ) @ . plus + 5 é а john com point".split()
    texts = [" ".join(draw.choice(words) for _ in range(12)) for _ in range(3000)]
    for text, hides in zip(texts, disguised(pa.array(texts)), strict=True):
        assert hides or find(text)[1] == []


def test_rows(spark, odd_docs, no_docs):
    assert span_digests(odd_docs).count() == odd_docs.count()
    assert span_digests(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "é a@b.cd and 1.2.3.4, x [at] y [dot] com"), (2, None)], "doc_id bigint, text string")
    one, two = span_digests(docs).orderBy("doc_id").collect()
    assert one.spans == "email:2:8,email:22:40,ip:13:20" and (one.n_email, one.n_ip, one.n_card, one.n_disguised) == (1, 1, 0, 1)
    assert two.spans == "" and two.n_email == 0


def test_numbers_in_two_languages():
    """A run is skipped only where it overlaps a run of an earlier language."""
    german = "Ruf plus vier neun drei null eins zwei drei vier fünf sechs an. "
    english = "Later call plus one five five five one two three four five six seven."
    spans = [find(t)[1] for t in (german, english, german + english)]
    assert len(spans[0]) == len(spans[1]) == 1
    assert spans[2] == spans[0] + [(k, s + len(german), e + len(german)) for k, s, e in spans[1]]


@pytest.mark.parametrize("filler", ["x dot ", "x_dot_x ", "x at ", "x_at_", " ", "a. ", "one two ", "x dot y.", "at x dot "])
def test_long_texts_take_time_in_proportion(filler):
    took = []
    for size in (100_000, 400_000):
        text = filler * (size // len(filler)) + " write to jane dot doe at mail dot site dot com"
        begin = time.process_time()
        spans = find(text)[1]
        took.append(time.process_time() - begin)
        assert any(e == len(text) for k, _, e in spans if k == "email")
    assert took[1] < 12 * took[0] + 0.5 and took[1] < 20


@pytest.mark.parametrize(("text", "address"), [
    ("mail jane at example dot com now", "jane at example dot com"), ("a jane_dot_doe_at_mail_dot_site_dot_org b", "jane_dot_doe_at_mail_dot_site_dot_org"),
    ("j dot d dot e at x-y dot uk.", "j dot d dot e at x-y dot uk"), ("a.b dot c at d.e dot net", "a.b dot c at d.e dot net"),
    ("one at a dot com two at b dot org", "one at a dot com"), ("İ jane at example dot com", "jane at example dot com"),
])
def test_spelled_addresses(text, address):
    kind, start, end = find(text)[1][0]
    assert kind == "email" and text[start:end] == address
