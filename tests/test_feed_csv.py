"""Delimited feeds: header contract, numbering over files, odd cells."""

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedplan.plans.employees import RAW_COLUMNS
from feedplan.sources import feed_csv
from feedplan.sources.feed_csv import CsvFormatError, read_feed
from feedplan.sources.staging import new_folder

HEADER = ",".join(RAW_COLUMNS)


def write(spark, *files):
    import os

    folder = new_folder(spark, "csv")
    os.makedirs(folder)
    for i, text in enumerate(files):
        with open(f"{folder}/part-{i}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def rows(df):
    return [(r.line_no, r.record_id, r.raw_id, r.full_name) for r in df.orderBy("line_no").collect()]


def test_any_header_order_and_extra_columns(spark):
    names = ["more", *reversed(RAW_COLUMNS)]
    body = ",".join(["m", "e", "emp", "f", "mgr", "o", '"a, ""b"""', "mail", "NULL", " Name ", "1"])
    df = read_feed(spark, write(spark, "﻿" + ",".join(names) + "\n\n" + body + "\n"), RAW_COLUMNS)
    row = df.first()
    assert (row.line_no, row.raw_id, row.full_name, row.login, row.contacts) == (2, "1", "Name", None, 'a, "b"')


def test_missing_columns_are_named(spark):
    folder = write(spark, "raw_id,login,org\n1,2,3\n")
    with pytest.raises(CsvFormatError, match="full_name, email_or_phone, contacts, manager"):
        read_feed(spark, folder, RAW_COLUMNS)


def test_short_and_long_records(spark):
    df = read_feed(spark, write(spark, f"{HEADER}\n1,A B C\n\n2,X Y Z,l,e,c,o,m,f,em,ex,extra,cells\n"), RAW_COLUMNS)
    assert rows(df) == [(2, "line:2", "1", "A B C"), (3, "line:3", "2", "X Y Z")]
    assert df.where("line_no = 2").first().extra is None


def test_numbers_run_on_over_files_and_splits(spark):
    files = ["".join(f"{f}-{i},name {i}\n" for i in range(n)) for f, n in enumerate((300, 50, 1200))]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = rows(read_feed(spark, write(spark, *files), ("raw_id", "full_name"), has_header=False).selectExpr("*"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [f"{f}-{i}" for f, n in enumerate((300, 50, 1200)) for i in range(n)]
    assert [r[0] for r in got] == list(range(1, 1551)) and [r[2] for r in got] == expected


def test_empty_quoted_cells_do_not_shift_columns(spark):
    df = read_feed(spark, write(spark, f'{HEADER}\n"",N,l,e,",x",o,m,f,em,ex\n'), RAW_COLUMNS)
    assert df.select("full_name").first().full_name == "N"


def test_line_breaks_inside_quotes(spark):
    df = read_feed(spark, write(spark, f'{HEADER}\n1,"a\nb",l,e,c,o,m,f,em,ex\n2,B,,,,,,,,\n'), RAW_COLUMNS)
    assert rows(df) == [(2, "line:2", "1", "a\nb"), (3, "line:3", "2", "B")]


def by_library(texts, columns, has_header=True):
    """Records of files, one after the other, by the standard library."""
    found = []
    for text in texts:
        reader = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
        records = [r for r in reader if r]
        header = records.pop(0) if has_header and records else columns
        found += [dict(zip(header, r, strict=False)) for r in records]
    return [(i, *(f.get(c) for c in columns)) for i, f in enumerate(found, 2 if has_header else 1)]


def by_spark(spark, texts, columns, has_header=True, split=None):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split or old))
    try:
        found = feed_csv.read_cells(spark, write(spark, *texts), columns, has_header).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    return sorted((r.line_no, *(r[c] for c in columns)) for r in found)


def test_blank_records_and_bare_quotes(spark):
    text = 'k,v,w\n1,Ann 5" Lee,"x"\n  \n\n2,"a ""b"" c"d"e,\r\n"3",",",1,2,3\r4,"un\r\nfinished""\n5,e,f\n'
    assert by_spark(spark, [text], ["k", "v", "w"]) == by_library([text], ["k", "v", "w"])
    assert len(by_library([text], ["k", "v", "w"])) == 5


@pytest.mark.parametrize("split", [64, 300, None])
def test_splits_anywhere(spark, split):
    """Quoted cells that are longer than a split, records that begin at any place of one."""
    draw = random.Random(split)
    cells = ["", "a", "x y", '"q"', '"l1\nl2"', '"a, ""b"""', 'b"q', '"' + "long\n" * 40 + '"', '"x"y', "\u00e9\u65e5", '"\r\n"', '",\n"""']
    texts = []
    for n in (40, 0, 25):
        lines = [",".join(draw.choice(cells) for _ in range(draw.randint(1, 4))) for _ in range(n)]
        texts.append("k,v,w\n" + draw.choice(["\n", "\r\n"]).join(lines) + "\n")
    texts[0] = "\ufeff" + texts[0]
    assert by_spark(spark, texts, ["v", "k"], split=split) == by_library(texts, ["v", "k"])
    bare = [t.removeprefix("\ufeff") for t in texts]
    assert by_spark(spark, bare, ["a", "b"], False, split) == by_library(bare, ["a", "b"], False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from('a",\n\r \u00e9'), max_size=30), max_size=4))
def test_effects_compose(parts):
    """The records that begin, and whether a quotation is open, by the library on the whole text."""
    whole = feed_csv.Effect.none()
    for part in parts:
        whole = whole.then(feed_csv.Effect.of(part.encode()))
    text = "".join(parts)
    at_once = feed_csv.Effect.of(text.encode())
    assert (whole.exits == at_once.exits).all() and (whole.begins == at_once.begins).all()
    records = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    assert whole.begins[feed_csv.RECORD] == len(records)
    closed = [r for r in csv.reader(io.StringIO(text + "\nz", newline="")) if r]
    assert (whole.exits[feed_csv.RECORD] == feed_csv.QUOTED) == (not closed or closed[-1] != ["z"])


def test_every_file_has_the_same_header(spark):
    with pytest.raises(Exception, match="header differs"):
        by_spark(spark, ["k,v\n1,2\n", "v,k\n1,2\n"], ["k", "v"])


def test_nothing_to_read(spark):
    with pytest.raises(CsvFormatError, match="Missing header"):
        by_spark(spark, ["", "\n\n"], ["k"])
    assert by_spark(spark, ["k\n"], ["k"]) == by_spark(spark, ["", "\n"], ["k"], False) == []


def test_the_feed_is_not_shuffled(spark):
    folder = write(spark, "k,v\n" + "1,2\n" * 500)
    plan = feed_csv.read_feed(spark, folder, ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1
