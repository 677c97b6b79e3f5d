import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from annalist.functions import paths
from annalist.functions import text as T
from annalist.functions import values as V


def rows(spark, values, schema, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {schema}").repartition(3)
    return [tuple(r)[1:] for r in sorted(df.select("i", *columns).collect())]


def test_parse_day(spark):
    values = [None, 0, 20260130, 2026013, 20261341, 20260230, 20240229]
    v = F.col("v")
    got = rows(spark, values, "BIGINT", V.parse_day(v), V.is_impossible_day(v))
    day = dt.date
    assert got == [
        (None, False), (None, False), (day(2026, 1, 30), False), (None, False), (None, True), (None, True),
        (day(2024, 2, 29), False),
    ]


def test_parse_iso_day(spark):
    values = [None, "2026-01-30", "2026-01-30T10:11:12", "x", "2026-02-30", "2026"]
    assert [r[0] for r in rows(spark, values, "STRING", V.parse_iso_day(F.col("v")))] == [
        None, dt.date(2026, 1, 30), dt.date(2026, 1, 30), None, None, None,
    ]


def test_parse_ids(spark):
    values = [None, "95", "6|168", "6||168", " 6 | 7 ", "6|x", ""]
    got = rows(spark, values, "STRING", V.parse_ids(F.col("v")), V.has_bad_id(F.col("v")))
    assert got == [
        ([], False), ([95], False), ([6, 168], False), ([6, 168], False), ([6, 7], False), ([6, None], True), ([], False),
    ]


def test_first_truthy(spark):
    values = [None, "", "0", "5", "471|164"]
    got = rows(spark, values, "STRING", V.first_truthy(F.col("v"), F.lit("9")))
    assert [r[0] for r in got] == ["9", "9", "9", "5", "471|164"]


def test_content_hash(spark):
    df = spark.createDataFrame(
        [("T", 5, dt.date(2026, 1, 30)), (None, 0, None)], "title STRING, status INT, day DATE"
    )
    got = {r[0] for r in df.select(V.content_hash(F.col("title"), F.col("status"), F.col("day"))).collect()}
    assert got == {hashlib.sha256(t.encode()).hexdigest() for t in ("T|5|2026-01-30", "|0|")}


def clean_model(text):
    lines, blank_before = [], False
    for line in text.split("\n"):
        if line.strip():
            lines.append(line.rstrip())
            blank_before = False
        elif not blank_before:
            lines.append("")
            blank_before = True
    return "\n".join(lines).strip() + "\n"


ALPHABET = list("ab\"\\é漢😀") + ["\n", "\n", " ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f"] + [
    "\x85", "\xa0", " ", " ", " ", " ", " ", " ", "　", "​", "﻿",
]


@pytest.fixture(scope="module")
def strings():
    source = random.Random(7)
    fixed = ["", " ", "\n", "\n\n\n", "  a \r\n\n \n\tb\n\n", "a b　c", "  x", "x \n　", "a" + " " * 5000 + "b"]
    return fixed + ["".join(source.choices(ALPHABET, k=source.randint(0, 40))) for _ in range(4000)]


def test_text_functions_equal_models(spark, strings):
    v = F.col("v")
    got = rows(spark, strings, "STRING", T.clean_text(v), T.strip_text(v), T.word_count(v), T.text_length(v), T.is_blank(v))
    for text, result in zip(strings, got, strict=True):
        assert result == (clean_model(text), text.strip(), len(text.split()), len(text), not text.strip()), repr(text)


def test_text_functions_of_null(spark):
    v = F.col("v")
    got = rows(spark, [None], "STRING", T.clean_text(v), T.word_count(v), T.text_length(v), T.is_blank(v))
    assert got == [(None, 0, 0, True)]


def test_quote_round_trip(spark, strings):
    got = rows(spark, strings, "STRING", T.quote(F.col("v")), T.unquote(T.quote(F.col("v"))))
    for text, (quoted, back) in zip(strings, got, strict=True):
        assert back == text
        assert "\n" not in quoted
        assert re.fullmatch(r'"(?:[^"\\]|\\.)*"', quoted, re.S)


def test_header(spark):
    df = spark.range(1).select(
        T.header(
            F.lit("s"), F.lit("7"), F.lit("7-x"), F.lit('The "T"'), F.lit(dt.date(2026, 1, 5)), F.lit(None).cast("date"),
            F.lit(None).cast("int"), F.array(F.lit(6), F.lit(168)), F.lit("471|164"),
        ).alias("escaped"),
        T.header(
            F.lit("s"), F.lit("7"), F.lit("7-x"), F.lit('The "T"'), F.lit(None).cast("date"), F.lit(None).cast("date"),
            F.lit(5), F.array().cast("array<int>"), F.lit(None).cast("string"), escape=False,
        ).alias("plain"),
    )
    escaped, plain = df.first()
    assert escaped == (
        '---\nsource: "s"\ndokid: 7\nnreg: "7-x"\ntitle: "The \\"T\\""\ndoc_date: 2026-01-05\n'
        "types: [6, 168]\norg: 471|164\n---\n"
    )
    assert plain == '---\nsource: "s"\ndokid: 7\nnreg: "7-x"\ntitle: "The "T""\nstatus: 5\n---\n'


def test_decode_cp1251(spark):
    data = bytes(range(256))
    df = spark.createDataFrame([(bytearray(data),)], "b BINARY")
    assert df.select(T.decode_cp1251(F.col("b"))).first()[0] == data.decode("cp1251", errors="replace")


def test_paths(spark):
    columns = paths.document_paths(
        F.lit("s"), F.lit("7"), F.lit(dt.date(2026, 1, 5)), F.lit(dt.date(2026, 2, 2))
    )
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()
    assert row["raw_path_revision"] == "by_revision/source=s/year=2026/month=01/day=05/7.txt"
    assert row["raw_path_collection"] == "by_collection/date=2026-02-02/source=s/7.txt"
    assert row["meta_path_collection"] == "by_collection/date=2026-02-02/source=s/7.meta.json"
    assert row["processed_path_revision"] == "by_revision/source=s/year=2026/month=01/day=05/7.md"
    temp = paths.temp_path(F.lit(dt.date(2026, 1, 5)), F.lit("r1"), F.lit("report"), F.lit("x.json"))
    assert spark.range(1).select(temp).first()[0] == "date=2026-01-05/run_id=r1/task_report/x.json"


def test_partition_day(spark):
    values = ["date=2026-02-02/x", "date=2026-02-30/x", "date=bad/x", "x/y", "date=2026-02-02", "date=2026-02-021/x"]
    got = rows(spark, values, "STRING", V.partition_day(F.col("v")))
    assert [r[0] for r in got] == [dt.date(2026, 2, 2), None, None, None, dt.date(2026, 2, 2), None]


def test_json_keeps_nulls(spark):
    df = spark.createDataFrame([(None, "é")], "a STRING, b STRING")
    assert df.select(V.to_json_text(F.col("a"), F.col("b"))).first()[0] == '{"a":null,"b":"é"}'
