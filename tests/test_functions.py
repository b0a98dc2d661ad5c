"""Column expressions against hand-made cases and a step-by-step count."""

import datetime as dt

import pytest
from postern.functions import dates, documents, errors, parties, text
from postern.functions import json as J
from pyspark.sql import functions as F

STARTS = [
    dt.datetime(2024, 1, 8, 12, 59) + dt.timedelta(days=day, minutes=late)
    for day in range(14)
    for late in (0, 1)
] + [dt.datetime(2024, 2, 29, 0, 0), dt.datetime(2024, 12, 31, 23, 59, 59, 999999)]


def by_steps(start: dt.datetime, days: int) -> dt.date:
    def next_weekday(day):
        return day + dt.timedelta(days={4: 3, 5: 2}.get(day.weekday(), 1))

    day = start.date()
    for _ in range(days + (start.hour > 12)):
        day = next_weekday(day)
    return day


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_deadline_equals_steps(spark, zone):
    from postern.session import session_settings

    with session_settings(spark, {"spark.sql.session.timeZone": zone}):
        rows = [(start, n) for start in STARTS for n in range(9)]
        df = spark.createDataFrame(rows, "ts timestamp_ntz, n int")
        got = df.select("ts", "n", dates.deadline(F.col("ts"), F.col("n")).alias("d")).collect()
    assert len(got) == len(rows)
    assert [(r.ts, r.n, r.d) for r in got if r.d != by_steps(r.ts, r.n)] == []


def test_known_deadlines(spark):
    friday = dt.datetime(2024, 1, 12)
    cases = [
        (friday.replace(hour=12, minute=59), 1, dt.date(2024, 1, 15)),
        (friday.replace(hour=13), 1, dt.date(2024, 1, 16)),
        (friday.replace(hour=9), 3, dt.date(2024, 1, 17)),
        (dt.datetime(2024, 1, 13, 9), 1, dt.date(2024, 1, 15)),
        (dt.datetime(2024, 1, 14, 9), 1, dt.date(2024, 1, 15)),
        (dt.datetime(2024, 1, 14, 14), 3, dt.date(2024, 1, 18)),
        (dt.datetime(2024, 1, 11, 14), 1, dt.date(2024, 1, 15)),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "ts timestamp_ntz, n int")
    got = df.select(dates.deadline(F.col("ts"), F.col("n")).alias("d")).collect()
    assert [r.d for r in got] == [c[2] for c in cases]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_ms_rounds_down_in_any_zone(spark, zone):
    from postern.session import session_settings

    with session_settings(spark, {"spark.sql.session.timeZone": zone}):
        ts = dt.datetime(2024, 7, 1, 12, 0, 0, 778999)
        df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
        row = df.select(
            dates.epoch_ms(F.col("ts")).alias("ms"),
            dates.from_epoch_ms(dates.epoch_ms(F.col("ts"))).alias("back"),
            dates.local_time(F.col("ts")).alias("local"),
        ).first()
    assert row.ms == 1719835200778
    assert row.back == ts.replace(microsecond=778000)
    assert row.local == ts + dt.timedelta(hours=2)


def test_blank_and_terms(spark):
    rows = [(None,), ("",), (" ",), ("\t ",), ("a",), ("\x1f",)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(text.is_blank(F.col("t")).alias("b"), text.is_empty(F.col("t")).alias("e")).collect()
    assert [r.b for r in got] == [True, True, True, True, False, True]
    assert [r.e for r in got] == [True, True, False, False, False, False]
    terms = ["ab;ae", "ab;", ";ae", " ;\t", "ab", "a;b;c", "", None]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    t = F.col("t")
    got = df.select(text.term_part(t, 0).alias("x"), text.term_part(t, 1).alias("y"), text.term_malformed(t).alias("m"))
    assert [tuple(r) for r in got.collect()] == [
        ("ab", "ae", False), ("ab", None, False), (None, "ae", False), (None, None, False),
        ("ab", None, True), ("a", "b", False), (None, None, True), (None, None, False),
    ]


def test_document_list(spark):
    ddl = "d array<struct<brevkode: string, tittel: string>>"
    rows = [([],), ([("a", "x"), ("b", None)],), ([(None, " ")],), ([("a", "")],)]
    df = spark.createDataFrame(rows, ddl)
    got = df.select(
        documents.first_code(F.col("d")).alias("c"), documents.titles_present(F.col("d")).alias("t")
    ).collect()
    assert [(r.c, r.t) for r in got] == [(None, True), ("a", False), (None, True), ("a", False)]


def test_array_or_single(spark):
    values = [
        '{"x": [{"a": "1"}, {"a": "2"}]}',
        '{"x": {"a": "1", "unknown": 2}}',
        '{"x": []}',
        '{"x": null}',
        "{}",
        '{"x": {"a": 7}}',
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(J.array_or_single(F.col("v"), "$.x", "struct<a: string>").alias("x")).collect()
    assert [r.x and [i.a for i in r.x] for r in got] == [["1", "2"], ["1"], [], None, None, ["7"]]
    df = spark.createDataFrame([(v,) for v in ['{"x": "a"}', '{"x": ["a", "b"]}', '{"x": "[a"}', "{}"]], "v string")
    got = df.select(J.strings_or_single(F.col("v"), "$.x").alias("x")).collect()
    assert [r.x for r in got] == [["a"], ["a", "b"], ["[a"], None]


def test_joined_messages(spark):
    rows = [([("a",), (None,)],), ([],), (None,)]
    df = spark.createDataFrame(rows, "e array<struct<message: string>>")
    assert [r.t for r in df.select(errors.joined_messages(F.col("e")).alias("t")).collect()] == ["a - null", "", None]


def test_party_kinds_are_never_null(spark):
    df = spark.createDataFrame([(p,) for p in ("AKTOERID", "FNR", "ORGNR", "PERSONBRUKER", None)], "p string")
    got = df.select(parties.is_person(F.col("p")).alias("a"), parties.is_organisation(F.col("p")).alias("o")).collect()
    assert [(r.a, r.o) for r in got] == [(True, False), (True, False), (False, True), (False, False), (False, False)]
