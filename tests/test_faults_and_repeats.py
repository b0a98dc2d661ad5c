"""Records that can't be read, repeated replies and updates, and retries that come late."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from postern.operators import decode, outputs, repair, retry
from postern.plans import intake
from postern.rules import REJECTION_TEXTS
from postern.schemas import EVENT_DECODED, EVENT_REQUIRED, EVENT_WIRE


def test_unreadable_record_is_quarantined(spark):
    wire = spark.createDataFrame([(None,) * len(EVENT_WIRE.names)], EVENT_WIRE)
    marked = decode.mark_unreadable(wire, F.lit("AAAA"))
    good, faulty = decode.split_faulty(decode.decode(decode.checked(marked)))
    assert good.count() == 0
    assert [(r.fault, r.raw) for r in faulty.collect()] == [("unreadable", "AAAA")]


def _retries(spark):
    full = {name: "x" for name in EVENT_REQUIRED} | {"journalpostId": "1"}
    import json

    rows = [("1", json.dumps(full), 1000), ("2", "{broken", 1000), ("3", '{"journalpostId":"3"}', 1000), ("4", None, 1000)]
    return spark.createDataFrame(rows, "key string, value string, due_ms bigint")


def test_retries_are_checked(spark):
    retries = _retries(spark)
    good = retry.events_of(retries).collect()
    assert [r.entry_id for r in good] == ["1"]
    assert good[0].versjon is not None and good[0].behandlingstema is not None
    faults = {r.entry_id: r.fault.split(":")[0] for r in retry.quarantined(retries).collect()}
    assert faults == {"2": "unreadable", "3": "missing", "4": "unreadable"}


def test_late_retry_counts_from_now(spark):
    now = datetime.datetime(2024, 1, 1, 12)
    late = retry.events_of(_retries(spark), F.lit(now).cast("timestamp_ntz")).first()
    assert late.as_of == now
    early = retry.events_of(_retries(spark), F.lit(datetime.datetime(1960, 1, 1)).cast("timestamp_ntz")).first()
    assert early.as_of == datetime.datetime(1970, 1, 1, 0, 0, 1)


def test_repeated_replies_count_once(spark):
    requests = spark.createDataFrame([("1",), ("2",)], "journalpostId string")
    answers = spark.createDataFrame(
        [("1", 1, 500, "x"), ("1", 1, 201, None), ("2", 1, 500, "x"), ("2", 1, 500, "x")],
        "entry_id string, attempt int, http_status int, message string",
    )
    rows = repair.with_replies(requests, answers, "journalpostId").collect()
    assert sorted((r.journalpostId, r.accepted) for r in rows) == [("1", True), ("2", False)]


def test_replies_are_picked_without_sorting_texts(spark):
    first, second = REJECTION_TEXTS[0][1:]
    other = [t for t in REJECTION_TEXTS if t[0] == repair.BAD_ORG][0]
    unit, org = f"{first} {second}", f"{other[1]} {other[2]}"
    answers = spark.createDataFrame(
        [
            ("unit", 1, 400, unit), ("unit", 2, 204, None), ("org", 1, 400, org), ("org", 2, 500, None),
            ("both", 1, 400, org), ("both", 1, 400, unit), ("least", 1, 500, None), ("least", 1, 404, "z"),
            ("unknown", 1, None, None), ("plain", 1, 201, "z"), ("late", 2, 201, None),
        ],
        "entry_id string, attempt int, http_status int, message string",
    )
    requests = answers.select(F.col("entry_id").alias("id")).distinct().union(spark.sql("SELECT 'none'"))
    replied = repair.with_replies(requests, answers, "id")
    got = {r.id: (r.http_status, r.rejection, r.attempts, r.accepted) for r in replied.collect()}
    assert got == {
        "unit": (400, "bad_unit", 2, True),
        "org": (400, "bad_org", 2, False),
        "both": (400, "bad_unit", 2, False),
        "least": (404, None, 1, False),
        "unknown": (None, None, 1, False),
        "plain": (201, None, 1, True),
        "late": (None, None, 1, False),
        "none": (None, None, 1, False),
    }
    assert "SortAggregate" not in replied._jdf.queryExecution().executedPlan().toString()


def test_retries_of_many_failed_entries(spark, monkeypatch):
    """Above the broadcast bound the same retries come, by a bitmap and a reduction per task."""
    fields = ", ".join(f"'x' AS {n}" for n in EVENT_DECODED.names)
    events = spark.sql(
        f"""SELECT id AS event_order, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS as_of,
            CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN CAST(id AS STRING) END AS entry_id, {fields}
            FROM range(3000)"""
    )
    decisions = events.selectExpr(
        "entry_id", "CASE WHEN entry_id = 'hot' OR event_order % 2 = 0 THEN 'RETRY' ELSE 'JFR' END AS outcome"
    ).where("entry_id IS NOT NULL").distinct()
    few = sorted(map(tuple, intake.retries_of(events, decisions).collect()))
    monkeypatch.setattr(intake, "MAX_BROADCAST_IDS", 1)
    many = intake.retries_of(events, decisions)
    assert sorted(map(tuple, many.collect())) == few
    # The last hot event, at 2997 s, waits a second.
    assert len(few) == 501 and {r[0]: r[2] for r in few}["hot"] == 1_704_067_200_000 + 2_998_000


def test_last_update_wins(spark):
    names = ["status", "theme", "party_id", "party_type", "unit", "title", "sender_id", "sender_type", "preset_theme"]
    journal = spark.createDataFrame([("1", *["old"] * len(names))], ["entry_id", *names])
    fields = ["unit", "title", "sender_id", "sender_id_type", "case_type", "handling_theme", "handling_type"]
    updates = spark.createDataFrame(
        [("1", 2, *["new"] * 7), ("1", 1, *["zzz"] * 7)], ["entry_id", "update_order", *fields]
    )
    rows = outputs.current_journal(journal, updates).collect()
    assert [(r.unit, r.title) for r in rows] == [("new", "new")]


def test_large_line_and_part_numbers(spark, tmp_path):
    from postern.sources import tables

    spark.createDataFrame(
        [(1, 1 << 23, 1, 0.05), (1, 1, 1 << 41, 0.05)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_discount double"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, "n", "STANDARD X"), (1 << 41, "n", "ECONOMY X")], "p_partkey bigint, p_name string, p_type string"
    ).write.parquet(f"{tmp_path}/part.parquet")
    whole = spark.read.parquet(f"{tmp_path}/part.parquet")
    assert whole.count() == 2
    want = tables.documents(spark, str(tmp_path)).orderBy("doc_order").first().form_code
    assert tables.document_facts(spark, str(tmp_path)).first().form_code == want
