"""What follows from replies of the task system and the archive, in batch and as a stream."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace

import fixtures as X
import pytest
from pyspark.sql import functions as F

from postern.operators import repair
from postern.operators.decode import checked, decode
from postern.plans import intake
from postern.session import work_dir
from postern.sources import streams
from postern.streaming import route, settle

LATER = dt.datetime(2024, 1, 10, 12)
ENTRIES = [X.entry("1", code=X.MANUAL_CODE), X.entry("2"), X.entry("3", code="4936"), X.entry("4")]


def _events(spark, orders):
    wire = X.wire(spark, [(o, X.WEDNESDAY_MORNING, e, "Mottatt", "SYK") for o, e in orders])
    return decode(checked(wire)).withColumn("is_retry", F.lit(False))


def test_after_archive(spark):
    decisions = spark.createDataFrame(
        [(e, "AUTO", None) for e in "abcd"] + [("e", "JFR", None), ("f", "RETRY", "journal_missing")],
        "entry_id string, outcome string, reason string",
    )
    replies = spark.createDataFrame(
        [
            ("a", "update", 200), ("a", "finalize", 204),
            ("b", "update", 500), ("b", "finalize", 200),
            ("c", "update", 200), ("c", "finalize", 500), ("c", "finalize", None),
            ("c", "update", 500),
        ],
        "entry_id string, step string, http_status int",
    )
    got = {r.entry_id: (r.outcome, r.reason) for r in repair.after_archive(decisions, replies).collect()}
    assert got == {
        "a": ("AUTO", None),
        "b": ("RETRY", "update_failed"),
        "c": ("RETRY", "finalize_failed"),
        "d": ("RETRY", "update_failed"),  # never answered
        "e": ("JFR", None),
        "f": ("RETRY", "journal_missing"),
    }


def test_batch_with_archive_replies(spark):
    """A refused update leads to no finalization and to a retry; its task and update were sent."""
    out = work_dir(spark, "archive")
    lookups = replace(
        X.make_lookups(spark, ENTRIES, [X.person("100")]), snapshot=X.snapshot(spark, ENTRIES)
    )
    replies = spark.createDataFrame(
        [("2", "update", 500), ("4", "update", 200), ("4", "finalize", 200)],
        "entry_id string, step string, http_status int",
    )
    events = _events(spark, [(1, 1), (2, 2), (3, 3), (4, 4)]).drop("fault", "raw")
    done = intake.run_batch(spark, events, lookups, out, "batch_id=0", archive=replies)
    assert {r.journalpostId for r in done.task_requests.collect()} == {"1", "2", "4"}
    assert {r.entry_id for r in done.journal_updates.collect()} == {"2", "4"}
    assert [r.entry_id for r in done.finalizations.collect()] == ["4"]
    assert [r.key for r in done.retries.collect()] == ["2"]
    assert {r.entry_id: r.reason for r in done.decisions.where("outcome = 'RETRY'").collect()} == {
        "2": "update_failed"
    }
    bodies = {r.entry_id: json.loads(r.body) for r in spark.read.parquet(f"{out}/update_bodies").collect()}
    assert [d["dokumentInfoId"] for d in bodies["4"]["dokumenter"]] == ["0"]
    assert bodies["4"]["relevanteDatoer"] is None


@pytest.fixture
def job(spark):
    """The intake waiting for replies, and a stream of replies in files."""
    out = work_dir(spark, "replies")
    lookups = X.make_lookups(spark, ENTRIES, [X.person("100")])
    handle = route.handle_batch(out, lambda s: lookups, await_replies=True)
    route.prepare(spark, out)

    def run(batch_id, orders):
        handle(_events(spark, orders), batch_id)

    def reply(*rows):
        full = [(e, b, step, n, status, text, LATER) for e, b, step, n, status, text in rows]
        told = spark.createDataFrame(full, settle.REPLY_DDL)
        told.coalesce(1).write.mode("append").parquet(f"{out}/told")
        stream = streams.file_stream(spark, out, "told", settle.REPLY_DDL)
        settle.start(stream, out).awaitTermination()

    def ids(name, column="entry_id"):
        return sorted(r[column] for r in spark.read.parquet(f"{out}/{name}").collect() if r[column])

    return run, reply, ids


def test_accepted_tasks_lead_to_updates_then_finalizations(job):
    run, reply, ids = job
    run(0, [(1, 1), (2, 2), (3, 3)])
    reply(("1", 0, "task", 1, 201, None), ("2", 0, "task", 1, 201, None), ("9", 0, "task", 1, 201, None))
    assert ids("journal_updates") == ["2"]
    assert ids("finalizations") == []
    reply(("2", 0, "task", 1, 201, None), ("2", 0, "update", 1, 200, None))  # the first is a repeat
    assert ids("journal_updates") == ids("finalizations") == ["2"]
    reply(("2", 0, "finalize", 1, 200, None))
    assert ids("steps", "action") == ["done", "done", "finalize", "update"]
    assert ids("reply_retries", "key") == []


def test_replies_open_their_batches_only(job, spark, monkeypatch):
    run, reply, ids = job
    run(0, [(1, 1)])
    run(1, [(2, 2)])
    opened = []
    real = settle.in_batches

    def watched(spark, path, rows):
        out = real(spark, path, rows)
        opened.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(settle, "in_batches", watched)
    reply(("2", 1, "task", 1, 201, None))
    plan = opened[0][opened[0].index("PartitionFilters") :].split("]")[0]
    assert "batch_id" in plan and "1" in plan
    (body,) = (json.loads(b) for b in ids("update_bodies", "body"))
    assert body["journalpostId"] == "2" and body["sak"]["sakstype"] == "GENERELL_SAK"


def test_refused_task_is_retried_and_leaves_nothing(job, spark):
    run, reply, ids = job
    run(0, [(1, 1), (2, 2)])
    reply(("1", 0, "task", 1, 500, "down"), ("2", 0, "task", 1, 400, "Organisasjonsnummer er ugyldig"))
    assert ids("journal_updates") == []
    assert ids("repaired_requests", "journalpostId") == ["2"]
    assert ids("reply_retries", "key") == ["1"]
    reply(("2", 0, "task", 2, 400, "Organisasjonsnummer er ugyldig"))
    assert ids("repaired_requests", "journalpostId") == ["2"]
    assert ids("reply_retries", "key") == ["1", "2"]
    run(1, [(5, 1), (6, 2)])
    assert ids("task_requests", "journalpostId") == ["1", "1", "2", "2"]


def test_refused_update_is_retried_after_the_reply(job):
    run, reply, ids = job
    run(0, [(2, 2)])
    reply(("2", 0, "task", 1, 201, None))
    reply(("2", 0, "update", 1, 503, None))
    assert ids("finalizations") == []
    assert ids("reply_retries", "enqueued_at") == [LATER]
    assert ids("reply_retries", "due_ms") == [int(LATER.replace(tzinfo=dt.UTC).timestamp() * 1000) + 1000]


def test_late_first_replies_count(spark):
    """One source of replies goes on while another is two days behind."""
    out = work_dir(spark, "late")
    lookups = X.make_lookups(spark, ENTRIES, [X.person("100")])
    route.prepare(spark, out)
    route.handle_batch(out, lambda s: lookups, await_replies=True)(_events(spark, [(1, 1), (2, 2), (4, 4)]), 0)

    def reply(*rows):
        full = [(e, 0, "task", 1, status, None, at) for e, status, at in rows]
        spark.createDataFrame(full, settle.REPLY_DDL).coalesce(1).write.mode("append").parquet(f"{out}/told")
        stream = streams.file_stream(spark, out, "told", settle.REPLY_DDL)
        settle.start(stream, out).awaitTermination()

    day = dt.timedelta(days=1)
    reply(("4", 201, LATER))
    reply(("4", 201, LATER + day / 24))
    reply(("2", 201, LATER - 2 * day), ("2", 500, LATER), ("1", 500, LATER - 2 * day))
    reply(("2", 500, LATER), ("4", 500, LATER - 3 * day))
    steps = spark.read.parquet(f"{out}/steps").select("entry_id", "action").collect()
    assert sorted(map(tuple, steps)) == [("1", "retry"), ("2", "update"), ("4", "update")]
    assert [r.key for r in spark.read.parquet(f"{out}/reply_retries").collect()] == ["1"]


def test_waiting_retries_are_reported(spark):
    from postern.operators import retry

    now = dt.datetime(2024, 1, 31)
    ms = int(now.replace(tzinfo=dt.UTC).timestamp() * 1000)
    rows = [
        ("a", "v", ms - 1, now - dt.timedelta(hours=1)),
        ("b", "v", ms + 1, now - dt.timedelta(hours=2)),
        ("c", "v", ms + 9, now),
        ("d", "v", ms + 1, now - dt.timedelta(hours=337)),
    ]
    report = retry.waiting_report(spark.createDataFrame(rows, route.RETRY_DDL), F.lit(now).cast("timestamp_ntz"))
    got = {r.state: (r.n_retries, r.oldest, r.last_due_ms) for r in report.collect()}
    assert got == {
        "due": (1, now - dt.timedelta(hours=1), ms - 1),
        "waiting": (2, now - dt.timedelta(hours=2), ms + 9),
        "expired": (1, now - dt.timedelta(hours=337), ms + 1),
    }
