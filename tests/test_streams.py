"""Streams give what the batch job gives, in any number of batches, and after a replay."""

import datetime as dt
import json
import time
import uuid
from dataclasses import replace

import fixtures as X
import pytest
from postern.operators import retry
from postern.operators.decode import checked, decode
from postern.plans import intake
from postern.plans.queries import QUERIES, _route_slice
from postern.session import session_settings, work_dir
from postern.sources import streams, tables
from postern.streaming import publish, route
from postern.streaming.due import DueStore
from postern.streaming.state import FANOUT, RunLog
from pyspark.sql import functions as F


def _outcomes(df):
    return {r.event_order: (r.entry_id, r.outcome, r.reason) for r in df.collect()}


def _sliced_events(spark, sf_dir, slices):
    """The events as several files; event order and file order agree."""
    folder = work_dir(spark, "slices")
    events = tables.table(spark, sf_dir, "events")
    step = events.count() // slices + 1
    for n in range(slices):
        part = events.where((F.col("event_id") >= n * step) & (F.col("event_id") < (n + 1) * step))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/events")
        time.sleep(0.02)  # files are taken in the order of their times
    return folder, events.schema


def test_many_batches_equal_one(spark, sf_dir):
    folder, schema = _sliced_events(spark, sf_dir, 3)
    out = work_dir(spark, "route")
    source = streams.file_stream(spark, folder, "events", schema, files_per_batch=1)
    route.start(
        spark, source.selectExpr(*tables.EVENT_COLUMNS), lambda s: intake.table_lookups(s, sf_dir), out
    ).awaitTermination()
    written = spark.read.parquet(f"{out}/routed")
    assert written.select("batch_id").distinct().count() == 3
    assert _outcomes(written) == _outcomes(QUERIES["routed_events"](spark, sf_dir))
    tasks = spark.read.parquet(f"{out}/task_requests").drop("batch_id")
    expected = QUERIES["task_requests"](spark, sf_dir)
    assert tasks.exceptAll(expected).count() == 0 and expected.exceptAll(tasks).count() == 0


def _events_of(spark, numbers):
    """A folder with these events only."""
    folder = work_dir(spark, "own")
    rows = [(n, dt.datetime(2024, 1, 10, 9), 1, "view", 1.0, '{"k": 1}') for n in numbers]
    spark.createDataFrame(rows, tables.SCHEMAS["events"]).write.parquet(f"{folder}/events.parquet")
    return folder


def test_a_slice_is_one_batch_of_many_files(spark):
    """All tasks write and read a slice, not one."""
    folder, out = _events_of(spark, range(400)), work_dir(spark, "files")
    source = X.make_lookups(spark, [X.entry("3")], [X.person("100")])
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    with session_settings(spark, settings):
        for n in range(2):
            _route_slice(spark, folder, out, 2, n, lambda _: source)
    assert len(spark.read.parquet(f"{out}/in").inputFiles()) == 8
    read = spark.read.parquet(f"{out}/entries").inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in read} == {"0", "1"}
    rows = spark.read.parquet(f"{out}/events").groupBy("batch_id").agg(F.min("event_order"), F.max("event_order"))
    (least, most) = sorted(tuple(r)[1:] for r in rows.collect())
    assert least[1] < 200 <= most[0]


def test_a_batch_broadcasts_no_large_table_by_itself(spark):
    """Within a batch only small tables pass through the driver unasked; afterwards all is as before."""
    seen, keys = [], list(route.BATCH_SETTINGS)
    source = X.make_lookups(spark, [X.entry("2")], [X.person("100")])

    def read_lookups(session):
        large = session.range(400_000)  # 3.2 MB, which would be broadcast outside
        joined = session.range(10_000_000).join(large, "id")
        seen.append(joined._jdf.queryExecution().executedPlan().toString())
        return source

    before = [spark.conf.get(k, None) for k in keys]
    wire = X.wire(spark, [(1, X.WEDNESDAY_MORNING, 2, "Mottatt", "SYK")])
    handle = route.handle_batch(work_dir(spark, "narrow"), read_lookups)
    handle(decode(checked(wire)).withColumn("is_retry", F.lit(False)), 0)
    assert len(seen) == 1 and "BroadcastHashJoin" not in seen[0]
    assert [spark.conf.get(k, None) for k in keys] == before


@pytest.fixture
def batches(spark):
    rows = [X.entry("1", code=X.MANUAL_CODE), X.entry("2"), X.entry("3", code="4936")]
    source = X.make_lookups(spark, rows, [X.person("100")])
    out = work_dir(spark, "replay")
    handle = route.handle_batch(out, lambda s: source, await_replies=False)

    def run(batch_id, orders):
        wire = X.wire(spark, [(o, X.WEDNESDAY_MORNING, e, "Mottatt", "SYK") for o, e in orders])
        wire = wire.withColumn("mottaksKanal", F.when(F.col("event_order") < 100, "NAV_NO"))
        handle(decode(checked(wire)).withColumn("is_retry", F.lit(False)), batch_id)

    def table(name):
        return spark.read.parquet(f"{out}/{name}")

    return run, table


def test_replayed_batch_changes_nothing(batches):
    run, table = batches
    run(0, [(1, 1), (2, 2), (3, 3), (4, 9), (100, 1)])  # the last one lacks a field
    run(1, [(5, 1), (6, 2), (7, 3), (8, 9), (9, 1)])
    (faulty,) = table("quarantine").collect()
    assert (faulty.event_order, faulty.fault) == (100, "missing:mottaksKanal")
    first = _outcomes(table("routed"))
    assert {o: v[1] for o, v in first.items()} == {
        1: "JFR", 2: "AUTO", 3: "SKIP_IGNORED", 4: "RETRY",
        5: "SKIP_HAS_TASK", 6: "SKIP_STATUS", 7: "SKIP_IGNORED", 8: "RETRY", 9: "SKIP_HAS_TASK",
    }
    run(1, [(5, 1), (6, 2), (7, 3), (8, 9), (9, 1)])
    assert _outcomes(table("routed")) == first
    run(0, [(1, 1), (2, 2), (3, 3), (4, 9)])  # must not see what batch 1 or itself left
    assert _outcomes(table("routed")) == first
    assert table("task_requests").count() == 2
    assert table("journal_updates").count() == table("finalizations").count() == 1


def test_events_of_one_order_give_one_first(batches, spark):
    """Offsets of two sources may agree; even rows that are equal in everything are told apart."""
    run, table = batches
    run(0, [(1, 1), (1, 1), (1, 1), (2, 2), (2, 2)])
    assert sorted(r.outcome for r in table("routed").collect()) == ["AUTO", "JFR", "SKIP_HAS_TASK", "SKIP_HAS_TASK", "SKIP_STATUS"]
    assert table("task_requests").count() == 2
    rows = [(1, X.WEDNESDAY_MORNING, 1, kind, "SYK") for kind in ("Mottatt", "JournalpostMottatt")]
    source = X.make_lookups(spark, [X.entry("1", code=X.MANUAL_CODE)], [X.person("100")])
    routed = intake.route_events(intake.gated_events(X.wire(spark, rows)), source)
    assert sorted(r.outcome for r in routed.collect()) == ["JFR", "SKIP_HAS_TASK"]


@pytest.mark.parametrize("broken", ["task_requests", "routed", "retries"])
def test_a_killed_batch_shows_nothing(batches, monkeypatch, broken):
    """The job dies after some of a batch's tables; consumers see them only after the replay, once."""
    run, table = batches
    run(0, [(1, 1)])
    folder = next(c.cell_contents for c in run.__closure__[0].cell_contents.__closure__ if isinstance(c.cell_contents, str))
    spark = table("routed").sparkSession
    seen = lambda name: sorted(map(str, publish.published(spark, folder, name).collect()))
    before = {name: seen(name) for name in ("routed", "task_requests", "decisions")}
    real = intake.write_table

    def dies(spark, df, path):
        out = real(spark, df, path)
        if f"/{broken}/" in path:
            raise RuntimeError("killed")
        return out

    with monkeypatch.context() as m:
        m.setattr(intake, "write_table", dies)
        with pytest.raises(RuntimeError):
            run(1, [(2, 2), (3, 1)])
    assert {name: seen(name) for name in before} == before
    assert publish.last_published(spark, folder) == 0
    run(1, [(2, 2), (3, 1)])
    after = {name: seen(name) for name in before}
    assert {name: len(rows) for name, rows in after.items()} == {"routed": 3, "task_requests": 2, "decisions": 3}
    run(1, [(2, 2)])  # published already
    assert {name: seen(name) for name in before} == after
    assert {r.table for r in publish.manifest(spark, folder, 1).collect()} >= {"decisions", "routed", "retries"}


def test_last_published_opens_few_manifests(spark, monkeypatch):
    for last in (-1, 0, 1, 2, 7, 8, 100, 1000):
        opened = []
        monkeypatch.setattr(publish, "manifest", lambda s, f, n, last=last, opened=opened: opened.append(n) or (n <= last or None))
        assert publish.last_published(spark, "x") == last and len(opened) <= 22


def test_large_batch_without_broadcast(batches, monkeypatch):
    run, table = batches
    monkeypatch.setattr(intake, "MAX_BROADCAST_IDS", 1)
    run(0, [(1, 1), (2, 2)])
    run(1, [(3, 1), (4, 2)])
    got = {o: v[1] for o, v in _outcomes(table("routed")).items()}
    assert got == {1: "JFR", 2: "AUTO", 3: "SKIP_HAS_TASK", 4: "SKIP_STATUS"}


def _wait(condition, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        if condition():
            return True
        time.sleep(0.5)
    return False


MINUTE = 60_000


def test_messages_are_held_until_due(spark):
    """Later ones of a key replace earlier ones, replays change nothing, what is past its retention is
    recorded once."""
    store = DueStore(work_dir(spark, "due"), "INTERVAL '2' HOUR")
    start = dt.datetime(2024, 1, 10, 9, 30)
    t0 = int(start.replace(tzinfo=dt.UTC).timestamp() * 1000)

    def turn(batch_id, minute, *rows):
        came = [(k, v, t0 + int(due * MINUTE), start + dt.timedelta(minutes=at)) for k, v, due, at in rows]
        due, now_ms = store.turn(spark, spark.createDataFrame(came, route.RETRY_DDL), batch_id, lambda: t0 + minute * MINUTE)
        return sorted((r.key, r.value) for r in due.collect()), (now_ms - t0) / MINUTE

    def expired():
        return sorted(r.key for r in spark.read.parquet(f"{store.folder}/expired").collect())

    first = [("past", "a", -1, -1), ("soon", "early", 1, 0), ("soon", "b", 15, 0), ("later", "c", 110, 0), ("never", "d", 500, 0), ("far", "e", 10**12, 0)]
    assert turn(0, 0, *first) == ([("past", "a")], 0)
    assert turn(1, 10) == ([], 10)
    assert turn(2, 16, ("later", "sooner", 17, 15)) == ([("soon", "b")], 16)
    assert turn(2, 99, ("later", "sooner", 17, 15)) == ([("soon", "b")], 16)  # a replay keeps its time
    assert turn(0, 99, *first) == ([("past", "a")], 0)
    assert turn(3, 50) == ([], 50)
    assert turn(4, 40, ("soon", "again", 45, 40)) == ([("soon", "again")], 50)  # the clock never goes back
    assert {r.key for r in store.waiting(spark, 4).collect()} == {"later", "never", "far"}
    assert expired() == []
    restarted = DueStore(store.folder, store.retention)
    assert restarted == store
    assert turn(5, 111, ("late", "f", 60, -30)) == ([("later", "c")], 111)
    assert expired() == ["late"]
    assert turn(6, 300) == ([], 300)
    assert turn(6, 300) == ([], 300)
    assert expired() == ["far", "late", "never"]
    assert turn(7, 400) == ([], 400) and expired() == ["far", "late", "never"]
    assert store.waiting(spark, 7).count() == 0


def test_a_batch_opens_its_own_messages_and_hours_that_still_wait(spark):
    """Messages overdue since many hours cost one folder a batch, and later batches don't open it."""
    store = DueStore(work_dir(spark, "overdue"), None)
    start = dt.datetime(2024, 1, 10)
    t0 = int(start.replace(tzinfo=dt.UTC).timestamp() * 1000)
    for n in range(4):
        rows = [(f"k{n}-{h}", "v", t0 - h * 60 * MINUTE, start) for h in range(30)] + [("none", "w", None, None)]
        rows.append((f"later{n}", "x", t0 + 90 * MINUTE, start))
        due, _ = store.turn(spark, spark.createDataFrame(rows, route.RETRY_DDL), n, lambda n=n: t0 + n * MINUTE)
        opened = {f.split("/waiting/")[1].rsplit("/", 1)[0] for f in due.inputFiles()}
        hour = t0 // (60 * MINUTE)
        later = {f"hour={hour + 1}/batch_id={i}" for i in range(n + 1)}
        assert opened == {f"hour={hour - 1}/batch_id={n}", *later}
        assert sorted(r.key for r in due.collect()) == sorted([*(r[0] for r in rows[:30]), "none"])
    assert sorted(r.key for r in store.waiting(spark, 3).collect()) == [f"later{n}" for n in range(4)]


def test_due_store_plans_no_python_and_sorts_no_payload(spark):
    store = DueStore(work_dir(spark, "due"))
    rows = spark.createDataFrame([("k", "v", 1, dt.datetime(2024, 1, 10))], route.RETRY_DDL)
    due, _ = store.turn(spark, rows, 0, lambda: 2)
    plan = due._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "HashAggregate" in plan
    assert "PartitionFilters" in plan


def test_few_files_hold_many_batches(spark):
    """Fifty batches; any batch, a replay too, reads what went before it from a bounded number of runs."""
    folder = work_dir(spark, "log")
    log = RunLog(folder, "made", "n", "entry_id string, outcome string, n bigint", "outcome <> 'SKIP'")
    rows = lambda n: [(f"e{n}", "JFR"), (f"e{n % 7}", "AUTO"), (f"s{n}", "SKIP")]
    for n in range(50):
        made = spark.createDataFrame(rows(n), "entry_id string, outcome string").coalesce(1)
        made.write.parquet(f"{folder}/made/n={n}")
        log.merge(spark, n)
        assert len(log.runs(n)) <= 2 * (FANOUT - 1)
    want = lambda n: sorted((e, o, i) for i in range(n) for e, o in rows(i) if o != "SKIP")
    for n in (1, 7, 8, 9, 37, 50):
        assert sorted(map(tuple, log.read(spark, n).collect())) == want(n)
    assert log.read(spark, 0) is None
    log.merge(spark, 47)  # a replay writes the same run again
    assert sorted(map(tuple, log.read(spark, 50).collect())) == want(50)
    from postern.streaming.state import buckets_of

    ids = spark.createDataFrame([("e3",)], "entry_id string")
    found = log.read(spark, 48, buckets_of(ids))
    assert {tuple(r) for r in found.where("entry_id = 'e3'").collect()} == {r for r in want(48) if r[0] == "e3"}
    assert found.count() < len(want(48))
    assert len(log.runs(10**6)) <= 7 * (FANOUT - 1)


def test_a_closed_task_frees_its_entry(spark):
    """An own request holds the entry until the live table shows it; then its task does, while open."""
    wednesday = X.WEDNESDAY_MORNING
    shown = wednesday + dt.timedelta(minutes=5)
    tasks = [("t0", "1", "AVSLUTTET", "JFR", wednesday - dt.timedelta(days=1))]  # an older one
    rows = [X.entry("1", code=X.MANUAL_CODE), X.entry("2", code=X.MANUAL_CODE)]
    schema = f"{X.TASKS}, opened_at timestamp_ntz"
    out = work_dir(spark, "closed")

    def run(batch_id, orders):
        source = X.make_lookups(spark, rows, [X.person("100")])
        source = replace(source, tasks=spark.createDataFrame(tasks, schema))
        now = wednesday + dt.timedelta(minutes=10 * batch_id)
        wire = X.wire(spark, [(o, now, e, "Mottatt", "SYK") for o, e in orders])
        route.handle_batch(out, lambda s: source)(decode(checked(wire)).withColumn("is_retry", F.lit(False)), batch_id)
        routed = spark.read.parquet(f"{out}/routed").where(F.col("batch_id") == batch_id)
        return {r.event_order: r.outcome for r in routed.collect()}

    assert run(0, [(1, 1), (2, 2)]) == {1: "JFR", 2: "JFR"}
    assert run(1, [(3, 1)]) == {3: "SKIP_HAS_TASK"}  # asked for, not shown yet
    tasks.append(("t1", "1", "AAPEN", "JFR", shown))
    assert run(2, [(4, 1)]) == {4: "SKIP_HAS_TASK"}
    tasks[-1] = ("t1", "1", "AVSLUTTET", "JFR", shown)
    assert run(3, [(5, 1), (6, 1), (7, 2)]) == {5: "JFR", 6: "SKIP_HAS_TASK", 7: "SKIP_HAS_TASK"}
    assert run(4, [(8, 1)]) == {8: "SKIP_HAS_TASK"}  # the second task is not shown yet


def test_failed_entry_is_retried_until_it_works(spark):
    """The entry is missing at first and there on the retry, which skips the gates."""
    out = work_dir(spark, "loop")
    folder = work_dir(spark, "loop-in")
    now = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    X.wire(spark, [(1, now, 2, "Mottatt", "SYK")]).coalesce(1).write.parquet(f"{folder}/events")
    schema = spark.read.parquet(f"{folder}/events").schema
    calls = []

    def read_lookups(session):
        calls.append(1)
        rows = [X.entry("2")] if len(calls) > 1 else []
        return X.make_lookups(session, rows or [X.entry("other")], [X.person("100")])

    stream = route.start(
        spark, streams.file_stream(spark, folder, "events", schema), read_lookups, out,
        with_retries=True, processingTime="1 second",
    )
    try:
        assert _wait(lambda: "AUTO" in _read_outcomes(spark, out))
    finally:
        stream.stop()
    assert _read_outcomes(spark, out) == ["AUTO", "RETRY"]
    value = spark.read.parquet(f"{out}/retries").where("key is not null").first().value
    assert json.loads(value)["journalpostId"] == "2"


def _read_outcomes(spark, out):
    try:
        return sorted(r.outcome for r in spark.read.parquet(f"{out}/routed").collect())
    except Exception:
        return []


class _Session:
    """Only what ``work_dir`` reads."""

    def __init__(self, master, shared):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_work_dir():
    assert work_dir(_Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert work_dir(_Session("local[2]", "/shared"), "x").startswith("/shared/x-")
    assert work_dir(_Session("local[2]", None), "x")
    with pytest.raises(ValueError):
        work_dir(_Session("spark://cluster:7077", None), "x")


def test_settings_for_size(spark):
    from postern.session import session_settings, settings_for

    assert settings_for(10)["spark.sql.shuffle.partitions"] == "200"
    settings = settings_for(100 << 40)
    assert settings["spark.sql.shuffle.partitions"] == str((100 << 20) // 200)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, settings):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "200m"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_second_failure_waits_ten_minutes(batches, spark):
    routed = X.wire(spark, [(1, X.WEDNESDAY_MORNING, 5, "Mottatt", "SYK")])
    failed = decode(routed).withColumn("outcome", F.lit("RETRY"))
    delays = [retry.enqueue(failed, F.expr(d)).first().due_ms for d in ("INTERVAL '1' SECOND", "INTERVAL '10' MINUTE")]
    assert delays[1] - delays[0] == 599_000


def test_bucketed_entries_are_not_shuffled(spark, sf_dir):
    from dataclasses import replace

    from postern.sources import snapshot

    lookups = intake.table_lookups(spark, sf_dir)
    location = work_dir(spark, "warehouse")
    name = "entries_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")
    snapshot.publish(lookups.entries, f"{name}.entries", 4)
    ready = replace(lookups, journal=snapshot.read(spark, f"{name}.entries"), documents=None)
    events = intake.gated_events(tables.events(spark, sf_dir))
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        decisions = intake.decide_events(events, ready)
        plan = decisions._jdf.queryExecution().executedPlan().toString()
        got = decisions.select("entry_id", "outcome", "reason").collect()
    scan = plan[: plan.index("entries_")].rsplit("\n", 4)
    assert not any("Exchange" in line for line in scan[1:])
    expected = intake.decide_events(events, lookups).select("entry_id", "outcome", "reason").collect()
    assert sorted(map(str, got)) == sorted(map(str, expected))
