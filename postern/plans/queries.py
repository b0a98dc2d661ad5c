"""The registered queries: (session, table folder) -> DataFrame, one per operator and job."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postern import rules
from postern.functions import dates
from postern.functions import json as J
from postern.functions import parties as P
from postern.functions.dates import deadline, epoch_ms
from postern.functions.text import term_malformed, term_part
from postern.operators import envelope, gates, joins, outputs, repair, retry, routing
from postern.operators.decode import checked, decode, parse_json_events, split_faulty
from postern.plans import intake
from postern.schemas import JOURNAL_ENTRY, RETRY_MESSAGE
from postern.session import work_dir
from postern.sources import lookups, streams, tables
from postern.streaming import enrich, publish, route, settle
from postern.streaming.due import DueStore, wall_clock

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.gated_events(tables.gate_events(spark, sf_dir))


def _from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(checked(parse_json_events(tables.wire_messages(spark, sf_dir))))


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.decide_events(_gated(spark, sf_dir), intake.table_lookups(spark, sf_dir))


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.settled_decisions(_decisions(spark, sf_dir), tables.answers(spark, sf_dir))


def _settled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.fan_out(_gated(spark, sf_dir), _settled(spark, sf_dir))


def _retry_as_of() -> Column:
    return F.expr(tables.RETRY_AS_OF)


_EVENT_OUTCOME = ["event_order", "entry_id", "first_in_set", "outcome", "reason"]


# -- routing --------------------------------------------------------------------------------


@query
def outcome_counts(spark, sf_dir):
    """Events per outcome and reason: the flagship report."""
    return intake.outcome_counts(routed_events(spark, sf_dir))


@query
def routed_events(spark, sf_dir):
    """Outcome of every gated event."""
    routed = intake.route_events(_gated(spark, sf_dir), intake.table_lookups(spark, sf_dir))
    return routed.select(*_EVENT_OUTCOME)


@query
def routed_entries(spark, sf_dir):
    """Outcome of every entry of the journal, as if each had one event."""
    source = intake.table_lookups(spark, sf_dir)
    decided = intake.decide_keys(source.journal.select("entry_id"), source)
    return decided.select("entry_id", "outcome", "reason")


@query
def settled_events(spark, sf_dir):
    """Outcome of every gated event after the task system's replies."""
    return _settled_events(spark, sf_dir).select(*_EVENT_OUTCOME)


@query
def dedup_in_batch(spark, sf_dir):
    """Which event of an entry is handled, and how many there are in the set."""
    events = _gated(spark, sf_dir)
    keys = joins.keys_of(events)
    return keys.select("entry_id", "first_event", "n_events")


# -- gates and decoding ---------------------------------------------------------------------


@query
def gate_theme(spark, sf_dir):
    events = tables.events(spark, sf_dir).where(gates.theme_passes())
    return events.select("event_order", "temaNytt")


@query
def gate_event_type(spark, sf_dir):
    events = tables.events(spark, sf_dir).where(gates.event_type_passes())
    return events.select("event_order", "hendelsesType")


@query
def decode_events(spark, sf_dir):
    """Gated JSON messages without faults, decoded with defaults."""
    good, _ = split_faulty(_from_text(spark, sf_dir))
    return good.select(
        "event_order", "entry_id", "hendelsesId", "hendelsesType", "temaNytt", "mottaksKanal",
        "journalpostStatus", "versjon", "temaGammelt", "kanalReferanseId", "behandlingstema",
    )


@query
def quarantine_events(spark, sf_dir):
    """Messages that cannot be handled, with the fault."""
    _, bad = split_faulty(_from_text(spark, sf_dir))
    return bad.select("event_order", "fault")


@query
def single_as_array(spark, sf_dir):
    """A list field given as array, as single value, or not at all."""
    dates = J.array_or_single(F.col("value"), "$.relevanteDatoer", "struct<dato: string, datotype: string>")
    path = J.strings_or_single(F.col("value"), "$.path")
    return (
        tables.date_documents(spark, sf_dir)
        .select("entry_id", dates.alias("dates"), path.alias("path"))
        .select(
            "entry_id",
            F.when(F.col("dates").isNotNull(), F.size("dates")).cast("bigint").alias("n_dates"),
            F.get("dates", F.lit(0))["dato"].alias("first_date"),
            F.get("dates", F.lit(0))["datotype"].alias("first_kind"),
            F.when(F.col("path").isNotNull(), F.size("path")).cast("bigint").alias("n_path"),
            F.array_join("path", "/").alias("path_text"),
        )
    )


@query
def envelope_unwrap(spark, sf_dir):
    """Lookup responses: entity if there is one, else failed; errors in any case."""
    unwrapped = envelope.unwrap(tables.responses(spark, sf_dir), "journalpost", JOURNAL_ENTRY)
    return unwrapped.select(
        "entry_id", "failed", "entity.journalstatus", "entity.tema", F.col("n_errors").cast("bigint").alias("n_errors")
    )


@query
def error_messages(spark, sf_dir):
    unwrapped = envelope.unwrap(tables.responses(spark, sf_dir), "journalpost", JOURNAL_ENTRY)
    return unwrapped.select("entry_id", "error_text")


@query
def error_rows(spark, sf_dir):
    """Side table of lookup errors."""
    unwrapped = envelope.unwrap(tables.responses(spark, sf_dir), "journalpost", JOURNAL_ENTRY)
    return envelope.error_rows(unwrapped, "entry_id").withColumn("pos", F.col("pos").cast("bigint"))


# -- lookup tables --------------------------------------------------------------------------


@query
def journal_snapshot(spark, sf_dir):
    """Every entry with the facts of its documents."""
    return tables.entries(spark, sf_dir).drop("entry_ok")


@query
def snapshot_entries(spark, sf_dir):
    """The same from nested rows, as the archive gives them."""
    return lookups.entries_from_snapshot(tables.snapshot(spark, sf_dir)).drop("entry_ok")


@query
def snapshot_bodies(spark, sf_dir):
    """Bodies of the updates, with the lists of the nested rows."""
    updates = outputs.journal_updates(_settled(spark, sf_dir))
    return outputs.update_bodies(updates, tables.snapshot(spark, sf_dir))


@query
def identity_lists(spark, sf_dir):
    """Current identities per party, in order."""
    current = lookups.current_identities()
    text = F.transform(F.col("current"), lambda i: F.concat(i["grp"], F.lit(":"), i["ident"]))
    return (
        tables.identities(spark, sf_dir)
        .select("party_id", current.alias("current"))
        .select(
            "party_id",
            F.size("current").cast("bigint").alias("n_identities"),
            F.array_join(text, ",").alias("identity_text"),
        )
    )


@query
def first_identity(spark, sf_dir):
    facts = lookups.identity_facts(tables.identities(spark, sf_dir))
    return facts.select("party_id", "actor_id", "national_id")


@query
def code_hierarchy_flat(spark, sf_dir):
    """The flattened code tree with the number of entries that use each code."""
    used = tables.entries(spark, sf_dir).groupBy("theme", "form_code").agg(F.count("*").alias("n_entries"))
    return (
        tables.hierarchy(spark)
        .join(used, ["theme", "form_code"], "left")
        .withColumn("n_entries", F.coalesce("n_entries", F.lit(0).cast("bigint")))
    )


@query
def open_tasks(spark, sf_dir):
    return lookups.open_tasks(tables.tasks(spark, sf_dir)).select("task_id", "entry_id", "task_type")


# -- predicates on entries ------------------------------------------------------------------


@query
def first_form_code(spark, sf_dir):
    return tables.entries(spark, sf_dir).select("entry_id", "form_code")


@query
def titles_valid(spark, sf_dir):
    return tables.entries(spark, sf_dir).select("entry_id", "titles_ok")


@query
def status_gate(spark, sf_dir):
    return tables.journal(spark, sf_dir).where(routing.status_open()).select("entry_id", "status")


def _ruled(spark, sf_dir):
    return joins.with_form_rules(tables.entries(spark, sf_dir), rules.form_rules(spark))


@query
def ignore_list(spark, sf_dir):
    """Entries that end without a task because of their form."""
    return _ruled(spark, sf_dir).where("ignored").select("entry_id", "theme", "form_code")


@query
def auto_list(spark, sf_dir):
    return _ruled(spark, sf_dir).select("entry_id", "listed")


@query
def form_rules(spark, sf_dir):
    """Task type and deadline of the entries with an automatic form."""
    return _ruled(spark, sf_dir).where("listed").select("entry_id", "task_type", "deadline_days")


@query
def has_open_task(spark, sf_dir):
    taken = lookups.entries_with_open_task(tables.tasks(spark, sf_dir))
    return tables.journal(spark, sf_dir).join(taken, "entry_id", "left_semi").select("entry_id", "status")


@query
def no_open_task(spark, sf_dir):
    taken = lookups.entries_with_open_task(tables.tasks(spark, sf_dir))
    return tables.journal(spark, sf_dir).join(taken, "entry_id", "left_anti").select("entry_id", "status")


@query
def party_kind(spark, sf_dir):
    kind = F.col("party_type")
    return tables.journal(spark, sf_dir).select(
        "entry_id",
        P.has_type(kind, rules.PARTY_ACTOR).alias("is_actor"),
        P.has_type(kind, rules.PARTY_PERSON).alias("is_national"),
        P.is_organisation(kind).alias("is_organisation"),
    )


@query
def manual_kind(spark, sf_dir):
    """Task type an entry would get by hand."""
    kind = F.when(routing.to_distribution(), rules.TASK_DISTRIBUTION).otherwise(rules.TASK_JOURNALING)
    return tables.journal(spark, sf_dir).select("entry_id", kind.alias("manual_type"))


# -- joins ----------------------------------------------------------------------------------


@query
def enrich_journal(spark, sf_dir):
    joined = joins.events_with_entry(_gated(spark, sf_dir), tables.entries(spark, sf_dir))
    return joined.select("event_order", "entry_id", "entry_found", "status", "theme", "form_code", "titles_ok")


@query
def resolve_identities(spark, sf_dir):
    resolved = joins.with_identities(tables.journal(spark, sf_dir), tables.identities(spark, sf_dir))
    return resolved.select("entry_id", "person_found", "actor_id", "national_id")


@query
def map_codes(spark, sf_dir):
    mapped = joins.with_codes(tables.entries(spark, sf_dir), tables.hierarchy(spark))
    return mapped.select("entry_id", "handling_theme", "handling_type")


@query
def split_terms(spark, sf_dir):
    term = F.col("term")
    return tables.part_terms(spark, sf_dir).select(
        "part_id",
        term_part(term, 0).alias("handling_theme"),
        term_part(term, 1).alias("handling_type"),
        term_malformed(term).alias("malformed"),
    )


# -- derived values -------------------------------------------------------------------------


@query
def deadline_auto(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    return events.select("event_order", deadline(F.col("as_of"), 3).alias("deadline"))


@query
def deadline_manual(spark, sf_dir):
    events = tables.events(spark, sf_dir)
    return events.select(
        "event_order", deadline(F.col("as_of"), rules.MANUAL_DEADLINE_DAYS).alias("deadline")
    )


@query
def local_time(spark, sf_dir):
    """Local wall time of every event, its time taken as UTC."""
    return tables.events(spark, sf_dir).select("event_order", dates.local_time(F.col("as_of")).alias("local_ts"))


@query
def assigned_unit(spark, sf_dir):
    """Unit of an automatic and of a manual task."""
    return tables.journal(spark, sf_dir).select(
        "entry_id", outputs.auto_unit().alias("auto_unit"), F.col("unit").alias("manual_unit")
    )


@query
def task_party(spark, sf_dir):
    """Actor id and organisation number a manual task would carry."""
    resolved = joins.with_identities(tables.journal(spark, sf_dir), tables.identities(spark, sf_dir))
    return resolved.select(
        "entry_id", outputs.manual_actor().alias("actor"), outputs.manual_org().alias("organisation")
    )


# -- outputs --------------------------------------------------------------------------------


@query
def task_requests(spark, sf_dir):
    return outputs.task_requests(_decisions(spark, sf_dir))


@query
def auto_tasks(spark, sf_dir):
    return outputs.auto_tasks(_decisions(spark, sf_dir))


@query
def manual_tasks(spark, sf_dir):
    return outputs.manual_tasks(_decisions(spark, sf_dir))


@query
def distribution_tasks(spark, sf_dir):
    return outputs.distribution_tasks(_decisions(spark, sf_dir))


@query
def journal_updates(spark, sf_dir):
    """Updates of the entries whose automatic task was accepted."""
    return outputs.journal_updates(_settled(spark, sf_dir))


@query
def update_bodies(spark, sf_dir):
    """The same as JSON text."""
    return outputs.update_bodies(outputs.journal_updates(_settled(spark, sf_dir)))


@query
def finalizations(spark, sf_dir):
    return outputs.finalizations(outputs.journal_updates(_settled(spark, sf_dir)))


@query
def current_journal(spark, sf_dir):
    """The journal with the updates applied."""
    updates = outputs.journal_updates(_settled(spark, sf_dir))
    return outputs.current_journal(tables.journal(spark, sf_dir), updates)


# -- rejected tasks -------------------------------------------------------------------------


@query
def classify_rejections(spark, sf_dir):
    """Class of the reply to every first attempt."""
    kind = repair.rejection_class(F.col("http_status"), F.col("message"))
    first = tables.answers(spark, sf_dir).where(F.col("attempt") == 1)
    return first.select("entry_id", "http_status", kind.alias("rejection"))


@query
def repair_rejections(spark, sf_dir):
    """Every task request after at most one repair."""
    settled = repair.settle(task_requests(spark, sf_dir), tables.answers(spark, sf_dir))
    return settled.select(
        "journalpostId", "oppgavetype", "orgnr", "tildeltEnhetsnr", "rejection", "attempts", "accepted", "reason"
    )


@query
def archive_failures(spark, sf_dir):
    """Automatic entries whose update or finalization the archive refused, with the reason."""
    decisions = repair.after_archive(_settled(spark, sf_dir), tables.archive_replies(spark, sf_dir))
    failed = decisions.where(F.col("reason").isin(repair.UPDATE_FAILED, repair.FINALIZE_FAILED))
    return failed.select("entry_id", "outcome", "reason")


# -- retries --------------------------------------------------------------------------------


@query
def retry_enqueue(spark, sf_dir):
    """Retry messages of everything that failed, refused tasks included."""
    return retry.enqueue(_settled_events(spark, sf_dir)).select("key", "value", "due_ms")


@query
def retry_due(spark, sf_dir):
    """Retry messages that are due at a point in time."""
    due = retry.due(tables.retries(spark, sf_dir), epoch_ms(_retry_as_of()))
    return due.select("key", "due_ms")


@query
def quarantine_retries(spark, sf_dir):
    """Retry messages that can't be read or lack required fields."""
    key = F.col("key").cast("bigint")
    lacking = F.to_json(F.struct(F.col("key").alias("journalpostId")))
    broken = tables.retries(spark, sf_dir).withColumn(
        "value",
        F.when(key % 101 == 0, "{broken").when(key % 7 == 0, lacking).otherwise(F.col("value")),
    )
    return retry.quarantined(broken)


@query
def retry_retained(spark, sf_dir):
    """Retry messages not yet past their retention."""
    return retry.retained(tables.retries(spark, sf_dir), _retry_as_of()).select("key", "due_ms")


@query
def retry_waiting(spark, sf_dir):
    """How many retry messages wait, since when, and until when."""
    return retry.waiting_report(tables.retries(spark, sf_dir), _retry_as_of())


@query
def retry_schedule(spark, sf_dir):
    """Due times of the next three attempts of every retry message."""
    return retry.schedule(tables.retries(spark, sf_dir), 3)


# -- streams --------------------------------------------------------------------------------


def _written_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Run a stream into a parquet table until its source is read through; read the table."""
    stream = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    stream.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams.file_stream(spark, sf_dir, "events.parquet", tables.SCHEMAS["events"])
    return rows.selectExpr(*tables.EVENT_COLUMNS)


@query
def src_event_stream(spark, sf_dir):
    """The event stream from its beginning, decoded."""
    events = decode(_event_stream(spark, sf_dir))
    rows = events.select("event_order", "entry_id", "hendelsesType", "temaNytt", "kanalReferanseId")
    return _written_stream(spark, rows, work_dir(spark, "events"))


@query
def src_retry_due(spark, sf_dir):
    """The retry stream: due time from the last header of its name, else now."""
    folder = work_dir(spark, "retry-source")
    tables.retry_messages(spark, sf_dir).write.parquet(f"{folder}/messages")
    messages = streams.file_stream(spark, folder, "messages", RETRY_MESSAGE)
    rows = retry.read_messages(messages, epoch_ms(_retry_as_of())).select("key", "due_ms")
    return _written_stream(spark, rows, folder)


@query
def stream_route(spark, sf_dir):
    """The whole job on the event stream."""
    folder = work_dir(spark, "route")
    stream = route.start(
        spark, _event_stream(spark, sf_dir), lambda session: intake.table_lookups(session, sf_dir), folder
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/routed").select(*_EVENT_OUTCOME)


def _settle(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The job on the event stream up to its task requests, then a stream of replies to them."""
    route.start(
        spark,
        _event_stream(spark, sf_dir),
        lambda session: intake.table_lookups(session, sf_dir),
        folder,
        await_replies=True,
    ).awaitTermination()
    decided = spark.read.parquet(f"{folder}/decisions").select("entry_id", "outcome")
    automatic = F.col("step").isin(repair.UPDATE, repair.FINALIZE)
    replies = tables.request_replies(spark, sf_dir).join(decided, "entry_id")
    replies = replies.where(~automatic | (F.col("outcome") == routing.AUTO))
    replies.drop("outcome").write.parquet(f"{folder}/told")
    stream = streams.file_stream(spark, folder, "told", settle.REPLY_DDL)
    settle.start(stream, folder).awaitTermination()


@query
def stream_settle(spark, sf_dir):
    """What follows from each reply."""
    folder = work_dir(spark, "settle")
    _settle(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/steps").select("entry_id", "step", "attempt", "action", "reason")


@query
def stream_settle_bodies(spark, sf_dir):
    """The whole bodies of the updates that follow from accepted tasks."""
    folder = work_dir(spark, "bodies")
    _settle(spark, sf_dir, folder)
    return spark.read.parquet(f"{folder}/update_bodies").select("entry_id", "body")


@query
def stream_enrich(spark, sf_dir):
    """Gated events with their entry's codes, batch by batch."""
    folder = work_dir(spark, "enrich")
    events = intake.gated_events(_event_stream(spark, sf_dir))
    stream = enrich.start(events, lambda session: intake.table_lookups(session, sf_dir), folder)
    stream.awaitTermination()
    return spark.read.parquet(f"{folder}/enriched").select(
        "event_order", "entry_id", "theme", "form_code", "handling_theme", "handling_type"
    )


def _due_stream(spark: SparkSession, folder: str, store: DueStore, clock: Callable[[], int]) -> DataFrame:
    """Run the files of ``folder``/retries through a store, a batch each; the messages that were
    handed out, with the batch and its time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        due, now_ms = store.turn(batch.sparkSession, batch, batch_id, clock)
        rows = due.withColumn("released_ms", F.lit(now_ms).cast("bigint"))
        intake.write_table(batch.sparkSession, rows, f"{folder}/released/batch_id={batch_id}")

    waiting = streams.file_stream(spark, folder, "retries", route.RETRY_DDL, files_per_batch=1)
    (
        waiting.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{folder}/released")


@query
def stream_retry(spark, sf_dir):
    """Retry messages held until due, without a retention; all of the test tables' are due."""
    folder = work_dir(spark, "retry")
    tables.retries(spark, sf_dir).write.parquet(f"{folder}/retries")
    return _due_stream(spark, folder, DueStore(folder, None), wall_clock).select("key", "due_ms")


@query
def stream_retry_held(spark, sf_dir):
    """Messages that come in two batches at two points in time: handed out at which of them, expired,
    or still waiting."""
    folder = work_dir(spark, "held")
    rows = tables.retries(spark, sf_dir)
    odd = F.abs(F.col("key").cast("bigint")) % 2 == 1
    for n, some in enumerate((~odd, odd)):
        rows.where(some).coalesce(1).write.mode("append").parquet(f"{folder}/retries")
        time.sleep(0.05)  # files are taken in the order of their times
    times = iter([tables.RETRY_FIRST_MS, tables.RETRY_AS_OF_MS])
    store = DueStore(folder)
    released = _due_stream(spark, folder, store, lambda: next(times))
    expired = spark.read.parquet(f"{folder}/expired")
    none = F.lit(None).cast("bigint").alias("released_ms")
    state = lambda name: F.lit(name).alias("state")
    return (
        released.select("key", "due_ms", state("released"), "released_ms")
        .unionByName(expired.select("key", "due_ms", state("expired"), none))
        .unionByName(store.waiting(spark, 1).select("key", "due_ms", state("waiting"), none))
    )


def _route_slice(spark: SparkSession, sf_dir: str, folder: str, slices: int, n: int, read_lookups) -> None:
    """The job on slice ``n`` of the events by event id, as one batch: it takes all files that have come
    since the last start, so all tasks write and read a slice."""
    events = tables.table(spark, sf_dir, "events")
    least, most = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = ((most or 0) - (least or 0)) // slices + 1
    begin = (least or 0) + n * step
    part = events.where((F.col("event_id") >= begin) & (F.col("event_id") < begin + step))
    part.repartition("event_id").write.mode("append").parquet(f"{folder}/in")
    rows = streams.file_stream(spark, folder, "in", tables.SCHEMAS["events"])
    route.start(spark, rows.selectExpr(*tables.EVENT_COLUMNS), read_lookups, folder).awaitTermination()


@query
def stream_route_batches(spark, sf_dir):
    """The whole job in nine batches, of which the first eight are merged into one run of earlier
    decisions: what one batch gives."""
    folder = work_dir(spark, "batches")
    for n in range(9):
        _route_slice(spark, sf_dir, folder, 9, n, lambda session: intake.table_lookups(session, sf_dir))
    return spark.read.parquet(f"{folder}/routed").select("event_order", "entry_id", "outcome", "reason")


@query
def published_requests(spark, sf_dir):
    """The task requests that consumers see after the job in two batches."""
    folder = work_dir(spark, "published")
    for n in range(2):
        _route_slice(spark, sf_dir, folder, 2, n, lambda session: intake.table_lookups(session, sf_dir))
    return publish.published(spark, folder, "task_requests").drop("batch_id")


@query
def stream_closed_tasks(spark, sf_dir):
    """The job on the first half of the events, then on the second, when the live table shows most
    of the tasks that the first half asked for, half of them closed: closed ones free their entry."""
    folder = work_dir(spark, "closed")
    base = intake.table_lookups(spark, sf_dir)
    dated = base.tasks.withColumn("opened_at", F.lit(None).cast("timestamp_ntz"))
    _route_slice(spark, sf_dir, folder, 2, 0, lambda _: replace(base, tasks=dated))
    made = tables.tasks_of(spark.read.parquet(f"{folder}/decisions"))
    _route_slice(spark, sf_dir, folder, 2, 1, lambda _: replace(base, tasks=dated.unionByName(made)))
    routed = spark.read.parquet(f"{folder}/routed").where("batch_id = 1")
    return routed.select(*_EVENT_OUTCOME)


@query
def events_with_task_at(spark, sf_dir):
    """Gated events whose entry had an open task at the event's time."""
    found = lookups.events_with_task_at(_gated(spark, sf_dir), tables.task_versions(spark, sf_dir))
    return found.select("event_order", "entry_id")


@query
def tasks_at(spark, sf_dir):
    """Tasks as a search at one time finds them."""
    return lookups.tasks_at(tables.task_versions(spark, sf_dir), _retry_as_of())
