"""The intake job: events and lookup tables in, decisions and all outputs out."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postern import rules
from postern.operators import bitmap, joins, outputs, repair, retry, routing
from postern.operators.decode import checked, decode, split_faulty
from postern.sources import tables
from postern.sources.lookups import entries_with_documents


@dataclass(frozen=True)
class Lookups:
    """The reference data of one run (layouts in ``schemas``). ``documents`` holds the facts per
    entry (``lookups.document_facts``), or None where the journal rows carry them already
    (``lookups.entries_from_snapshot``)."""

    journal: DataFrame
    documents: DataFrame | None
    identities: DataFrame
    tasks: DataFrame
    hierarchy: DataFrame
    rules: DataFrame
    # Nested rows (``schemas.JOURNAL_ENTRY``), for the whole bodies of the updates.
    snapshot: DataFrame | None = None
    # Parties of very many entries (``joins.hot_parties``), where they are known.
    hot_parties: DataFrame | None = None

    @property
    def entries(self) -> DataFrame:
        if self.documents is None:
            return self.journal
        return entries_with_documents(self.journal, self.documents)


def table_lookups(spark: SparkSession, sf_dir: str) -> Lookups:
    return Lookups(
        journal=tables.journal(spark, sf_dir),
        documents=tables.document_facts(spark, sf_dir),
        identities=tables.identities(spark, sf_dir),
        tasks=tables.tasks(spark, sf_dir),
        hierarchy=tables.hierarchy(spark),
        rules=rules.form_rules(spark),
    )


def gated_events(events: DataFrame) -> DataFrame:
    """Wire events -> gated, decoded events without faults."""
    good, _ = split_faulty(decode(checked(events)))
    return good


def decide_events(events: DataFrame, lookups: Lookups) -> DataFrame:
    """One decided row per entry id among the events."""
    return decide_keys(joins.keys_of(events), lookups)


def decide_keys(keys: DataFrame, lookups: Lookups) -> DataFrame:
    return routing.decide(
        keys,
        lookups.entries,
        lookups.identities,
        lookups.tasks,
        lookups.hierarchy,
        lookups.rules,
        lookups.hot_parties,
    )


def route_events(events: DataFrame, lookups: Lookups) -> DataFrame:
    """Outcome of every gated event."""
    return routing.fan_out(events, decide_events(events, lookups))


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("outcome", "reason").agg(F.count("*").alias("n_events"))


REJECTION = ("rejection",)


@dataclass(frozen=True)
class BatchResult:
    """Written tables of one run."""

    decisions: DataFrame
    routed: DataFrame
    task_requests: DataFrame
    journal_updates: DataFrame | None
    finalizations: DataFrame | None
    retries: DataFrame


def write_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write and read back: later steps start from the files, not from the plan before."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Up to this many entry ids of a batch are broadcast to cut the lookup tables as they are
# scanned. A larger batch joins the whole tables by shuffle.
MAX_BROADCAST_IDS = 1_000_000


def run_batch(
    spark: SparkSession,
    events: DataFrame,
    lookups: Lookups,
    folder: str,
    part: str,
    earlier: DataFrame | None = None,
    answers: DataFrame | None = None,
    delay: Column | None = None,
    archive: DataFrame | None = None,
    await_replies: bool = False,
) -> BatchResult:
    """Route one set of gated events and write every output below ``folder``.

    ``part`` (such as ``batch_id=7``) names the sub-folder of this run in each table. A rerun
    replaces it, so a batch that is replayed after a failure adds nothing. The decisions are
    written first; all outputs are cheap projections of those files. ``earlier`` holds decisions
    of earlier runs that the lookups do not show yet. ``answers`` and ``archive`` hold replies of the
    task system and the archive where they are known; with ``await_replies`` updates and
    finalizations are left to the replies (``streaming.settle``).
    """

    def write(df: DataFrame, name: str) -> DataFrame:
        return write_table(spark, df, f"{folder}/{name}/{part}")

    events = joins.with_tie(events)
    ids = joins.keys_of(events).select("entry_id")
    lookups, small = cut_to(lookups, ids)
    if earlier is not None:
        if small:
            earlier = earlier.join(F.broadcast(ids), "entry_id", "left_semi")
        lookups = after_earlier(lookups, earlier)
    lookups = with_entries(lookups, write(lookups.entries, "entries"), small)

    decisions = decide_events(events, lookups)
    if answers is not None:
        decisions = repair.settled_decisions(decisions, answers)
    if archive is not None:
        decisions = repair.after_archive(decisions, archive)
    decisions = write(decisions, "decisions")
    sent = decisions
    if archive is not None:
        sent = repair.updates_sent(decisions).unionByName(decisions.where("NOT update_sent"))
    requests = outputs.task_requests(sent, keep=REJECTION if answers is not None else ())
    if answers is not None:
        requests = repair.emptied(requests).drop(*REJECTION)
    task_requests = write(requests, "task_requests")
    updates = finalizations = None
    if not await_replies:
        updates = write(outputs.journal_updates(sent), "journal_updates")
        if lookups.snapshot is not None:
            write(outputs.update_bodies(updates, lookups.snapshot), "update_bodies")
        final = updates
        if archive is not None:
            final = updates.join(decisions.where("update_accepted"), "entry_id", "left_semi")
        finalizations = write(outputs.finalizations(final), "finalizations")
    narrow = events.select("event_order", "event_tie", "as_of", "entry_id")
    routed = write(routing.fan_out(narrow, decisions, keys=decisions), "routed")
    retries = write(retries_of(events, decisions, delay), "retries")
    return BatchResult(decisions, routed, task_requests, updates, finalizations, retries)


def retries_of(events: DataFrame, decisions: DataFrame, delay: Column | None = None) -> DataFrame:
    """Retry rows of the entries decided as RETRY; all events of such an entry end so.

    Mostly these are few entries, which are broadcast. Of many, as in an outage, a bitmap drops most
    other events where they are scanned; then each task reduces its events to one row per entry, and
    only these rows meet the failed entries, so an entry of very many events costs a row per task.
    """
    failed = decisions.where(F.col("outcome") == routing.RETRY).select("entry_id")
    events = events.withColumn("outcome", F.lit(routing.RETRY))
    n = failed.count()
    if n <= MAX_BROADCAST_IDS:
        return retry.enqueue(events.join(F.broadcast(failed), "entry_id", "left_semi"), delay)
    bits = bitmap.bits_for(n)
    maps = bitmap.bitmap(failed, F.col("entry_id"), bits)
    maybe = bitmap.with_maybe(events, F.col("entry_id"), maps, bits).where("maybe").drop("maybe")
    rows = retry.enqueue(maybe, delay)
    return rows.join(failed.withColumnRenamed("entry_id", "key"), "key", "left_semi")


def cut_to(lookups: Lookups, ids: DataFrame) -> tuple[Lookups, bool]:
    """Lookups for a batch of events with these entry ids, and whether the ids are few enough to be
    broadcast for it (``MAX_BROADCAST_IDS``)."""
    n = ids.count()
    small = n <= MAX_BROADCAST_IDS
    return restricted(lookups, ids, None if small else n), small


def restricted(lookups: Lookups, ids: DataFrame, many: int | None = None) -> Lookups:
    """Lookups cut to the entry ids of a batch.

    Few ids, whose number the caller has checked, are broadcast, and the optimizer moves the semi
    join below the document aggregate, to the scan. Of ``many`` ids a bitmap of bounded size is
    broadcast: it drops the bulk of the tables where they are scanned, and the rest meets the ids in
    the shuffle by entry that the joins need anyway.
    """
    ids = ids.select("entry_id").distinct()
    if many is None:
        ids = F.broadcast(ids)
    else:
        bits = bitmap.bits_for(many)
        maps = bitmap.bitmap(ids, F.col("entry_id"), bits)

    def cut(df: DataFrame | None) -> DataFrame | None:
        if df is None:
            return None
        if many is not None:
            df = bitmap.with_maybe(df, F.col("entry_id"), maps, bits).where("maybe").drop("maybe")
        return df.join(ids, "entry_id", "left_semi")

    return replace(
        lookups,
        journal=cut(lookups.journal),
        documents=cut(lookups.documents),
        tasks=cut(lookups.tasks),
    )


def with_entries(lookups: Lookups, entries: DataFrame, small: bool) -> Lookups:
    """Lookups around the written entries of a batch: only the identities of their parties are
    looked up. There are at most as many parties as entries, so those of a small batch are
    broadcast."""
    parties = entries.select("party_id").where("party_id IS NOT NULL").distinct()
    parties = F.broadcast(parties) if small else parties
    identities = lookups.identities.join(parties, "party_id", "left_semi")
    hot = joins.hot_parties(entries)
    return replace(lookups, journal=entries, documents=None, identities=identities, hot_parties=hot)


def after_earlier(lookups: Lookups, earlier: DataFrame) -> Lookups:
    """Lookups as they stand after earlier requests (``entry_id``, ``outcome``, ``as_of``): a manual
    task is an open task, an automatically handled entry is no longer open for handling.

    Once the live table shows a task of the entry and kind opened since the request, that task stands
    for the request, so when it is closed the entry is free again. Without ``opened_at`` in the live
    table a request can't be told from an older task and holds its entry."""
    made = earlier.where(F.col("outcome").isin(routing.JOURNALING, routing.DISTRIBUTION))
    if "opened_at" in lookups.tasks.columns:
        live = lookups.tasks.select(
            F.col("entry_id").alias("_entry"), F.col("task_type").alias("_type"), "opened_at"
        )
        shown = (
            (F.col("entry_id") == F.col("_entry"))
            & (F.col("outcome") == F.col("_type"))
            & (F.col("opened_at") >= F.col("as_of"))
        )
        made = made.join(live, shown, "left_anti")
    made = made.select(
        F.concat(F.lit("made-"), "entry_id").alias("task_id"),
        "entry_id",
        F.lit(rules.TASK_OPEN).alias("category"),
        F.col("outcome").alias("task_type"),
    )
    finalized = (
        earlier.where(F.col("outcome") == routing.AUTO)
        .select("entry_id")
        .distinct()
        .withColumn("finalized", F.lit(True))
    )
    status = F.when(F.col("finalized"), F.lit(rules.FINAL_STATUS)).otherwise(F.col("status"))
    journal = (
        lookups.journal.join(finalized, "entry_id", "left")
        .withColumn("status", status)
        .drop("finalized")
    )
    tasks = lookups.tasks.select("task_id", "entry_id", "category", "task_type").union(made)
    return replace(lookups, journal=journal, tasks=tasks)
