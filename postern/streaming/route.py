"""The intake job on a stream: every micro-batch runs the batch job on its events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postern import rules
from postern.functions.dates import from_epoch_ms
from postern.operators import joins, routing
from postern.operators.decode import checked, decode, split_faulty
from postern.operators.retry import read_events
from postern.plans import intake
from postern.plans.intake import Lookups, run_batch, write_table
from postern.session import session_settings
from postern.streaming.due import MESSAGE, DueStore, wall_clock
from postern.streaming.publish import manifest, publish
from postern.streaming.settle import GIVE_UP, step_log
from postern.streaming.state import RunLog, buckets_of, table_if_there

RETRY_DDL = MESSAGE
MESSAGE_COLUMNS = [c.split()[0] for c in MESSAGE.split(", ")]
# The tables of a batch that are published together.
TABLES = ["events", "quarantine", "entries", "decisions", "task_requests", "journal_updates", "update_bodies",
          "finalizations", "routed", "retries"]
# A table that is broadcast passes through the driver in every batch, with several times the size its
# files have; so within a batch only tables below this size are, besides those that are marked.
BATCH_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
}
# What a row of the stream is.
EVENT, RETRY_MESSAGE, TICK = "event", "retry", "tick"


def made_log(folder: str) -> RunLog:
    """What the batches decided to request, by entry."""
    outcomes = rules.sql_list(routing.TASK_OUTCOMES)
    columns = "entry_id string, outcome string, as_of timestamp_ntz, batch_id bigint"
    return RunLog(folder, "decisions", "batch_id", columns, f"outcome IN ({outcomes})")


def replies_seen(spark: SparkSession, folder: str, batch_id: int) -> int:
    """How many reply batches were done when this batch was first handled. Written down, so that a
    replay takes the same number; counted on from what the batch before saw."""

    def told(batch: int) -> int | None:
        table = table_if_there(spark, f"{folder}/seen/batch_id={batch}", "reply_batches bigint")
        row = None if table is None else table.first()
        return row and row.reply_batches

    known = told(batch_id)
    if known is not None:
        return known
    seen = told(batch_id - 1) or 0
    while table_if_there(spark, f"{folder}/replies_done/reply_batch={seen}", "n_steps bigint") is not None:
        seen += 1
    one = spark.range(1).select(F.lit(seen).cast("bigint").alias("reply_batches"))
    one.coalesce(1).write.mode("overwrite").parquet(f"{folder}/seen/batch_id={batch_id}")
    return seen


def earlier_decisions(
    spark: SparkSession, folder: str, batch_id: int, ids: DataFrame | None = None
) -> DataFrame | None:
    """Requests of the batches before this one (entry_id, outcome, as_of). Its own, left by a failed
    attempt, and any later ones do not count: a replay sees what the first attempt saw. They lie in
    few runs (``streaming.state``), of which a small batch, with the entries ``ids``, reads its
    buckets only. Requests that were refused (``streaming.settle``) left nothing behind and do not
    count either."""
    buckets = None if ids is None else buckets_of(ids)
    earlier = made_log(folder).read(spark, batch_id, buckets)
    if earlier is None:
        return None
    steps = step_log(folder).read(spark, replies_seen(spark, folder, batch_id), buckets)
    if steps is not None:
        refused = steps.where(F.col("action") == GIVE_UP)
        earlier = earlier.join(refused, ["entry_id", "batch_id"], "left_anti")
    return earlier.select("entry_id", "outcome", "as_of")


def handle_batch(
    folder: str,
    read_lookups: Callable[[SparkSession], Lookups],
    await_replies: bool = True,
    clock: Callable[[], int] = wall_clock,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function. The lookups are read anew for every batch; where they do not show
    yet what earlier batches requested, the earlier decisions are consulted.

    Rows with a ``kind`` are told apart by it: events, and retry messages, which wait in a store
    (``streaming.due``) until they are due. ``clock`` gives the time in ms of a batch that is handled
    for the first time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"batch_id={batch_id}"
        if manifest(spark, folder, batch_id) is not None:
            return  # a replay of what consumers may be reading already
        with session_settings(spark, BATCH_SETTINGS):
            if "kind" in batch.columns:
                messages = batch.where(F.col("kind") == RETRY_MESSAGE)
                due, now_ms = DueStore(f"{folder}/due").turn(spark, messages, batch_id, clock)
                again = read_events(due, from_epoch_ms(F.lit(now_ms))).withColumn("is_retry", F.lit(True))
                came = batch.where(F.col("kind") == EVENT).drop("kind", *MESSAGE_COLUMNS)
                batch = came.unionByName(again, allowMissingColumns=True)
            # The row's number makes the order of events unique; the written table fixes it.
            numbered = batch.withColumn("event_tie", F.monotonically_increasing_id())
            received = write_table(spark, numbered, f"{folder}/events/{part}")
            events, faulty = split_faulty(received)
            write_table(spark, faulty, f"{folder}/quarantine/{part}")
            ids = joins.keys_of(events).select("entry_id")
            small = ids.count() <= intake.MAX_BROADCAST_IDS
            earlier = earlier_decisions(spark, folder, batch_id, ids if small else None)
            delay = F.when(F.col("is_retry"), F.expr(rules.NEXT_RETRY_DELAY)).otherwise(
                F.expr(rules.FIRST_RETRY_DELAY)
            )
            run_batch(
                spark,
                events,
                read_lookups(spark),
                folder,
                part,
                earlier=earlier,
                delay=delay,
                await_replies=await_replies,
            )
            made_log(folder).merge(spark, batch_id)
            publish(spark, folder, batch_id, TABLES)

    return handle


def prepare(spark: SparkSession, folder: str) -> None:
    """The retry tables must be there before they are read as streams."""
    none = spark.createDataFrame([], RETRY_DDL)
    none.write.mode("ignore").parquet(f"{folder}/retries/batch_id=-1")
    none.write.mode("ignore").parquet(f"{folder}/reply_retries/reply_batch=-1")


def start(
    spark: SparkSession,
    wire_events: DataFrame,
    read_lookups: Callable[[SparkSession], Lookups],
    folder: str,
    with_retries: bool = False,
    await_replies: bool = True,
    clock: Callable[[], int] = wall_clock,
    **trigger,
) -> StreamingQuery:
    """Start the intake stream; outputs and the checkpoint go below ``folder``. Consumers read the
    outputs with ``publish.published``.

    ``with_retries`` reads the job's own retry table back as a second source, held until due
    and not gated. Both sources share one query, so two batches never race for one entry. Retries
    are handled at the time of their batch, which is written down for a replay; those that can't be
    read go to the quarantine table like events, those past their retention to ``due/expired``. A
    query that goes on by itself gets a tick a second, so that what is due need not wait for other
    events: choose its trigger interval as the delay that retries may have. The job only requests
    tasks; ``streaming.settle`` follows up the replies, and what it gives up comes back as a retry
    too. Without ``await_replies`` every request is taken as accepted at once.
    """
    trigger = trigger or {"availableNow": True}
    events = decode(checked(wire_events)).withColumn("is_retry", F.lit(False))
    if with_retries:
        prepare(spark, folder)
        waiting = spark.readStream.schema(RETRY_DDL).parquet(f"{folder}/retries")
        if await_replies:
            refused = spark.readStream.schema(RETRY_DDL).parquet(f"{folder}/reply_retries")
            waiting = waiting.union(refused)
        messages = waiting.select(*MESSAGE_COLUMNS).withColumn("kind", F.lit(RETRY_MESSAGE))
        events = events.withColumn("kind", F.lit(EVENT)).unionByName(messages, allowMissingColumns=True)
        if "processingTime" in trigger:
            ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            kinds = ticks.select(F.lit(TICK).alias("kind"))
            events = events.unionByName(kinds, allowMissingColumns=True)
    return (
        events.writeStream.foreachBatch(handle_batch(folder, read_lookups, await_replies, clock))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger)
        .start()
    )
