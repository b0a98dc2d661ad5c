"""Events with their entry's codes, batch by batch; the lookup tables are read anew each time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postern.operators import joins
from postern.plans.intake import Lookups, cut_to, write_table


def enriched(events: DataFrame, lookups: Lookups) -> DataFrame:
    """Gated events with theme, form code, handling theme and handling type of their entry."""
    found = joins.events_with_entry(events, lookups.entries)
    return joins.with_codes(found, lookups.hierarchy).select(
        "event_order", "entry_id", "theme", "form_code", "handling_theme", "handling_type"
    )


def start(
    events: DataFrame, read_lookups: Callable[[SparkSession], Lookups], folder: str, **trigger
) -> StreamingQuery:
    """Write enriched events to ``folder``/enriched, one sub-folder per batch, which a replay
    overwrites. A stream-static join would scan and shuffle the whole static side per batch;
    here it is cut to the batch's entries as it is scanned."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"batch_id={batch_id}"
        received = write_table(spark, batch, f"{folder}/events/{part}")
        ids = joins.keys_of(received).select("entry_id")
        lookups, _ = cut_to(read_lookups(spark), ids)
        write_table(spark, enriched(received, lookups), f"{folder}/enriched/{part}")

    return (
        events.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
