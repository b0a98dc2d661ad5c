"""Lookup joins around the entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern.functions.text import term_malformed, term_part
from postern.operators.skew import (
    EVENTS_PER_TASK,
    ROWS_PER_TASK,
    hot_entries,
    hot_keys,
    salted_left_join,
    sparse_left_join,
)
from postern.rules import PARTY_ORGANISATION
from postern.sources.lookups import entries_with_open_task, identity_facts


def with_tie(events: DataFrame) -> DataFrame:
    """Add ``event_tie``: what tells events of one ``event_order`` apart. The streams number the rows
    of a batch as they are written; elsewhere it is a hash of the whole event."""
    if "event_tie" in events.columns:
        return events
    return events.withColumn("event_tie", F.xxhash64(*sorted(events.columns)))


def event_rank() -> Column:
    """Order and tie of an event as one exact number, which is compared without sorting rows. Orders
    come from several sources (offsets, due times), so two events of an entry may share one."""
    return F.expr(
        "CAST(event_order AS DECIMAL(38, 0)) * 1000000000000000000BD"
        " + CAST(pmod(event_tie, 1000000000000000000L) AS DECIMAL(18, 0))"
    ).cast("decimal(38,0)")


def keys_of(events: DataFrame) -> DataFrame:
    """One row per entry id of a set of events: the event that comes first, its time, and how
    many events there are. Combined on the map side."""
    ranked = with_tie(events).withColumn("_rank", event_rank())
    return ranked.groupBy("entry_id").agg(
        F.min("event_order").alias("first_event"),
        F.min("_rank").alias("first_rank"),
        F.min_by("as_of", "_rank").alias("as_of"),
        F.count("*").alias("n_events"),
    )


def _found(entries: DataFrame) -> DataFrame:
    return entries.withColumn("entry_found", F.lit(True))


def _flags(entries: DataFrame, **defaults: bool) -> DataFrame:
    """NULL flags of a left join become their default."""
    return entries.fillna(defaults)


def with_entry(keys: DataFrame, entries: DataFrame) -> DataFrame:
    """Left join with the journal entry; ``entry_found`` tells whether there was one."""
    joined = keys.join(_found(entries), "entry_id", "left")
    return _flags(joined, entry_found=False, entry_ok=True)


def events_with_entry(
    events: DataFrame, entries: DataFrame, per_task: int = EVENTS_PER_TASK
) -> DataFrame:
    """Every event with its entry; one entry may have any number of events."""
    hot = hot_entries(keys_of(events), per_task)
    salts = F.broadcast(hot.select("entry_id", "salts"))
    found = _found(entries).join(salts, "entry_id", "left")
    return _flags(salted_left_join(events, found, hot), entry_found=False)


def with_open_task(entries: DataFrame, tasks: DataFrame) -> DataFrame:
    flagged = entries_with_open_task(tasks).withColumn("has_task", F.lit(True))
    return _flags(entries.join(flagged, "entry_id", "left"), has_task=False)


def with_form_rules(entries: DataFrame, rules: DataFrame) -> DataFrame:
    """``listed``: automatic handling; ``ignored``: ends without a task. A NULL form code
    matches no rule. The rules are a literal table of a few rows, so they are broadcast."""
    joined = entries.join(F.broadcast(rules), ["theme", "form_code"], "left")
    return _flags(joined.withColumn("listed", F.expr("task_type IS NOT NULL")), ignored=False)


def with_codes(entries: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Handling theme and type by (theme, form code).

    A preset theme that is not empty stays; the type always comes from the hierarchy. Whether
    that is broadcast is decided where it is read (``lookups.broadcast_if_small``).
    """
    term = F.col("term")
    preset = F.nullif("preset_theme", F.lit(""))
    return (
        entries.join(hierarchy, ["theme", "form_code"], "left")
        .withColumns(
            {
                "handling_theme": F.coalesce(preset, term_part(term, 0)),
                "handling_type": term_part(term, 1),
                "malformed": term_malformed(term),
            }
        )
        .drop("term")
    )


# Identities are looked up for every party that is not an organisation.
LOOKUP_PARTY = f"coalesce(party_type <> '{PARTY_ORGANISATION}', false)"


def hot_parties(entries: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, salts) of the parties that very many entries look up."""
    return hot_keys(entries.where(LOOKUP_PARTY), F.col("party_id"), per_task)


def with_identities(
    entries: DataFrame, identities: DataFrame, wanted: str = "true", hot: DataFrame | None = None
) -> DataFrame:
    """Left join on the party, for entries that need it only. The others have no key and are
    spread over all partitions. Parties with very many entries are dealt out over several tasks if
    the caller knows them (``hot_parties`` of a written table); without, adaptive skew handling
    applies, as both sides come out of a shuffle."""
    joined = sparse_left_join(
        entries,
        identity_facts(identities),
        wanted=F.expr(f"{wanted} AND {LOOKUP_PARTY}"),
        key=F.col("party_id"),
        otherwise=F.col("entry_id"),
        lookup_key="party_id",
        hot=hot,
    )
    return _flags(joined, person_found=False, identities_ok=True)
