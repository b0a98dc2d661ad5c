"""The decision table and what follows from it inside one set of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern import rules
from postern.operators import joins
from postern.operators.skew import EVENTS_PER_TASK, hot_entries, salted_left_join, salts_for

AUTO = "AUTO"
JOURNALING = "JFR"
DISTRIBUTION = "FDR"
RETRY = "RETRY"
SKIP_STATUS = "SKIP_STATUS"
SKIP_IGNORED = "SKIP_IGNORED"
SKIP_HAS_TASK = "SKIP_HAS_TASK"
TASK_OUTCOMES = [AUTO, JOURNALING, DISTRIBUTION]


def status_open() -> Column:
    return F.expr(FACTS["_open"])


def to_distribution() -> Column:
    return F.expr(FACTS["_distribution"])


# Facts the decision table tests, besides the flags of the joins. None of them is ever NULL.
FACTS = {
    "_open": f"coalesce(status IN ({rules.sql_list(rules.OPEN_STATUSES)}), false)",
    "_auto": "listed AND titles_ok",
    "_lookup": joins.LOOKUP_PARTY,
    "_needs_actor": (
        f"coalesce(party_type IN ('{rules.PARTY_ACTOR}', '{rules.PARTY_PERSON}'), false)"
    ),
    "_distribution": f"coalesce(theme <> '{rules.GATE_THEME}', false)",
}

# (condition, outcome, reason) in order; the first condition that holds decides. Everything is
# validated before a task is decided on, so a RETRY never leaves a task behind.
DECISION_TABLE = [
    ("NOT entry_found", RETRY, "journal_missing"),
    ("NOT entry_ok", RETRY, "journal_incomplete"),
    ("NOT _open", SKIP_STATUS, None),
    ("ignored", SKIP_IGNORED, None),
    # automatic handling, as far as it gets
    ("_auto AND has_task", SKIP_HAS_TASK, None),
    ("_auto AND malformed", RETRY, "term_malformed"),
    ("_auto AND _lookup AND NOT person_found", RETRY, "person_missing"),
    ("_auto AND _lookup AND NOT identities_ok", RETRY, "identities_incomplete"),
    ("_auto AND _lookup AND actor_id IS NULL", RETRY, "actor_missing"),
    ("_auto AND _lookup AND sender_id IS NULL AND national_id IS NULL", RETRY, "sender_missing"),
    ("_auto AND _lookup", AUTO, None),
    # manual handling
    ("has_task", SKIP_HAS_TASK, None),
    ("_lookup AND NOT person_found", RETRY, "person_missing"),
    ("_lookup AND NOT identities_ok", RETRY, "identities_incomplete"),
    ("_distribution AND _needs_actor AND actor_id IS NULL", RETRY, "actor_missing"),
    ("_distribution", DISTRIBUTION, None),
    ("malformed", RETRY, "term_malformed"),
    ("_needs_actor AND actor_id IS NULL", RETRY, "actor_missing"),
    ("true", JOURNALING, None),
]


def decided(facts: DataFrame) -> DataFrame:
    """Add ``outcome`` and ``reason``: the decision table as one ordered CASE over row numbers,
    and the row it picked."""
    lines = " ".join(f"WHEN {test} THEN {n}" for n, (test, *_) in enumerate(DECISION_TABLE))
    outcomes = rules.sql_list([outcome for _, outcome, _ in DECISION_TABLE])
    reasons = rules.sql_list([reason for *_, reason in DECISION_TABLE])
    return (
        facts.withColumns({name: F.expr(fact) for name, fact in FACTS.items()})
        .withColumn("_line", F.expr(f"CASE {lines} END"))
        .withColumns(
            {
                "outcome": F.expr(f"array({outcomes})[_line]"),
                "reason": F.expr(f"array({reasons})[_line]"),
            }
        )
        .drop("_line", *FACTS)
    )


# Only entries that no earlier line of the decision table settles are looked up.
NEEDS_IDENTITIES = f"entry_found AND entry_ok AND {FACTS['_open']} AND NOT ignored AND NOT has_task"


def decide(
    keys: DataFrame,
    entries: DataFrame,
    identities: DataFrame,
    tasks: DataFrame,
    hierarchy: DataFrame,
    form_rules: DataFrame,
    hot_parties: DataFrame | None = None,
) -> DataFrame:
    """One decided row per key. ``keys`` needs ``entry_id``; its other columns are kept.

    Keys, entries, document facts and open tasks are each shuffled once by entry id and joined
    in one stage; rules and codes are broadcast; only the party lookup shuffles again.
    """
    facts = joins.with_entry(keys, entries)
    facts = joins.with_open_task(facts, tasks)
    facts = joins.with_form_rules(facts, form_rules)
    facts = joins.with_codes(facts, hierarchy)
    facts = joins.with_identities(facts, identities, NEEDS_IDENTITIES, hot_parties)
    return decided(facts)


def inherited(outcome: Column) -> Column:
    """What a later event on the same entry gets once the first one is handled: it finds the
    manual task, or the finalized entry; anything else repeats."""
    return (
        F.when(outcome.isin(JOURNALING, DISTRIBUTION), SKIP_HAS_TASK)
        .when(outcome == AUTO, SKIP_STATUS)
        .otherwise(outcome)
    )


def fan_out(
    events: DataFrame,
    decisions: DataFrame,
    keys: DataFrame | None = None,
    per_task: int = EVENTS_PER_TASK,
) -> DataFrame:
    """Outcome of every event: the first event of an entry gets the entry's decision, the later
    ones what they inherit.

    "First" is known from the per-entry minimum, so no window sorts the events of an entry or
    gathers them in one task. ``keys`` (entry id, first event, number of events) serves to find
    hot entries: pass ``decisions`` if they are a written table; otherwise the events are
    reduced to keys as for the decisions, which reuses that shuffle.
    """
    hot = hot_entries(joins.keys_of(events) if keys is None else keys, per_task)
    lookup = decisions.select(
        "entry_id",
        "first_rank",
        "outcome",
        "reason",
        salts_for(F.col("n_events"), per_task).alias("salts"),
    )
    joined = salted_left_join(joins.with_tie(events), lookup, hot)
    first = joins.event_rank() == F.col("first_rank")
    return (
        joined.withColumn("first_in_set", first)
        .withColumn("outcome", F.when(first, F.col("outcome")).otherwise(inherited(F.col("outcome"))))
        .drop("first_rank", "event_tie")
    )
