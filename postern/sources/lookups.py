"""Lookup tables in the shape the joins want: one row per key, only needed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postern.functions import documents as D
from postern.functions import parties as P
from postern.functions.text import is_empty
from postern.rules import BLOCKING_TASK_TYPES, TASK_CLOSED, TASK_OPEN, TERM_LANGUAGE
from postern.schemas import CODE_TREE

ENTRY_COLUMNS = [
    "entry_id",
    "status",
    "theme",
    "unit",
    "title",
    "preset_theme",
    "sender_id",
    "sender_type",
    "party_id",
    "party_type",
    "n_documents",
    "form_code",
    "titles_ok",
    "entry_ok",
]


def coded(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (``entry_id``, ``doc_order`` bigint, ``form_code``, ``title``) with a number in place of
    their code and a flag in place of their title, and the dictionary of the codes."""
    code_id = F.xxhash64("form_code").alias("code_id")
    rows = documents.select("entry_id", "doc_order", code_id, (~is_empty(F.col("title"))).alias("titled"))
    return rows, documents.select(code_id, "form_code").distinct()


def document_facts(documents: DataFrame, codes: DataFrame) -> DataFrame:
    """Per entry: number of documents, form code of the first one, whether all have titles, from rows
    (``entry_id``, ``doc_order``, ``code_id``, ``titled``) and a dictionary (``code_id``, ``form_code``).

    Order and code of a document are packed into one exact number (an order below 10 ** 17 in front of
    64 bits), so the first one is a minimum in a hash aggregate of fixed width: nothing is sorted, no
    list is built, and an entry holding a large share of all documents costs one small row per input
    task. The dictionary is joined once per entry, not per document.
    """
    unsigned = "CAST(code_id AS DECIMAL(20, 0)) + 9223372036854775808BD"
    order = "CAST(CAST(doc_order AS DECIMAL(17, 0)) * 100000000000000000000BD AS DECIMAL(37, 0))"
    first = F.expr(f"CAST({order} + {unsigned} AS DECIMAL(38, 0))")
    facts = documents.select("entry_id", "titled", first.alias("first")).groupBy("entry_id").agg(
        F.count("*").alias("n_documents"),
        F.min("first").alias("first"),
        F.every("titled").alias("titles_ok"),
    )
    code_id = F.expr("CAST(pmod(first, 100000000000000000000BD) - 9223372036854775808BD AS BIGINT)")
    return (
        facts.withColumn("code_id", code_id)
        .join(codes, "code_id", "left")
        .select("entry_id", "n_documents", "form_code", "titles_ok")
    )


def entries_with_documents(journal: DataFrame, facts: DataFrame) -> DataFrame:
    """Entry table from a journal table and document facts. Both sides are partitioned by entry
    id once; an entry without documents has no form code and passes the title test."""
    return (
        journal.join(facts, "entry_id", "left")
        .fillna({"n_documents": 0, "titles_ok": True})
        .withColumn("entry_ok", _required_present())
        .select(*ENTRY_COLUMNS)
    )


def entries_from_snapshot(snapshot: DataFrame) -> DataFrame:
    """Entry table from nested rows (``schemas.JOURNAL_ENTRY``); no shuffle."""
    documents = F.col("dokumenter")
    flat = snapshot.select(
        F.col("journalpostId").alias("entry_id"),
        F.col("journalstatus").alias("status"),
        F.col("tema").alias("theme"),
        F.col("journalforendeEnhet").alias("unit"),
        F.col("tittel").alias("title"),
        F.col("behandlingstema").alias("preset_theme"),
        F.col("avsenderMottaker.id").alias("sender_id"),
        F.col("avsenderMottaker.type").alias("sender_type"),
        F.col("bruker.id").alias("party_id"),
        F.col("bruker.type").alias("party_type"),
        F.size(F.coalesce(documents, F.array())).cast("bigint").alias("n_documents"),
        D.first_code(documents).alias("form_code"),
        D.titles_present(documents).alias("titles_ok"),
        (
            documents.isNotNull()
            & F.forall(documents, lambda d: d["dokumentInfoId"].isNotNull())
            & (F.col("avsenderMottaker").isNull() | F.col("avsenderMottaker.type").isNotNull())
            & (
                F.col("bruker").isNull()
                | (F.col("bruker.id").isNotNull() & F.col("bruker.type").isNotNull())
            )
            & (
                F.col("relevanteDatoer").isNull()
                | F.forall("relevanteDatoer", lambda d: d["dato"].isNotNull() & d["datotype"].isNotNull())
            )
        ).alias("nested_ok"),
    )
    complete = F.coalesce(F.col("nested_ok"), F.lit(False)) & _required_present()
    return flat.withColumn("entry_ok", complete).select(*ENTRY_COLUMNS)


def _required_present():
    return (
        F.col("status").isNotNull()
        & F.col("theme").isNotNull()
        & (F.col("party_id").isNull() == F.col("party_type").isNull())
    )


def identity_facts(identities: DataFrame) -> DataFrame:
    """Per party: the list is there, is complete, and its first actor id and national number
    among the current identities. The list sits in one source row, so nothing is grouped."""
    return (
        identities.where(F.col("identities").isNotNull())
        .withColumn("current", current_identities())
        .select(
            "party_id",
            F.lit(True).alias("person_found"),
            F.forall(
                "current", lambda i: i["grp"].isNotNull() & i["ident"].isNotNull()
            ).alias("identities_ok"),
            P.actor_id(F.col("current")).alias("actor_id"),
            P.national_id(F.col("current")).alias("national_id"),
        )
    )


def current_identities():
    return F.filter("identities", lambda i: F.coalesce(i["current"], F.lit(True)))


def open_tasks(tasks: DataFrame) -> DataFrame:
    """Open journaling and distribution tasks."""
    return tasks.where(
        (F.col("category") == TASK_OPEN) & F.col("task_type").isin(*BLOCKING_TASK_TYPES)
    )


def tasks_at(versions: DataFrame, as_of: Column) -> DataFrame:
    """The tasks as a search at a time finds them, from their times (``task_id``, ``entry_id``,
    ``task_type``, ``opened_at``, ``closed_at``): plain comparisons, so they reach the scan."""
    closed = F.coalesce(F.col("closed_at") <= as_of, F.lit(False))
    return versions.where(F.col("opened_at") <= as_of).select(
        "task_id",
        "entry_id",
        F.when(closed, TASK_CLOSED).otherwise(TASK_OPEN).alias("category"),
        "task_type",
        "opened_at",
    )


def events_with_task_at(events: DataFrame, versions: DataFrame) -> DataFrame:
    """The events whose entry had an open task at the event's own time. A semi join by entry, with
    the times tested per pair; an event is never repeated."""
    tasks = versions.where(F.col("task_type").isin(*BLOCKING_TASK_TYPES)).select(
        F.col("entry_id").alias("_entry"), "opened_at", "closed_at"
    )
    was_open = (F.col("opened_at") <= F.col("as_of")) & (
        F.col("closed_at").isNull() | (F.col("closed_at") > F.col("as_of"))
    )
    return events.join(tasks, (F.col("entry_id") == F.col("_entry")) & was_open, "left_semi")


def entries_with_open_task(tasks: DataFrame) -> DataFrame:
    """Distinct entry ids, reduced on the map side before any join."""
    return open_tasks(tasks).where(F.col("task_id").isNotNull()).select("entry_id").distinct()


def flatten_code_tree(tree: DataFrame, value: str = "value") -> DataFrame:
    """JSON code tree -> (theme, form_code, term): one language, picked before the maps are
    exploded. A code without that language has a NULL term."""
    parsed = tree.select(F.from_json(value, CODE_TREE)["noder"].alias("nodes"))
    themes = parsed.select(F.explode("nodes").alias("theme", "node"))
    codes = themes.select("theme", F.explode("node.undernoder").alias("form_code", "leaf"))
    return codes.select(
        "theme", "form_code", F.try_element_at("leaf.termer", F.lit(TERM_LANGUAGE)).alias("term")
    )


# Rows of a lookup table that may be sent to every executor.
MAX_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if it has at most ``max_rows`` rows. They are counted by all
    tasks; a limit would send each task's rows to one. A larger table is returned as it is and
    joined by shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    """(theme, form_code, term) from files that hold the JSON code tree, one tree per file."""
    return broadcast_if_small(flatten_code_tree(spark.read.text(path, wholetext=True)))
