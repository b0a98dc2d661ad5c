"""What a decision produces. All outputs are projections of the decided rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern import rules
from postern.functions import parties as P
from postern.functions.dates import deadline
from postern.functions.text import unless_blank
from postern.operators.routing import AUTO, DISTRIBUTION, JOURNALING, TASK_OUTCOMES


def auto_unit(overrides: list[str] | None = None) -> Column:
    """Unit of an automatic task: the entry's unit unless blank, none for listed entries."""
    overrides = rules.UNIT_OVERRIDES if overrides is None else overrides
    return F.when(~F.col("entry_id").isin(*overrides), unless_blank(F.col("unit")))


def manual_actor() -> Column:
    return F.when(P.is_person(F.col("party_type")), F.col("actor_id"))


def manual_org() -> Column:
    return F.when(P.is_organisation(F.col("party_type")), F.col("party_id"))


def distribution_theme() -> Column:
    return F.when(F.col("theme") == rules.THEME_UNKNOWN, rules.THEME_GENERAL).otherwise(
        F.col("theme")
    )


def task_requests(
    decisions: DataFrame, overrides: list[str] | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The task feed: one request per entry decided as automatic, journaling or distribution
    task, in the task system's field names. One projection serves the three kinds; ``keep``
    names decision columns to carry along."""
    outcome = F.col("outcome")
    is_auto = outcome == AUTO
    is_distribution = outcome == DISTRIBUTION
    days = F.when(is_auto, F.col("deadline_days")).otherwise(F.lit(rules.MANUAL_DEADLINE_DAYS))
    return decisions.where(outcome.isin(*TASK_OUTCOMES)).select(
        F.when(is_auto, F.col("actor_id")).otherwise(manual_actor()).alias("aktoerId"),
        F.when(~is_auto, manual_org()).alias("orgnr"),
        F.col("entry_id").alias("journalpostId"),
        F.when(is_distribution, distribution_theme()).otherwise(F.col("theme")).alias("tema"),
        F.when(~is_distribution, F.col("handling_theme")).alias("behandlingstema"),
        F.when(~is_distribution, F.col("handling_type")).alias("behandlingstype"),
        F.when(is_auto, F.col("task_type"))
        .when(is_distribution, rules.TASK_DISTRIBUTION)
        .otherwise(rules.TASK_JOURNALING)
        .alias("oppgavetype"),
        F.when(is_auto, auto_unit(overrides))
        .when(~is_distribution, F.col("unit"))
        .alias("tildeltEnhetsnr"),
        F.when(outcome == JOURNALING, F.col("title")).alias("beskrivelse"),
        F.lit(rules.PRIORITY).alias("prioritet"),
        F.to_date("as_of").alias("aktivDato"),
        deadline(F.col("as_of"), days).alias("fristFerdigstillelse"),
        *keep,
    )


def auto_tasks(decisions: DataFrame, overrides: list[str] | None = None) -> DataFrame:
    return task_requests(decisions.where(F.col("outcome") == AUTO), overrides)


def manual_tasks(decisions: DataFrame) -> DataFrame:
    return task_requests(decisions.where(F.col("outcome") == JOURNALING))


def distribution_tasks(decisions: DataFrame) -> DataFrame:
    return task_requests(decisions.where(F.col("outcome") == DISTRIBUTION))


def journal_updates(decisions: DataFrame) -> DataFrame:
    """The entry as it is written back after an automatic task: mapped codes, the case, and the
    party's national number as sender where the sender has no id. Types are written as
    ``idType``."""
    default_sender = F.col("sender_id").isNull()
    return decisions.where(F.col("outcome") == AUTO).select(
        "entry_id",
        "status",
        "theme",
        "unit",
        "title",
        "party_id",
        F.col("party_type").alias("party_id_type"),
        F.coalesce("sender_id", "national_id").alias("sender_id"),
        F.when(default_sender, rules.PARTY_PERSON).otherwise(F.col("sender_type")).alias("sender_id_type"),
        F.lit(rules.CASE_TYPE).alias("case_type"),
        "handling_theme",
        "handling_type",
    )


def update_bodies(updates: DataFrame, snapshot: DataFrame | None = None) -> DataFrame:
    """Update rows as the nested JSON the archive takes; NULL fields are written. The lists of
    an entry, its documents and dates, are sent back as they are in the nested ``snapshot``."""

    def party(id_column: str, type_column: str) -> Column:
        return F.struct(F.col(id_column).alias("id"), F.col(type_column).alias("idType"))

    lists = []
    if snapshot is not None:
        lists = ["dokumenter", "relevanteDatoer"]
        nested = snapshot.select(F.col("journalpostId").alias("entry_id"), *lists)
        updates = updates.join(nested, "entry_id", "left")
    body = F.struct(
        party("party_id", "party_id_type").alias("bruker"),
        F.col("title").alias("tittel"),
        F.col("entry_id").alias("journalpostId"),
        F.col("status").alias("journalstatus"),
        F.col("unit").alias("journalforendeEnhet"),
        F.struct(F.col("case_type").alias("sakstype")).alias("sak"),
        F.col("theme").alias("tema"),
        party("sender_id", "sender_id_type").alias("avsenderMottaker"),
        F.col("handling_theme").alias("behandlingstema"),
        F.col("handling_type").alias("behandlingstype"),
        *lists,
    )
    return updates.select("entry_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


def finalizations(updates: DataFrame) -> DataFrame:
    """Finalize requests; they follow the updates of the same entries."""
    return updates.select("entry_id", F.lit(rules.FINALIZE_UNIT).alias("journalfoerendeEnhet"))


def current_journal(journal: DataFrame, updates: DataFrame) -> DataFrame:
    """The journal with the updates applied: an updated entry is replaced as a whole. Of several
    updates of an entry the one last by ``update_order`` counts, if there is such a column."""
    fields = ["unit", "title", "sender_id", "sender_id_type", "case_type", "handling_theme", "handling_type"]
    order = ["update_order"] if "update_order" in updates.columns else []
    updated = updates.groupBy("entry_id").agg(F.max(F.struct(*order, *fields)).alias("_new"))
    new = F.col("_new").isNotNull()

    def pick(updated_field: str, column: Column) -> Column:
        return F.when(new, F.col(f"_new.{updated_field}")).otherwise(column)

    none = F.lit(None).cast("string")
    return journal.join(updated, "entry_id", "left").select(
        "entry_id",
        "status",
        "theme",
        "party_id",
        "party_type",
        pick("unit", F.col("unit")).alias("unit"),
        pick("title", F.col("title")).alias("title"),
        pick("sender_id", F.col("sender_id")).alias("sender_id"),
        pick("sender_id_type", F.col("sender_type")).alias("sender_type"),
        pick("case_type", none).alias("case_type"),
        pick("handling_theme", F.col("preset_theme")).alias("handling_theme"),
        pick("handling_type", none).alias("handling_type"),
    )
