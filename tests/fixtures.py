"""Small inputs made by hand: nested journal rows, identity lists, tasks and events."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postern import rules
from postern.operators.joins import keys_of
from postern.plans.intake import Lookups
from postern.schemas import JOURNAL_ENTRY
from postern.sources import lookups, tables

WEDNESDAY_MORNING = dt.datetime(2024, 1, 10, 9, 30)
AUTO_CODE = "NAV 08-07.04 D"
MANUAL_CODE = "NAV 08-35.01"
IDENTITIES = "party_id string, identities array<struct<grp: string, ident: string, current: boolean>>"
TASKS = "task_id string, entry_id string, category string, task_type string"
EVENTS = "event_order bigint, as_of timestamp_ntz, entry_id string"


def entry(
    entry_id: str,
    status: str | None = "MOTTATT",
    theme: str | None = "SYK",
    code: str | None = AUTO_CODE,
    titles: tuple = ("Title",),
    party: tuple | None = ("100", "FNR"),
    unit: str | None = None,
    preset: str | None = None,
    sender: tuple | None = None,
    title: str | None = "Title",
    **changes,
) -> dict:
    row = {
        "bruker": party and {"id": party[0], "type": party[1]},
        "tittel": title,
        "journalpostId": entry_id,
        "journalstatus": status,
        "dokumenter": [
            {"brevkode": code if n == 0 else "OTHER", "tittel": text, "dokumentInfoId": str(n)}
            for n, text in enumerate(titles)
        ],
        "journalforendeEnhet": unit,
        "tema": theme,
        "avsenderMottaker": sender and {"id": sender[0], "type": sender[1]},
        "behandlingstema": preset,
    }
    return row | changes


def snapshot(spark: SparkSession, rows: list[dict]) -> DataFrame:
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
    return lines.select(F.from_json("value", JOURNAL_ENTRY).alias("e")).select("e.*")


def journal(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return lookups.entries_from_snapshot(snapshot(spark, rows))


def person(party_id: str, *groups: str) -> tuple:
    groups = groups or (rules.GROUP_NATIONAL, rules.GROUP_ACTOR)
    idents = {rules.GROUP_NATIONAL: party_id, rules.GROUP_ACTOR: party_id + "00"}
    return party_id, [(g, idents[g], True) for g in groups]


def make_lookups(
    spark: SparkSession,
    rows: list[dict],
    identities: list[tuple] = (),
    tasks: list[tuple] = (),
    extra_codes: list[tuple] = (),
) -> Lookups:
    hierarchy = tables.hierarchy(spark)
    if extra_codes:
        hierarchy = hierarchy.union(
            spark.createDataFrame(extra_codes, "theme string, form_code string, term string")
        )
    return Lookups(
        journal=journal(spark, rows),
        documents=None,
        identities=spark.createDataFrame(list(identities), IDENTITIES),
        tasks=spark.createDataFrame(list(tasks), TASKS),
        hierarchy=hierarchy,
        rules=rules.form_rules(spark),
    )


def keys(spark: SparkSession, ids: list[str], as_of: dt.datetime = WEDNESDAY_MORNING) -> DataFrame:
    events = [(n, as_of, entry_id) for n, entry_id in enumerate(ids)]
    return keys_of(spark.createDataFrame(events, EVENTS))


def wire(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(order, as_of, entry id as number, type, theme) -> wire events."""
    base = spark.createDataFrame(
        rows,
        "event_order bigint, as_of timestamp_ntz, journalpostId bigint, hendelsesType string, temaNytt string",
    )
    texts = {
        "hendelsesId": "h",
        "journalpostStatus": "MOTTATT",
        "temaGammelt": "SYK",
        "mottaksKanal": "NAV_NO",
        "kanalReferanseId": "r",
        "behandlingstema": "",
    }
    return base.withColumns({"versjon": F.lit(1)} | {name: F.lit(text) for name, text in texts.items()})
