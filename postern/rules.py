"""The routing rules as data: every value that decides an outcome stands here."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Fixed values -----------------------------------------------------------------------------

# Gates on the incoming event.
GATE_THEME = "SYK"
GATE_EVENT_TYPES = ["MidlertidigJournalført", "Mottatt", "JournalpostMottatt"]

# Entry status values that may be handled.
OPEN_STATUSES = ["MOTTATT", "M"]

# Form codes handled automatically: theme, form code, task type, deadline in business days.
AUTO_FORMS = [
    ("SYK", "NAV 08-07.04D", "SOK", 3),
    ("SYK", "NAV 08-07.04 D", "SOK", 3),
]

# Form codes that end without any task: theme, form code.
IGNORED_FORMS = [
    ("SYK", "4936"),
    ("SYK", "krav_om_fritak_fra_agp_gravid"),
    ("SYK", "krav_om_fritak_fra_agp_kronisk"),
    ("SYK", "soeknad_om_fritak_fra_agp_kronisk"),
    ("SYK", "refusjonskrav_arbeidsgiverperiode_korona"),
    ("SYK", "soeknad_om_fritak_fra_agp_gravid"),
    ("SYK", "refusjonskrav_utestengt_arbeider_korona"),
    ("SYK", "annuller_refusjonskrav_utestengt_arbeider_korona"),
]

# Party types and identity groups.
PARTY_ACTOR = "AKTOERID"
PARTY_PERSON = "FNR"
PARTY_ORGANISATION = "ORGNR"
GROUP_ACTOR = "AKTORID"
GROUP_NATIONAL = "FOLKEREGISTERIDENT"

# Task values.
TASK_JOURNALING = "JFR"
TASK_DISTRIBUTION = "FDR"
TASK_OPEN = "AAPEN"
TASK_CLOSED = "AVSLUTTET"
BLOCKING_TASK_TYPES = [TASK_JOURNALING, TASK_DISTRIBUTION]
MANUAL_DEADLINE_DAYS = 1
PRIORITY = "NORM"
THEME_UNKNOWN = "UKJ"
THEME_GENERAL = "GEN"

# Entries whose automatic task is sent without a unit.
UNIT_OVERRIDES = ["755763339"]

# Journal update and finalization.
CASE_TYPE = "GENERELL_SAK"
FINALIZE_UNIT = "9999"
FINAL_STATUS = "JOURNALFOERT"

# Rejection texts: class, first part, second part (both must occur in the text).
REJECTION_TEXTS = [
    ("bad_unit", "NAVEnheten '", "' er av typen oppgavebehandler"),
    ("bad_unit", "NAVEnheten '", "' har status: 'Nedlagt'"),
    ("bad_unit", "Enheten med nummeret '", "' eksisterer ikke"),
    ("bad_org", "Organisasjonsnummer er ugyldig", ""),
]
REPAIRABLE_HTTP_STATUS = 400

# Retry: header name, delays, retention, code-hierarchy language.
DUE_HEADER = "behandlingstidspunkt"
FIRST_RETRY_DELAY = "INTERVAL '1' SECOND"
NEXT_RETRY_DELAY = "INTERVAL '10' MINUTE"
RETRY_RETENTION = "INTERVAL '336' HOUR"
TERM_LANGUAGE = "nb"
LOCAL_ZONE = "Europe/Oslo"

# ------------------------------------------------------------------------------------------


def sql_list(values: list[str | None]) -> str:
    """The values as text for a SQL expression."""
    return ", ".join("NULL" if v is None else "'" + v.replace("'", "\\'") + "'" for v in values)


def form_rules(spark: SparkSession) -> DataFrame:
    """One row per (theme, form code) that has a rule: ignored, or automatic with a task type
    and a deadline. A literal table: the optimizer knows its size and broadcasts it without a
    hint."""
    rows = [
        {"theme": theme, "form_code": code, "ignored": False, "task_type": kind, "deadline_days": days}
        for theme, code, kind, days in AUTO_FORMS
    ]
    rows += [
        {"theme": theme, "form_code": code, "ignored": True, "task_type": None, "deadline_days": None}
        for theme, code in IGNORED_FORMS
    ]
    columns = pa.schema(
        [
            ("theme", pa.string()),
            ("form_code", pa.string()),
            ("ignored", pa.bool_()),
            ("task_type", pa.string()),
            ("deadline_days", pa.int32()),
        ]
    )
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=columns))
