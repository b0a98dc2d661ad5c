"""Lookup tables made of stored lookup responses (JSON envelopes). A response without an entity
gives no row, so the entry counts as missing, or the person as not found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postern.functions.json import array_or_single
from postern.operators.envelope import unwrap
from postern.schemas import DOCUMENT, IDENTITY, JOURNAL_ENTRY
from postern.sources.lookups import entries_from_snapshot

_IDENTITIES = T.StructType([T.StructField("identer", T.ArrayType(IDENTITY))])


def _listed(entity_field: str, list_field: str, element: T.StructType):
    return array_or_single(F.col("value"), f"$.data.{entity_field}.{list_field}", element.simpleString())


def entries(responses: DataFrame) -> DataFrame:
    """Entry table from journal responses (``value``). Documents and dates may be a list or a
    single object."""
    dates = JOURNAL_ENTRY["relevanteDatoer"].dataType.elementType
    lists = responses.select(
        "value",
        _listed("journalpost", "dokumenter", DOCUMENT).alias("_documents"),
        _listed("journalpost", "relevanteDatoer", dates).alias("_dates"),
    )
    found = unwrap(lists, "journalpost", JOURNAL_ENTRY).where("NOT failed")
    snapshot = found.select("entity.*", "_documents", "_dates").withColumns(
        {"dokumenter": F.col("_documents"), "relevanteDatoer": F.col("_dates")}
    )
    return entries_from_snapshot(snapshot)


def identities(responses: DataFrame) -> DataFrame:
    """Identity lists from person responses (``party_id``, ``value``). The lookup asks for
    current identities only, so all of them are."""
    listed = responses.select("party_id", "value", _listed("hentIdenter", "identer", IDENTITY).alias("listed"))
    found = unwrap(listed, "hentIdenter", _IDENTITIES).where("NOT failed")
    current = F.transform(
        "listed",
        lambda i: F.struct(i["gruppe"].alias("grp"), i["ident"].alias("ident"), F.lit(True).alias("current")),
    )
    return found.select("party_id", current.alias("identities"))
