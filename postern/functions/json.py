"""JSON fields that may hold one value or an array of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_or_single(value: Column, path: str, element_ddl: str) -> Column:
    """``array<element>`` at ``path``: a lone object becomes a list of one, an absent or null
    field stays NULL."""
    raw = F.get_json_object(value, path)
    return _listed(raw, element_ddl, F.from_json(raw, element_ddl))


def strings_or_single(value: Column, path: str) -> Column:
    """The same for ``array<string>``, where a lone value is not a JSON document itself."""
    raw = F.get_json_object(value, path)
    return _listed(raw, "string", raw)


def _listed(raw: Column, element_ddl: str, single: Column) -> Column:
    many = F.from_json(raw, f"array<{element_ddl}>")
    return F.when(raw.isNotNull(), F.coalesce(many, F.array(single)))
