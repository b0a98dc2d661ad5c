"""Facts about the document list held inside one entry row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postern.functions.text import is_empty


def first_code(documents: Column) -> Column:
    """Form code of document 0; NULL for an empty list."""
    return F.get(documents, F.lit(0))["brevkode"]


def titles_present(documents: Column) -> Column:
    """False if any title is NULL or empty; white space counts; an empty list passes."""
    return F.forall(documents, lambda d: ~is_empty(d["tittel"]))
