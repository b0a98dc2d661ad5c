"""Error lists of a lookup response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_messages(errors: Column) -> Column:
    """Messages joined by ' - '; a missing message reads 'null', a missing list stays NULL."""
    return F.array_join(F.transform(errors, lambda e: F.coalesce(e["message"], F.lit("null"))), " - ")
