"""Lookup responses: ``data`` is used even if errors came along; without it the lookup failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postern.functions.errors import joined_messages
from postern.schemas import envelope


def unwrap(responses: DataFrame, entity_field: str, entity: T.DataType) -> DataFrame:
    """JSON ``value`` -> ``entity`` struct, ``errors``, ``n_errors``, ``error_text`` and
    ``failed`` (no entity). Other columns are kept."""
    parsed = F.from_json("value", envelope(entity_field, entity))
    kept = [c for c in responses.columns if c != "value"]
    return (
        responses.withColumn("_response", parsed)
        .select(
            *kept,
            F.col(f"_response.data.{entity_field}").alias("entity"),
            F.col("_response.errors").alias("errors"),
        )
        .withColumn("n_errors", F.coalesce(F.size(F.coalesce("errors", F.array())), F.lit(0)))
        .withColumn("error_text", joined_messages(F.col("errors")))
        .withColumn("failed", F.col("entity").isNull())
    )


def error_rows(unwrapped: DataFrame, key: str) -> DataFrame:
    """Side table: one row per error."""
    return unwrapped.select(key, F.posexplode("errors").alias("pos", "error")).select(
        key, "pos", "error.message", "error.extensions.code", "error.extensions.classification"
    )
