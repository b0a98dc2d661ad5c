"""Wire record -> event: defaults, id as text, required fields.

Faulty records go to a quarantine table and the job goes on; a record is never held back in
front of the ones behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postern.operators.gates import event_type_passes, theme_passes
from postern.schemas import EVENT_DECODED, EVENT_DEFAULTS, EVENT_REQUIRED, EVENT_WIRE

_CORRUPT = "_corrupt"


def parse_json_events(messages: DataFrame, schema: T.StructType = EVENT_WIRE) -> DataFrame:
    """JSON ``value`` -> wire columns; unknown fields are ignored. ``_corrupt`` holds text that
    does not parse. All other message columns are kept."""
    fields = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json("value", fields, {"columnNameOfCorruptRecord": _CORRUPT})
    kept = [c for c in messages.columns if c != "value"]
    return messages.withColumn("_parsed", parsed).select(*kept, "value", "_parsed.*")


def mark_unreadable(wire: DataFrame, raw: Column) -> DataFrame:
    """Wire columns of a reader that turns a record it can't read into NULLs: such a record gets
    its bytes as text in ``value`` and ``_corrupt``, like JSON that does not parse."""
    nothing = F.coalesce(*[F.col(name).cast("string") for name in EVENT_WIRE.names]).isNull()
    return wire.withColumn("value", raw).withColumn(_CORRUPT, F.when(nothing, raw))


def missing_fields() -> Column:
    """Comma-separated names of absent required fields, '' if all are there."""
    return F.concat_ws(
        ",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in EVENT_REQUIRED]
    )


def checked(wire: DataFrame) -> DataFrame:
    """Wire columns that pass the gates, with ``fault`` (NULL if they can be decoded) and, for
    faulty JSON, its text as ``raw``.

    Text that does not parse has no theme to test, so it is kept with its fault whatever the
    gates say; a record without a required field is a fault only if it passes them.
    """
    from_text = _CORRUPT in wire.columns
    unreadable = F.col(_CORRUPT).isNotNull() if from_text else F.lit(False)
    missing = missing_fields()
    fault = F.when(unreadable, "unreadable").when(missing != "", F.concat(F.lit("missing:"), missing))
    raw = F.col("value") if from_text else F.lit(None).cast("string")
    return (
        wire.where(unreadable | (theme_passes() & event_type_passes()))
        .withColumn("fault", fault)
        .withColumn("raw", F.when(F.col("fault").isNotNull(), raw))
    )


def decode(wire: DataFrame) -> DataFrame:
    """Wire columns -> decoded event columns; ``entry_id`` is the key of everything after.

    Extra columns (order, time, fault) stay in front.
    """
    wire_names = {*EVENT_DECODED.names, "value", _CORRUPT}
    extra = [c for c in wire.columns if c not in wire_names]
    decoded = []
    for field in EVENT_DECODED.fields:
        column = F.col(field.name).cast(field.dataType)
        if field.name in EVENT_DEFAULTS:
            column = F.coalesce(column, F.lit(EVENT_DEFAULTS[field.name]))
        decoded.append(column.alias(field.name))
    return wire.select(*extra, *decoded).withColumn("entry_id", F.col("journalpostId"))


def split_faulty(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Checked and decoded events -> (good ones, quarantine rows)."""
    faulty = F.col("fault").isNotNull()
    return events.where(~faulty).drop("fault", "raw"), events.where(faulty)
