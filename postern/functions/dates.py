"""Deadlines in business days, epoch milliseconds and local wall time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postern.rules import LOCAL_ZONE

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_FRIDAY = 4
_LATE_AFTER_HOUR = 12


def deadline(local_ts: Column, days: Column | int) -> Column:
    """The date ``days`` business days after ``local_ts``, one more from 13:00 on.

    A weekend start counts from its Friday; every five business days then span a weekend.
    Public holidays are not considered. ``local_ts`` is wall time; the caller picks the zone.
    """
    day = F.to_date(local_ts)
    days = F.lit(days) if isinstance(days, int) else days
    steps = days + F.when(F.hour(local_ts) > _LATE_AFTER_HOUR, 1).otherwise(0)
    past_friday = F.greatest(F.weekday(day) - _FRIDAY, F.lit(0))
    weekends = F.floor((F.weekday(day) - past_friday + steps) / 5).cast("int")
    return F.when(steps == 0, day).otherwise(
        F.date_add(day, steps - past_friday + 2 * weekends)
    )


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970 of a zone-less timestamp, rounded down."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def from_epoch_ms(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH))


def local_time(utc_ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall time in ``zone`` of a zone-less UTC timestamp, whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ts)
