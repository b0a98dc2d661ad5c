"""Which events are taken at all. The gates are plain comparisons of raw columns, so they run
before decoding and reach the scan where the source allows it. As filters they drop NULLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postern.rules import GATE_EVENT_TYPES, GATE_THEME


def theme_passes() -> Column:
    return F.col("temaNytt") == GATE_THEME


def event_type_passes() -> Column:
    return F.col("hendelsesType").isin(*GATE_EVENT_TYPES)


def gate(events: DataFrame) -> DataFrame:
    return events.where(theme_passes() & event_type_passes())
