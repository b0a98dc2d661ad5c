"""Left join of events with a table of one row per entry, safe against hot entries.

Adaptive execution splits a hot partition only when both sides of the join come straight out
of a shuffle. That does not hold where the lookup side is itself the end of a chain of joins on
the same key, so hot entries are salted explicitly there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Events of one entry that one task takes. An entry above it is split, so n events have fewer
# than n / EVENTS_PER_TASK hot entries: 100 billion events give a broadcast table below 100,000
# rows of an id and two numbers.
EVENTS_PER_TASK = 1_000_000


def salts_for(n: Column, per_task: int = EVENTS_PER_TASK) -> Column:
    """Number of parts for ``n`` rows; 1 for nearly all keys."""
    return F.ceil(n / per_task).cast("int")


def hot_entries(keys: DataFrame, per_task: int = EVENTS_PER_TASK) -> DataFrame:
    """(entry_id, first_event, salts) of the entries with more than ``per_task`` events."""
    return keys.where(F.col("n_events") > per_task).select(
        "entry_id", "first_event", salts_for(F.col("n_events"), per_task).alias("salts")
    )


def salted_left_join(events: DataFrame, lookup: DataFrame, hot: DataFrame) -> DataFrame:
    """``events`` left join ``lookup`` on ``entry_id``; ``lookup`` has a ``salts`` column.

    Events of a hot entry are dealt out by their distance from the first one (not at random: a
    recomputed task must send a row where it went before), and the one lookup row of that entry
    is repeated for each part. Events without an id match nothing and are spread as well.
    """
    order = F.col("event_order")
    hot = F.broadcast(hot.select("entry_id", F.col("first_event").alias("_first"), F.col("salts").alias("_salts")))
    salted = events.join(hot, "entry_id", "left").withColumn(
        "_salt",
        F.when(F.col("entry_id").isNull(), F.xxhash64(order))
        .when(F.col("_salts").isNotNull(), F.pmod(order - F.col("_first"), F.col("_salts")))
        .otherwise(F.lit(0)),
    )
    last = F.coalesce("salts", F.lit(1)).cast("bigint") - 1
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    return (
        salted.drop("_first", "_salts")
        .join(repeated.drop("salts"), ["entry_id", "_salt"], "left")
        .drop("_salt")
    )


#: Rows of one lookup key that one task takes, counters of the sketch in each task, and the most
#: keys that are split; of a billion rows no more can be hot, and others are left to adaptive skew
#: handling.
ROWS_PER_TASK, MAX_TRACKED, MAX_HOT = 1_000_000, 10_000, 1000


def hot_keys(rows: DataFrame, key: Column, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, salts) of the keys with more than ``per_task`` rows, by a mergeable sketch of frequent
    items: each task keeps at most MAX_TRACKED counters, which are merged, so nothing is shuffled by
    key. Its counts are bounds from above; a key that is none too hot only gets a salt too many."""
    sketch = F.expr(f"approx_top_k(_key, {MAX_HOT}, {MAX_TRACKED})")
    found = rows.select(key.alias("_key")).where("_key IS NOT NULL").agg(sketch.alias("top"))
    items = found.select(F.explode("top").alias("x")).select(F.col("x.item").alias("key"), F.col("x.count").alias("n"))
    return items.where(F.col("n") > per_task).select("key", salts_for(F.col("n"), per_task).alias("salts"))


def sparse_left_join(
    rows: DataFrame,
    lookup: DataFrame,
    wanted: Column,
    key: Column,
    otherwise: Column,
    lookup_key: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``rows`` left join ``lookup`` on ``key``, for the ``wanted`` rows only.

    The others would all share the partition of NULL; they take part under ``otherwise``, which
    only has to spread them, and the join condition keeps them from matching. Rows of the ``hot``
    keys (``hot_keys``, at most MAX_HOT rows, so they are broadcast) are dealt out by
    ``otherwise`` too, and their lookup row is repeated for each part.
    """
    left = rows.withColumns({"_wanted": wanted, "_key": F.when(wanted, key).otherwise(otherwise)})
    right = lookup.withColumnRenamed(lookup_key, "_lookup_key")
    match = F.col("_wanted") & (F.col("_key") == F.col("_lookup_key"))
    if hot is None:
        return left.join(right, match, "left").drop("_wanted", "_key", "_lookup_key")
    salts = F.broadcast(hot.select(F.col("key").alias("_hot"), F.col("salts").alias("_salts")))
    part = F.when(
        F.col("_wanted") & F.col("_salts").isNotNull(), F.pmod(F.xxhash64(otherwise), F.col("_salts").cast("bigint"))
    ).otherwise(F.lit(0).cast("bigint"))
    left = left.join(salts, F.col("_key") == F.col("_hot"), "left").withColumn("_part", part).drop("_hot", "_salts")
    last = F.coalesce("_salts", F.lit(1)).cast("bigint") - 1
    right = (
        right.join(salts, F.col("_lookup_key") == F.col("_hot"), "left")
        .withColumn("_lookup_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .drop("_hot", "_salts")
    )
    match = match & (F.col("_part") == F.col("_lookup_part"))
    return left.join(right, match, "left").drop("_wanted", "_key", "_lookup_key", "_part", "_lookup_part")
