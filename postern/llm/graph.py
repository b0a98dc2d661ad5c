"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postern.llm.common import written


def _print(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0)),
            F.coalesce(F.sum(F.xxhash64("b", "a") % 999_983), F.lit(0)),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches.

    Alternating star steps: every node points its larger neighbours to its smallest neighbour, then
    its smaller ones; links only ever move within a component, and their number never rises. Only
    minima are taken per node (combined before the shuffle), no neighbour lists, so a hub with a
    third of all links is no group that one task must hold. Each step is a written table; a count
    and two checksums tell when nothing moves any more. ``links``: a and b, any order.
    """
    now = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a > b")
        .distinct(),
        "links",
    )
    seen = _print(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = (
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        )
        large = large.filter("a > b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("least").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                )
            ).alias("link")
        )
        now = written(small.select("link.*").filter("a > b").distinct(), "links")
        if seen == (seen := _print(now)):
            break
    to = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return to.unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
