"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postern.session import work_dir

#: What separates words in most contracts: space and the control characters 9 to 13.
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows from a table in the shared folder: cuts the lineage, survives lost executors, and
    makes values that depend on the partitioning (partition ids) the same for every later read."""
    folder = work_dir(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table_of(columns: Sequence[tuple[str, pa.DataType]]) -> str:
    """The schema of Arrow columns in Spark's words."""
    names = {
        pa.int64(): "long",
        pa.string(): "string",
        pa.binary(): "binary",
        pa.list_(pa.int64()): "array<long>",
        pa.list_(pa.string()): "array<string>",
    }
    return ", ".join(f"{name} {names[kind]}" for name, kind in columns)


def set_aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but the needed ones under names that clash with nothing, and a
    function that brings a result with these columns back to the columns of ``docs``."""
    names = [c if c in needed else f"_other{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*names).toDF(*docs.columns)


#: Names a document row that has no other name: its doc_id (and whether it is null) and its text's hash.
ROW_KEY = ["_null", "_id", "_hash"]


def with_row_key(docs: DataFrame) -> DataFrame:
    """Add ROW_KEY; none of it is null, so tables join on it by plain equality. Only repeated rows
    (and, in 2 ** 64, two texts of one doc_id) share a key."""
    return docs.withColumns(
        {
            "_null": F.col("doc_id").isNull(),
            "_id": F.coalesce(F.col("doc_id"), F.lit(0)),
            "_hash": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )


def with_starts(
    df: DataFrame, size: str, order: Sequence[str], group: str | None = None, start: str = "start"
) -> DataFrame:
    """Add ``start``: the sum of ``size`` over all earlier rows in ``order`` (of the same ``group``).

    Two-level prefix sums, so no group and no order is walked by one task: rows are dealt out by
    range, each range sums by itself, and ranges get their bases from the sums of earlier ranges
    (a row for each range and group that meet). ``df`` must be slim and cheap to read twice; rows
    that tie in ``order`` take any order among themselves, fixed by the written table.
    """
    keys = [group, *order] if group else list(order)
    ranged = written(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged"
    )
    near = [group, "_part"] if group else ["_part"]
    sums = ranged.groupBy(*near).agg(F.sum(size).alias("_sum"))
    earlier = (
        (Window.partitionBy(group) if group else Window.partitionBy())
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = sums.select(
        *[F.col(c).alias(f"_b{c}") for c in near],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    inside = (
        Window.partitionBy(*near).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = ranged.withColumn("_own", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    on = F.lit(True)
    for c in near:
        on = on & rows[c].eqNullSafe(bases[f"_b{c}"])
    return rows.join(bases, on).select(
        *df.columns, (F.col("_base") + F.col("_own")).cast("long").alias(start)
    )
