"""The entry table kept ready for the join: document facts combined once, rows bucketed by
entry id, so that a batch job neither reads the documents nor shuffles the entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def publish(entries: DataFrame, name: str, buckets: int) -> None:
    """Replace the table ``name``. The bucket count should be the number of shuffle partitions
    the batch jobs use (a few hundred megabytes per bucket)."""
    (
        entries.repartition(buckets, "entry_id")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "entry_id")
        .sortBy("entry_id")
        .saveAsTable(name)
    )


def read(spark: SparkSession, name: str) -> DataFrame:
    """As ``Lookups.journal``, with ``documents`` left out."""
    return spark.table(name)
