"""Session settings and the folder for durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

def local_session(cores: int | str = "*", app: str = "postern", **settings: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the submitter's settings apply; the
    package relies on adaptive execution, which is on by default."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def settings_for(shuffle_bytes: int, partition_mb: int = 200) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes`` in its largest stage: partitions
    that fit an executor's memory, coalesced where a stage turns out smaller, split where one
    key makes a partition several times that size."""
    size = f"{partition_mb}m"
    partitions = max(200, -(-shuffle_bytes // (partition_mb << 20)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    }


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for tables and stream checkpoints of one run.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local master may do
    without that setting; a machine-local folder on a cluster would be lost with its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"postern-{name}-")


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
