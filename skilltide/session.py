"""Session settings the library expects, and the folders and size checks its plans use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side with at most this many rows may be broadcast; the rows are short strings and keys.
BROADCAST_ROWS = 100_000

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, name: str = "skilltide", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.log.level": "ERROR",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. A machine-local folder is used in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="skilltide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Its readers see the same rows, a lost executor costs none of the work before it, and its
    size is known: Catalyst broadcasts it in a join below the session's threshold only.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most ``max_rows + 1`` rows."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side after counting it. A larger side keeps its shuffle join, where adaptive
    execution splits hot keys."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def broadcaster(df: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The broadcast hint for sides that have at most a few rows per row of ``df``, when ``df``
    was counted to be small; otherwise no hint."""
    return F.broadcast if is_small(df, BROADCAST_ROWS // 10) else lambda side: side
