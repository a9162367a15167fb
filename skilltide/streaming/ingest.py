"""I-22: the repeated crawl as a stream, each posting stored once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skilltide.operators.ingest import insert_if_absent
from skilltide.sources.files import read_if_exists

PREFIXES = 64
PREFIX = "key_prefix"


def stored_part(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of the target whose prefix a key of the batch has; a batch has at most ``PREFIXES`` of them."""
    prefixes = [row[0] for row in batch.select(PREFIX).distinct().collect()]
    return stored.filter(F.col(PREFIX).isin(prefixes))


def ingest_stream(
    stream: DataFrame, target: str, key: str, order_by: list[str], checkpoint: str
) -> StreamingQuery:
    """Exact form: each micro-batch appends the keys the target lacks, then the query ends.

    The target is kept by a prefix of the key's hash. A micro-batch reads the key column of its own
    prefixes only, and writes a file per prefix. A repeated batch finds its own rows in the target and
    appends nothing.
    """

    def append(batch: DataFrame, _batch_id: int) -> None:
        tagged = batch.withColumn(PREFIX, F.pmod(F.xxhash64(key), F.lit(PREFIXES)).cast("int"))
        stored = read_if_exists(batch.sparkSession, target, tagged.schema)
        part = None if stored is None else stored_part(tagged, stored)
        rows = insert_if_absent(tagged, part, key, order_by)
        rows.repartition(PREFIX).write.mode("append").partitionBy(PREFIX).parquet(target)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a target, without the prefix it is kept by."""
    return spark.read.parquet(target).drop(PREFIX)


def dedupe_stream(stream: DataFrame, event_time: str, delay: str, key: str) -> DataFrame:
    """Bounded state: a key repeated later than ``delay`` passes again."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
