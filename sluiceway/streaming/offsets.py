"""A trace of the offsets that a stream has read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sluiceway.operators.topic_offsets import KEYS, gaps, merged, read_intervals

_BATCH = "batch"


def trace_offsets(
    topic: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep the intervals of offsets of each micro-batch as Parquet below ``path``.

    A query of its own beside the one that takes the rows. A batch that is made again
    replaces what it had kept, so the trace holds each batch once.
    """
    def keep(rows: DataFrame, number: int) -> None:
        read_intervals(rows).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{_BATCH}={number}")

    writer = topic.select(*KEYS, "offset").writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def traced_gaps(spark: SparkSession, path: str, earliest: int | None = None) -> DataFrame:
    """Offsets that no batch of a trace has read, between those that some batch has."""
    return gaps(merged(spark.read.parquet(path).drop(_BATCH)), earliest)
