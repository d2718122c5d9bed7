"""Continuous append of change messages to the lake table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.operators.change_events import ROW, rejects, routed_rows, table_rows
from sluiceway.schemas import LAKE_ROW, PARTITION_COLUMN, TOPIC_ROW
from sluiceway.sources.lake import gathered, read_lake, write_lake

ROUTED_BY = ("kind", PARTITION_COLUMN)
ROUTED_ROW = StructType([
    *LAKE_ROW.fields, StructField("message", TOPIC_ROW), StructField("kind", StringType())])


@dataclass(frozen=True)
class Sink:
    """Where rows go and how often.

    ``checkpoint`` must be on storage that outlives the driver and that every
    executor reaches. ``interval`` is a processing-time trigger such as
    ``"1 minute"``; longer ones make fewer, larger files. ``until_caught_up`` takes
    what is there and ends. With neither, batches follow each other directly.
    ``gather`` shuffles each batch by partition value before it is written; without
    it every task writes a file for every value it meets.
    """

    path: str
    checkpoint: str
    format: str = "parquet"
    gather: bool = True
    interval: str | None = None
    until_caught_up: bool = False
    name: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def start_append(df: DataFrame, sink: Sink, partition_by: str | Sequence[str] | None = None) -> StreamingQuery:
    """Append a streaming frame to a sink, each row once across restarts."""
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    rows = gathered(df, *by) if by and sink.gather else df
    writer = (
        rows.writeStream.format(sink.format)
        .outputMode("append")
        .option("checkpointLocation", sink.checkpoint)
        .options(**sink.options)
    )
    if by:
        writer = writer.partitionBy(*by)
    if sink.name:
        writer = writer.queryName(sink.name)
    if sink.until_caught_up:
        writer = writer.trigger(availableNow=True)
    elif sink.interval:
        writer = writer.trigger(processingTime=sink.interval)
    return writer.start(sink.path)


def append_changes(topic: DataFrame, sink: Sink, signed: bool = True) -> StreamingQuery | None:
    """Topic rows to the lake table.

    A streaming topic starts a query, which is returned; a batch is written at once
    by the same transformation.
    """
    return _append(table_rows(topic, signed), sink, PARTITION_COLUMN)


def append_rejects(topic: DataFrame, sink: Sink) -> StreamingQuery | None:
    """Messages without a row image to their own sink, partitioned by kind.

    A query of its own: it reads and parses the topic again, but commits on its own and
    cannot hold up or half-complete the table's.
    """
    return _append(rejects(topic), sink, "kind")


def append_routed(topic: DataFrame, sink: Sink, signed: bool = True) -> StreamingQuery | None:
    """Rows and rejects by one parse and one commit, to one location partitioned by kind and brand.

    ``append_changes`` and ``append_rejects`` parse each message once for either sink, and a job can
    die with one of them ahead. Here a batch is there with all its kinds or not at all;
    ``routed_table`` and ``routed_rejects`` read one part, pruned by partition.
    """
    rows = routed_rows(topic, signed)
    if not rows.isStreaming:
        write_lake(rows, sink.path, sink.format, "append", ROUTED_BY, sink.gather)
        return None
    return start_append(rows, sink, ROUTED_BY)


def routed_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Rows of a routed location, as ``read_lake`` gives those of a table of their own."""
    return read_lake(spark, path, format, ROUTED_ROW).where(F.col("kind") == ROW).select(*LAKE_ROW.names)


def routed_rejects(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """All other messages, whole, with their kind."""
    return read_lake(spark, path, format, ROUTED_ROW).where(F.col("kind") != ROW).select("message.*", "kind")


def _append(rows: DataFrame, sink: Sink, partition_by: str) -> StreamingQuery | None:
    if rows.isStreaming:
        return start_append(rows, sink, partition_by)
    write_lake(rows, sink.path, sink.format, "append", partition_by, sink.gather)
    return None


def wait(query: StreamingQuery, timeout: float | None = None) -> None:
    """Block until the query ends; with ``timeout`` in seconds, stop it and raise when
    it has not."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")
