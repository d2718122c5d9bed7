"""Message topics as sources and sinks.

The format is a parameter. With ``kafka`` the options name servers and topics. With
a file format the path holds captured topic rows of the same shape, so that the
code downstream does not differ.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from sluiceway.operators.change_events import of_tables
from sluiceway.schemas import CHANGE_TOPIC, TOPIC_ROW


def kafka_options(
    servers: str,
    tables: Iterable[tuple[str, str, str]] = (CHANGE_TOPIC,),
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Source options: the topics of ``tables``, from the start, going on if offsets
    have expired."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(".".join(name) for name in tables),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_topic(
    spark: SparkSession,
    *,
    servers: str | None = None,
    path: str | None = None,
    format: str = "kafka",
    tables: Iterable[tuple[str, str, str]] = (CHANGE_TOPIC,),
    streaming: bool = True,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    **options,
) -> DataFrame:
    """Topic rows of ``tables``, as a stream or as a batch.

    More ``options`` go to the source. For Kafka, ``minPartitions`` splits a topic
    partition that holds most of the messages over several tasks, and
    ``maxOffsetsPerTrigger`` bounds a micro-batch; for files,
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` do.
    """
    tables = tuple(tables)
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        if servers is None:
            raise ValueError("a kafka topic needs servers")
        known = kafka_options(servers, tables, starting_offsets, fail_on_data_loss)
        bounds = {"maxOffsetsPerTrigger", "maxBytesPerTrigger", "minOffsetsPerTrigger"}
        if streaming and starting_offsets == "earliest" and not bounds & options.keys():
            raise ValueError(
                "a stream from the earliest offset needs maxOffsetsPerTrigger: without it "
                "the whole backlog is one batch"
            )
        return reader.format("kafka").options(**{**known, **options}).load()
    if path is None:
        raise ValueError(f"a topic kept as {format} needs a path")
    rows = reader.format(format).schema(TOPIC_ROW).options(**options).load(path)
    return of_tables(rows, *tables)


def write_topic(
    messages: DataFrame, *, servers: str | None = None, path: str | None = None,
    format: str = "kafka", **options,
) -> None:
    """Publish messages (``topic``, ``value`` and perhaps ``key``) as they are."""
    if format == "kafka":
        if servers is None:
            raise ValueError("a kafka topic needs servers")
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).options(
            **options
        ).save()
        return
    if path is None:
        raise ValueError(f"a topic kept as {format} needs a path")
    messages.write.format(format).mode("append").options(**options).save(path)
