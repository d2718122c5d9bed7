"""Product events as self-describing JSON records: ``{schema, payload}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.functions.expressions import text_to_bytes
from sluiceway.schemas import EVENT, EVENT_OWN_FIELDS, EVENT_TOPIC
from sluiceway.sources.avro_schema import avro_type


def project_fields(
    df: DataFrame, schema: StructType = EVENT, exclude: Sequence[str] = EVENT_OWN_FIELDS
) -> DataFrame:
    """Columns of a declared schema except ``exclude``, cast to their types.

    A value that its type cannot hold becomes null; ``bad_events`` finds such rows.
    """
    return df.select(
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema if f.name not in exclude)
    )


def bad_events(df: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """Rows with a value that its declared type cannot hold, with the names of such columns."""
    bad = F.filter(F.array(*(
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name)
        for f in schema if f.name in df.columns
    )), lambda name: name.isNotNull())
    return df.withColumn("bad_fields", bad).where(F.size("bad_fields") > 0)


def schema_block(schema: StructType = EVENT) -> Column:
    """The ``schema`` member of a record, a constant of the query."""
    fields = [
        F.struct(F.lit(f.name).alias("name"), F.lit(avro_type(f.dataType)).alias("type"))
        for f in schema
    ]
    return F.struct(F.lit("struct").alias("type"), F.array(*fields).alias("fields"))


def event_json(created: Column, schema: StructType = EVENT) -> Column:
    """JSON text of one event; null members are written, not left out."""
    payload = F.struct(
        created.alias("created"),
        *(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema),
    )
    record = F.struct(schema_block(schema).alias("schema"), payload.alias("payload"))
    return F.to_json(record, {"ignoreNullFields": "false"})


def event_messages(df: DataFrame, created: Column, schema: StructType = EVENT) -> DataFrame:
    """Rows to messages for a topic sink: ``topic`` and ``value`` in bytes."""
    return df.select(
        F.lit(EVENT_TOPIC).alias("topic"),
        text_to_bytes(event_json(created, schema)).alias("value"),
    )
