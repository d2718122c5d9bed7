"""Events whose schema goes by an id: written by the id's own schema, read by a common one.

Every row takes one branch of a ``CASE`` over the distinct schemas, so a message is written or
parsed once, whatever their number; ids that share a schema share a branch. Reading one schema's
data by another follows the rules of the schema format: fields by name or alias, defaults for
fields that the writer lacks, promotion of numbers, null only where the reader allows it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.functions.expressions import bytes_to_text, text_to_bytes
from sluiceway.schemas import EVENT_TOPIC
from sluiceway.sources.avro_schema import Record, RecordField, resolve

NO_SCHEMA, MALFORMED = "no schema", "malformed"
BROKEN = "_broken"


def _branches(schemas: Mapping[str, Record]) -> Iterable[tuple[Record, list[str]]]:
    """Distinct schemas with the ids that have them."""
    shared: dict[Record, list[str]] = {}
    for own, record in schemas.items():
        shared.setdefault(record, []).append(own)
    return shared.items()


def _case(own: Column, branches: Iterable[tuple[list[str], Column]]) -> Column:
    found = None
    for ids, column in branches:
        found = F.when(own.isin(ids), column) if found is None else found.when(own.isin(ids), column)
    if found is None:
        raise ValueError("no schemas")
    return found


def _record(schema: Record, columns: list[str], own: Column, created: Column) -> Column:
    """JSON text of a row by one schema. A column that the row lacks is written as the default."""
    def value(field: RecordField) -> Column:
        if field.name in columns:
            return F.col(field.name).try_cast(field.spark_type)
        return F.lit(field.default[0] if field.default else None).cast(field.spark_type)

    block = F.struct(F.lit("struct").alias("type"), F.array(*(
        F.struct(F.lit(field.name).alias("name"), F.lit(field.kind).alias("type")) for field in schema.fields)).alias("fields"))
    payload = F.struct(created.alias("created"), own.alias("product_id"), *(
        value(field).alias(field.name) for field in schema.fields if field.name not in ("created", "product_id")))
    return F.to_json(F.struct(block.alias("schema"), payload.alias("payload")), {"ignoreNullFields": "false"})


def messages_by_id(df: DataFrame, schemas: Mapping[str, Record], created: Column, id_column: str = "product_id") -> DataFrame:
    """Rows to messages, each by the schema of its id; ``value`` is null where an id has none."""
    own = F.col(id_column).cast("string")
    text = _case(own, ((ids, _record(schema, df.columns, own, created)) for schema, ids in _branches(schemas)))
    return df.select(F.lit(EVENT_TOPIC).alias("topic"), text_to_bytes(own).alias("key"), text_to_bytes(text).alias("value"))


def _image(text: Column, writer: Record, reader: Record) -> Column:
    """The reader's row of a payload, and what is wrong with it."""
    pairs = resolve(writer, reader)
    kept = StructType([StructField(field.name, field.spark_type) for field in dict.fromkeys(field for _, field in pairs if field)])
    parsed = F.from_json(text, StructType([StructField("payload", kept), StructField(BROKEN, StringType())]),
                         {"columnNameOfCorruptRecord": BROKEN})
    # One lambda over one parse: named again and again, it would be parsed for each field.
    def read(one: Column) -> Column:
        def value(field: RecordField, found: RecordField | None) -> Column:
            if found is None:
                return F.lit(field.default[0]).cast(field.spark_type)
            return one["payload"][found.name].cast(field.spark_type)

        missing = F.concat_ws("; ", *(
            F.when(one["payload"][found.name].isNull(), f"null in {field.name}") for field, found in pairs if found and not field.nullable))
        reason = F.when(one["payload"].isNull() | one[BROKEN].isNotNull(), MALFORMED).otherwise(F.nullif(missing, F.lit("")))
        return F.struct(F.struct(*(value(*pair).alias(pair[0].name) for pair in pairs)).alias("row"), reason.alias("reason"))

    return F.transform(F.array(parsed), read)[0]


def checked_events(messages: DataFrame, schemas: Mapping[str, Record], reader: Record) -> DataFrame:
    """Each message whole in ``message``, its ``row`` by the reader's schema, and the ``reason`` why it has none.

    The id is the message's key, so that a payload is parsed by its own schema at once.
    """
    own, text = bytes_to_text(F.col("key")), bytes_to_text(F.col("value"))
    read = _case(own, ((ids, _image(text, schema, reader)) for schema, ids in _branches(schemas)))
    message = F.struct(*(F.col(name) for name in messages.columns)).alias("message")
    return messages.select(message, read.alias("read")).select(
        "message", "read.row", F.when(F.col("read").isNull(), NO_SCHEMA).otherwise(F.col("read.reason")).alias("reason"))


def events_by_id(messages: DataFrame, schemas: Mapping[str, Record], reader: Record) -> DataFrame:
    """Events that the reader's schema can hold."""
    checked = checked_events(messages, schemas, reader)
    return checked.select(F.inline(F.when(F.col("reason").isNull(), F.array("row"))))


def rejected_events(messages: DataFrame, schemas: Mapping[str, Record], reader: Record) -> DataFrame:
    """The other messages, whole, with the reason."""
    rejected = F.array(F.struct("reason", "message.*"))
    return checked_events(messages, schemas, reader).select(F.inline(F.when(F.col("reason").isNotNull(), rejected)))
