"""Change messages of a table: telling their kinds apart, and unpacking row images.

Every function takes topic-shaped rows, batch or streaming alike.

Each message is parsed once. A plain ``filter`` on a parsed field would be pushed
below the projection and parse the JSON again for every field it tests; instead
the row image is emitted by ``inline`` over an array that is null for messages
of another kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.functions.decimals import decode_columns
from sluiceway.functions.expressions import bytes_to_text, topic_name
from sluiceway.schemas import (
    CHANGE,
    CHANGE_OUTLINE,
    CHANGE_TOPIC,
    DECIMAL_COLUMNS,
    LAKE_DECIMAL,
    PRODUCT_COLUMNS,
)

ROW, DELETE, TOMBSTONE, MALFORMED, EMPTY = "row", "delete", "tombstone", "malformed", "empty"
UNDECODABLE = "undecodable"
BROKEN = "_broken"  # text of a message with a value that its declared type cannot hold
CHECKED_CHANGE = StructType([*CHANGE.fields, StructField(BROKEN, StringType())])


def of_tables(topic: DataFrame, *tables: tuple[str, str, str]) -> DataFrame:
    """Messages of the listed (server, schema, table) only; pushed to the scan."""
    return topic.where(
        F.col("topic").isin([".".join(name) for name in tables or (CHANGE_TOPIC,)])
    )


def routed(df: DataFrame, server: str, schema: Column | str, table: Column | str) -> DataFrame:
    """Set the topic that each row's change message belongs to."""
    return df.withColumn("topic", topic_name(server, schema, table))


def _parsed(schema: StructType) -> Column:
    text, broken = bytes_to_text(F.col("value")), {"columnNameOfCorruptRecord": BROKEN}
    return F.from_json(text, schema, broken).alias("change")


def _kind() -> Column:
    payload = F.col("change.payload")
    return (
        F.when(F.col("value").isNull(), TOMBSTONE)
        .when(payload.isNull(), MALFORMED)
        .when(payload["op"] == "d", DELETE)
        .when(payload["after"].isNull(), EMPTY)
        .otherwise(ROW)
    )


def images_raw(topic: DataFrame) -> DataFrame:
    """After-images of all messages, encoded.

    Deletes, tombstones and malformed messages come out as rows of nulls, one per
    message, as from a plain parse and star expansion.
    """
    return topic.select(_parsed(CHANGE)).select("change.payload.after.*")


def classified(topic: DataFrame) -> DataFrame:
    """Topic columns and the ``kind`` of each message."""
    return topic.select("*", _parsed(CHANGE_OUTLINE)).withColumn("kind", _kind()).drop("change")


def images(topic: DataFrame) -> DataFrame:
    """After-images of row messages only, encoded."""
    image = F.when(_kind() == ROW, F.array("change.payload.after"))
    return topic.select("value", _parsed(CHANGE)).select(F.inline(image))


def decoded(images: DataFrame, signed: bool = True) -> DataFrame:
    """Replace the base64 columns of images by lake decimals."""
    return decode_columns(
        images, DECIMAL_COLUMNS, LAKE_DECIMAL.precision, LAKE_DECIMAL.scale, signed
    )


def checked_images(topic: DataFrame, signed: bool = True) -> DataFrame:
    """Each message whole in ``message``, its decoded image, and its ``kind``.

    A row image of which the parser dropped a value, or with a decimal that cannot be
    decoded, is of the kind ``undecodable``: a null would lose the value unseen.
    """
    message = F.struct(*(F.col(name) for name in topic.columns)).alias("message")
    parsed = (
        topic.select("value", message, _parsed(CHECKED_CHANGE))
        .select("message", _kind().alias("kind"), f"change.{BROKEN}", "change.payload.after.*")
        .withColumns({f"_{name}": F.col(name) for name in DECIMAL_COLUMNS})
    )
    lost = " OR ".join(f"(`{name}` IS NULL AND `_{name}` <> '')" for name in DECIMAL_COLUMNS)
    return decoded(parsed, signed).select(
        "message", *PRODUCT_COLUMNS,
        F.expr(f"CASE WHEN kind = '{ROW}' AND ({BROKEN} IS NOT NULL OR {lost}) THEN '{UNDECODABLE}' ELSE kind END")
        .alias("kind"),
    )


def table_rows(topic: DataFrame, signed: bool = True) -> DataFrame:
    """Change messages to lake rows: parse, keep row images without a lost value, decode."""
    row = F.array(F.struct(*PRODUCT_COLUMNS))
    return checked_images(topic, signed).select(F.inline(F.when(F.col("kind") == ROW, row)))


def rejects(topic: DataFrame, signed: bool = True) -> DataFrame:
    """All other messages, whole, with their kind."""
    message = F.array(F.struct("kind", "message.*"))
    return checked_images(topic, signed).select(F.inline(F.when(F.col("kind") != ROW, message)))


def routed_rows(topic: DataFrame, signed: bool = True) -> DataFrame:
    """Every message once, by ``kind``: rows with their columns, all others with the whole message.

    One parse feeds both. Columns that a kind does not have are null, which Parquet
    stores in next to nothing.
    """
    checked = checked_images(topic, signed)
    kept = F.when(F.col("kind") != ROW, F.col("message")).alias("message")
    columns = (F.when(F.col("kind") == ROW, F.col(name)).alias(name) for name in PRODUCT_COLUMNS)
    return checked.select("kind", *columns, kept)
