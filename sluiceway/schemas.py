"""Schemas of the product table, its change messages and its events.

The relational table is declared once; the shapes the same columns take in the
raw file, in change messages and in the lake are derived from it.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VarcharType,
)

# Names, order, types, lengths and precisions are the data contract
# of the existing table, change stream and event producer.
TABLE = StructType([
    StructField("id", VarcharType(50)),
    StructField("name", VarcharType(255)),
    StructField("original_price", DecimalType(10, 2)),
    StructField("price", DecimalType(10, 2)),
    StructField("fulfillment_type", VarcharType(50)),
    StructField("brand", VarcharType(100)),
    StructField("review_count", IntegerType()),
    StructField("rating_average", DecimalType(3, 2)),
    StructField("favourite_count", IntegerType()),
    StructField("current_seller", VarcharType(255)),
    StructField("number_of_images", IntegerType()),
    StructField("category", VarcharType(100)),
    StructField("quantity_sold", IntegerType()),
    StructField("discount", DecimalType(5, 2)),
])
EVENT = StructType([
    StructField("product_id", StringType()),
    StructField("name", StringType()),
    StructField("price", FloatType()),
    StructField("fulfillment_type", StringType()),
    StructField("brand", StringType()),
    StructField("review_count", IntegerType()),
    StructField("rating_average", FloatType()),
    StructField("current_seller", StringType()),
    StructField("category", StringType()),
    StructField("quantity_sold", IntegerType()),
])
RAW_ONLY_COLUMNS = (
    "Unnamed: 0", "description", "pay_later", "has_video", "date_created", "vnd_cashback",
)
LAKE_DECIMAL = DecimalType(12, 2)
PARTITION_COLUMN = "brand"
CHANGE_TOPIC = ("sales", "public", "products")  # server, schema, table
EVENT_TOPIC = "product_input"
EVENT_OWN_FIELDS = ("created", "product_id")  # set by the producer, not by its schema
# End of fixed values.

PRODUCT_COLUMNS = tuple(TABLE.names)
DECIMAL_COLUMNS = tuple(f.name for f in TABLE if isinstance(f.dataType, DecimalType))


def _derived(text: DataType, number: DataType) -> StructType:
    """The table's columns with other types for its strings and decimals."""

    def retype(kind: DataType) -> DataType:
        if isinstance(kind, VarcharType):
            return text
        return number if isinstance(kind, DecimalType) else kind

    return StructType([StructField(f.name, retype(f.dataType)) for f in TABLE])


# Decimals travel as base64 text, rest in the lake as decimals, and are read from
# files and by SQL clients as doubles.
CHANGE_IMAGE = _derived(StringType(), StringType())
LAKE_ROW = _derived(StringType(), LAKE_DECIMAL)
DOUBLE_ROW = _derived(StringType(), DoubleType())

RAW_ROW = StructType(
    [StructField(RAW_ONLY_COLUMNS[0], StringType())]
    + [f for f in DOUBLE_ROW if f.name != "discount"]
    + [StructField(name, StringType()) for name in RAW_ONLY_COLUMNS[1:]]
)

# Rows as Spark's Kafka source delivers them.
TOPIC_ROW = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("timestampType", IntegerType()),
])

# Messages without a row image, as they are kept aside.
REJECT_ROW = StructType([*TOPIC_ROW.fields, StructField("kind", StringType())])


def _envelope(image: StructType) -> StructType:
    before = StructType([StructField("id", StringType())])
    return StructType([
        StructField("payload", StructType([
            StructField("after", image),
            StructField("before", before),
            StructField("op", StringType()),
        ])),
    ])


# The whole change envelope, and the few fields that suffice to tell its kind.
CHANGE = _envelope(CHANGE_IMAGE)
CHANGE_OUTLINE = _envelope(StructType([StructField("id", StringType())]))


def plain(schema: StructType) -> StructType:
    """The schema that a frame has for a table: Spark knows lengths only in tables."""
    return StructType([
        StructField(f.name, StringType() if isinstance(f.dataType, VarcharType) else f.dataType)
        for f in schema
    ])


def columns_ddl(schema: StructType) -> str:
    """Column list of a ``CREATE TABLE`` statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
