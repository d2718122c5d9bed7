"""Products and change messages derived from the supplied tables.

The column expressions run unchanged on Spark and on DuckDB, so the oracles build
on the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.decimals import encode_columns
from sluiceway.functions.expressions import text_to_bytes
from sluiceway.operators.change_events import routed
from sluiceway.operators.products import with_discount
from sluiceway.schemas import (
    CHANGE_TOPIC,
    DECIMAL_COLUMNS,
    PRODUCT_COLUMNS,
    RAW_ONLY_COLUMNS,
    TABLE,
    TOPIC_ROW,
)

LOAD_ROWS = 2000  # rows that a limited load takes

# ``seq`` numbers the rows; the kind of change message a row yields depends on it.
PART_PRODUCTS = {
    "seq": "p_partkey",
    "id": "cast(p_partkey AS string)",
    "name": "p_name",
    "original_price": "cast(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_retailprice END AS decimal(10,2))",
    "price": "cast(floor(p_retailprice * (100 - CASE WHEN p_size % 7 = 0 THEN -10 ELSE p_size % 30 END)) / 100 AS decimal(10,2))",
    "fulfillment_type": "concat('  ', p_type, ' ')",
    "brand": "CASE WHEN p_size % 25 = 0 THEN NULL ELSE p_brand END",
    "review_count": "p_size * 3",
    "rating_average": "cast(p_size % 6 AS decimal(3,2))",
    "favourite_count": "p_size % 17",
    "current_seller": "concat('seller_', cast(p_size % 9 AS string))",
    "number_of_images": "p_size % 8",
    "category": "p_type",
    "quantity_sold": "p_size * 2",
}

# One product per order line; a single brand has more than a third of them.
LINE_PRODUCTS = {
    "seq": "l_orderkey * 8 + l_linenumber",
    "id": "concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string))",
    "name": "concat('part ', cast(l_partkey AS string))",
    "original_price": "cast(CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE l_extendedprice END AS decimal(10,2))",
    "price": "cast(floor(l_extendedprice * (100 - CASE WHEN l_suppkey % 7 = 0 THEN -10 ELSE l_suppkey % 30 END)) / 100 AS decimal(10,2))",
    "fulfillment_type": "concat('  ', l_returnflag, ' ')",
    "brand": "CASE WHEN l_suppkey % 3 = 0 THEN 'Brand#1' WHEN l_suppkey % 25 = 0 THEN NULL ELSE concat('Brand#', cast(l_suppkey % 25 AS string)) END",
    "review_count": "cast(l_quantity AS int)",
    "rating_average": "cast(l_linenumber % 6 AS decimal(3,2))",
    "favourite_count": "cast(l_partkey % 1000 AS int)",
    "current_seller": "concat('seller_', cast(l_suppkey % 9 AS string))",
    "number_of_images": "l_linenumber",
    "category": "l_linestatus",
    "quantity_sold": "cast(l_quantity * 2 AS int)",
}

# Table-shaped rows of which many break a constraint.
ORDER_PRODUCTS = {
    "id": "CASE WHEN o_orderkey % 50 = 0 THEN concat(cast(o_orderkey AS string), repeat('x', 60)) ELSE cast(o_orderkey AS string) END",
    "name": "repeat(o_orderpriority, cast(1 + o_orderkey % 30 AS int))",
    "original_price": "o_totalprice * CASE WHEN o_orderkey % 13 = 0 THEN 1000 ELSE 1 END",
    "price": "o_totalprice",
    "fulfillment_type": "concat(o_orderstatus, repeat(' ', 60))",
    "brand": "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END",
    "review_count": "o_orderkey * 300000",
    "rating_average": "cast(o_orderkey % 12 AS double) + 0.25",
    "favourite_count": "cast(o_orderkey % 9 AS double) - 4.5",
    "current_seller": "concat('seller ''', o_orderstatus, '''')",
    "number_of_images": "CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' ELSE cast(o_orderkey % 8 AS string) END",
    "category": "o_orderstatus",
    "quantity_sold": "cast(o_orderkey % 100 AS int)",
    "discount": "cast(o_orderkey % 2001 AS double) - 1000",
}

# Lines of a product file: bad prices and counts, rows with a cell too many or too few.
BROKEN_PRICE = "CASE WHEN o_orderkey % 7 = 1 THEN 'abc' ELSE '12.50' END"
BROKEN_COUNT = "CASE o_orderkey % 7 WHEN 2 THEN 'n/a' WHEN 3 THEN '3000000000' ELSE '5' END"
BROKEN_LINE = (
    "CASE WHEN o_orderkey % 7 = 5 THEN concat(cast(o_orderkey AS string), ',n') ELSE concat("
    f"cast(o_orderkey AS string), ',n,20.00,', {BROKEN_PRICE}, ',f,b,', {BROKEN_COUNT}, "
    "',1.5,1,s,2,c,3,4.5', CASE WHEN o_orderkey % 7 = 4 THEN ',surplus' ELSE '' END) END"
)

# Lines of a raw product file, broken like those and by a quoted line break.
BROKEN_RAW_HEAD = "concat('0,', cast(o_orderkey AS string), ',')"
BROKEN_RAW_REST = (
    f"concat(',20.00,', {BROKEN_PRICE}, ', f ,b,', {BROKEN_COUNT}, ',1.5,1,s,2,c,3,-,-,-,-,-', "
    "CASE WHEN o_orderkey % 7 = 4 THEN ',surplus' ELSE '' END)"
)
BROKEN_RAW_LINE = (
    f"CASE o_orderkey % 7 WHEN 5 THEN concat({BROKEN_RAW_HEAD}, 'n') "
    f"WHEN 6 THEN concat({BROKEN_RAW_HEAD}, '\"n', chr(10), 'n\"', {BROKEN_RAW_REST}) "
    f"ELSE concat({BROKEN_RAW_HEAD}, 'n', {BROKEN_RAW_REST}) END"
)

# Change messages: a price that is no base64, one beyond its type, a count beyond its type,
# an empty price, and a sound one.
BROKEN_CHANGE = (
    "concat('{\"payload\":{\"op\":\"c\",\"after\":{\"id\":\"', cast(o_orderkey AS string), '\",\"price\":\"', "
    "CASE o_orderkey % 5 WHEN 1 THEN '!!' WHEN 2 THEN 'AQEBAQEBAQEB' WHEN 4 THEN '' ELSE 'nA==' END, "
    "'\",\"review_count\":', CASE WHEN o_orderkey % 5 = 3 THEN '3000000000' ELSE '5' END, '}}}')"
)

# Where orders stand in a topic of four partitions, and those that expired unread: a stretch of
# each thousand, and one of more than a bitmap's size.
OFFSET = "cast(floor(o_orderkey / 4) AS bigint)"
EXPIRED = f"({OFFSET} % 1000 < 40 OR o_orderkey % 4 = 2 AND {OFFSET} BETWEEN 1500 AND 1500 + 40000)"

# A note of several lines, some blank, with quotes, commas and a carriage return.
NOTE = (
    "CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('a \"b\"', chr(10), 'c,', cast(o_orderkey AS string)) "
    "WHEN 2 THEN concat(repeat(concat('line', chr(10), chr(10)), cast(o_orderkey % 50 AS int)), '\"') "
    "WHEN 3 THEN 'x, \"y\"' WHEN 4 THEN concat(o_orderpriority, chr(13), chr(10), o_orderstatus) ELSE o_orderpriority END"
)

# Change messages with planted fields: a name that no schema has, an object with a list, a count as
# text or with decimals, a price as a number, an object for a brand; some are deletes, null or broken.
FIELD_CHANGE = (
    "CASE WHEN p_partkey % 20 = 11 THEN NULL WHEN p_partkey % 20 = 12 THEN '{bad' "
    "WHEN p_partkey % 20 = 13 THEN '{\"payload\":{\"op\":\"d\",\"before\":{\"id\":\"1\"},\"after\":null}}' "
    "ELSE concat('{\"payload\":{\"op\":\"c\",\"after\":{\"id\":\"', cast(p_partkey AS string), '\"', "
    "CASE WHEN p_partkey % 5 = 0 THEN ',\"colour\":\"red\"' ELSE '' END, "
    "CASE WHEN p_partkey % 7 = 0 THEN ',\"maker\":{\"tags\":[1,2,\"x\"],\"none\":{}}' ELSE '' END, "
    "',\"review_count\":', CASE p_partkey % 3 WHEN 0 THEN '\"3\"' WHEN 1 THEN '2.5' ELSE '4' END, "
    "',\"price\":', CASE WHEN p_partkey % 4 = 0 THEN '7' ELSE '\"nA==\"' END, "
    "',\"brand\":', CASE WHEN p_partkey % 9 = 0 THEN '{\"en\":\"b\"}' ELSE 'null' END, '}}}') END"
)

# A key of which a third is one value, a seventh is null and the rest grows with the fourth power.
SKEWED_KEY = (
    "CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_linenumber = 7 THEN NULL "
    "ELSE cast(l_quantity * l_quantity * l_quantity * l_quantity AS bigint) * 1000 + l_partkey % 1000 END"
)

# Prices as text, some no numbers.
TEXT_ORIGINAL = "CASE WHEN p_partkey % 9 = 0 THEN 'N/A' ELSE cast(p_retailprice AS string) END"
TEXT_PRICE = "CASE WHEN p_partkey % 11 = 0 THEN '' ELSE cast(p_size AS string) END"

# Product events from the events table.
EVENT_PRODUCTS = {
    "event_id": "event_id",
    "ts": "ts",
    "product_id": "user_id",
    "name": "event_type",
    "price": "floor(value * 4) / 4",
    "fulfillment_type": "props",
    "brand": "CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('Brand#', cast(user_id % 25 AS string)) END",
    "review_count": "user_id % 100",
    "rating_average": "cast(user_id % 11 AS double) / 2",
    "current_seller": "concat('seller \"', cast(user_id % 9 AS string), '\"')",
    "category": "event_type",
    "quantity_sold": "user_id % 50",
}


# Schemas of events by product id: of id 0 all fields, of id 1 an older one with fewer and narrower
# fields, of id 2 a newer one with unions and another name. Id 3 has none.
EVENT_SCHEMAS = {
    "0": [("name", "string"), ("price", "float"), ("brand", ["null", "string"]), ("review_count", "int"), ("category", "string")],
    "1": [("name", "string"), ("price", "int"), ("brand", ["null", "string"]), ("quantity_sold", "int")],
    "2": [("name", "string"), ("price", ["int", "double"]), ("brand", ["null", "string"]), ("reviews", ["null", "int"]),
          ("category", "string")],
}
EVENT_READER = [
    {"name": "product_id", "type": "string"}, {"name": "name", "type": "string"}, {"name": "price", "type": "double"},
    {"name": "brand", "type": ["null", "string"], "default": None},
    {"name": "review_count", "type": ["null", "long"], "aliases": ["reviews"], "default": None},
    {"name": "category", "type": "string", "default": "unknown"},
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(f"{text} AS {name}" for name, text in columns.items()))


def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_table_discount(derived(table(spark, sf_dir, "part"), PART_PRODUCTS))


def line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_table_discount(derived(table(spark, sf_dir, "lineitem"), LINE_PRODUCTS))


def with_table_discount(products: DataFrame) -> DataFrame:
    return with_discount(products).withColumn(
        "discount", F.col("discount").try_cast(TABLE["discount"].dataType)
    )


def raw_products(products: DataFrame) -> DataFrame:
    """Products as the raw file has them: six more columns, no discount."""
    extra = {name: F.lit("-") for name in RAW_ONLY_COLUMNS}
    return products.drop("seq", "discount").withColumns(extra)


def row_images(products: DataFrame) -> DataFrame:
    """Products as change messages carry them: decimals as base64 text."""
    return encode_columns(products, DECIMAL_COLUMNS)


def _message(after: Column | None, before: Column | None, op: Column | str) -> Column:
    parts = []
    if after is not None:
        parts.append(after.alias("after"))
    if before is not None:
        parts.append(before.alias("before"))
    parts.append((F.lit(op) if isinstance(op, str) else op).alias("op"))
    payload = F.struct(F.struct(*parts).alias("payload"))
    return F.to_json(payload, {"ignoreNullFields": "false"})


def change_topic(products: DataFrame, orders_every: int | None = None) -> DataFrame:
    """Topic rows of products: by ``seq % 10``, 0 to 6 row images, 7 malformed text,
    8 a null value, 9 a delete. With ``orders_every`` some belong to another table."""
    kind = F.col("seq") % 10
    op = F.when(kind == 0, "u").otherwise("c")
    value = (
        F.when(kind == 7, "{bad")
        .when(kind == 8, F.lit(None))
        .when(kind == 9, _message(None, F.struct("id"), "d"))
        .otherwise(_message(F.struct(*PRODUCT_COLUMNS), None, op))
    )
    server, schema, name = CHANGE_TOPIC
    other = F.col("seq") % orders_every == 0 if orders_every else F.lit(False)
    source = F.when(other, "orders").otherwise(name)
    rows = row_images(products).select(
        text_to_bytes(F.col("seq").cast("string")).alias("key"),
        text_to_bytes(value).alias("value"),
        (F.col("seq") % 4).cast("int").alias("partition"),
        F.col("seq").cast("bigint").alias("offset"),
        F.timestamp_seconds(F.col("seq") + 1704067200).alias("timestamp"),
        F.lit(0).alias("timestampType"),
        source.alias("_table"),
    )
    return routed(rows, server, schema, F.col("_table")).select(*TOPIC_ROW.names)


def as_topic(messages: DataFrame) -> DataFrame:
    """Topic rows of ``seq`` and ``value`` (text)."""
    seq = F.col("seq")
    rows = messages.select(
        text_to_bytes(seq.cast("string")).alias("key"), text_to_bytes(F.col("value")).alias("value"),
        (seq % 4).cast("int").alias("partition"), seq.cast("bigint").alias("offset"),
        F.timestamp_seconds(seq + 1704067200).alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    return routed(rows, *CHANGE_TOPIC).select(*TOPIC_ROW.names)
