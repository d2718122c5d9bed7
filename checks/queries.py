"""One query per operator. Each runs over whole tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks import fixtures as fx
from checks.scratch import fresh_folder
from sluiceway.functions.decimals import decode_columns, encode_columns
from sluiceway.functions.expressions import (
    bytes_to_text,
    discount_percent,
    event_time_text,
    text_to_bytes,
)
from sluiceway.operators import change_events as changes
from sluiceway.operators import constraints, event_schemas, field_census, product_events, products
from sluiceway.plans import catalog, compaction, jobs
from sluiceway.plans.ledger import Ledger
from sluiceway.schemas import (
    DECIMAL_COLUMNS,
    DOUBLE_ROW,
    EVENT,
    LAKE_DECIMAL,
    PRODUCT_COLUMNS,
    RAW_ROW,
    REJECT_ROW,
    TABLE,
    TOPIC_ROW,
)
from sluiceway.sources.avro_schema import Record, parse_record, read_avro_schema, to_avro_schema
from sluiceway.sources.csv import read_csv, read_csv_head, write_csv
from sluiceway.sources.csv_records import read_csv_records
from sluiceway.sources import splits
from sluiceway.sources.lake import differing_partitions, read_lake, write_lake
from sluiceway.sources.topic import read_topic, write_topic
from sluiceway.streaming.changes import (
    Sink,
    append_changes,
    append_rejects,
    append_routed,
    routed_rejects,
    routed_table,
    start_append,
    wait,
)
from sluiceway.streaming.offsets import trace_offsets, traced_gaps
from sluiceway.streaming.replay import replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# -- files ---------------------------------------------------------------------


def _csv_copy(spark: SparkSession, df: DataFrame) -> tuple[str, StructType]:
    path = fresh_folder(spark)
    write_csv(df, path)
    return path, df.schema


@query
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _csv_copy(spark, fx.table(spark, sf_dir, "part"))
    return read_csv(spark, path, schema)


@query
def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, fx.table(spark, sf_dir, "part"))
    return read_csv(spark, path)


@query
def csv_head_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of several files that are in order of the key."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    files = orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
    path, schema = _csv_copy(spark, files)
    return read_csv_head(spark, path, fx.LOAD_ROWS, schema)


@query
def csv_scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path, schema = _csv_copy(spark, orders)
    return read_csv_head(spark, path, fx.LOAD_ROWS, schema, order_by="o_orderkey")


@query
def csv_multiline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with line breaks, read in splits; blocks are small enough for records to cross them."""
    notes = fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{fx.NOTE} AS note", "o_totalprice").coalesce(2)
    path, schema = _csv_copy(spark, notes)
    return read_csv_records(spark, path, schema)


def _raw_file(spark: SparkSession, sf_dir: str) -> str:
    raw = fx.raw_products(fx.part_products(spark, sf_dir)).select(*RAW_ROW.names)
    return _csv_copy(spark, raw)[0]


@query
def csv_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = fresh_folder(spark)
    jobs.clean_product_file(spark, _raw_file(spark, sf_dir), cleaned, RAW_ROW, files=1)
    return read_csv(spark, cleaned, DOUBLE_ROW)


# -- projections and expressions -------------------------------------------------


@query
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.drop_raw_columns(fx.raw_products(fx.part_products(spark, sf_dir)))


@query
def trim_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.trim_fulfillment(
        fx.part_products(spark, sf_dir).select("id", "fulfillment_type")
    )


@query
def discount_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.with_discount(
        fx.part_products(spark, sf_dir).select("id", "original_price", "price")
    ).withColumn("discount", F.col("discount").try_cast(LAKE_DECIMAL))


@query
def discount_pct_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text, some of which are no numbers."""
    part = fx.table(spark, sf_dir, "part")
    prices = part.selectExpr("p_partkey AS id", f"{fx.TEXT_ORIGINAL} AS original_price", f"{fx.TEXT_PRICE} AS price")
    cut = products.with_discount(prices)
    return cut.select("id", F.col("discount").try_cast(LAKE_DECIMAL).alias("discount"))


@query
def discount_pct_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = discount_percent(
        F.col("l_extendedprice"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    )
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", cut.try_cast(LAKE_DECIMAL).alias("discount")
    )


@query
def positional_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS)
    unnamed = rows.toDF(*(f"_c{i}" for i in range(len(PRODUCT_COLUMNS))))
    return products.bind_by_position(unnamed, PRODUCT_COLUMNS)


@query
def timestamp_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events").select(
        "event_id", event_time_text(F.col("ts")).alias("created")
    )


# -- constraints and typed tables ------------------------------------------------


def _checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    return constraints.check_constraints(orders)


@query
def constraint_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_orders(spark, sf_dir).select("id", constraints.REASON)


@query
def constraint_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.accepted(_checked_orders(spark, sf_dir))


@query
def constraint_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.rejected(_checked_orders(spark, sf_dir)).select(
        "id", "name", "number_of_images", constraints.REASON
    )


@query
def constraint_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.reason_counts(_checked_orders(spark, sf_dir))


def _database(spark: SparkSession) -> str:
    name = f"lake_{uuid.uuid4().hex[:12]}"
    catalog.create_database(spark, name, fresh_folder(spark))
    return name


@query
def typed_table_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, place = f"{_database(spark)}.products", fresh_folder(spark)
    for _ in range(2):  # the second one drops what the first one made, files included
        catalog.recreate_table(spark, name, location=place)
        catalog.append_rows(fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS), name)
    return spark.table(name)


@query
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_database(spark)}.products"
    catalog.recreate_table(spark, name, location=fresh_folder(spark))
    jobs.load_catalog_table(
        fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS), name
    )
    jobs.load_catalog_table(
        fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS), name
    )
    return spark.table(name)


@query
def load_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, one of which is made twice under its id."""
    name, rejects = f"{_database(spark)}.products", fresh_folder(spark)
    catalog.recreate_table(spark, name, location=fresh_folder(spark), by_load=True)
    orders = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    for load_id in ("orders", "orders"):
        jobs.load_catalog_table(orders, name, rejects, load_id)
    jobs.load_catalog_table(fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS), name, rejects, "parts")
    return spark.table(name).drop(catalog.LOAD)


def _portions(spark: SparkSession, rows: DataFrame, count: int) -> str:
    """Rows as so many files. A row group is the least that a task reads, so small ones let all cores load a file."""
    path = fresh_folder(spark)
    rows.repartition(count).write.option("parquet.block.size", 4 << 20).parquet(path)
    return path


@query
def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two paced loads into one table, the second made twice: what the ledger says of each."""
    base = _database(spark)
    name, rejects = f"{base}.products", fresh_folder(spark)
    catalog.recreate_table(spark, name, location=fresh_folder(spark), by_load=True)
    ledger = Ledger.open(spark, f"{base}.loads", fresh_folder(spark))
    orders = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    parts = fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS)
    for source, rows in (("orders", orders), ("parts", parts), ("parts", None)):
        if rows is not None:
            path, schema = _portions(spark, rows, 3), rows.schema
        arriving = replay(spark, path, schema, "parquet", files_per_batch=1)
        wait(jobs.start_paced_load(
            arriving, lambda portion, load: jobs.load_catalog_table(portion, name, rejects, load, ledger),
            fresh_folder(spark), source=source))
    in_table = spark.table(name).groupBy(F.regexp_replace(catalog.LOAD, "_[0-9]+$", "").alias("source")).agg(
        F.count("*").alias("rows_in_table"))
    return ledger.by_source().join(in_table, "source")


@query
def product_file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file whose cells and rows are broken in several ways: what is kept aside, and why."""
    path = fresh_folder(spark)
    fx.table(spark, sf_dir, "orders").selectExpr(f"{fx.BROKEN_LINE} AS line").write.text(path)
    rows = jobs.read_products(spark, path, TABLE, header=False)
    kept = jobs.checked_products(rows).rejected
    return kept.select("id", "review_count", "price", constraints.REASON)


@query
def product_file_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark)
    fx.table(spark, sf_dir, "orders").selectExpr(f"{fx.BROKEN_LINE} AS line").write.text(path)
    rows = jobs.read_products(spark, path, TABLE, header=False)
    return jobs.checked_products(rows).accepted.select("id", "price", "review_count")


@query
def product_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned, rejects = fresh_folder(spark), fresh_folder(spark)
    jobs.clean_product_file(spark, _raw_file(spark, sf_dir), cleaned, RAW_ROW)
    name = f"{_database(spark)}.products"
    catalog.recreate_table(spark, name, location=fresh_folder(spark))
    jobs.load_catalog_table(jobs.read_products(spark, cleaned, DOUBLE_ROW), name, rejects)
    return spark.table(name)


@query
def product_file_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw file with broken rows, cleaned and loaded: every line and where it went."""
    raw, cleaned, unread, rejects = (fresh_folder(spark) for _ in range(4))
    fx.derived(fx.table(spark, sf_dir, "orders"), {"value": fx.BROKEN_RAW_LINE}).write.text(raw)
    jobs.clean_product_file(spark, raw, cleaned, RAW_ROW, rejects_path=unread, header=False)
    name = f"{_database(spark)}.products"
    catalog.recreate_table(spark, name, location=fresh_folder(spark))
    jobs.load_catalog_table(jobs.read_products(spark, cleaned, DOUBLE_ROW), name, rejects)
    cells = [F.col(column).cast("string") for column in ("id", "price", "review_count", "discount")]
    loaded = spark.table(name).select(*cells, F.lit(None).cast("string").alias("line"), F.lit("ok").alias("reason"))
    refused = [
        spark.read.parquet(path).select(*cells, F.col(constraints.CORRUPT).alias("line"), constraints.REASON)
        for path in (unread, rejects)
    ]
    return loaded.union(refused[0]).union(refused[1])


# -- change messages -------------------------------------------------------------


REPLAY_FILES = 6


def _part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.change_topic(fx.part_products(spark, sf_dir))


def _line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.change_topic(fx.line_products(spark, sf_dir))


@query
def cdc_value_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.table(spark, sf_dir, "documents")
    return documents.select("doc_id", text_to_bytes(F.col("text")).alias("value")).select(
        "doc_id", bytes_to_text(F.col("value")).alias("text")
    )


@query
def cdc_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = fx.change_topic(fx.part_products(spark, sf_dir), orders_every=4)
    return changes.of_tables(topic).select(
        bytes_to_text(F.col("key")).alias("key"), "topic", "partition", "offset"
    )


@query
def cdc_flatten_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = changes.images_raw(_part_changes(spark, sf_dir))
    return changes.decoded(images)


@query
def cdc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.classified(_part_changes(spark, sf_dir)).select(
        bytes_to_text(F.col("key")).alias("key"), "kind"
    )


@query
def cdc_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = [name for name in PRODUCT_COLUMNS if name not in DECIMAL_COLUMNS]
    return changes.images(_part_changes(spark, sf_dir)).select(*plain)


@query
def cdc_decode_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.decoded(fx.row_images(fx.part_products(spark, sf_dir)).select(*PRODUCT_COLUMNS))


@query
def cdc_decode_unsigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = fx.row_images(fx.part_products(spark, sf_dir))
    return changes.decoded(images, signed=False).select("id", *DECIMAL_COLUMNS)


@query
def cdc_decode_decimals_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.table_rows(_line_changes(spark, sf_dir))


@query
def decimal_codec_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("l_extendedprice").cast(LAKE_DECIMAL)
    values = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") % 2 == 0, -value).otherwise(value).alias("price"),
        (F.col("l_discount").cast(LAKE_DECIMAL) - F.col("l_tax").cast(LAKE_DECIMAL)).alias("margin"),
    )
    return decode_columns(encode_columns(values, ["price", "margin"]), ["price", "margin"])


# -- streams ----------------------------------------------------------------------


def _captured(spark: SparkSession, topic: DataFrame) -> str:
    path = fresh_folder(spark)
    topic.write.parquet(path)
    return path


def _sink(spark: SparkSession) -> Sink:
    folder = fresh_folder(spark)
    return Sink(f"{folder}/data", f"{folder}/checkpoint", until_caught_up=True)


def _append(spark: SparkSession, captured: str, sink: Sink) -> None:
    topic = read_topic(spark, path=captured, format="parquet")
    wait(append_changes(topic, sink))


@query
def cdc_topic_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = _captured(spark, _part_changes(spark, sf_dir))
    sink = _sink(spark)
    topic = read_topic(spark, path=captured, format="parquet")
    wait(start_append(topic, sink))
    return spark.read.schema(TOPIC_ROW).parquet(sink.path).select(
        bytes_to_text(F.col("key")).alias("key"),
        F.col("value").isNull().alias("value_is_null"),
        "topic", "partition", "offset",
        F.unix_seconds("timestamp").alias("sent_at"),
        F.col("timestampType").alias("timestamp_type"),
    )


@query
def cdc_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _sink(spark)
    _append(spark, _captured(spark, _part_changes(spark, sf_dir)), sink)
    return read_lake(spark, sink.path)


@query
def cdc_stream_append_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _sink(spark)
    _append(spark, _captured(spark, _line_changes(spark, sf_dir)), sink)
    return read_lake(spark, sink.path)


@query
def cdc_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages arrive in two lots; the stream runs after each, and once for nothing."""
    sink, captured = _sink(spark), fresh_folder(spark)
    messages = _part_changes(spark, sf_dir)
    for lot in (0, 1):
        messages.where(F.col("partition") % 2 == lot).write.mode("append").parquet(captured)
        _append(spark, captured, sink)
    _append(spark, captured, sink)
    return read_lake(spark, sink.path)


@query
def cdc_stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = _captured(spark, _part_changes(spark, sf_dir))
    sink = _sink(spark)
    topic = read_topic(spark, path=captured, format="parquet")
    wait(append_rejects(topic, sink))
    return read_lake(spark, sink.path, schema=REJECT_ROW).select(
        bytes_to_text(F.col("key")).alias("key"),
        bytes_to_text(F.col("value")).alias("value"),
        "kind",
    )


def _broken_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    return fx.as_topic(orders.selectExpr("o_orderkey AS seq", f"{fx.BROKEN_CHANGE} AS value"))


@query
def cdc_undecodable_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row messages with a value that is lost in parsing or decoding."""
    return changes.rejects(_broken_changes(spark, sf_dir)).select(
        bytes_to_text(F.col("key")).alias("key"), "kind"
    )


@query
def cdc_undecodable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.table_rows(_broken_changes(spark, sf_dir)).select("id", "price", "review_count")


@query
def cdc_batch_stream_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that only the batch or only the stream wrote, copies counted."""
    captured = _captured(spark, _part_changes(spark, sf_dir))
    streamed = _sink(spark)
    _append(spark, captured, streamed)
    batch = _sink(spark)
    append_changes(
        read_topic(spark, path=captured, format="parquet", streaming=False), batch
    )
    sides = read_lake(spark, batch.path).withColumn("side", F.lit(1)).unionByName(
        read_lake(spark, streamed.path).withColumn("side", F.lit(-1))
    )
    excess = sides.groupBy(*PRODUCT_COLUMNS).agg(
        F.sum("side").alias("excess"), F.count(F.when(F.col("side") == 1, 1)).alias("copies")
    )
    return excess.agg(
        F.sum("copies").alias("batch_rows"),
        F.sum(F.greatest("excess", F.lit(0))).alias("only_batch"),
        F.sum(F.greatest(-F.col("excess"), F.lit(0))).alias("only_stream"),
    )


@query
def replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of orders replayed in portions and appended as they arrive."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path, schema = _csv_copy(spark, orders.repartitionByRange(REPLAY_FILES, "o_orderkey"))
    sink = _sink(spark)
    arriving = replay(spark, path, schema, files_per_batch=2)
    wait(start_append(arriving, sink))
    return spark.read.schema(schema).parquet(sink.path)


# -- lake table and SQL -------------------------------------------------------------


def _streamed_table(spark: SparkSession, sf_dir: str) -> str:
    sink = _sink(spark)
    _append(spark, _captured(spark, _part_changes(spark, sf_dir)), sink)
    name = f"{_database(spark)}.products"
    catalog.register_table(spark, name, sink.path)
    return name


def _written_table(spark: SparkSession, df: DataFrame) -> str:
    path = fresh_folder(spark)
    write_lake(df.select(*PRODUCT_COLUMNS), path)
    name = f"{_database(spark)}.products"
    catalog.register_table(spark, name, path, schema=df.select(*PRODUCT_COLUMNS).schema)
    return name


@query
def lake_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_streamed_table(spark, sf_dir))


@query
def lake_double_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _streamed_table(spark, sf_dir)
    catalog.double_view(spark, f"{name}_double", name)
    return spark.table(f"{name}_double")


@query
def lake_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _written_table(spark, fx.line_products(spark, sf_dir))
    return catalog.run_sql(
        spark, f"SELECT id, price, brand FROM {name} WHERE brand = :brand", brand="Brand#1"
    )


@query
def lake_adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _written_table(spark, fx.line_products(spark, sf_dir))
    return catalog.run_sql(spark, f"""
        SELECT brand, count(*) AS row_count, sum(price) AS total_price, max(discount) AS max_discount
        FROM {name} GROUP BY brand""")


@query
def view_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.as_view(changes.table_rows(_part_changes(spark, sf_dir)), "products_view")


# -- product events -------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.derived(fx.table(spark, sf_dir, "events"), fx.EVENT_PRODUCTS)


@query
def cdc_routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's part of a location that one stream fills with rows and rejects."""
    return routed_table(spark, _routed(spark, sf_dir))


@query
def cdc_routed_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_rejects(spark, _routed(spark, sf_dir)).select(
        bytes_to_text(F.col("key")).alias("key"), bytes_to_text(F.col("value")).alias("value"), "kind")


def _routed(spark: SparkSession, sf_dir: str) -> str:
    sink = _sink(spark)
    wait(append_routed(read_topic(spark, path=_captured(spark, _part_changes(spark, sf_dir)), format="parquet"), sink))
    return sink.path


@query
def lake_digest_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions in which a streamed table differs from the batch: one row was lost, one came twice."""
    topic = _part_changes(spark, sf_dir)
    sink = _sink(spark)
    _append(spark, _captured(spark, topic), sink)
    batch, streamed = changes.table_rows(topic), read_lake(spark, sink.path)
    lost, twice = (streamed.agg(F.min_by("id", F.struct(F.length("id"), "id")), F.max_by("id", F.struct(F.length("id"), "id"))).first())
    damaged = streamed.where(F.col("id") != lost).unionByName(streamed.where(F.col("id") == twice))
    whole = differing_partitions(batch, streamed).withColumn("table", F.lit("streamed"))
    return whole.unionByName(differing_partitions(batch, damaged).withColumn("table", F.lit("damaged")))


@query
def split_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen splits of a skewed key with nulls: how many rows meet none or several, and whether they are even."""
    parts = 16
    name = f"{_database(spark)}.lines"
    lines = fx.table(spark, sf_dir, "lineitem").selectExpr(f"{fx.SKEWED_KEY} AS k", "l_orderkey * 8 + l_linenumber AS line")
    lines.write.option("path", fresh_folder(spark)).saveAsTable(name)
    table = spark.table(name)
    predicates = splits.split_predicates(table, "k", parts, second="line")
    met = [F.when(F.expr(one), 1).otherwise(0) for one in predicates]
    hits = F.array(*met)
    counts = F.array(*(F.sum(one) for one in met))
    return table.agg(
        F.count("*").alias("row_count"),
        F.count(F.when(F.aggregate(hits, F.lit(0), lambda a, b: a + b) != 1, 1)).alias("rows_not_in_one"),
        (F.array_max(counts) <= 1.2 * F.count("*") / parts).alias("even"),
    )


@query
def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many small files, streamed in eight batches, packed into few and shown by its view."""
    sink = _sink(spark)
    path = fresh_folder(spark)
    _part_changes(spark, sf_dir).repartition(8).write.parquet(path)
    wait(append_changes(read_topic(spark, path=path, format="parquet", maxFilesPerTrigger="1"), sink))
    view = f"{_database(spark)}.products"
    version = compaction.publish_compacted(spark, view, sink.path, fresh_folder(spark), target_bytes=1 << 20)
    files = spark.table(version).select("brand", "_metadata.file_path").distinct().groupBy("brand").count()
    most = files.agg(F.max("count").alias("most_files"))
    rows = spark.table(view).groupBy("brand").agg(F.count("*").alias("row_count"), F.sum("price").cast("decimal(20,2)").alias("total_price"))
    few = F.broadcast(most.select((F.col("most_files") == 1).alias("one_file")))  # a single row
    return rows.join(few, F.lit(True), "left")


@query
def lake_dynamic_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of brands that a filtered table names; only their partitions are read."""
    name = _written_table(spark, fx.line_products(spark, sf_dir))
    brands = fx.table(spark, sf_dir, "nation").selectExpr("concat('Brand#', n_nationkey) AS named", "n_regionkey")
    return spark.table(name).join(brands.where("n_regionkey = 1"), F.col("brand") == F.col("named")).select("id", "price", "brand")


@query
def cdc_field_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the messages hold, by path and type, against the declared change message; two batches added up."""
    parts = fx.table(spark, sf_dir, "part")
    halves = [fx.as_topic(parts.where(f"p_partkey % 2 = {half}").selectExpr("p_partkey AS seq", f"{fx.FIELD_CHANGE} AS value"))
              for half in (0, 1)]
    return field_census.against_schema(field_census.added(*map(field_census.field_census, halves)))


@query
def topic_offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets that expired before a stream of four batches read them; every file holds the one before it again."""
    path, trace = fresh_folder(spark), fresh_folder(spark)
    orders = fx.table(spark, sf_dir, "orders").where(f"NOT {fx.EXPIRED}")
    rows = fx.as_topic(orders.selectExpr("o_orderkey AS seq", "o_orderstatus AS value", "o_orderkey")).withColumns({
        "offset": F.expr(fx.OFFSET.replace("o_orderkey", "cast(cast(key AS string) AS bigint)")),
        "partition": F.expr("cast(cast(cast(key AS string) AS bigint) % 4 AS int)")})
    for part in range(4):
        rows.where(F.abs(F.hash("key")) % 5 <= part + 1).coalesce(1).write.mode("append").parquet(path)
    wait(trace_offsets(
        read_topic(spark, path=path, format="parquet", maxFilesPerTrigger="1"), trace, fresh_folder(spark)))
    return traced_gaps(spark, trace, earliest=0)


@query
def avro_schema_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark)
    text = F.lit(to_avro_schema(EVENT, "Products"))
    spark.range(1).select(text.alias("value")).write.text(path)
    declared = read_avro_schema(spark, path)
    return product_events.project_fields(fx.part_products(spark, sf_dir), declared)


def _events_of_ids(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Record], Record]:
    """Messages written by three schemas that are read from files, and what they are read by."""
    path, fields = fresh_folder(spark), [{"name": "product_id", "type": "string"}]
    for own, declared in fx.EVENT_SCHEMAS.items():
        record = {"type": "record", "name": f"Products{own}", "fields": [
            *fields, *({"name": name, "type": kind} for name, kind in declared)]}
        spark.range(1, numPartitions=1).select(F.lit(json.dumps(record)).alias("value")).write.text(f"{path}/products_schema_{own}.avsc")
    schemas = {}
    for own in fx.EVENT_SCHEMAS:
        schemas[own] = parse_record(spark.read.text(f"{path}/products_schema_{own}.avsc", wholetext=True).first()[0])
    events = _events(spark, sf_dir).withColumns({
        "product_id": F.col("product_id") % 4, "reviews": F.when(F.col("review_count") % 3 > 0, F.col("review_count"))})
    messages = event_schemas.messages_by_id(events, schemas, event_time_text(F.col("ts")))
    reader = parse_record(json.dumps({"type": "record", "name": "Read", "fields": fx.EVENT_READER}))
    return messages, schemas, reader


@query
def event_schema_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_schemas.events_by_id(*_events_of_ids(spark, sf_dir))


@query
def event_schema_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of an id without a schema, and those whose value was null where a value is due."""
    rejected = event_schemas.rejected_events(*_events_of_ids(spark, sf_dir))
    return rejected.groupBy(F.col("key").cast("string").alias("product_id"), "reason").agg(F.count("*").alias("row_count"))


@query
def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "event_id", product_events.event_json(event_time_text(F.col("ts"))).alias("value")
    )


@query
def event_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark)
    messages = product_events.event_messages(
        _events(spark, sf_dir), event_time_text(F.col("ts"))
    )
    write_topic(messages, path=path, format="parquet")
    return spark.read.schema("topic string, value binary").parquet(path).select(
        "topic", bytes_to_text(F.col("value")).alias("value")
    )
