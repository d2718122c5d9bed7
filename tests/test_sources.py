import json

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

from sluiceway.operators.product_events import bad_events, event_json, event_messages, project_fields
from sluiceway.plans import jobs
from sluiceway.schemas import EVENT, PRODUCT_COLUMNS, TABLE
from sluiceway.sources import csv, jdbc
from sluiceway.sources.avro_schema import parse_avro_schema, read_avro_schema, to_avro_schema
from sluiceway.sources.topic import kafka_options, read_topic, write_topic


# -- topics ------------------------------------------------------------------------


def test_kafka_options():
    assert kafka_options("a:1,b:2") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "sales.public.products",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    two = kafka_options("a:1", [("s", "p", "x"), ("s", "p", "y")], "latest", True)
    assert (two["subscribe"], two["startingOffsets"], two["failOnDataLoss"]) == ("s.p.x,s.p.y", "latest", "true")


def test_topic_needs_a_place(spark):
    with pytest.raises(ValueError, match="servers"):
        read_topic(spark)
    with pytest.raises(ValueError, match="path"):
        read_topic(spark, format="parquet")
    with pytest.raises(ValueError, match="servers"):
        write_topic(spark.range(1))


def test_kafka_reader_gets_all_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: (seen.update(o), self)[1])
    monkeypatch.setattr(DataFrameReader, "load", lambda self: "loaded")
    assert read_topic(spark, servers="a:1", streaming=False, minPartitions="64") == "loaded"
    assert seen == {**kafka_options("a:1"), "minPartitions": "64"}


def test_backlog_is_read_in_bounded_batches(spark):
    with pytest.raises(ValueError, match="maxOffsetsPerTrigger"):
        read_topic(spark, servers="a:1")


# -- declared schemas and events -----------------------------------------------------


def test_avro_schema(spark, tmp_path):
    text = to_avro_schema(EVENT, "Products")
    assert parse_avro_schema(text) == EVENT
    (tmp_path / "s.avsc").write_text(json.dumps(json.loads(text), indent=4))
    assert read_avro_schema(spark, str(tmp_path / "s.avsc")) == EVENT


def test_avro_unions_and_refusals():
    nullable = {"type": "record", "fields": [{"name": "a", "type": ["null", "int"]}]}
    assert parse_avro_schema(json.dumps(nullable)) == StructType([StructField("a", IntegerType())])
    for bad in ({"type": "enum"}, {"type": "record", "fields": [{"name": "a", "type": "fixed"}]}):
        with pytest.raises(ValueError):
            parse_avro_schema(json.dumps(bad))


def test_event_record(spark):
    df = spark.createDataFrame(
        [(7, "n", 1.5, None, "b", 3.0, 2.0, 's"', "c", 1)],
        "product_id int, name string, price double, fulfillment_type string, brand string, "
        "review_count double, rating_average double, current_seller string, category string, quantity_sold int",
    )
    message = event_messages(df, F.lit("2024-01-02 03:04:05")).first()
    record = json.loads(bytes(message.value).decode())
    assert message.topic == "product_input"
    assert record["schema"]["type"] == "struct"
    assert record["schema"]["fields"][:3] == [
        {"name": "product_id", "type": "string"}, {"name": "name", "type": "string"}, {"name": "price", "type": "float"},
    ]
    assert record["payload"]["created"] == "2024-01-02 03:04:05"
    assert record["payload"]["product_id"] == "7"
    assert record["payload"]["review_count"] == 3
    assert "fulfillment_type" in record["payload"] and record["payload"]["fulfillment_type"] is None
    assert set(record["payload"]) == {"created", *EVENT.names}
    assert df.select(event_json(F.lit("x"))).count() == 1


def test_projection_to_declared_fields(spark):
    df = spark.createDataFrame([(1, 2.5, "x", 4)], "product_id int, price double, name string, more int")
    declared = StructType([
        StructField("product_id", StringType()), StructField("price", FloatType()), StructField("name", StringType()),
    ])
    assert project_fields(df, declared).dtypes == [("price", "float"), ("name", "string")]
    assert project_fields(df, declared, exclude=()).dtypes[0] == ("product_id", "string")


# -- relational tables -----------------------------------------------------------------
# There is no database here: the JDBC calls are answered by a catalog table.


@pytest.fixture
def database_table(spark, database, monkeypatch):
    table = jdbc.JdbcTable("jdbc:none", f"{database}.products", {"user": "u", "password": "secret"})
    calls = []

    def read(self, url, name, **options):
        calls.append((name, options))
        return spark.sql(f"SELECT * FROM {name}")

    def write(self, url, name, mode=None, properties=None):
        calls.append((name, {"mode": mode}))
        frame = self._df
        if mode == "overwrite":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            frame.write.saveAsTable(name)
        else:
            frame.write.insertInto(name)

    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    monkeypatch.setattr(DataFrameWriter, "jdbc", write)
    return table, calls


def test_table_round_trip(spark, sf_dir, database_table):
    from checks import fixtures as fx

    table, _ = database_table
    jdbc.recreate_table(spark, table)
    assert jdbc.table_columns(spark, table) == list(PRODUCT_COLUMNS)
    rows = fx.part_products(spark, sf_dir).select(*PRODUCT_COLUMNS)
    jobs.load_jdbc_table(rows.toDF(*(f"c{i}" for i in range(14))), table)
    back = jdbc.read_table(spark, table, small=True)
    assert rows.count() == back.count() == jdbc.row_count(spark, table)
    assert back.exceptAll(rows).count() == 0


def test_rejects_of_a_load_are_kept(spark, sf_dir, database_table, tmp_path):
    from checks import fixtures as fx

    table, _ = database_table
    jdbc.recreate_table(spark, table)
    rows = fx.derived(fx.table(spark, sf_dir, "orders"), fx.ORDER_PRODUCTS)
    for _ in range(2):  # a repeated load replaces its own staging table and rejects
        jobs.load_jdbc_table(rows, table, str(tmp_path / "rejects"), load_id="7")
    sent = jdbc.row_count(spark, jdbc.staging_table(table, "7"))
    kept = spark.read.parquet(str(tmp_path / "rejects"))
    assert 0 < sent < rows.count()
    assert sent + kept.count() == rows.count()
    assert kept.where("reject_reason IS NULL OR reject_reason = 'ok'").count() == 0


def test_staging_names_are_plain():
    with pytest.raises(ValueError, match="load id"):
        jdbc.staging_table(jdbc.JdbcTable("u", "t"), "a; drop")


def test_one_task_reads_only_if_asked(spark, database_table):
    with pytest.raises(ValueError, match="small=True"):
        jdbc.read_table(spark, database_table[0])


def test_parallel_reads(spark, database_table):
    table, calls = database_table
    spark.range(5, 105).write.saveAsTable(table.name)
    jdbc.read_table(spark, table, split_on="id", partitions=8)
    assert calls[-1][1] == {
        "column": "id", "lowerBound": 5, "upperBound": 104, "numPartitions": 8, "properties": table.properties,
    }
    jdbc.read_table(spark, table, predicates=["a", "b"])
    assert calls[-1][1]["predicates"] == ["a", "b"]


def test_block_predicates_cover_every_block_once():
    def covers(predicate, block):
        low = int(predicate.split("'(")[1].split(",")[0])
        high = int(predicate.split("'(")[2].split(",")[0]) if "and" in predicate else None
        return low <= block and (high is None or block < high)

    for blocks, partitions in ((0, 4), (1, 4), (10, 4), (1000, 7)):
        predicates = jdbc.block_predicates(blocks, partitions)
        assert 1 <= len(predicates) <= partitions
        assert "and" not in predicates[-1]
        for block in range(blocks + 50):
            assert sum(covers(p, block) for p in predicates) == 1


def test_properties_are_not_shown():
    assert "secret" not in repr(jdbc.JdbcTable("u", "t", {"password": "secret"}))


def test_head_leaves_later_files_unread(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "files")
    spark.range(0, 40, 1, 4).write.csv(path, header=True)
    opened = []
    monkeypatch.setattr(csv, "read_csv", lambda s, files, *a, _read=csv.read_csv, **o: (opened.append(files), _read(s, files, *a, **o))[1])
    head = csv.read_csv_head(spark, path, 15, "id bigint")
    assert [r.id for r in head.collect()] == list(range(15))
    assert len(opened[-1]) == 2 and len({f for files in opened[1:] for f in files}) == 2
    assert csv.read_csv_head(spark, path, 0, "id bigint").count() == 0


def test_broken_file_rows_are_rejected_not_changed(spark, tmp_path):
    path = str(tmp_path / "lines")
    good = "1,n,20.00,12.50,f,b,5,1.5,1,s,2,c,3,4.5"
    lines = [good, good.replace("12.50", "abc"), good.replace(",5,", ",n/a,", 1), good.replace(",5,", ",3000000000,", 1),
             "2,n", good + ",surplus", '3,"a', 'b",20.00,12.50,f,b,5,1.5,1,s,2,c,3,4.5']
    spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1).write.text(path)
    checked = jobs.checked_products(jobs.read_products(spark, path, TABLE, header=False))
    assert [r.id for r in checked.accepted.collect()] == ["1"]
    reasons = sorted(r.reject_reason for r in checked.rejected.collect())
    assert len(reasons) == 7 and sum("corrupt record" in r for r in reasons) == 4


def test_several_schema_files_are_refused(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.avsc").write_text(to_avro_schema(StructType(EVENT.fields[:1]), "r"))
    with pytest.raises(ValueError, match="more than one"):
        read_avro_schema(spark, str(tmp_path))


def test_values_that_do_not_fit_become_null_and_are_found(spark):
    rows = spark.createDataFrame([("x", "7"), ("3", "8")], "review_count string, name string")
    schema = StructType([f for f in EVENT if f.name in ("review_count", "name")])
    assert [tuple(r) for r in project_fields(rows, schema).select("review_count", "name").collect()] == [(None, "7"), (3, "8")]
    assert [r.bad_fields for r in bad_events(rows, schema).collect()] == [["review_count"]]
