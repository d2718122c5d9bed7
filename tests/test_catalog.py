import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import fixtures as fx
from checks.queries import QUERIES
from sluiceway.plans import catalog
from sluiceway.schemas import LAKE_ROW, PRODUCT_COLUMNS, plain
from sluiceway.sources.lake import read_lake, write_lake
from sluiceway.streaming.changes import Sink, start_append, wait

SMALL = StructType([LAKE_ROW["id"], LAKE_ROW["price"], LAKE_ROW["brand"]])


@pytest.fixture
def rows(spark):
    return spark.range(40).select(
        F.col("id").cast("string").alias("id"),
        F.col("id").cast("decimal(12,2)").alias("price"),
        F.when(F.col("id") % 4 > 0, F.format_string("00%d", F.col("id") % 4)).alias("brand"),
    )


def test_typed_table(spark, database):
    name = f"{database}.products"
    catalog.recreate_table(spark, name)
    catalog.recreate_table(spark, name)
    assert catalog.table_columns(spark, name) == list(PRODUCT_COLUMNS)
    shown = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE {name}").collect()}
    assert (shown["id"], shown["price"], shown["discount"]) == ("varchar(50)", "decimal(10,2)", "decimal(5,2)")


def test_append_binds_by_position(spark, database):
    name = f"{database}.t"
    catalog.recreate_table(spark, name, SMALL)
    df = spark.createDataFrame([("1", 2, "b")], "brand string, x int, id string")
    catalog.append_rows(df, name)
    assert spark.table(name).first().asDict() == {"id": "1", "price": 2, "brand": "b"}
    with pytest.raises(ValueError, match="2 source columns"):
        catalog.append_rows(df.drop("x"), name)


def test_written_location(spark, database, rows, tmp_path, plan):
    name, path = f"{database}.t", str(tmp_path / "lake")
    write_lake(rows, path)
    for _ in range(2):
        catalog.register_table(spark, name, path, SMALL)
    assert spark.table(name).count() == 40
    assert dict(spark.table(name).dtypes)["brand"] == "string"
    one = catalog.run_sql(spark, f"SELECT id FROM {name} WHERE brand = :b", b="001")
    assert one.count() == 10
    assert "PartitionFilters: [isnotnull(brand" in plan(one)
    assert spark.table(name).where("brand IS NULL").count() == 10
    write_lake(rows.withColumn("brand", F.lit("new")), path)
    catalog.refresh_table(spark, name)
    assert spark.table(name).count() == 80


def test_streamed_location(spark, database, rows, tmp_path, plan, settings):
    name, path = f"{database}.t", str(tmp_path / "lake")
    rows.write.parquet(str(tmp_path / "source"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "source"))
    sink = Sink(path, str(tmp_path / "checkpoint"), until_caught_up=True)
    wait(start_append(arriving, sink, "brand"), timeout=300)
    assert {r.brand for r in read_lake(spark, path, schema=SMALL).collect()} == {None, "001", "002", "003"}

    settings(spark__sql__sources__partitionColumnTypeInference__enabled="true")
    with pytest.raises(ValueError, match="guessed from directory names"):
        catalog.register_table(spark, name, path, SMALL)
    settings(spark__sql__sources__partitionColumnTypeInference__enabled="false")
    catalog.register_table(spark, name, path, SMALL)
    assert spark.table(name).count() == 40
    one = spark.table(name).where("brand = '001'")
    assert one.count() == 10
    assert "PartitionFilters: [isnotnull(brand" in plan(one)

    write_more = rows.withColumn("brand", F.lit("new"))
    write_more.write.mode("append").parquet(str(tmp_path / "source"))
    wait(start_append(arriving, sink, "brand"), timeout=300)
    catalog.refresh_table(spark, name)
    assert spark.table(name).count() == 80


def test_double_view(spark, database, rows, tmp_path):
    write_lake(rows, str(tmp_path / "lake"))
    catalog.register_table(spark, f"{database}.t", str(tmp_path / "lake"), SMALL)
    catalog.double_view(spark, f"{database}.v", f"{database}.t")
    assert dict(spark.table(f"{database}.v").dtypes)["price"] == "double"
    assert spark.table(f"{database}.v").agg(F.sum("price")).first()[0] == 780.0


def test_view_of_a_stream(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "source"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "source"))
    viewed = catalog.as_view(arriving, "arriving")
    assert viewed.isStreaming and viewed.columns == rows.columns


def test_view_adds_nothing_to_the_plan(spark, sf_dir, plan):
    df = fx.part_products(spark, sf_dir)
    physical = plan(catalog.as_view(df, "products_view")).split("Physical Plan")[1]
    assert "SubqueryAlias" not in physical and "Exchange" not in physical


def test_quotes_in_a_location(spark, tmp_path):
    catalog.create_database(spark, "quoted", str(tmp_path / "it's"))
    assert spark.catalog.getDatabase("quoted").locationUri.endswith("it's")


def test_existing_tables_are_never_dropped(spark, database, rows, tmp_path):
    name = f"{database}.t"
    spark.sql(f"CREATE TABLE {name} (id int) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES (1)")
    with pytest.raises(ValueError, match="left as it is"):
        catalog.register_table(spark, name, str(tmp_path / "lake"), SMALL)
    assert spark.table(name).count() == 1
    other, place = f"{database}.u", str(tmp_path / "lake")
    write_lake(rows, place)
    catalog.register_table(spark, other, place, SMALL)
    catalog.register_table(spark, other, place, SMALL)
    with pytest.raises(ValueError, match="location"):
        catalog.register_table(spark, other, str(tmp_path / "elsewhere"), SMALL)
    with pytest.raises(ValueError, match="types"):
        catalog.register_table(spark, other, place, StructType([*SMALL.fields, StructField("more", StringType())]))
    assert spark.table(other).count() == rows.count()


def test_recreated_table_is_empty(spark, database, tmp_path):
    for by_load in (False, True):
        name, place = f"{database}.r{int(by_load)}", str(tmp_path / f"r{int(by_load)}")
        for _ in range(2):
            catalog.recreate_table(spark, name, SMALL, location=place, by_load=by_load)
            assert spark.table(name).count() == 0
            filled = spark.createDataFrame([], plain(SMALL)).schema
            row = spark.createDataFrame([tuple(None for _ in filled)], filled)
            catalog.replace_load(row, name, "a") if by_load else catalog.append_rows(row, name)
            assert spark.table(name).count() == 1


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_recreated_table_by_load_stays_empty(spark, database, tmp_path, settings, mode):
    """Files of a table that was dropped are gone, not only hidden until the next refresh."""
    settings(spark__sql__sources__partitionOverwriteMode=mode)
    name, place = f"{database}.again", str(tmp_path / "again")
    catalog.recreate_table(spark, name, SMALL, location=place, by_load=True)
    row = spark.range(10).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in catalog.plain(SMALL)))
    catalog.replace_load(row, name, "a")
    assert catalog.load_rows(spark, name, "a") == 10
    spark.sql(f"DROP TABLE {name}")
    catalog.recreate_table(spark, name, SMALL, location=place, by_load=True)
    assert spark.table(name).count() == 0
    catalog.refresh_table(spark, name)
    assert spark.table(name).count() == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_joined_table_prunes_partitions_at_run_time(spark, sf_dir, plan):
    found = QUERIES["lake_dynamic_prune"](spark, sf_dir)
    named = spark.read.parquet(f"{sf_dir}/nation.parquet").where("n_regionkey = 1").select(F.concat(F.lit("Brand#"), "n_nationkey"))
    brands = {row[0] for row in found.select("brand").distinct().collect()}
    assert brands and brands <= {row[0] for row in named.collect()}
    found.collect()
    final = plan(found).split("== Physical Plan ==")[1].split("Initial Plan")[0]
    assert "PartitionFilters: [isnotnull(brand" in final and "dynamicpruning" in final


def test_locations_differ_by_file_system(spark):
    place = catalog._place(spark, "/lake/x/")
    assert place == catalog._place(spark, "file:/lake/x") == catalog._place(spark, "file:///lake/x")
    assert place != catalog._place(spark, "s3a://lake/x") != catalog._place(spark, "s3a://other/x")


def test_a_table_made_meanwhile_stays(spark, database, rows, tmp_path, monkeypatch):
    name, path = f"{database}.raced", str(tmp_path / "lake")
    write_lake(rows, path)
    guessed = catalog._guessed_types

    def raced(*args):
        spark.sql(f"CREATE TABLE {name} (id STRING) USING parquet")
        return guessed(*args)

    monkeypatch.setattr(catalog, "_guessed_types", raced)
    with pytest.raises(ValueError, match="left as it is"):
        catalog.register_table(spark, name, path, SMALL)
    assert spark.table(name).columns == ["id"]
    assert [t.name for t in spark.catalog.listTables(database) if t.name.startswith("raced")] == ["raced"]
