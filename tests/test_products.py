import pytest
from pyspark.sql import functions as F

from sluiceway.functions.expressions import event_time_text
from sluiceway.operators import products
from sluiceway.plans import jobs
from sluiceway.schemas import DOUBLE_ROW, PRODUCT_COLUMNS, RAW_ROW
from sluiceway.sources.csv import first_files, read_csv, read_csv_head, write_csv


@pytest.fixture
def raw(spark):
    row = ["0", "a1", " n, \"q\" ", 200.0, 150.0, "  dealer ", None, 1, 4.5, 2, "s", 3, "c", 4, "-", "-", "-", "-", "-"]
    zero = list(row)
    zero[1], zero[3] = "a2", 0.0
    dearer = list(row)
    dearer[1], dearer[4] = "a3", 300.0
    return spark.createDataFrame([row, zero, dearer], RAW_ROW)


def test_clean(raw, plan):
    cleaned = products.clean_products(raw)
    assert cleaned.columns == list(PRODUCT_COLUMNS)
    assert {r.id: r.discount for r in cleaned.collect()} == {"a1": 25.0, "a2": None, "a3": -50.0}
    assert {r.fulfillment_type for r in cleaned.collect()} == {"dealer"}


def test_absent_columns_are_ignored(spark):
    df = spark.range(1).withColumn("_c0", F.lit(1)).withColumn("pay_later", F.lit(1))
    assert products.drop_raw_columns(df).columns == ["id"]


def test_binding_needs_as_many_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert products.bind_by_position(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError, match="2 source columns"):
        products.bind_by_position(df, ["x"])


def test_current_time_as_text(spark):
    text = spark.range(1).select(event_time_text().alias("t")).first().t
    assert len(text) == 19 and text[4] == "-" and text[13] == ":"


def test_clean_file_and_read_back(spark, raw, tmp_path):
    write_csv(raw, str(tmp_path / "raw"))
    jobs.clean_product_file(spark, str(tmp_path / "raw"), str(tmp_path / "out"), RAW_ROW, files=1)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    back = read_csv(spark, str(tmp_path / "out"), DOUBLE_ROW)
    assert sorted(back.collect()) == sorted(products.clean_products(raw).collect())
    assert back.where("id = 'a1'").first().name == " n, \"q\" "  # blanks and quotes kept


def test_column_pruning_reaches_the_file(spark, raw, tmp_path, plan):
    write_csv(raw, str(tmp_path / "raw"))
    cleaned = products.clean_products(read_csv(spark, str(tmp_path / "raw"), RAW_ROW))
    assert "ReadSchema: struct<original_price:double,price:double>" in plan(cleaned.select("discount"))


def test_inferred_types(spark, tmp_path):
    write_csv(spark.range(3).select("id", F.lit(1.5).alias("x"), F.lit("t").alias("s")), str(tmp_path / "f"))
    assert read_csv(spark, str(tmp_path / "f")).dtypes == [("id", "int"), ("x", "double"), ("s", "string")]


def test_first_rows_in_file_order(spark, tmp_path, settings):
    folder = tmp_path / "files"
    folder.mkdir()
    for i, name in enumerate(("a.csv", "b.csv", "c.csv")):  # the larger files come first in a scan
        rows = "\n".join(str(i * 1000 + n) for n in range(100 * (i + 1)))
        (folder / name).write_text(f"n\n{rows}\n")
    settings(spark__sql__files__maxPartitionBytes="200")
    head = read_csv_head(spark, str(folder), 150, "n int")
    assert head.columns == ["n"]
    assert [r.n for r in head.collect()] == [*range(100), *range(1000, 1050)]
    ordered = read_csv_head(spark, str(folder), 3, "n int", order_by="n")
    assert [r.n for r in ordered.collect()] == [0, 1, 2]


def test_head_is_a_top_k(spark, tmp_path, plan):
    write_csv(spark.range(10), str(tmp_path / "f"))
    physical = plan(read_csv_head(spark, str(tmp_path / "f"), 5, "id bigint")).split("Physical Plan")[1]
    assert "TakeOrderedAndProject" in physical
    assert "Exchange" not in physical


def test_schema_must_agree_with_the_header(spark, tmp_path):
    write_csv(spark.range(3).select("id", F.lit("x").alias("name")), str(tmp_path / "f"))
    assert read_csv(spark, str(tmp_path / "f"), "id bigint, name string").count() == 3
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_csv(spark, str(tmp_path / "f"), "name string, id bigint").collect()


def test_line_breaks_in_a_field(spark, raw, tmp_path):
    broken = raw.withColumn("name", F.lit("two\nlines, \"quoted\""))
    write_csv(broken, str(tmp_path / "raw"))
    jobs.clean_product_file(spark, str(tmp_path / "raw"), str(tmp_path / "out"), RAW_ROW, multiLine=True)
    back = jobs.read_products(spark, str(tmp_path / "out"), DOUBLE_ROW, multiLine=True)
    assert {r.name for r in back.collect()} == {"two\nlines, \"quoted\""}
    assert back.count() == 3


def test_broken_raw_rows_are_kept_apart_and_cells_stay(spark, tmp_path):
    good = '0,a1,n,20.00,12.50, f ,b,5,1.5,1,s,2,c,3,-,-,-,-,-'
    cells = [good, good.replace("12.50", "abc"), good.replace(",5,", ",n/a,", 1), good.replace(",5,", ",3000000000,", 1)]
    broken = ["0,a2,n", good + ",surplus", '0,a3,"n', 'n"' + good[6:]]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([",".join(RAW_ROW.names), *cells, *broken]) + "\n")
    out = str(tmp_path / "out")
    jobs.clean_product_file(spark, str(path), out, RAW_ROW)
    checked = jobs.checked_products(jobs.read_products(spark, out, DOUBLE_ROW))
    assert [(r.id, float(r.price), float(r.discount)) for r in checked.accepted.collect()] == [("a1", 12.5, 37.5)]
    assert sorted((r.price, r.review_count) for r in checked.rejected.collect()) == [
        ("12.50", "3000000000"), ("12.50", "n/a"), ("abc", "5")]
    kept = spark.read.parquet(f"{out}_rejects")
    assert sorted(r._corrupt_record for r in kept.collect()) == sorted(broken)
    assert [(r.reject_reason, r.row_count) for r in jobs.reject_counts(spark, f"{out}_rejects").collect()] == [
        ("corrupt record", 4)]
    jobs.clean_product_file(spark, str(path), str(tmp_path / "named"))  # columns by the header
    assert sorted(spark.read.text(str(tmp_path / "named")).collect()) == sorted(spark.read.text(out).collect())


def test_unnamed_index_column_without_schema(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(",id,original_price,price,fulfillment_type\n0,a,20,15, f \n")
    jobs.clean_product_file(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out")).columns == ["id", "original_price", "price", "fulfillment_type", "discount"]


def test_head_counts_files_in_lots(spark):
    """Many empty files take a number of jobs that grows with their logarithm."""
    files = [f"f{i:04d}" for i in range(1000)]
    lots = []

    def read(names):
        lots.append(len(names))
        return spark.range(sum(name > "f0900" for name in names))

    class Listed:
        @staticmethod
        def inputFiles():
            return list(reversed(files))

    assert first_files(Listed, 5, read)[-1] >= "f0905" and len(lots) < 10
    lots.clear()
    assert first_files(Listed, 0, read) == [] and not lots
