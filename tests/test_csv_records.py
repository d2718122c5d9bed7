import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from sluiceway.operators.constraints import CORRUPT
from sluiceway.sources.csv import read_csv
from sluiceway.sources.csv_records import csv_records, read_csv_records

SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", StringType()), StructField("c", StringType())])


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def rows(seed, count):
    rng = random.Random(seed)
    pieces = ["x", "", "\n", "\n\n", '"', ",", "word", "é", "\r\n", '""', "\n\"\n"]
    return [f"{i},{quoted(''.join(rng.choices(pieces, k=rng.randint(0, 30))))},c{i}" for i in range(count)]


@pytest.mark.parametrize("split", ["64", "333", "4k", "128m"])
def test_agrees_with_reading_whole_files(spark, tmp_path, settings, split):
    settings(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="0",
             spark__sql__files__minPartitionNum="1")
    for seed, count in ((1, 120), (2, 0), (3, 40)):
        (tmp_path / f"{seed}.csv").write_text("\n".join(["a,b,c", *rows(seed, count), ""]), newline="")
    whole = read_csv(spark, str(tmp_path), SCHEMA, multiLine=True)
    found = read_csv_records(spark, str(tmp_path), SCHEMA)
    assert found.count() == whole.count() == 160
    assert found.exceptAll(whole).count() == 0
    if split == "64":
        assert csv_records(spark, str(tmp_path)).select("_block").distinct().count() > 20


def test_one_record_over_many_blocks(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="128", spark__sql__files__openCostInBytes="0")
    long = "line\n" * 500
    (tmp_path / "long.csv").write_text(f"a,b,c\n1,{quoted(long)},end\n2,x,y\n3,{quoted(long)},end")
    found = {row.a: (row.b, row.c) for row in read_csv_records(spark, str(tmp_path), SCHEMA).collect()}
    assert found == {1: (long, "end"), 2: ("x", "y"), 3: (long, "end")}


def test_broken_records_are_marked_and_open_quotes_swallow_nothing(spark, tmp_path):
    marked = StructType([*SCHEMA.fields, StructField(CORRUPT, StringType())])
    (tmp_path / "good.csv").write_text('a,b,c\n1,"x\ny"\n2,b,c,d\n3,b,c\n')
    (tmp_path / "open.csv").write_text('a,b,c\n4,"open,c\n5,b,c\n6,b,c\n')
    found = {row[0]: row[CORRUPT] for row in read_csv_records(spark, str(tmp_path), marked).collect()}
    assert found[1] == '1,"x\ny"' and found[2] == "2,b,c,d" and found[3] is None
    assert found[4] == '4,"open,c' and found[5] is None and found[6] is None


def test_header_must_name_the_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,c,b\n1,2,3\n")
    with pytest.raises(Exception, match="header does not name"):
        read_csv_records(spark, str(tmp_path), SCHEMA).collect()
    assert read_csv_records(spark, str(tmp_path), SCHEMA, header=False).count() == 2


def test_no_task_holds_a_whole_file(spark, tmp_path, plan, settings):
    settings(spark__sql__files__maxPartitionBytes="1k", spark__sql__files__openCostInBytes="0")
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *rows(4, 300)]), newline="")
    sizes = csv_records(spark, str(tmp_path)).groupBy("_block").agg(F.sum(F.length("value")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 4096


def test_lines_are_neither_sorted_nor_shuffled(spark, tmp_path, plan):
    (tmp_path / "a.csv").write_text("\n".join(["a,b,c", *rows(5, 50)]), newline="")
    text = plan(csv_records(spark, str(tmp_path))).split("== Physical Plan ==")[1]
    assert not re.search(r"windowspecdefinition\(_file#\d+, _block#\d+L?, ", text)  # of a block's lines
    for line in (line for line in text.splitlines() if "Exchange hashpartitioning" in line):
        assert "_line" not in line and "value" not in line
    assert text.count("MapInArrow") == 2
