"""Every registered query against the same result in SQL."""

from pathlib import Path
from urllib.parse import urlsplit

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as driver
from checks import queries
from checks.compare import differences


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_equals_sql(spark, sf_dir, duck, name):
    result = driver.queries()[name](spark, sf_dir)
    assert differences(result, duck, driver.oracle_sql()[name]) == []


def test_no_sql_without_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(driver.QUERIES) == set(driver.ORACLES)


def test_flagship(spark):
    result = driver.entry(spark)
    assert len(result.columns) == 14
    assert result.count() == 140


def test_a_portion_can_be_loaded_by_several_tasks(spark):
    rows = spark.range(300_000).selectExpr("id", "concat(uuid(), uuid()) AS text")
    files = list(Path(urlsplit(queries._portions(spark, rows, 2)).path).glob("*.parquet"))
    assert len(files) == 2
    assert all(pq.ParquetFile(file).num_row_groups > 2 for file in files)
