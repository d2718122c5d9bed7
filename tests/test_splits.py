import pytest
from pyspark.sql import functions as F

from sluiceway.sources.splits import quantile_bounds, split_predicates


def counts(df, predicates):
    met = [F.when(F.expr(one), 1).otherwise(0) for one in predicates]
    row = df.agg(*(F.sum(one) for one in met), F.max(sum(met[1:], met[0])), F.min(sum(met[1:], met[0]))).first()
    assert row[-1] == row[-2] == 1, "a row meets none or several"
    return list(row[:-2])


CASES = {
    "even": "id", "fourth power": "id * id * id * id", "descending": "-id", "doubles": "sqrt(id)",
    "one hot value": "CASE WHEN id % 3 = 0 THEN 5 ELSE id END", "three hot values": "id % 3", "all null": "cast(null AS bigint)",
    "nulls and a hot value": "CASE WHEN id % 4 = 0 THEN NULL WHEN id % 4 = 1 THEN 9000 ELSE id END", "one value": "cast(4 AS bigint)",
    "a value a bit over a part": "CASE WHEN id < 740 THEN 50 ELSE id END",
}


@pytest.mark.parametrize("key", CASES.values(), ids=CASES.keys())
@pytest.mark.parametrize("parts", [1, 7, 20])
def test_splits_are_even_and_whole(spark, key, parts):
    rows = spark.range(10_000).selectExpr(f"{key} AS k", "id AS line").repartition(4)
    found = counts(rows, split_predicates(rows, "k", parts, second="line"))
    assert sum(found) == 10_000 and max(found) <= 1.2 * 10_000 / parts
    assert len(found) <= 1.3 * parts + 3


def test_without_a_second_column_a_hot_value_stays_whole(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 5 ELSE id END AS k")
    assert sum(counts(rows, split_predicates(rows, "k", 10))) == 1000


def test_second_column_with_nulls_and_empty_tables(spark):
    rows = spark.range(1000).selectExpr("cast(5 AS int) AS k", "CASE WHEN id % 3 > 0 THEN id END AS line")
    assert sum(counts(rows, split_predicates(rows, "k", 5, second="line"))) == 1000
    assert split_predicates(rows.limit(0), "k", 5) == ["1 = 1"]
    assert quantile_bounds(rows.limit(0), "k", 5) == []


def test_bounds_that_are_no_numbers_are_refused(spark):
    rows = spark.range(100).selectExpr("double('NaN') AS k")
    with pytest.raises(ValueError, match="a number"):
        split_predicates(rows, "k", 4)
