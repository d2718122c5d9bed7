from decimal import Decimal

import pytest
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

from sluiceway.operators.constraints import accepted, check_constraints, reason_counts, rejected


def verdict(spark, source, target, value):
    """(reason, stored value) of one value."""
    df = spark.createDataFrame([(value,)], StructType([StructField("c", source)]))
    checked = check_constraints(df, StructType([StructField("c", target)]))
    reason = checked.first().reject_reason
    rows = accepted(checked).collect()
    assert len(rows) == (reason == "ok")
    return reason, rows[0].c if rows else None


@pytest.mark.parametrize(("value", "stored"), [
    ("abc", "abc"), ("abcde", "abcde"), ("abcde   ", "abcde"), ("ab      ", "ab   "),
    (None, None), ("", ""), ("éàüöß", "éàüöß"),
])
def test_text_that_fits(spark, value, stored):
    assert verdict(spark, StringType(), VarcharType(5), value) == ("ok", stored)


def test_text_too_long(spark):
    assert verdict(spark, StringType(), VarcharType(5), "abcdef") == ("c varchar(5)", None)
    assert verdict(spark, StringType(), VarcharType(5), "abcde\tx")[0] == "c varchar(5)"


@pytest.mark.parametrize(("source", "value", "stored"), [
    (DoubleType(), 1.005, "1.01"), (DoubleType(), -1.005, "-1.01"), (DoubleType(), 9.994, "9.99"),
    (DoubleType(), 9.995, None), (DoubleType(), -9.995, None), (DoubleType(), float("nan"), None),
    (DoubleType(), float("inf"), None), (DoubleType(), 1e300, None), (DoubleType(), None, "null"),
    (StringType(), "1.005", "1.01"), (StringType(), "9.9949", "9.99"), (StringType(), "n/a", None),
    (StringType(), "1e0", "1.00"), (StringType(), "9" * 60, None), (IntegerType(), 9, "9.00"),
    (IntegerType(), 10, None), (DecimalType(38, 10), Decimal("9.995"), None),
])
def test_decimals(spark, source, value, stored):
    expected = (
        ("c decimal(3,2)", None) if stored is None
        else ("ok", None if stored == "null" else Decimal(stored))
    )
    assert verdict(spark, source, DecimalType(3, 2), value) == expected


@pytest.mark.parametrize(("source", "value", "stored"), [
    (DoubleType(), 2.5, 3), (DoubleType(), -2.5, -3), (DoubleType(), 2147483647.4, 2147483647),
    (DoubleType(), 2147483647.5, None), (DoubleType(), float("nan"), None),
    (LongType(), 2**31, None), (LongType(), -(2**31), -(2**31)), (LongType(), None, "null"),
    (StringType(), " 12 ", 12), (StringType(), "+7", 7), (StringType(), "2.5", None),
    (StringType(), "x", None), (StringType(), "", None), (StringType(), "2147483648", None),
    (StringType(), "9" * 60, None), (DecimalType(10, 2), Decimal("1.50"), 2), (IntegerType(), 5, 5),
])
def test_integers(spark, source, value, stored):
    expected = ("c int", None) if stored is None else ("ok", None if stored == "null" else stored)
    assert verdict(spark, source, IntegerType(), value) == expected


def test_every_row_is_accounted_for(spark):
    table = StructType([StructField("a", VarcharType(2)), StructField("b", IntegerType())])
    df = spark.createDataFrame(
        [("xx", 1), ("xxx", 2), ("xxx", 2**40), ("x'x\"", None), (None, None)], "a string, b bigint"
    )
    checked = check_constraints(df, table)
    counts = {r.reject_reason: r.row_count for r in reason_counts(checked).collect()}
    assert counts == {"ok": 2, "a varchar(2)": 2, "a varchar(2); b int": 1}
    assert accepted(checked).count() == 2
    kept = rejected(checked)
    assert kept.columns == ["a", "b", "reject_reason"]
    assert {(r.a, r.b) for r in kept.collect()} == {("xxx", 2), ("xxx", 2**40), ("x'x\"", None)}


def test_one_pass(spark, sf_dir, plan):
    from checks.queries import QUERIES

    for name in ("constraint_accepted", "constraint_rejected"):
        physical = plan(QUERIES[name](spark, sf_dir)).split("Physical Plan")[1]
        assert "Exchange" not in physical
        assert "Filter (" not in physical  # a pushed filter would check every rule again
