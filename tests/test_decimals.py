import base64
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway.functions.decimals import (
    decode_columns,
    encode_columns,
    register_decode_function,
)

# Text, value of signed bytes, value of unsigned bytes.
EDGES = [
    ("MDk=", "123.45", "123.45"),
    ("MDk", "123.45", "123.45"),  # padding left out
    ("AA", "0.00", "0.00"),
    ("", None, None),
    (None, None, None),
    ("nA==", "-1.00", "1.56"),
    ("/av0HAE=", "-99999999.99", None),
    ("A", None, None),  # no such length
    ("!!", None, None),
    ("AAAAAAAAAAAAAAAAAAA=", "0.00", "0.00"),  # fourteen zero bytes
    (base64.b64encode(b"\xff" * 12).decode(), "-0.01", None),
    (base64.b64encode(b"\x00" * 9 + b"\xff").decode(), "2.55", "2.55"),
    (base64.b64encode(b"\x00" * 4 + b"\x80" + b"\x00" * 7).decode(), None, None),
    (base64.b64encode(b"\x01" + b"\x00" * 8).decode(), None, None),
    (base64.b64encode((10**12 - 1).to_bytes(8, "big")).decode(), "9999999999.99", "9999999999.99"),
    (base64.b64encode((10**12).to_bytes(8, "big")).decode(), None, None),
    (base64.b64encode((2**63).to_bytes(8, "big")).decode(), None, None),
]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, x string")


def decoded(df, **options):
    return [r.x for r in decode_columns(df, ["x"], **options).orderBy("i").collect()]


def test_edges(spark):
    df = texts(spark, [text for text, _, _ in EDGES])
    wanted = [(s and Decimal(s), u and Decimal(u)) for _, s, u in EDGES]
    assert list(zip(decoded(df), decoded(df, signed=False), strict=True)) == wanted


def test_result_type_and_other_columns(spark):
    result = decode_columns(texts(spark, ["AA"]), ["x"], precision=10, scale=3)
    assert dict(result.dtypes) == {"i": "int", "x": "decimal(10,3)"}
    with pytest.raises(ValueError, match="18"):
        decode_columns(texts(spark, []), ["x"], precision=20)


@given(st.lists(st.integers(-(10**12) + 1, 10**12 - 1), min_size=1, max_size=300))
@hypothesis_settings(max_examples=8, deadline=None)
def test_agrees_with_an_independent_codec(spark, numbers):
    def minimal(n):
        return base64.b64encode(n.to_bytes((n ^ (n >> 63)).bit_length() // 8 + 1, "big", signed=True))

    values = [Decimal(n).scaleb(-2) for n in numbers]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x decimal(12,2)")
    encoded = encode_columns(df, ["x"])
    assert [r.x for r in encoded.orderBy("i").collect()] == [minimal(n).decode() for n in numbers]
    assert decoded(encoded) == values


@given(st.lists(st.one_of(st.none(), st.binary(min_size=1, max_size=20)), min_size=1, max_size=300))
@hypothesis_settings(max_examples=8, deadline=None)
def test_any_bytes(spark, inputs):
    def value(raw, signed):
        if raw is None:
            return None
        number = int.from_bytes(raw, "big", signed=signed)
        return Decimal(number).scaleb(-2) if abs(number) < 10**12 else None

    df = texts(spark, [raw and base64.b64encode(raw).decode() for raw in inputs])
    assert decoded(df) == [value(raw, True) for raw in inputs]
    assert decoded(df, signed=False) == [value(raw, False) for raw in inputs]


def test_no_python_worker(spark, plan):
    df = decode_columns(texts(spark, ["AA"]), ["x"])
    assert "EvalPython" not in plan(df)


def test_null_decimals_stay_null(spark):
    df = spark.createDataFrame([(0, None)], "i int, x decimal(12,2)")
    assert encode_columns(df, ["x"]).first().x is None
    assert decode_columns(encode_columns(df, ["x"]), ["x"]).first().x is None


def test_sql_function(spark, plan):
    register_decode_function(spark)
    texts(spark, [text for text, _, _ in EDGES]).createOrReplaceTempView("encoded")
    result = spark.sql("SELECT i, decode_decimal(x) AS x FROM encoded")
    assert [r.x for r in result.orderBy("i").collect()] == [s and Decimal(s) for _, s, _ in EDGES]
    assert "EvalPython" not in plan(result)
    assert "Join" not in plan(result).split("Optimized Logical Plan")[1]
    assert result.filter(F.col("x") > 1).count() == 4
