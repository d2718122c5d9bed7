"""Decimals carried as base64 text of a big-endian two's complement integer.

Everything is a built-in expression, so it stays inside generated code and needs no
Python worker. The work is done in several projections: each names a value that the
next one refers to more than once, which keeps it from being computed again and
keeps the generated methods small enough to be compiled.

Expressions are SQL text, since a column built of some twenty function calls costs
the driver as many round trips.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

_HEX_DIGITS = 16  # of a 64-bit integer


def _bytes_hex(text: str) -> str:
    """Hex digits of base64 text, padded first; null if it is not base64."""
    padded = f"rpad({text}, shiftleft(shiftright(length({text}) + 3, 2), 2), '=')"
    return f"hex(try_to_binary({padded}, 'base64'))"


def _without_surplus(digits: str, signed: bool) -> str:
    """Where there are more than eight bytes: drop those that only repeat the sign."""
    surplus = "^(00)+(?=[0-7])|^(FF)+(?=[89A-F])" if signed else "^(00)+(?=.)"
    return (
        f"CASE WHEN length({digits}) > {_HEX_DIGITS} "
        f"THEN regexp_replace({digits}, '{surplus}', '') ELSE {digits} END"
    )


def _hex_value(digits: str, precision: int, scale: int, signed: bool) -> str:
    """The decimal that hex digits stand for; null if there are none or too many."""
    full, base = digits, 10
    if signed:
        sign = f"CASE WHEN substring({digits}, 1, 1) >= '8' THEN 'F' ELSE '0' END"
        full, base = f"lpad({digits}, {_HEX_DIGITS}, {sign})", -10
    unscaled = f"try_cast(conv({full}, 16, {base}) AS bigint)"
    # A decimal without places first: null beyond ``precision`` digits.
    value = f"try_cast({unscaled} AS decimal({precision},0)) * {Decimal(1).scaleb(-scale):f}BD"
    return (
        f"CASE WHEN length({digits}) BETWEEN 1 AND {_HEX_DIGITS} "
        f"THEN cast({value} AS decimal({precision},{scale})) END"
    )


def _unscaled(value: str, scale: int) -> str:
    return f"cast(cast({value} AS decimal(18,{scale})) * {10**scale} AS bigint)"


def _shortest_base64(unscaled: str) -> str:
    """Base64 of the fewest bytes that hold an integer and its sign."""
    magnitude = f"({unscaled} ^ shiftright({unscaled}, 63))"
    width = f"shiftright(length(bin({magnitude})) + 8, 3)"
    digits = f"lpad(hex({unscaled}), {_HEX_DIGITS}, '0')"
    return f"base64(unhex(right({digits}, 2 * {width})))"


def _in_place(df: DataFrame, columns: list[str], to_sql: Callable[[str], str]) -> DataFrame:
    """Replace columns by expressions over themselves."""
    return df.selectExpr(*(
        f"{to_sql(f'`{name}`')} AS `{name}`" if name in columns else f"`{name}`"
        for name in df.columns
    ))


def decode_columns(
    df: DataFrame,
    columns: Iterable[str],
    precision: int = 12,
    scale: int = 2,
    signed: bool = True,
) -> DataFrame:
    """Replace base64 columns by decimals.

    Null and empty text give null, as do broken base64 and values beyond the
    target precision. ``signed=False`` reads the bytes as an unsigned integer.
    """
    if precision > 18:
        raise ValueError("only decimals of up to 18 digits can be decoded")
    columns = list(columns)
    digits = _in_place(df, columns, _bytes_hex)
    digits = _in_place(digits, columns, lambda c: _without_surplus(c, signed))
    return _in_place(digits, columns, lambda c: _hex_value(c, precision, scale, signed))


def encode_columns(df: DataFrame, columns: Iterable[str], scale: int = 2) -> DataFrame:
    """Replace decimal columns by base64 text of their shortest bytes."""
    columns = list(columns)
    whole = _in_place(df, columns, lambda c: _unscaled(c, scale))
    return _in_place(whole, columns, _shortest_base64)


def register_decode_function(
    spark: SparkSession, name: str = "decode_decimal", precision: int = 12, scale: int = 2
) -> None:
    """Make decoding a SQL function of the session: text to decimal.

    It is a SQL function, not a Python one, and is expanded into the query.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(encoded STRING)
        RETURNS decimal({precision},{scale})
        RETURN SELECT {_hex_value("short", precision, scale, True)}
        FROM (SELECT {_without_surplus("digits", True)} AS short
        FROM (SELECT {_bytes_hex("encoded")} AS digits))""")
