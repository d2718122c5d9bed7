"""Table constraints as predicates: rows that break one are kept apart, with the
reason, and the load goes on.

The rules are those of a relational database on assignment: text longer than its
VARCHAR is refused unless only blanks are cut off, numbers are rounded half away
from zero to the declared scale, and numbers that do not fit are refused.

Values out of range are found by comparison. A ``try_cast`` that fails costs an
exception inside Spark, some ten microseconds a row, which a frequent bad value
would turn into most of the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    VarcharType,
)

from sluiceway.schemas import TABLE

REASON = "reject_reason"
OK = "ok"
CORRUPT = "_corrupt_record"  # text of a file row that could not be taken apart
CORRUPT_REASON = "corrupt record"
_STORED = "_stored"
_WHOLE_NUMBER = "^ *[+-]?[0-9]{1,37} *$"


def _stored(column: StructField, source: DataType) -> str:
    """SQL of a value as its column stores it; null where it cannot be stored."""
    value, target = f"`{column.name}`", column.dataType
    if isinstance(target, VarcharType):
        text = value if isinstance(source, StringType) else f"cast({value} AS string)"
        return (
            f"CASE WHEN length({text}) <= {target.length} THEN {text} "
            f"WHEN length(rtrim({text})) <= {target.length} "
            f"THEN substring({text}, 1, {target.length}) END"
        )
    if isinstance(target, DecimalType):
        wide = f"try_cast({value} AS decimal(38,{target.scale}))"  # rounds, has room to spare
        return (
            f"CASE WHEN abs({wide}) < {10 ** (target.precision - target.scale)} "
            f"THEN cast({wide} AS {target.simpleString()}) END"
        )
    if isinstance(target, IntegerType) and source != target:
        whole = f"try_cast({value} AS decimal(38,0))"
        if isinstance(source, StringType):
            whole = f"CASE WHEN {value} RLIKE '{_WHOLE_NUMBER}' THEN {whole} END"
        return f"CASE WHEN {whole} BETWEEN {-2**31} AND {2**31 - 1} THEN cast({whole} AS int) END"
    return f"try_cast({value} AS {target.simpleString()})"


def _reason(column: StructField) -> str:
    label = f"{column.name} {column.dataType.simpleString()}"
    return (
        f"CASE WHEN `{column.name}` IS NOT NULL AND {_STORED}.`{column.name}` IS NULL "
        f"THEN '{label}' END"
    )


def check_constraints(df: DataFrame, table: StructType = TABLE) -> DataFrame:
    """Add ``reject_reason``: the broken rules in table order, or ``ok``.

    Every row stays, nothing is shuffled or read twice. The values as the table
    would store them come along in one more column, which ``accepted`` unpacks.
    """
    stored = ", ".join(
        f"{_stored(column, df.schema[column.name].dataType)} AS `{column.name}`"
        for column in table
    )
    reasons = ", ".join(_reason(column) for column in table)
    if CORRUPT in df.columns:
        reasons = f"CASE WHEN `{CORRUPT}` IS NOT NULL THEN '{CORRUPT_REASON}' END, {reasons}"
    return df.selectExpr("*", f"struct({stored}) AS {_STORED}").selectExpr(
        "*", f"coalesce(nullif(concat_ws('; ', {reasons}), ''), '{OK}') AS {REASON}"
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Rows that keep every rule, as the table stores them."""
    return checked.select(F.inline(F.when(F.col(REASON) == OK, F.array(_STORED))))


def rejected(checked: DataFrame) -> DataFrame:
    """Rows that break a rule, unchanged, with the reason."""
    row = F.struct(*(name for name in checked.columns if name != _STORED))
    return checked.select(F.inline(F.when(F.col(REASON) != OK, F.array(row))))


def reason_counts(checked: DataFrame) -> DataFrame:
    """Rows per reason; counted before the shuffle, so a frequent reason is cheap."""
    return checked.groupBy(REASON).agg(F.count("*").alias("row_count"))
