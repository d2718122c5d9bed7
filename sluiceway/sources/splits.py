"""Even splits of a table for reads by predicates, such as ``read_table(predicates=...)`` over JDBC.

Ranges of equal width leave most rows to one task where a key is skewed. Here the bounds are
quantiles: each task's sketch of the key is merged, and the driver gets the bounds alone. A value
that alone fills several parts can't be split by its key; it is split by quantiles of a
second column within that value.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def quantile_bounds(df: DataFrame, column: str, parts: int, per_part: int = 50) -> list:
    """Values that cut the non-null rows of ``column`` into ``parts`` of equal counts, repeats included.

    The error of a bound is at most one ``per_part``-th of a part.
    """
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, shares, parts * per_part).alias("b")).first()["b"]
    return list(found or [])


def _literal(value: object) -> str:
    if isinstance(value, bool | str) or value != value:
        raise ValueError(f"a number is needed as a bound, not {value!r}")
    return str(value)


def _ranges(column: str, bounds: Sequence) -> list[str]:
    """Predicates that each non-null value meets exactly one of; ``bounds`` ascend."""
    if not bounds:
        return [f"{column} IS NOT NULL"]
    middle = [f"{column} >= {_literal(low)} AND {column} < {_literal(high)}" for low, high in pairwise(bounds)]
    return [f"{column} < {_literal(bounds[0])}", *middle, f"{column} >= {_literal(bounds[-1])}"]


def split_predicates(df: DataFrame, column: str, parts: int, second: str | None = None) -> list[str]:
    """About ``parts`` predicates on numeric columns, of which every row meets exactly one.

    None has more than 1.2 times the mean, but for values that repeat without a ``second`` column.
    Nulls of ``column`` have predicates of their own, as do values that fill more than a part, if a
    ``second`` column is given by which they can be split. A few passes over at most two
    columns; what reaches the driver are bounds, and counts of values at bounds.
    """
    rows, filled = df.agg(F.count("*"), F.count(column)).first()
    if not rows:
        return ["1 = 1"]
    per_part = 1.1 * rows / parts  # the most that is left in one piece
    cuts = quantile_bounds(df, column, ceil(filled / per_part))
    hot = {}
    if second is not None:
        # A value that fills a part lies at one of twice as many bounds; these values are counted.
        near = sorted(set(quantile_bounds(df, column, 2 * ceil(filled / per_part))))
        counts = df.where(F.col(column).isin(near)).groupBy(column).agg(F.count("*").alias("n")).collect()
        hot = {row[column]: row["n"] for row in counts if row["n"] > per_part}

    def shared(condition: str, n: int) -> list[str]:
        pieces = ceil(n / per_part)
        if second is None or pieces < 2:
            return [condition]
        own = sorted(set(quantile_bounds(df.where(condition), second, pieces)))
        ranges = _ranges(second, own)
        ranges[0] = f"({ranges[0]} OR {second} IS NULL)"
        return [f"{condition} AND {one}" for one in ranges]

    found = []
    if hot:
        apart = ", ".join(map(_literal, sorted(hot)))
        rest = df.where(f"{column} NOT IN ({apart})")
        left = filled - sum(hot.values())
        cuts = quantile_bounds(rest, column, ceil(left / per_part)) if left else []
        if left:
            found += [f"{one} AND {column} NOT IN ({apart})" for one in _ranges(column, sorted(set(cuts)))]
        for value, n in sorted(hot.items()):
            found += shared(f"{column} = {_literal(value)}", n)
    elif filled:
        found += _ranges(column, sorted(set(cuts)))
    if rows > filled:
        found += shared(f"{column} IS NULL", rows - filled)
    return found
