"""Small column expressions shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value: event time as text


def discount_percent(original: Column, price: Column) -> Column:
    """Price cut in percent, two places; null when the original price is zero or either
    one is no number."""
    original, price = original.try_cast("double"), price.try_cast("double")
    return F.round(F.try_divide(original - price, original) * 100, 2)


def event_time_text(ts: Column | None = None) -> Column:
    """A timestamp as event text; the current time by default."""
    return F.date_format(F.current_timestamp() if ts is None else ts, EVENT_TIME_FORMAT)


def topic_name(server: Column | str, schema: Column | str, table: Column | str) -> Column:
    """Topic of a table's change messages: ``server.schema.table``."""
    parts = [F.lit(p) if isinstance(p, str) else p for p in (server, schema, table)]
    return F.concat_ws(".", *parts)


def bytes_to_text(value: Column) -> Column:
    return value.cast("string")


def text_to_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")
