"""Functions on columns."""

from sluiceway.functions.decimals import (
    decode_columns,
    encode_columns,
    register_decode_function,
)
from sluiceway.functions.expressions import (
    bytes_to_text,
    discount_percent,
    event_time_text,
    text_to_bytes,
    topic_name,
)

__all__ = [
    "bytes_to_text", "decode_columns", "discount_percent", "encode_columns",
    "event_time_text", "register_decode_function", "text_to_bytes", "topic_name",
]
