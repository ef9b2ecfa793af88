"""Column expressions shared by the operators (key codec, table names)."""

from spanload.functions.keys import (
    HEX_KEY_PATTERN,
    boundary_key,
    is_hex_key,
    key_seconds,
    key_time,
    seconds_to_key,
    synthetic_hex_key,
)
from spanload.functions.names import (
    normalize_table_name,
    normalize_table_name_col,
    source_name_col,
    source_table_name,
)

__all__ = [
    "HEX_KEY_PATTERN", "boundary_key", "is_hex_key", "key_seconds", "key_time",
    "seconds_to_key", "synthetic_hex_key", "normalize_table_name",
    "normalize_table_name_col", "source_name_col", "source_table_name",
]
