"""Key expressions.

Document keys are 12-byte object ids written as 24 lower-case hex
characters.  The first 4 bytes are the creation time in seconds, so string
order equals byte order equals creation order, and a boundary key for a
second is that second in hex followed by zeros.  Everything here is a
built-in column expression — no Python on the data path.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shape of a textual object id (24 lower-case hex characters).
HEX_KEY_PATTERN = "^[0-9a-f]{24}$"
_HEX_KEY_RE = re.compile(HEX_KEY_PATTERN)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_hex_key(c: str | Column) -> Column:
    """J4 — true where the value is a well-formed textual object id."""
    return _col(c).rlike(HEX_KEY_PATTERN)


def key_seconds(c: str | Column) -> Column:
    """J2 — creation second (BIGINT) held in the first 8 hex characters."""
    return F.conv(F.substring(_col(c), 1, 8), 16, 10).cast("bigint")


def key_time(c: str | Column) -> Column:
    """J2 — creation time as a TIMESTAMP."""
    return F.timestamp_seconds(key_seconds(c))


def seconds_to_key(sec: str | Column) -> Column:
    """J3 — boundary key for a second: 8 hex digits then 16 zeros."""
    return F.concat(F.lpad(F.lower(F.hex(_col(sec).cast("bigint"))), 8, "0"),
                    F.lit("0" * 16))


def boundary_key(sec: int) -> str:
    """J3 on the driver, for the handful of split points of a time split."""
    if sec < 0 or sec >= 1 << 32:
        raise ValueError(f"second {sec} does not fit an object id")
    return f"{sec:08x}" + "0" * 16


def is_hex_text(s: object) -> bool:
    """J4 on the driver, for range-file values."""
    return isinstance(s, str) and bool(_HEX_KEY_RE.match(s))


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ value, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _col(ts))


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ value, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _col(ts))


def synthetic_hex_key(ts: str | Column, seq: str | Column) -> Column:
    """An object-id-shaped key made from a TIMESTAMP_NTZ column and a unique number.

    ``hex8(epoch seconds of ts) || 16 hex digits of seq`` — the layout used
    to give the TPC-style test tables time-ordered document keys.
    """
    sec = epoch_seconds(ts)
    return F.concat(F.lpad(F.lower(F.hex(sec)), 8, "0"),
                    F.lpad(F.lower(F.hex(_col(seq).cast("bigint"))), 16, "0"))
