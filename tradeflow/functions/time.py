"""Epoch milliseconds, timestamps and the age cutoff."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from tradeflow.constants import DAY_MS, MOVE_SECONDS

_EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def ntz_to_epoch_ms(ts: Column) -> Column:
    """Zone-less timestamp (read as UTC) to epoch ms, truncated."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), ts)


def ntz_to_epoch_ms_rounded(ts: Column) -> Column:
    """Zone-less timestamp (read as UTC) to the nearest epoch ms."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), ts)
    return F.floor((micros + 500) / 1000)


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def epoch_ms_to_ntz(ms: Column) -> Column:
    return F.timestamp_add("MILLISECOND", ms, F.expr(_EPOCH_NTZ))


def timestamp_to_ntz(ts: Column) -> Column:
    """Instant to zone-less UTC timestamp (the session zone is UTC)."""
    return ts.cast("timestamp_ntz")


def now_ms() -> Column:
    """Current time as epoch ms, rounded; fixed within one query or micro-batch."""
    return F.floor((F.unix_micros(F.current_timestamp()) + 500) / 1000)


def cutoff_ms(now: int, delay_s: int = MOVE_SECONDS) -> int:
    """Rows with a time below this are older than ``delay_s`` seconds."""
    return now - 1000 * delay_s


def day_of(ms: int) -> str:
    """The UTC day of an epoch ms, as ``yyyy-mm-dd``."""
    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=ms // DAY_MS)).isoformat()


def bound(ms: int, dtype: T.DataType) -> Column:
    """Epoch ms as a constant of the given time column's own type.

    The constant is folded, so a comparison leaves the bare column on one side
    and reaches the Parquet scan.
    """
    constant = F.lit(ms).cast("bigint")
    if isinstance(dtype, T.TimestampType):
        return epoch_ms_to_timestamp(constant)
    if isinstance(dtype, T.TimestampNTZType):
        return epoch_ms_to_ntz(constant)
    if isinstance(dtype, T.LongType):
        return constant
    raise TypeError(f"not a time column: {dtype.simpleString()}")
