"""Time helpers.

Test tables carry ``TIMESTAMP_NTZ``; watermarks and epoch casts need
``TIMESTAMP``.  With the session pinned to UTC the conversion is the identity
on wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss"
TS_TEXT_SQL = "%Y-%m-%d %H:%M:%S"


def as_timestamp(c: Column) -> Column:
    """TIMESTAMP_NTZ / TIMESTAMP / string → TIMESTAMP (session zone, UTC)."""
    return c.cast("timestamp")


def epoch_ms(c: Column, exact: bool = False) -> Column:
    """Epoch milliseconds.  Default keeps whole seconds × 1000 (sub-second
    part dropped, as the monitored request log does); ``exact`` keeps ms."""
    ts = as_timestamp(c)
    if exact:
        return F.unix_millis(ts)
    return F.unix_seconds(ts) * F.lit(1000)


def ts_text(c: Column) -> Column:
    """Render a timestamp as ``yyyy-MM-dd HH:mm:ss`` text (engine-neutral)."""
    return F.date_format(c, TS_TEXT)
