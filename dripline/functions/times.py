"""Epoch milliseconds, time text and event-time columns.

Time text is in the session time zone (``spark.sql.session.timeZone``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time text patterns.
SECONDS = "yyyyMMddHHmmss"
DAY = "yyyyMMdd"
HOUR = "HH"
HOUR_BUCKET = "yyyyMMdd/HH"
CLOCK = "yyyy-MM-dd HH:mm:ss"


def as_time(epoch_ms: Column) -> Column:
    return F.timestamp_millis(epoch_ms)


def as_epoch_ms(time: Column) -> Column:
    return F.unix_millis(time.cast("timestamp"))


def time_text(epoch_ms: Column, pattern: str = SECONDS) -> Column:
    return F.date_format(as_time(epoch_ms), pattern)
