"""Event time and time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline.functions import times


def with_event_time(df: DataFrame, epoch_ms: Column, delay: str = "1 second", out: str = "event_time") -> DataFrame:
    """Event time from epoch milliseconds (missing counts as 0) and its watermark.

    Delay ``0 seconds`` is the rule for timestamps that only grow.
    """
    timed = df.withColumn(out, times.as_time(F.coalesce(epoch_ms, F.lit(0).cast("bigint"))))
    return timed.withWatermark(out, delay)


def with_arrival_time(df: DataFrame, out: str = "ts", delay: str = "0 seconds") -> DataFrame:
    """The time of reading as event time, with its watermark."""
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, delay)


def windowed_count(df: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None) -> DataFrame:
    """Rows per time window and key; counts are combined before the shuffle."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    counted = df.groupBy(window.alias("_w"), *keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *keys, "row_count"
    )


def session_windows(df: DataFrame, time: str, keys: list[str], gap: str) -> DataFrame:
    """Session windows of a stream: the form of ``session_summary`` that closes by watermark.

    With the session's settings each map task merges its own sessions before the shuffle, so
    a busy key ships few rows.
    """
    counted = df.groupBy(*keys, F.session_window(time, gap).alias("_w")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(time).alias("session_end")
    )
    return counted.select(*keys, F.col("_w.start").alias("session_start"), "session_end", "row_count")


def refuse_dropped(query: StreamingQuery) -> None:
    """Fail where the watermark dropped rows of a finished stream: its delay does not cover the disorder.

    The count is that of rows after partial aggregation, so it is above 0 where any row was dropped.
    """
    dropped = sum(
        s["numRowsDroppedByWatermark"] for progress in query.recentProgress for s in progress["stateOperators"]
    )
    if dropped:
        raise ValueError(f"{dropped} partial rows came behind the watermark; raise the delay")
