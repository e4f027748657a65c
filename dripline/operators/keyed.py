"""Keyed operators over rows in arrival order: running values, sessions, late rows.

Arrival order is a column (a log offset, an event id), because a shuffle does not keep
it. Every window runs over (key, chunk), so a busy key is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dripline.operators.skew import CHUNK, FLOOR_ROWS, same_keys, with_chunks


def _carried(summary: DataFrame, keys: list[str], *columns: Column) -> DataFrame:
    """Per-chunk carry-in, renamed so it joins back without clashing names."""
    return F.broadcast(
        summary.select(
            *(F.col(k).alias(f"_at_{k}") for k in keys), F.col(CHUNK).alias("_at_chunk"), *columns
        )
    )


def _join_carry(rows: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    at = [f"_at_{k}" for k in keys] + ["_at_chunk"]
    return rows.join(carry, same_keys([*keys, CHUNK], at), "left").drop(*at)


def _running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    fold: Callable[[Column], Column],
    join: Callable[[Column, Column], Column],
    out: str,
    floor_rows: int,
) -> DataFrame:
    data = df.withColumn("_value", value)
    rows, busy_rows = with_chunks(data, keys, order, floor_rows)
    here = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = busy_rows.groupBy(*keys, CHUNK).agg(fold(F.col("_value")).alias("_part"))
    carry = _carried(
        per_chunk.withColumn("_carry", fold(F.col("_part")).over(before)), keys, F.col("_carry")
    )
    joined = _join_carry(rows, carry, keys)
    local = fold(F.col("_value")).over(here)
    total = F.when(F.col("_carry").isNull(), local).otherwise(join(local, F.col("_carry")))
    return joined.withColumn(out, total).drop("_value", "_carry", CHUNK)


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column | None = None,
    out: str = "total",
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """The key's total so far, on every row; counts rows when no value is given."""
    one = F.lit(1).cast("bigint") if value is None else value
    return _running(df, keys, order, one, F.sum, lambda a, b: F.coalesce(a + b, b), out, floor_rows)


def running_max(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    out: str = "max_so_far",
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """The key's greatest value so far, on every row."""
    return _running(df, keys, order, value, F.max, lambda a, b: F.greatest(a, b), out, floor_rows)


def late_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    ts_ms: Column,
    delay_ms: int = 1000,
    out: str = "is_late",
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """Mark rows behind the watermark (greatest time so far, less the delay) on arrival."""
    seen = running_max(df, keys, order, ts_ms, "_seen", floor_rows)
    return seen.withColumn(out, ts_ms < F.col("_seen") - delay_ms).drop("_seen")


def word_totals(df: DataFrame, word: str, out: str = "total") -> DataFrame:
    """Final count per word. Map-side partial counts keep a busy word cheap."""
    return df.groupBy(word).agg(F.count(F.lit(1)).alias(out))


def session_start(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    ts_ms: Column,
    gap_ms: int = 60_000,
    out: str = "session_start_ms",
    floor_rows: int = FLOOR_ROWS,
    open_session: Column | None = None,
) -> DataFrame:
    """Stamp each row with the time its session began.

    In arrival order per key, the first row opens a session, and so does a row more than
    ``gap_ms`` after the row before it. A missing time counts as 0, and a row that arrives
    out of order moves the "last seen" time back.

    ``open_session`` is non-NULL on rows that stand for what came before this data: such a
    row, ordered first (its order columns are NULL), continues the session of that start.
    """
    forced = F.lit(None).cast("bigint") if open_session is None else open_session
    data = df.withColumn("_ts", F.coalesce(ts_ms, F.lit(0).cast("bigint"))).withColumn("_forced", forced)
    w = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    gap = F.col("_prev").isNull() | (F.col("_ts") - F.col("_prev") > gap_ms)
    opens = F.coalesce("_forced", F.when(gap, F.col("_ts")))

    # What the chunks of busy keys hand on: their first and last time, and the last
    # session opened inside them. The first row's own case is settled once the chunk
    # before it is known.
    rows, busy_rows = with_chunks(data, keys, order, floor_rows)
    at = F.struct(*order)
    inner = F.when(F.col("_forced").isNotNull() | F.col("_prev").isNotNull(), opens)
    chunks = (
        busy_rows.withColumn("_prev", F.lag("_ts").over(w))
        .groupBy(*keys, CHUNK)
        .agg(
            F.min_by("_ts", at).alias("_first"),
            F.max_by("_ts", at).alias("_last"),
            F.max(F.when(inner.isNotNull(), F.struct(*order, inner.alias("_opened"))))["_opened"].alias("_inner"),
        )
    )
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    first_opens = F.when(
        F.col("_before").isNull() | (F.col("_first") - F.col("_before") > gap_ms), F.col("_first")
    )
    carry = _carried(
        chunks.withColumn("_before", F.lag("_last").over(by_chunk)).withColumn(
            "_current", F.last(F.coalesce("_inner", first_opens), ignorenulls=True).over(earlier)
        ),
        keys,
        F.col("_before"),
        F.col("_current"),
    )

    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return (
        _join_carry(rows, carry, keys)
        .withColumn("_prev", F.coalesce(F.lag("_ts").over(w), "_before"))
        .withColumn("_opened", opens)
        .withColumn(out, F.coalesce(F.last("_opened", ignorenulls=True).over(so_far), "_current"))
        .drop("_ts", "_forced", "_prev", "_before", "_current", "_opened", CHUNK)
    )


def session_summary(
    df: DataFrame, keys: list[str], ts_ms: Column, gap_ms: int = 60_000, floor_rows: int = FLOOR_ROWS
) -> DataFrame:
    """One row per key and session in event-time order: start, last time, rows.

    Built on the chunked stamping: ``session_window`` alone would send all rows of a
    key to one task. Rows with the same key and time are counted together first, so
    times are distinct.
    """
    data = df.select(*keys, ts_ms.alias("_time")).filter(F.col("_time").isNotNull())
    moments = data.groupBy(*keys, "_time").agg(F.count(F.lit(1)).alias("_rows_then"))
    stamped = session_start(
        moments, keys, ["_time"], F.col("_time"), gap_ms, "session_start_ms", floor_rows
    )
    return stamped.groupBy(*keys, "session_start_ms").agg(
        F.max("_time").alias("session_end_ms"), F.sum("_rows_then").alias("row_count")
    )
