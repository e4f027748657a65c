"""Windowed counts of a stream that give late rows out instead of dropping them.

One stateful operator sees every row, so the window and the late output go by the same
watermark: a row whose window is over goes out as it came, any other is counted, and a timer
gives a window's count out when the watermark reaches its end. Keys are salted, so a busy key is
counted in parts by many tasks; all parts of a window end in the same micro-batch, where the
sink's side adds them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from dripline.functions import times
from dripline.sinks.batches import Sink, kept
from dripline.streaming.carried import start_batches

#: Parts that a key's rows are counted in.
SALTS = 16
_SALT, _MS, _ROW = "_salt", "_ms", "_row"


class _Counted(StatefulProcessor):
    """Counts per window start of one salted key, and a timer at each window's end."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "start bigint", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        reached = timerValues.getCurrentWatermarkInMs()
        for part in rows:
            at, row = part.iloc[:, -2].to_numpy(np.int64), part.iloc[:, -1]
            start = at // self.width_ms * self.width_ms
            late = start + self.width_ms <= reached
            for first, n in zip(*np.unique(start[~late], return_counts=True)):
                before = self.counts.getValue((int(first),)) if self.counts.containsKey((int(first),)) else None
                self.counts.updateValue((int(first),), (int(n) + (before[0] if before else 0),))
                if before is None:
                    self.handle.registerTimer(int(first) + self.width_ms)
            if late.any():
                yield self._out(key, start[late], [None] * int(late.sum()), row[late].tolist())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first = expiredTimerInfo.getExpiryTimeInMs() - self.width_ms
        (n,) = self.counts.getValue((first,))
        self.counts.removeKey((first,))
        yield self._out(key, [first], [n], [None])

    def _out(self, key, start, n, row) -> pd.DataFrame:
        named = {f"k{k}": [v] * len(start) for k, v in enumerate(key[:-1])}
        return pd.DataFrame({**named, "start": start, "n": pd.array(n, "Int64"), "row": row})

    def close(self) -> None:
        pass


def counts_and_late(
    stream: DataFrame, keys: list[str], ts: str, width_ms: int, delay_ms: int, salts: int = SALTS
) -> DataFrame:
    """``k0, k1, … , start, n, row``: parts of window counts (row is NULL), and late rows as JSON (n is NULL).

    ``ts`` is in epoch milliseconds; a row without one counts as time 0. The watermark is the
    greatest time of earlier micro-batches less the delay.
    """
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in stream.columns)), {"ignoreNullFields": "false"})
    timed = stream.select(
        *(F.col(f"`{k}`") for k in keys),
        F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in stream.columns)), F.lit(salts)).cast("int").alias(_SALT),
        F.coalesce(F.col(ts), F.lit(0).cast("bigint")).alias(_MS),
        row.alias(_ROW),
    )
    # Without the watermark's own column, Spark has nothing to drop late rows by.
    timed = timed.withColumn("_time", times.as_time(F.col(_MS))).withWatermark("_time", f"{delay_ms} milliseconds")
    schema = T.StructType(
        [T.StructField(f"k{k}", stream.schema[c].dataType) for k, c in enumerate(keys)]
        + [T.StructField("start", T.LongType()), T.StructField("n", T.LongType()), T.StructField("row", T.StringType())]
    )
    return timed.drop("_time").groupBy(*keys, _SALT).transformWithStateInPandas(_Counted(width_ms), schema, "Append", "EventTime")


def start_counts_and_late(
    stream: DataFrame, keys: list[str], ts: str, width_ms: int, delay_ms: int, counts: Sink, late: Sink, folder: str,
    name: str = "counts", trigger: str | None = None, salts: int = SALTS,
) -> StreamingQuery:
    """Window counts (``keys, window_start_ms, row_count``) to one sink, late rows as they came to another."""
    schema = stream.schema

    def both(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as held:
            named = [F.col(f"k{k}").alias(c) for k, c in enumerate(keys)]
            done = held.where("row is null").groupBy(*named, F.col("start").alias("window_start_ms"))
            counts(done.agg(F.sum("n").alias("row_count")), batch_id)
            late(held.where("row is not null").select(F.from_json("row", schema).alias("r")).select("r.*"), batch_id)

    return start_batches(counts_and_late(stream, keys, ts, width_ms, delay_ms, salts), both, folder, name, trigger)
