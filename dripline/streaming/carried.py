"""Keyed streaming operators on Spark's own state store.

``transformWithStateInPandas`` keeps one small value per key (last time and session start, total
so far, greatest time so far) in the session's state store (RocksDB, see ``session.SETTINGS``),
versioned and recovered with the query's checkpoint. Keys are dealt to ``BUCKETS`` by a hash, and a
call sees the rows of a bucket: pandas takes much longer over a call, and over each frame it gives
back, than over a row, and many keys have few rows. The state is a map from key to value, of which
only the keys that have rows are read and written. A bucket's rows of a micro-batch are sorted by key
and arrival columns, and each key's are folded as whole arrays, so a busy key costs one pass of numpy
over its rows; what a micro-batch may hold (``max.rows``, ``maxFilesPerTrigger``) bounds what a task
holds.

``closed_sessions`` keeps the open sessions of keys and a timer for the first of a bucket that can end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from dripline.functions import times
from dripline.session import STATE_STORE
from dripline.sinks.batches import Sink

#: A value folded over a key's sorted rows (columns by name): the new column, and the state that is left.
Fold = Callable[[dict[str, np.ndarray], tuple | None], tuple[np.ndarray, tuple]]
#: Groups that keys are dealt to; a checkpoint keeps to the number it was made with.
BUCKETS = 256
_BUCKET = "_bucket"
_HAS = "_has_"
_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def start_batches(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    folder: str,
    name: str,
    trigger: str | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """Run ``work`` on each micro-batch; without a trigger interval, on all there is now.

    The state of these operators needs the RocksDB store, whatever else the session uses. With a TTL
    Spark would go on with batches without rows for ever, to look for expired state; a query that
    ends with its input does without them, and expired state is not seen all the same.
    """
    conf = stream.sparkSession.conf
    writer = stream.writeStream.foreachBatch(work).queryName(name)
    writer = writer.option("checkpointLocation", f"{folder}/checkpoint")
    wanted = {_PROVIDER: STATE_STORE} | ({_EMPTY_BATCHES: "false"} if ttl_ms is not None and not trigger else {})
    before = {key: conf.get(key) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:  # a query takes the session's settings of its start along
        return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _runs(found: pd.DataFrame, keys: list[str], by: list[str]) -> tuple[pd.DataFrame, list[tuple]]:
    """A bucket's rows sorted by key and ``by``, and of each key its values, its first row and the one behind its last.

    Whether a key column has a value is in a column beside it.
    """
    code = found.groupby([c for k in keys for c in (k, _HAS + k)], sort=False, dropna=False).ngroup()
    found = found.assign(_code=code).sort_values(["_code", *by], kind="stable", na_position="first", ignore_index=True)
    code = found.pop("_code").to_numpy()
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    firsts = [found[c].iloc[starts].tolist() for k in keys for c in (k, _HAS + k)]
    plain = lambda v: v.to_pydatetime() if isinstance(v, pd.Timestamp) else v
    named = [tuple(plain(v) if has else None for v, has in zip(row[::2], row[1::2])) for row in zip(*firsts)]
    return found, list(zip(named, starts.tolist(), [*starts[1:].tolist(), len(code)]))


def _whole(stream: DataFrame) -> list[str]:
    return [f.name for f in stream.schema.fields if isinstance(f.dataType, T.IntegralType)]


def _marked(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Whole numbers without NULLs, beside them and beside keys whether there was a value, and the bucket.

    pandas would turn whole numbers with NULLs to floats.
    """
    whole = _whole(stream)
    marks = [c for c in stream.columns if c in whole or c in keys]
    return stream.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(stream.schema[c].dataType)).alias(c) if c in whole else F.col(f"`{c}`") for c in stream.columns),
        *(F.col(f"`{c}`").isNotNull().alias(_HAS + c) for c in marks),
        F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(BUCKETS)).alias(_BUCKET),
    )


class _Folded(StatefulProcessor):
    """Sorts a bucket's rows of a micro-batch and folds each key's onto what the key carries."""

    def __init__(self, columns: list[str], keys: T.StructType, by: list[str], out: str, state: str, fold: Fold, ttl_ms: int | None):
        self.columns, self.keys, self.by, self.out = columns, keys, by, out
        self.state, self.fold, self.ttl_ms = state, fold, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carried = handle.getMapState("carried", self.keys, self.state, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(rows, ignore_index=True)
        found.columns = self.columns  # computed columns come in order, but may have lost their names
        found, runs = _runs(found.drop(columns=_BUCKET), self.keys.names, self.by)
        columns = {c: found[c].to_numpy() for c in found.columns}
        folded = np.empty(len(found), np.int64)
        for one, a, b in runs:
            folded[a:b], left = self.fold({c: v[a:b] for c, v in columns.items()}, self.carried.getValue(one))
            self.carried.updateValue(one, left)
        found[self.out] = folded
        yield found

    def close(self) -> None:
        pass


def _with_state(
    stream: DataFrame, keys: list[str], order: list[str], out: str, state: str, fold: Fold, ttl_ms: int | None
) -> DataFrame:
    """The stream with the folded column ``out`` (a whole number, never NULL). NULLs of the order columns are first."""
    whole, marked = _whole(stream), _marked(stream, keys)
    by = [b for c in order for b in ([_HAS + c, c] if c in whole else [c])]
    schema = T.StructType([*marked.drop(_BUCKET).schema.fields, T.StructField(out, T.LongType())])
    named = T.StructType([T.StructField(k, stream.schema[k].dataType) for k in keys])
    done = marked.groupBy(_BUCKET).transformWithStateInPandas(
        _Folded(marked.columns, named, by, out, state, fold, ttl_ms), schema, "Append", "None" if ttl_ms is None else "ProcessingTime"
    )
    return done.select(
        *(F.when(F.col(_HAS + c), F.col(f"`{c}`")).alias(c) if c in whole else F.col(f"`{c}`") for c in stream.columns), out
    )


def _session_fold(ts: str, gap_ms: int) -> Fold:
    def fold(found: dict[str, np.ndarray], carried: tuple | None):
        at = found[ts]
        opens = np.r_[carried is None or at[0] - carried[0] > gap_ms, np.diff(at) > gap_ms]
        last = np.maximum.accumulate(np.where(opens, np.arange(len(at)), -1))
        start = np.where(last >= 0, at[last], 0 if carried is None else carried[1])
        return start, (int(at[-1]), int(start[-1]))

    return fold


def session_starts(
    stream: DataFrame, keys: list[str], order: list[str], ts: str, gap_ms: int = 60_000,
    out: str = "session_start_ms", ttl_ms: int | None = None,
) -> DataFrame:
    """Stamp each row of a stream with its session's start.

    Arrival order within a micro-batch is ``order``; batches follow one another. A missing time
    counts as 0. A key silent for ``ttl_ms`` of processing time is forgotten; its next row opens a
    session.
    """
    return _with_state(stream, keys, order, out, "last bigint, open bigint", _session_fold(ts, gap_ms), ttl_ms)


def running_totals(
    stream: DataFrame, keys: list[str], order: list[str], value: str | None = None, out: str = "total",
    ttl_ms: int | None = None,
) -> DataFrame:
    """The key's total so far on every row of a stream; counts rows when no value (a whole number) is given."""

    def fold(found: dict[str, np.ndarray], carried: tuple | None):
        rows = len(found[_HAS + keys[0]])
        own = np.ones(rows, np.int64) if value is None else found[value].astype(np.int64)
        total = np.cumsum(own) + (0 if carried is None else carried[0])
        some = (0 if carried is None else carried[1]) + (rows if value is None else np.cumsum(found[_HAS + value]))
        left = (int(total[-1]), int(np.max(some)))
        # A total of no values yet is marked by the least number and becomes NULL below.
        return np.where(np.broadcast_to(some, len(total)) > 0, total, _NONE), left

    done = _with_state(stream, keys, order, out, "total bigint, some bigint", fold, ttl_ms)
    return done.withColumn(out, F.when(F.col(out) != _NONE, F.col(out)))


_NONE = -(1 << 63)


def late_marks(
    stream: DataFrame, keys: list[str], order: list[str], ts: str, delay_ms: int = 1000, out: str = "is_late",
    ttl_ms: int | None = None,
) -> DataFrame:
    """Mark rows of a stream that arrive behind the key's watermark; a row without a time has no mark."""

    def fold(found: dict[str, np.ndarray], carried: tuple | None):
        at = np.where(found[_HAS + ts], found[ts], _NONE)
        seen = np.maximum.accumulate(np.maximum(at, _NONE if carried is None else carried[0]))
        return seen, (int(seen[-1]),)

    done = _with_state(stream, keys, order, "_seen", "seen bigint", fold, ttl_ms)
    return done.withColumn(out, F.col(ts) < F.col("_seen") - delay_ms).drop("_seen")


class _Closing(StatefulProcessor):
    """Open sessions of a bucket's keys, as starts, ends and numbers of rows; a timer stands for the earliest end."""

    def __init__(self, columns: list[str], keys: T.StructType, gap_ms: int):
        self.columns, self.keys, self.gap_ms = columns, keys, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", self.keys, "starts array<bigint>, ends array<bigint>, counts array<bigint>")
        self.timer = handle.getValueState("timer", "at bigint")

    def _wake(self, at: int | None) -> None:
        """Move the bucket's timer."""
        held = self.timer.get()
        if held and held[0] != at:
            self.handle.deleteTimer(held[0])
        if at is None:
            self.timer.clear()
        elif not held or held[0] != at:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(rows, ignore_index=True)
        found.columns = self.columns
        found, runs = _runs(found, self.keys.names, ["_ms"])
        all_, held = found["_ms"].to_numpy(), self.timer.get()
        first = held[0] if held else None
        for one, a, b in runs:
            sessions = self._merged(all_[a:b], self.open.getValue(one))
            self.open.updateValue(one, tuple(map(list, zip(*sessions))))
            due = min(end for _, end, _ in sessions) + self.gap_ms + 1
            first = due if first is None else min(first, due)
        self._wake(first)
        return iter(())

    def _merged(self, at: np.ndarray, held: tuple | None) -> list[list[int]]:
        cuts = np.flatnonzero(np.r_[True, np.diff(at) > self.gap_ms])
        ends = np.r_[cuts[1:], len(at)]
        found = [(int(at[a]), int(at[b - 1]), int(b - a)) for a, b in zip(cuts, ends)]
        merged: list[list[int]] = []
        for start, end, n in sorted([*found, *(zip(*held) if held else [])]):
            if merged and start - merged[-1][1] <= self.gap_ms:
                merged[-1] = [merged[-1][0], max(merged[-1][1], end), merged[-1][2] + n]
            else:
                merged.append([start, end, n])
        return merged

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Sessions of the bucket that are over; a timer may come early, as sessions grow."""
        now, first, done = timerValues.getCurrentWatermarkInMs(), None, []
        for one, held in list(self.open.iterator()):
            sessions = list(zip(*held))
            left = [s for s in sessions if s[1] + self.gap_ms >= now]
            if len(left) < len(sessions):
                done += [(*one, *s) for s in sessions if s[1] + self.gap_ms < now]
                if left:
                    self.open.updateValue(tuple(one), tuple(map(list, zip(*left))))
                else:
                    self.open.removeKey(tuple(one))
            if left:
                due = min(s[1] for s in left) + self.gap_ms + 1
                first = due if first is None else min(first, due)
        self.timer.clear()  # Spark takes the timer that has come away
        self._wake(first)
        if done:
            whole = [isinstance(f.dataType, T.IntegralType) for f in self.keys] + [True] * 3
            names = [*self.keys.names, "session_start_ms", "session_end_ms", "row_count"]
            columns = [pd.array(v, "Int64") if w else list(v) for v, w in zip(zip(*done), whole)]
            yield pd.DataFrame(dict(zip(names, columns)))

    def close(self) -> None:
        pass


def closed_sessions(
    stream: DataFrame, keys: list[str], ts: str, gap_ms: int = 60_000, delay_ms: int = 0
) -> DataFrame:
    """``keys, session_start_ms, session_end_ms, row_count`` of sessions, each given once it is over.

    Sessions are in event time, rows may come ``delay_ms`` out of order. A session is over when the
    watermark is more than ``gap_ms`` past its last row; then its timer gives it out and its state
    goes. A missing time counts as 0, which is behind any watermark: Spark drops such rows as late.
    """
    timed = stream.select(*(F.col(f"`{k}`") for k in keys), F.coalesce(F.col(ts), F.lit(0).cast("bigint")).alias("_ms"))
    timed = timed.withColumn("_time", times.as_time(F.col("_ms"))).withWatermark("_time", f"{delay_ms} milliseconds")
    schema = T.StructType(
        [*(stream.schema[k] for k in keys)]
        + [T.StructField(n, T.LongType()) for n in ("session_start_ms", "session_end_ms", "row_count")]
    )
    named, marked = T.StructType([T.StructField(k, stream.schema[k].dataType) for k in keys]), _marked(timed, keys)
    return marked.groupBy(_BUCKET).transformWithStateInPandas(
        _Closing(marked.columns, named, gap_ms), schema, "Append", "EventTime"
    )


def session_stream(
    stream: DataFrame, keys: list[str], order: list[str], ts: str, sink: Sink, folder: str, gap_ms: int = 60_000,
    out: str = "session_start_ms", name: str = "sessions", trigger: str | None = None, ttl_ms: int | None = None,
) -> StreamingQuery:
    """``session_starts`` into a sink."""
    return start_batches(session_starts(stream, keys, order, ts, gap_ms, out, ttl_ms), sink, folder, name, trigger, ttl_ms)


def running_total_stream(
    stream: DataFrame, keys: list[str], order: list[str], sink: Sink, folder: str, value: str | None = None,
    out: str = "total", name: str = "totals", trigger: str | None = None, ttl_ms: int | None = None,
) -> StreamingQuery:
    """``running_totals`` into a sink."""
    return start_batches(running_totals(stream, keys, order, value, out, ttl_ms), sink, folder, name, trigger, ttl_ms)


def late_rows_stream(
    stream: DataFrame, keys: list[str], order: list[str], ts: str, sink: Sink, folder: str, delay_ms: int = 1000,
    out: str = "is_late", name: str = "late", trigger: str | None = None, ttl_ms: int | None = None,
) -> StreamingQuery:
    """``late_marks`` into a sink."""
    return start_batches(late_marks(stream, keys, order, ts, delay_ms, out, ttl_ms), sink, folder, name, trigger, ttl_ms)
