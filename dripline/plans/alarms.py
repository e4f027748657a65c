"""Alarm job: device lines to alarm rows stamped with their session's start."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline import schemas
from dripline.functions import times
from dripline.operators import keyed, rows
from dripline.operators.skew import FLOOR_ROWS
from dripline.session import written
from dripline.sinks.batches import Sink
from dripline.streaming.carried import session_stream

SILENCE_MS = 60_000

# The output columns.
ALARM_COLUMNS = ["factoryNum", "startDateTime", "injectMode", "alarmType", "alarmValue", "alarmTs"]


def readings(lines: DataFrame, order: list[str], strict: bool = True, column: str = "value") -> DataFrame:
    """Non-blank lines, each parsed once into the columns the alarm job needs.

    A bad line fails the job when strict; otherwise it is left out.
    """
    needed = ["factoryNum", "injectMode", *schemas.ALARMS]
    parsed = rows.with_pump(rows.drop_blank(lines, column), column, strict, needed)
    data = F.col("pump.data")
    return parsed.filter(F.col("pump").isNotNull()).select(
        *order,
        data["factoryNum"].alias("factoryNum"),
        F.coalesce(time_or_zero(F.col("pump.ts"), strict), F.lit(0).cast("bigint")).alias("alarmTs"),
        data["injectMode"].alias("injectMode"),
        *(data[a].alias(a) for a in schemas.ALARMS),
    )


def time_or_zero(ts: Column, strict: bool) -> Column:
    return ts.cast("bigint") if strict else ts.try_cast("bigint")


def alarm_output(stamped: DataFrame) -> DataFrame:
    """Stamped readings to one row per alarm that is set."""
    timed = stamped.withColumn("startDateTime", times.time_text(F.col("session_start_ms")))
    keep = ["factoryNum", "startDateTime", "injectMode", "alarmTs"]
    return rows.unpivot_ordinal(timed, schemas.ALARMS, keep).select(*ALARM_COLUMNS)


def alarm_rows(
    lines: DataFrame,
    order: list[str],
    gap_ms: int = SILENCE_MS,
    strict: bool = True,
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """The whole job on a batch of lines. Rows without alarms still move the session on.

    The stamping reads its input more than once, in narrow columns, so the parsed
    readings are first written to the shared folder: no line is parsed twice.
    """
    parsed = written(readings(lines, order, strict), "readings")
    stamped = keyed.session_start(
        parsed, ["factoryNum"], order, F.col("alarmTs"), gap_ms, floor_rows=floor_rows
    )
    return alarm_output(stamped)


def alarm_stream_job(
    lines: DataFrame,
    order: list[str],
    sink: Sink,
    folder: str,
    gap_ms: int = SILENCE_MS,
    strict: bool = True,
    trigger: str | None = None,
    ttl_ms: int | None = None,
) -> StreamingQuery:
    """The whole job on a stream of lines. Sessions go on from one micro-batch to the next."""
    return session_stream(
        readings(lines, order, strict),
        ["factoryNum"],
        order,
        "alarmTs",
        lambda stamped, batch_id: sink(alarm_output(stamped), batch_id),
        folder,
        gap_ms,
        name="alarms",
        trigger=trigger,
        ttl_ms=ttl_ms,
    )
