"""Writers chosen by a settings block's ``sink``."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline.session import scratch

KINDS = ("console", "memory", "text", "parquet", "kafka")


def _kind(settings: dict[str, Any]) -> str:
    kind = settings.get("sink")
    if kind not in KINDS:
        raise ValueError(f"unknown sink {kind!r}: use {', '.join(KINDS)}")
    return kind


def kafka_sink_options(settings: dict[str, Any]) -> dict[str, str]:
    """Writer options from a ``kafka.sink`` block. Delivery is at least once.

    Spark's writer has no transactions: ``EXACTLY_ONCE`` is refused rather than quietly
    weakened.
    """
    semantic = str(settings.get("semantic") or "AT_LEAST_ONCE").upper()
    if semantic not in ("AT_LEAST_ONCE", "NONE"):
        raise ValueError(f"semantic {semantic} is not offered by this sink; use AT_LEAST_ONCE or NONE")
    options = {
        "kafka.bootstrap.servers": str(settings["bootstrap.servers"]),
        "topic": str(settings["topic"]),
        "kafka.acks": "0" if semantic == "NONE" else "all",
    }
    known = {"sink", "bootstrap.servers", "topic", "semantic", "checkpoint", "trigger"}
    options.update({f"kafka.{k}": str(v) for k, v in settings.items() if k not in known and v is not None})
    return options


def write_sink(df: DataFrame, settings: dict[str, Any]) -> None:
    """Write a batch. The console takes every row, unless the settings ask for a preview of ``rows``."""
    kind = _kind(settings)
    if kind == "console":
        print_rows(df, settings.get("prefix"), settings.get("rows"))
    elif kind == "memory":
        df.createOrReplaceTempView(settings["name"])
    elif kind == "kafka":
        df.selectExpr("cast(value as string) AS value").write.format("kafka").options(
            **kafka_sink_options(settings)
        ).save()
    else:
        df.write.format(kind).mode(settings.get("mode", "append")).save(settings["path"])


def start_sink(df: DataFrame, settings: dict[str, Any], name: str) -> StreamingQuery:
    """Start a stream into the sink; the query's name and checkpoint identify it."""
    kind = _kind(settings)
    writer = df.writeStream.queryName(settings.get("name", name)).outputMode(settings.get("mode", "append"))
    folder = settings.get("checkpoint")
    if not folder:
        if kind not in ("console", "memory"):
            raise ValueError(f"sink {kind!r} of {name} needs a checkpoint, or a restart would write all rows again")
        folder = scratch(df.sparkSession, f"checkpoint-{name}")
    writer = writer.option("checkpointLocation", folder)
    trigger = settings.get("trigger")
    if trigger == "available_now":
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    if kind == "kafka":
        writer = writer.options(**kafka_sink_options(settings))
    elif kind in ("text", "parquet"):
        writer = writer.option("path", settings["path"])
    elif kind == "console":
        return writer.foreachBatch(console_sink(settings.get("prefix"), settings.get("rows"))).start()
    return writer.format(kind).start()


def console_sink(prefix: str | None = None, rows: int | None = None) -> Callable[[DataFrame, int], None]:
    return lambda batch, _: print_rows(batch, prefix, rows)


def print_rows(df: DataFrame, prefix: str | None = None, rows: int | None = None) -> None:
    """Print every row as JSON to the log of the executor that holds it; a repeated task prints again.

    With ``rows`` the driver shows so many rows instead, as a preview.
    """
    if rows is not None:
        if prefix:
            print(prefix)
        df.show(int(rows), truncate=False)
        return
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"})
    df.select(line.alias("line")).foreachPartition(lambda part: print_lines((r.line for r in part), prefix))


def print_lines(lines: Iterable[str], prefix: str | None = None) -> None:
    for line in lines:
        print(f"{prefix}> {line}" if prefix else line)
    sys.stdout.flush()
