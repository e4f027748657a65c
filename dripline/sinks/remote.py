"""Rows to a remote service in small requests, with retries and dead letters.

A few writer tasks each send buffers of rows through a transport, several at a time: the
buffers wait in a bounded queue, and each request has a deadline, whatever the transport does.
Rows that still fail after all retries go to a dead-letter store. Delivery is at least once: a
task that is lost sends its rows again, and a request that is given up may have arrived.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from queue import Queue
from threading import Thread
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.functions import cells
from dripline.operators.rows import row_to_cells
from dripline.sinks.batches import Sink
from dripline.sinks.jdbc import jdbc_sink
from dripline.sinks.writers import kafka_sink_options

# Executors need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules["dripline"])

# Takes a buffer of rows and returns a status code, or raises.
Transport = Callable[[list[dict[str, Any]]], int]

STATUS, ATTEMPTS = "status", "attempts"
FAILED = -1


@dataclass(frozen=True)
class RemoteSettings:
    writers: int = 4
    buffer_rows: int = 10
    retries: int = 1
    delay_seconds: float = 0.0
    timeout_seconds: float = 600.0
    success_codes: tuple[int, ...] = (200,)
    #: Requests of a task at a time, and buffers that wait for them.
    in_flight: int = 1
    queued: int = 100
    #: The wait before a retry grows by this factor each time.
    back_off: float = 2.0

    @staticmethod
    def of(settings: dict[str, Any]) -> RemoteSettings:
        """From a sink block's ``threshold`` part; several success codes are separated by commas."""
        t = settings.get("threshold") or {}
        given = {k: v for k, v in t.items() if v is not None}  # a zero is a setting
        codes = str(given.get("successCode", 200)).split(",")
        return RemoteSettings(
            writers=int(given.get("numWriters", 4)),
            buffer_rows=int(given.get("bufferSize", 1)),
            retries=int(given.get("retries", 1)),
            delay_seconds=float(given.get("delayTime", 0)) / 1000,
            timeout_seconds=float(given.get("requestTimeout", given.get("timeout", 600))),
            success_codes=tuple(int(c) for c in codes),
            in_flight=int(given.get("inFlight", 1)),
            queued=int(given.get("queueCapacity", 100)),
            back_off=float(given.get("backOff", 2.0)),
        )


def send_rows(rows: DataFrame, connect: Callable[[], Transport], settings: RemoteSettings) -> DataFrame:
    """Send all rows when the result is used; each comes back with its status and attempts.

    The result must be used once only, since using it sends.
    """
    schema = T.StructType(
        [*rows.schema.fields, T.StructField(STATUS, T.IntegerType()), T.StructField(ATTEMPTS, T.IntegerType())]
    )

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transport = connect()
        for part in parts:
            status: list[int] = []
            attempts: list[int] = []
            for size, code, tries in _send_all(transport, part, settings):
                status += [code] * size
                attempts += [tries] * size
            added = [pa.array(status, pa.int32()), pa.array(attempts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, STATUS, ATTEMPTS])

    # Arrow batches keep whole numbers beside NULLs whole.
    return rows.repartition(settings.writers).mapInArrow(send, schema)


def _send_all(transport: Transport, part: pa.RecordBatch, settings: RemoteSettings) -> list[tuple[int, int, int]]:
    """Rows, status and attempts of each buffer in order, with ``in_flight`` requests at a time."""
    starts = range(0, part.num_rows, settings.buffer_rows)
    done: list[tuple[int, int, int]] = [(0, FAILED, 0)] * len(starts)
    waiting: Queue[int | None] = Queue(max(1, settings.queued))

    def work() -> None:
        while (k := waiting.get()) is not None:
            buffer = part.slice(starts[k], settings.buffer_rows).to_pylist()
            done[k] = (len(buffer), *_try(transport, buffer, settings))

    workers = [Thread(target=work, daemon=True) for _ in range(max(1, min(settings.in_flight, len(starts))))]
    for worker in workers:
        worker.start()
    for k in (*range(len(starts)), *(None for _ in workers)):
        waiting.put(k)
    for worker in workers:
        worker.join()
    return done


def _within(transport: Transport, buffer: list[dict[str, Any]], seconds: float) -> int:
    """The transport's code; a request past its deadline is left behind as failed."""
    code = [FAILED]

    def call() -> None:
        try:
            code[0] = transport(buffer)
        except Exception:  # noqa: BLE001 - any failure of a remote service is a failed attempt
            pass

    request = Thread(target=call, daemon=True)
    request.start()
    request.join(seconds)
    return FAILED if request.is_alive() else code[0]


def _try(transport: Transport, buffer: list[dict[str, Any]], settings: RemoteSettings) -> tuple[int, int]:
    code = FAILED
    for attempt in range(1, settings.retries + 2):
        code = _within(transport, buffer, settings.timeout_seconds)
        if code in settings.success_codes:
            return code, attempt
        if attempt <= settings.retries and settings.delay_seconds:
            time.sleep(settings.delay_seconds * settings.back_off ** (attempt - 1))
    return code, settings.retries + 1


def failed(sent: DataFrame, settings: RemoteSettings) -> DataFrame:
    return sent.filter(~F.col(STATUS).isin(*settings.success_codes))


def dead_letter_folder(path: str) -> Sink:
    """Dead letters as files by date of failure; a repeated batch replaces its own."""

    def write(rows: DataFrame, batch_id: int) -> None:
        dated = rows.withColumn("dt", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
        dated.write.mode("overwrite").partitionBy("dt").parquet(f"{path}/batch_id={batch_id}")

    return write


def dead_letter_kafka(settings: dict[str, Any]) -> Sink:
    def write(rows: DataFrame, _: int) -> None:
        values = rows.select(F.to_json(F.struct("*")).alias("value"))
        values.write.format("kafka").options(**kafka_sink_options(settings)).save()

    return write


def dead_letter_cells(path: str, family: str = "cf") -> Sink:
    """Dead letters as cells: the row key is a hash of the row, so a repeated batch rewrites its cells."""

    def write(rows: DataFrame, batch_id: int) -> None:
        own = [F.col(f"`{c}`") for c in rows.columns if c not in (STATUS, ATTEMPTS)]
        body = F.to_json(F.struct(*own), {"ignoreNullFields": "false"})
        values = {"s_row": cells.encode_text(body), "i_status": cells.encode_int(F.col(STATUS)), "i_attempts": cells.encode_int(F.col(ATTEMPTS))}
        now = F.unix_millis(F.current_timestamp())
        found = row_to_cells(rows, F.sha2(body, 256), now, family, values)
        found.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def dead_letter_sink(failover: dict[str, Any]) -> Sink:
    """The store a ``failover`` block names: ``hdfs`` (files), ``hbase`` (cells), ``kafka``, or ``mysql``/``jdbc``."""
    storage = failover.get("storage")
    part = failover.get(storage) or failover.get("jdbc") or {}
    if storage == "hdfs":
        return dead_letter_folder(f"{part['path']}/{failover['table']}")
    if storage == "hbase":
        return dead_letter_cells(f"{part['path']}/{failover['table']}", part.get("family", "cf"))
    if storage == "kafka":
        return dead_letter_kafka(part)
    if storage in ("mysql", "jdbc"):
        return jdbc_sink(part, failover["table"])
    raise ValueError(f"unknown failover storage {storage!r}: use hdfs, hbase, kafka, mysql or jdbc")


def remote_sink(connect: Callable[[], Transport], settings: RemoteSettings, dead_letters: Sink) -> Sink:
    """Send each batch and keep what failed; sending happens in the dead letters' one pass."""

    def write(rows: DataFrame, batch_id: int) -> None:
        dead_letters(failed(send_rows(rows, connect, settings), settings), batch_id)

    return write


def http_get(
    column: str = "url", timeout_seconds: float = 100.0, success_codes: tuple[int, ...] = (200,)
) -> Callable[[], Transport]:
    """One GET per row to the row's URL; the first code that is not a success stands for the buffer."""

    def connect() -> Transport:
        from urllib.error import HTTPError
        from urllib.request import urlopen

        def send(buffer: list[dict[str, Any]]) -> int:
            code = success_codes[0]
            for row in buffer:
                try:
                    with urlopen(row[column], timeout=timeout_seconds) as answer:
                        code = answer.status
                except HTTPError as refused:
                    code = refused.code
                if code not in success_codes:
                    break
            return code

        return send

    return connect


def json_lines(buffer: list[dict[str, Any]]) -> bytes:
    """A body with one JSON object a line, as bulk loads take it; times and bytes as text."""
    return b"".join(json.dumps(row, default=str, ensure_ascii=False).encode() + b"\n" for row in buffer)


def delimited(columns: list[str], separator: str = "\t", null: str = "\\N") -> Callable[[list[dict[str, Any]]], bytes]:
    """A body encoder with one row a line; separators and line ends inside a value are escaped."""

    def text(value: Any) -> str:
        shown = null if value is None else str(value)
        return shown if value is None else shown.replace("\\", "\\\\").replace(separator, "\\" + separator).replace("\n", "\\n")

    def encode(buffer: list[dict[str, Any]]) -> bytes:
        return "".join(separator.join(text(row[c]) for c in columns) + "\n" for row in buffer).encode()

    return encode


def http_send(
    url: str, encode: Callable[[list[dict[str, Any]]], bytes] = json_lines, method: str = "POST",
    headers: dict[str, str] | None = None, timeout_seconds: float = 100.0,
) -> Callable[[], Transport]:
    """One request per buffer, whose body holds its rows."""

    def connect() -> Transport:
        from urllib.error import HTTPError
        from urllib.request import Request, urlopen

        def send(buffer: list[dict[str, Any]]) -> int:
            try:
                with urlopen(Request(url, encode(buffer), headers or {}, method=method), timeout=timeout_seconds) as answer:
                    return answer.status
            except HTTPError as refused:
                return refused.code

        return send

    return connect
