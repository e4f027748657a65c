"""Micro-batch sinks chosen by a settings block's ``kind``."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.sinks import remote, writers
from dripline.sinks.batches import Sink, batch_folders
from dripline.sinks.jdbc import jdbc_sink
from dripline.sinks.subtables import BUCKETS, subtable_sink
from dripline.sinks.upserts import BUCKETS as UPSERT_BUCKETS
from dripline.sinks.upserts import UpsertTable


def batch_sink(settings: dict[str, Any]) -> Sink:
    """``folders``, ``upserts``, ``subtables``, ``jdbc``, ``http``, ``kafka`` or ``console``."""
    kind = settings.get("kind")
    if kind == "folders":
        return batch_folders(settings["path"])
    if kind == "upserts":
        return UpsertTable(settings["path"], list(settings["keys"]), list(settings["order"]), int(settings.get("buckets", UPSERT_BUCKETS))).write
    if kind == "subtables":
        return subtable_sink(settings["path"], int(settings.get("buckets", BUCKETS)))
    if kind == "jdbc":
        return jdbc_sink(settings, settings["table"])
    if kind == "http":
        rules = remote.RemoteSettings.of(settings)
        column = settings.get("column", "url")
        connect = remote.http_get(column, rules.timeout_seconds, rules.success_codes)
        return remote.remote_sink(connect, rules, remote.dead_letter_sink(settings["failover"]))
    if kind == "kafka":
        return _kafka(settings)
    if kind == "console":
        return writers.console_sink(settings.get("prefix"), settings.get("rows"))
    raise ValueError(f"unknown sink {kind!r}: use folders, upserts, subtables, jdbc, http, kafka or console")


def _kafka(settings: dict[str, Any]) -> Sink:
    options = writers.kafka_sink_options({k: v for k, v in settings.items() if k != "kind"})

    def write(rows: DataFrame, _: int) -> None:
        value = F.col("value") if "value" in rows.columns else F.to_json(F.struct(*rows.columns))
        rows.select(value.cast("string").alias("value")).write.format("kafka").options(**options).save()

    return write
