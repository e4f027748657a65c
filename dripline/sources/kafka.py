"""Settings of a message-log source, as Spark's Kafka reader takes them."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that are read here rather than passed on to the client.
_OWN = {"bootstrap.servers", "topic", "group.id", "auto.offset.reset", "start.from", "max.rows"}


def kafka_options(settings: dict[str, Any]) -> dict[str, str]:
    """Reader options from a ``kafka.source`` block.

    ``start.from.timestamp`` starts all topics at a time. ``start.from.offset`` names
    topics and, for each, ``partition:offset`` pairs such as ``0:182,1:183``. Else
    ``auto.offset.reset`` decides, with ``earliest`` as default. ``max.rows`` bounds a
    micro-batch. Other keys go to the client as they are.
    """
    topics = [t.strip() for t in str(settings["topic"]).split(",") if t.strip()]
    options = {
        "kafka.bootstrap.servers": str(settings["bootstrap.servers"]),
        "subscribe": ",".join(topics),
        "startingOffsets": str(settings.get("auto.offset.reset") or "earliest"),
    }
    if options["startingOffsets"] not in ("earliest", "latest"):
        raise ValueError("auto.offset.reset is earliest or latest")
    if settings.get("group.id"):
        options["kafka.group.id"] = str(settings["group.id"])
    if settings.get("max.rows"):
        options["maxOffsetsPerTrigger"] = str(settings["max.rows"])
    start = settings.get("start.from") or {}
    if start.get("timestamp") and start.get("offset"):
        raise ValueError("start.from takes a timestamp or offsets, not both")
    if start.get("timestamp"):
        options["startingTimestamp"] = str(start["timestamp"])
        # Applies to partitions with nothing after that time.
        options["startingOffsetsByTimestampStrategy"] = "latest"
        del options["startingOffsets"]
    elif start.get("offset"):
        options["startingOffsets"] = json.dumps(_offsets(start["offset"], topics))
    for key, value in settings.items():
        if key not in _OWN and value is not None:
            options[f"kafka.{key}"] = str(value)
    return options


def _offsets(block: dict[str, Any], topics: list[str]) -> dict[str, dict[str, int]]:
    named = [t.strip() for t in str(block.get("topic", ",".join(topics))).split(",")]
    starts: dict[str, dict[str, int]] = {}
    for topic in named:
        if topic not in topics:
            raise ValueError(f"start offsets for {topic}, which is not read")
        pairs = [pair.split(":") for pair in str(block[topic]).split(",")]
        starts[topic] = {p.strip(): int(o) for p, o in pairs}
    missing = set(topics) - set(starts)
    if missing:
        raise ValueError(f"no start offsets for {', '.join(sorted(missing))}")
    return starts


def kafka_lines(spark: SparkSession, settings: dict[str, Any], stream: bool = True) -> DataFrame:
    """Record values as text, with topic, partition and offset for the arrival order."""
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**kafka_options(settings)).load()
    return raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
