"""Readers chosen by a settings block's ``kind``."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from dripline.sources.kafka import kafka_lines
from dripline.sources.synthetic import synthetic_stream, synthetic_table


def open_source(spark: SparkSession, settings: dict[str, Any], stream: bool = True) -> DataFrame:
    """``kafka``, ``socket``, ``text`` (a folder of lines), ``parquet`` or ``datagen``."""
    kind = settings.get("kind")
    rest = {k: v for k, v in settings.items() if k != "kind"}
    if kind == "kafka":
        return kafka_lines(spark, rest, stream)
    if kind == "socket":
        if not stream:
            raise ValueError("a socket can only be streamed")
        return spark.readStream.format("socket").options(host=rest["host"], port=int(rest["port"])).load()
    if kind == "text":
        return text_lines(spark, rest["path"], stream, rest.get("max_files"))
    if kind == "parquet":
        return parquet_rows(spark, rest["path"], stream, rest.get("max_files"))
    if kind == "datagen":
        return synthetic_stream(spark, **rest) if stream else synthetic_table(spark, **rest)
    raise ValueError(f"unknown source kind {kind!r}: use kafka, socket, text, parquet or datagen")


def text_lines(spark: SparkSession, path: str, stream: bool = True, max_files: int | None = None) -> DataFrame:
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).load(path)


def parquet_rows(spark: SparkSession, path: str, stream: bool = True, max_files: int | None = None) -> DataFrame:
    """Parquet rows; a stream takes its schema from the files there at the start."""
    rows = spark.read.parquet(path)
    if not stream:
        return rows
    reader = spark.readStream.schema(rows.schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def from_items(spark: SparkSession, items: Iterable[Any], schema: str = "value string") -> DataFrame:
    """A finite in-memory collection as rows, for literals in a job."""
    rows = [i if isinstance(i, (tuple, list, dict)) else (i,) for i in items]
    return spark.createDataFrame(rows, schema)
