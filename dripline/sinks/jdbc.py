"""Batches to a JDBC table, repeatable by batch number.

Spark commits each task's rows on its own, so a failed batch can leave rows behind. Every
row carries its batch number, and a batch first deletes the rows of that number: a batch
that failed half-way is rewritten as a whole, and the stream's offset moves only after
all of it is in. Values are bound by the writer, never pasted into SQL.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.operators.rows import drop_transient
from dripline.sinks.batches import Sink

BATCH_COLUMN = "batch_id"
_NAME = re.compile(r"[A-Za-z_][\w.]*")


def jdbc_options(settings: dict[str, Any], table: str, rows_per_flush: int = 1000, writers: int = 5) -> dict[str, str]:
    """Writer options from a ``jdbc`` block (``jdbcUrl``, ``driverClassName``, ``username``, ``password``)."""
    if not _NAME.fullmatch(table):
        raise ValueError(f"not a table name: {table!r}")
    options = {
        "url": str(settings["jdbcUrl"]),
        "dbtable": table,
        "batchsize": str(settings.get("batch.size") or rows_per_flush),
        "numPartitions": str(settings.get("writers") or writers),
    }
    for ours, spark_name in (("driverClassName", "driver"), ("username", "user"), ("password", "password")):
        if settings.get(ours) is not None:
            options[spark_name] = str(settings[ours])
    return options


def delete_statement(table: str, batch_id: int) -> str:
    return f"DELETE FROM {table} WHERE {BATCH_COLUMN} = {int(batch_id)}"


def execute(spark: SparkSession, options: dict[str, str], statement: str) -> None:
    """Run one statement on the driver over the same JDBC driver the writer uses."""
    jvm = spark._jvm
    if options.get("driver"):
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    login = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            login.setProperty(key, options[key])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], login)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def numbered(rows: DataFrame, batch_id: int) -> DataFrame:
    """The sink's columns in order, without transient ones, and the batch number."""
    return drop_transient(rows).withColumn(BATCH_COLUMN, F.lit(int(batch_id)).cast("bigint"))


def jdbc_sink(settings: dict[str, Any], table: str, run=execute) -> Sink:
    """Append batches to an existing table that has a ``batch_id`` column.

    With ``semantic: AT_LEAST_ONCE`` a repeated batch is not cleaned up first.
    """
    options = jdbc_options(settings, table)
    semantic = str(settings.get("semantic") or "EXACTLY_ONCE").upper()

    def write(rows: DataFrame, batch_id: int) -> None:
        if semantic == "EXACTLY_ONCE":
            run(rows.sparkSession, options, delete_statement(table, batch_id))
        numbered(rows, batch_id).write.format("jdbc").options(**options).mode("append").save()

    return write


def jdbc_table(spark: SparkSession, settings: dict[str, Any], table: str, split: dict[str, Any] | None = None) -> DataFrame:
    """Read a table; ``split`` (partitionColumn, lowerBound, upperBound, numPartitions) reads it in parallel."""
    options = {k: v for k, v in jdbc_options(settings, table).items() if k not in ("batchsize", "numPartitions")}
    return spark.read.format("jdbc").options(**options, **(split or {})).load()
