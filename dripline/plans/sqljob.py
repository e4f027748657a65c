"""Named SQL jobs: tables from a settings file, statements run by Spark SQL.

A job's settings declare its tables (``tables:``) and its script (``sql:``)::

    tables:
      numbers: {kind: datagen, end: 1000, computed: {ts: current_timestamp()},
                watermark: {column: ts, delay: 0 seconds}}
      shown:   {sink: console}
    sql:
      copy_numbers: |
        INSERT INTO shown SELECT f_sequence, f_random, f_random_str FROM numbers;

Sources become temporary views. ``INSERT INTO <declared sink>`` writes the query's rows
there, as a batch or as a running stream; any other statement goes to Spark as it is. The
script may also declare its tables itself: ``CREATE TABLE … (…) WITH ('connector' = …)``.
"""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline.plans.sqltext import declared, settings_of, statements
from dripline.sinks.writers import start_sink, write_sink
from dripline.sources.readers import open_source

_INSERT = re.compile(
    r"INSERT\s+INTO\s+(?:TABLE\s+)?`?(\w+)`?\s*(?:\((\s*`?\w+`?\s*(?:,\s*`?\w+`?\s*)*)\))?\s*(\S.*)", re.IGNORECASE | re.DOTALL
)


def script_of(config: dict[str, Any], name: str) -> str:
    scripts = config.get("sql") or {}
    if name not in scripts:
        raise KeyError(f"no SQL job {name!r}; known: {', '.join(sorted(scripts)) or 'none'}")
    return scripts[name]


def _open_view(spark: SparkSession, name: str, settings: dict[str, Any], stream: bool, columns: dict[str, str]) -> None:
    plain = {k: v for k, v in settings.items() if k not in ("computed", "watermark")}
    if columns and plain.get("kind") == "datagen":
        plain = {**plain, "columns": columns}
    rows = open_source(spark, plain, stream)
    if columns:
        rows = rows.select(*(F.col(c).cast(kind).alias(c) for c, kind in columns.items()))
    for column, expression in (settings.get("computed") or {}).items():
        rows = rows.withColumn(column, F.expr(expression))
    mark = settings.get("watermark")
    if mark:
        rows = rows.withWatermark(mark["column"], mark.get("delay", "0 seconds"))
    rows.createOrReplaceTempView(name)


def register_tables(spark: SparkSession, config: dict[str, Any], stream: bool) -> dict[str, dict[str, Any]]:
    """Open the declared sources as views; return the declared sinks."""
    sinks = {}
    for name, settings in (config.get("tables") or {}).items():
        if "sink" in settings:
            sinks[name] = settings
        else:
            _open_view(spark, name, settings, stream, {})
    return sinks


def _for_sink(rows: DataFrame, named: str | None, columns: dict[str, str]) -> DataFrame:
    """Rows under the sink's columns: by position, or by the statement's list; the rest is NULL."""
    if named is None and not columns:
        return rows
    names = [n.strip().strip("`") for n in named.split(",")] if named else list(columns)
    if len(names) != len(rows.columns) or (columns and not set(names) <= set(columns)):
        raise ValueError(f"{len(rows.columns)} columns given for ({', '.join(names)})")
    rows = rows.toDF(*names)
    return rows.select(*(
        (F.col(c) if c in names else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()
    )) if columns else rows


def run_sql_job(
    spark: SparkSession, config: dict[str, Any], name: str, stream: bool = False
) -> list[DataFrame | StreamingQuery | None]:
    """Run the named script; one result per statement, None for a declared table or a finished batch write.

    A table that the script declares with options is a sink if the script inserts into it, else a source.
    """
    sinks = register_tables(spark, config, stream)
    script = statements(script_of(config, name))
    targets = {m[1] for m in map(_INSERT.fullmatch, script) if m}
    shapes: dict[str, dict[str, str]] = {}
    results: list[DataFrame | StreamingQuery | None] = []
    for number, statement in enumerate(script):
        if table := declared(statement):
            settings = settings_of(table, table.name in targets)
            if table.name in targets:
                sinks[table.name], shapes[table.name] = settings, table.columns
            else:
                settings = {**settings, "computed": table.computed, "watermark": table.watermark}
                _open_view(spark, table.name, settings, stream, table.columns)
            results.append(None)
            continue
        insert = _INSERT.fullmatch(statement)
        if insert is None or insert[1] not in sinks:
            results.append(spark.sql(statement))
            continue
        target = sinks[insert[1]]
        rows = _for_sink(spark.sql(insert[3]), insert[2], shapes.get(insert[1], {}))
        if rows.isStreaming:
            results.append(start_sink(rows, target, f"{name}_{number}"))
        else:
            results.append(write_sink(rows, target))
    return results


def through_view(df: DataFrame, name: str) -> DataFrame:
    """Put rows behind a view name and read them back as a table; streams stay streams."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
