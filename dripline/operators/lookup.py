"""Lookups of stream or batch rows in a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.operators.rows import cells_to_map
from dripline.operators.skew import FLOOR_ROWS, spread_join


def _join(df: DataFrame, table: DataFrame, key: str, seq: list[str] | None, floor_rows: int) -> DataFrame:
    if df.isStreaming:
        # Inside a streaming plan there is no count to find busy keys with. For a large
        # table, look up within ``start_batches`` instead, where each micro-batch has one.
        return df.join(table, F.col(key) == F.col("_ref"), "left")
    return spread_join(df, table, key, "_ref", seq or df.columns, floor_rows)


def _asked(df: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """The table's rows that some row of ``df`` asks for, so that only they are aggregated."""
    if df.isStreaming:
        return table
    keys = df.select(F.col(key).alias("_asked")).filter(F.col("_asked").isNotNull()).distinct()
    return table.join(keys, F.col(table_key) == F.col("_asked"), "left_semi")


def lookup_exists(
    df: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    seq: list[str] | None = None,
    out: str = "found",
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """Add whether the key is in the table. Every input row stays, once; NULL is never found.

    ``seq`` names columns that tell rows of one key apart (an offset, an id).
    """
    refs = table.select(F.col(table_key).alias("_ref")).filter(F.col("_ref").isNotNull())
    known = _asked(df, key, refs, "_ref").distinct()
    joined = _join(df, known, key, seq, floor_rows)
    return joined.withColumn(out, F.col("_ref").isNotNull()).drop("_ref")


def lookup_row(
    df: DataFrame,
    cells: DataFrame,
    key: str,
    seq: list[str] | None = None,
    out: str = "cells",
    strict: bool = True,
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """Add the key's row of a cell table as a map; an unknown key gets an empty map."""
    found = _asked(df, key, cells, "row_key")
    table = cells_to_map(found, strict).select(F.col("row_key").alias("_ref"), F.col("cells").alias(out))
    joined = _join(df, table, key, seq, floor_rows)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return joined.withColumn(out, F.coalesce(out, empty)).drop("_ref")
