"""Costly expressions, worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, costly: Column) -> DataFrame:
    """Add a column that later filters and projections read, but never copy.

    Spark moves a filter below the projection that makes its column, and with it a copy
    of the expression: a JSON line would be parsed once per filter and field. It does
    not move filters below an explode, here of an array of one.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    if name not in df.columns:
        return df.select(*others, F.explode(F.array(costly)).alias(name))
    held = df.select(*others, F.explode(F.array(costly)).alias("_once"))
    return held.withColumnRenamed("_once", name)
