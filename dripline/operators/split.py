"""Splitting one DataFrame into several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIN = "main"


def tag_rows(df: DataFrame, tags: dict[str, Column], out: str = "tag") -> DataFrame:
    """Name the first tag whose predicate holds; rows with none go to ``main``."""
    named = None
    for tag, predicate in tags.items():
        named = F.when(predicate, tag) if named is None else named.when(predicate, tag)
    return df.withColumn(out, F.coalesce(named, F.lit(MAIN)) if named is not None else F.lit(MAIN))


def split_by(df: DataFrame, tags: dict[str, Column]) -> dict[str, DataFrame]:
    """One DataFrame per tag, and ``main`` for the rest: every row is in exactly one."""
    tagged = tag_rows(df, tags, "_tag")
    return {t: tagged.filter(F.col("_tag") == t).drop("_tag") for t in [*tags, MAIN]}


def dead_letters(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and dead letters; a row whose check is NULL is a dead letter."""
    passed = F.coalesce(ok, F.lit(False))
    return df.filter(passed), df.filter(~passed)
