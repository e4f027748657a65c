"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a partial minimum per node and a join back to the links, so a node with very
many links is spread by Spark's skew handling. Links of every round are a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import land


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hook the neighbours of each node (larger ones, or smaller ones and itself) to its least."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    joined = both.join(least.withColumn("least", F.least("a", "least")), "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return out.where("a <> b").distinct()


def _print(links: DataFrame):
    row = links.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    ).first()
    return row.n, row.s


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links to ``(node, component)``: every linked node and the least it reaches.

    Self-links, repeated links and null ends carry nothing. No links give no rows.
    """
    now = land(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _print(now)
    while before[0]:
        now = land(_star(_star(now, True), False), "stars")
        after = _print(now)
        if after == before:
            break
        before = after
    least = now.groupBy("a").agg(F.min("b").alias("component"))
    return least.select(F.col("a").alias("node"), "component").union(
        least.select(F.col("component").alias("node"), "component").distinct()
    )
