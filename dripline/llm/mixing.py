"""Mixing sources to target weights by Sainte-Laguë apportionment of token blocks.

Sources share a multiple of all words by weight, none above twice its size. A source is dealt
into shards by a seeded hash; a shard's words, its documents in seeded order, are cut into
equal blocks. Shards get whole numbers of blocks by highest quotients, and each shard picks
its blocks by seeded rank. A block is taken at most twice, and so is a word.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.llm.common import WORD, land, mix

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2, 29
#: Words of a block; words of a shard, raised so that there are at most SHARDS_MOST beside one per source.
BLOCK, SHARD, SHARDS_MOST = 64, 200_000, 20_000
PIECES = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("first", "last", "times")])
)


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST) -> list[float]:
    """Words due to each source; what a full source can't hold is shared again by weight."""
    out, rest, open_ = [0.0] * len(sizes), share * sum(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[k] for k in open_)
        due = {k: rest * weights[k] / total for k in open_}
        full = [k for k in open_ if due[k] > most * sizes[k]]
        if not full:
            for k in open_:
                out[k] = due[k]
            break
        for k in full:
            out[k] = float(most * sizes[k])
            rest -= out[k]
        open_ = [k for k in open_ if k not in set(full)]
    return out


def apportion(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Sainte-Laguë: each seat in turn to the highest ``votes / (2 * held + 1)``, within ``most``.

    Starts from the rounded votes, which highest quotients reach in any case, and adds or
    takes back the few seats that are over or missing.
    """
    held = [min(m, int(np.floor(v + 0.5))) for v, m in zip(votes, most)]
    gap = seats - sum(held)
    step = 1 if gap > 0 else -1

    def entry(k: int):
        if step > 0:
            return (-votes[k] / (2 * held[k] + 1), k)
        return (votes[k] / (2 * held[k] - 1), -k)

    def can(k: int) -> bool:
        return held[k] < most[k] and votes[k] > 0 if step > 0 else held[k] > 0

    heap = [entry(k) for k in range(len(votes)) if can(k)]
    heapq.heapify(heap)
    while gap and heap:
        k = abs(heapq.heappop(heap)[1])
        held[k] += step
        gap -= step
        if can(k):
            heapq.heappush(heap, entry(k))
    return held


def block_times(blocks: int, quota: int, salt: int) -> np.ndarray:
    """How often each block of a shard is taken: evenly, the rest by seeded rank."""
    times = np.full(blocks, quota // blocks, np.int64)
    rank = np.argsort(mix(np.arange(blocks, dtype=np.uint64) + np.uint64(salt % (1 << 63))), kind="stable")
    times[rank[: quota % blocks]] += 1
    return times


def _taken(pieces: bool):
    """Of one shard: words taken of each document, and with ``pieces`` which."""

    def one(group: pa.Table) -> pa.Table:
        size = group.column("size").to_numpy()
        order = np.lexsort((size, group.column("spot").to_numpy()))
        end = np.empty(len(size), np.int64)
        end[order] = np.cumsum(size[order])
        start = end - size
        blocks, quota, salt = (group.column(c)[0].as_py() for c in ("blocks", "quota", "salt"))
        times = block_times(blocks, quota, salt)
        edge = np.arange(blocks + 1) * int(size.sum()) // blocks
        upto = np.r_[0, np.cumsum(times * np.diff(edge))]

        def before(word):
            k = np.minimum(np.searchsorted(edge, word, "right") - 1, blocks - 1)
            return upto[k] + (word - edge[k]) * times[k]

        out = group.select(["doc_id", "source", "size"]).append_column(
            "taken", pa.array(before(end) - before(start), pa.int64())
        )
        if pieces:
            found = []
            for a, b in zip(start, end):
                k = np.arange(np.searchsorted(edge, a, "right") - 1, np.searchsorted(edge, b, "left"))
                found.append([
                    {"first": int(max(edge[i], a) - a), "last": int(min(edge[i + 1], b) - a), "times": int(times[i])}
                    for i in k if times[i]
                ])
            out = out.append_column("pieces", pa.array(found, pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "times")]))))
        return out

    return one


def mixed(docs: DataFrame, seed: int = SEED, pieces: bool = False) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for each row of ``doc_id, text, source``.

    A null or blank text has size 0 and nothing is taken of it. A null source is the last of
    the sources. Repeated rows are mixed each. With ``pieces`` the taken runs of words
    (``first`` to ``last``, end exclusive, ``times``) come along. One row per source and per
    shard comes to the driver; the shards' number is bounded by SHARDS_MOST.
    """
    spark = docs.sparkSession
    sized = land(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.asc_nulls_last("source")).collect()
    due = targets([r.n for r in found], [WEIGHTS[k % len(WEIGHTS)] for k in range(len(found))])
    total = sum(r.n for r in found)
    words = max(SHARD, total // SHARDS_MOST)
    sources = spark.createDataFrame(
        [(r.source, r.n, t, max(1, -(-r.n // words))) for r, t in zip(found, due)],
        "of string, source_size long, target double, shards long",
    )
    kept = sized.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    spot = F.xxhash64(F.lit(seed), "doc_id")
    some = kept.where("size > 0").withColumn("spot", spot).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("shards"))
    )
    shards = some.groupBy("source", "shard").agg(
        F.sum("size").alias("n"), F.first("source_size").alias("m"), F.first("target").alias("t")
    ).orderBy(F.asc_nulls_last("source"), "shard").collect()
    blocks = [max(1, round(r.n / BLOCK)) for r in shards]
    votes = [r.t * r.n / r.m / (r.n / b) for r, b in zip(shards, blocks)]
    quota = apportion(votes, round(sum(votes)), [MOST * b for b in blocks])
    plan = spark.createDataFrame(
        [(r.source, r.shard, b, q, seed * 1_000_003 + k * 7_919) for k, (r, b, q) in enumerate(zip(shards, blocks, quota))],
        "of string, part long, blocks long, quota long, salt long",
    )
    dealt = some.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("part")))
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType())]
        + [T.StructField(n, T.LongType()) for n in ("size", "taken")]
        + ([T.StructField("pieces", PIECES)] if pieces else [])
    )
    taken = (
        dealt.select(F.col("doc_id").cast("long"), "source", "shard", "size", "spot", "blocks", "quota", "salt")
        .groupBy("source", "shard").applyInArrow(_taken(pieces), schema)
    )
    none = sized.where("size = 0").select(F.col("doc_id").cast("long"), "source", "size", F.lit(0).cast("long").alias("taken"))
    if pieces:
        none = none.withColumn("pieces", F.lit(None).cast(PIECES))
    out = taken.union(none).join(sources, F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "size", "source_size", "target", "taken", *(["pieces"] if pieces else []))
