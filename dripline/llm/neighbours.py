"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is split into parts of equal size with few links cut.
A small network learns the part of a sampled vector; it then names the part of every row and
the most probable parts of every query. A query is compared exactly with all rows of its parts.

Rows of a part, and queries of a part, are cut into blocks of bounded size; each block of rows
meets each block of queries in one group, so a large part is many groups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import Shared, land, map_rows, rows

#: The sample's bound, rows of it in a part, the bound of parts, and links of a sampled vector.
SAMPLE, PART, PARTS_MOST, LINKS = 12_000, 60, 200, 10
#: A query goes to its most probable parts until they hold this probability, so that vectors in
#: clear clusters see few parts and vectors without structure see many.
MASS = 0.98
HIDDEN, EPOCHS, BATCH, RATE, SEED = 128, 10, 256, 0.01, 5
#: Rows and queries in one group at most.
ROW_BLOCK, QUERY_BLOCK = 16_384, 512
VECTOR = "vec_id long, v array<double>"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` as doubles; null, zero, non-finite or gappy vectors are left out.

    So are null ids, and vectors of another length than the most common one.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0)
    )
    common = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.where(F.size("v") == (common.n if common else 0))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(sample: DataFrame, x: np.ndarray) -> np.ndarray:
    """For each sampled vector its LINKS nearest others; blocks of it run side by side."""
    shared = sample.sparkSession.sparkContext.broadcast(x)
    count = min(LINKS, len(x) - 1)

    def make():
        def step(batch):
            at = batch.column("at").to_numpy()
            for k in range(0, len(at), 1000):
                own = at[k : k + 1000]
                near = shared.value[own] @ shared.value.T
                near[np.arange(len(own)), own] = -np.inf
                best = np.argpartition(-near, count - 1, axis=1)[:, :count]
                yield rows(at=pa.array(own), near=pa.array(best.tolist(), pa.list_(pa.int64())))

        return step

    spread = sample.sparkSession.range(len(x)).withColumnRenamed("id", "at").repartition(8)
    found = map_rows(spread, make, "at long, near array<long>").toArrow().sort_by("at")
    return _matrix(found.column("near").combine_chunks())


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size, at most one tenth over: median cuts, then moves that cut fewer links."""
    part = np.zeros(len(x), np.int64)

    def cut(own: np.ndarray, first: int, count: int) -> None:
        if count < 2:
            part[own] = first
            return
        y = x[own] - x[own].mean(0)
        along = y @ np.linalg.eigh(y.T @ y)[1][:, -1]
        order = own[np.argsort(along, kind="stable")]
        left = count // 2
        at = len(own) * left // count
        cut(order[:at], first, left)
        cut(order[at:], first + left, count - left)

    cut(np.arange(len(x)), 0, parts)
    heads = np.r_[np.repeat(np.arange(len(x)), graph.shape[1]), graph.ravel()]
    tails = np.r_[graph.ravel(), np.repeat(np.arange(len(x)), graph.shape[1])]
    room = int(len(x) / parts * 1.1) + 1
    size = np.bincount(part, minlength=parts)
    for _ in range(8):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (heads, part[tails]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        moved = 0
        for k in np.argsort(-gain, kind="stable"):
            if gain[k] <= 0:
                break
            if size[best[k]] < room:
                size[part[k]] -= 1
                size[best[k]] += 1
                part[k] = best[k]
                moved += 1
        if not moved:
            break
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer and a softmax over the parts."""

    w: np.ndarray
    b: np.ndarray
    u: np.ndarray
    c: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w + self.b, 0) @ self.u + self.c


def learn_router(x: np.ndarray, part: np.ndarray, graph: np.ndarray, parts: int) -> Router:
    """Fit to the parts of a vector and of its neighbours, so that routes follow the graph."""
    draw = np.random.default_rng(SEED)
    weights = [draw.normal(size=(x.shape[1], HIDDEN)) * 0.3, np.zeros(HIDDEN), draw.normal(size=(HIDDEN, parts)) * 0.1, np.zeros(parts)]
    first, second, steps = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    aim = np.zeros((len(x), parts))
    np.add.at(aim, (np.arange(len(x)), part), 1.0)
    np.add.at(aim, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1 / graph.shape[1])
    aim /= aim.sum(1, keepdims=True)
    for _ in range(EPOCHS):
        order = draw.permutation(len(x))
        for k in range(0, len(x), BATCH):
            own = order[k : k + BATCH]
            y, (w, b, u, c) = x[own], weights
            hidden = np.maximum(y @ w + b, 0)
            out = hidden @ u + c
            out = np.exp(out - out.max(1, keepdims=True))
            gap = (out / out.sum(1, keepdims=True) - aim[own]) / len(own)
            back = gap @ u.T * (hidden > 0)
            steps += 1
            for i, g in enumerate((y.T @ back, back.sum(0), hidden.T @ gap, gap.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] = weights[i] - RATE * (first[i] / (1 - 0.9**steps)) / (np.sqrt(second[i] / (1 - 0.999**steps)) + 1e-8)
    return Router(*weights)


def _routed(vectors: DataFrame, router, mass: float) -> DataFrame:
    """Each vector once for each of its most probable parts that together reach ``mass``."""

    def make():
        def step(batch):
            for k in range(0, batch.num_rows, 4000):
                piece = batch.slice(k, 4000)
                out = router.value.logits(_unit(_matrix(piece.column("v"))))
                out = np.exp(out - out.max(1, keepdims=True))
                best = np.argsort(-out, axis=1, kind="stable")
                share = np.take_along_axis(out, best, 1) / out.sum(1, keepdims=True)
                taken = np.cumsum(share, 1) - share < mass
                taken[:, 0] = True
                again = pa.array(np.nonzero(taken)[0])
                yield rows(part=pa.array(best[taken]), vec_id=piece.column("vec_id").take(again), v=piece.column("v").take(again))

        return step

    return map_rows(vectors, make, f"part long, {VECTOR}")


def nearest(x: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and cosines of the k best rows; near ties are settled by scores computed row by row."""
    rough = x @ (query / np.linalg.norm(query)) / np.linalg.norm(x, axis=1)
    rough[ids == own] = -np.inf
    if len(rough) > k:
        least = np.partition(rough, -k)[-k]
        at = np.flatnonzero(rough >= least - 1e-9)
    else:
        at = np.arange(len(rough))
    at = at[ids[at] != own]
    near = x[at]
    score = (near * query).sum(1) / (np.sqrt((near * near).sum(1)) * np.sqrt((query * query).sum()))
    best = np.lexsort((ids[at], -score))[:k]
    return ids[at][best], score[best]


def _search(k: int):
    def one(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found, ids, score = [], [], []
        if left.num_rows and right.num_rows:
            x, own = _matrix(left.column("v").combine_chunks()), left.column("vec_id").to_numpy()
            for q, v in zip(right.column("vec_id").to_pylist(), _matrix(right.column("v").combine_chunks())):
                i, s = nearest(x, own, v, q, k)
                found += [q] * len(i)
                ids.append(i)
                score.append(s)
        flat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": pa.array(found, pa.int64()), "vec_id": flat(ids, pa.int64()), "score": flat(score, pa.float64())})

    return one


def approximate_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of largest cosine found for each query.

    Both tables have ``vec_id, embedding``. A row with the query's own id is no candidate.
    Repeated rows of another id fill several ranks; repeated queries are asked once. Ties go to
    the smaller id. Unusable vectors take no part; with none usable there are no rows.
    """
    spark = vectors.sparkSession
    all_ = land(usable(vectors), "vectors")
    sample = all_.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = _unit(_matrix(sample.column("v").combine_chunks()))
    parts = max(1, min(PARTS_MOST, len(x) // PART))
    graph = neighbour_graph(all_, x) if len(x) > 1 else np.zeros((1, 0), np.int64)
    part = balanced_parts(x, graph, parts)
    router = Shared(spark, learn_router(x, part, graph, parts))
    asked = usable(queries).dropDuplicates(["vec_id"]).where(F.size("v") == x.shape[1])
    index = _routed(all_, router, 0.0)
    routes = _routed(asked, router, MASS)
    index, routes = land(index, "index"), land(routes, "routes")
    deal = index.groupBy("part").agg((F.count("*") / ROW_BLOCK).cast("int").alias("b")).join(
        routes.groupBy("part").agg((F.count("*") / QUERY_BLOCK).cast("int").alias("q")), "part"
    )
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n) + 1).cast("int")
    left = index.join(deal, "part").withColumn("i", block("b")).withColumn("j", F.explode(F.sequence(F.lit(0), "q")))
    right = routes.join(deal, "part").withColumn("j", block("q")).withColumn("i", F.explode(F.sequence(F.lit(0), "b")))
    group = ["part", "i", "j"]
    found = (
        left.select(*group, "vec_id", "v").groupBy(*group)
        .cogroup(right.select(*group, "vec_id", "v").groupBy(*group))
        .applyInArrow(_search(k), "query_id long, vec_id long, score double")
    )
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return (
        found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("p", "r"))
        .select("query_id", (F.col("p") + 1).alias("rank"), F.col("r.vec_id").alias("vec_id"), (-F.col("r.s")).alias("score"))
    )
