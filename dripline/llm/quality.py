"""Quality classifier on random Fourier features with ridge scores and isotonic calibration.

A document is a vector of statistics of its whole text. A cosine feature map with normal
directions approximates a Gaussian kernel over the standardised statistics. The normal
equations of a ridge fit are summed inside partitions, then by block of rows, and solved on
the driver: their size depends on the number of features only. Scores of the training rows
fall into fixed bins; pooling adjacent violators over the bins gives the calibration.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import Shared, folds, land, map_rows, rows, texts

#: Fixed groups of bytes whose shares are statistics.
GROUPS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".,;:'\"-?", b"!", b"|", b"#$%&*+/<=>@[]^_{}~\\`", bytes(range(128, 256)), b"\n"]
_BYTES = np.array([[b in g for g in GROUPS] for b in range(256)], float)
WIDTH = len(GROUPS) + 13
#: Number of cosines, kernel width in standard deviations, ridge strength, seed of the directions.
COSINES, KERNEL, RIDGE, SEED = 384, 4.0, 1.0, 17
#: Training rows are summed in so many tasks, and each sum is sent in blocks of so many rows.
SUM_TASKS, BLOCK = 64, 64
#: Calibration bins over the raw scores from LOW to HIGH; both ends are open.
BINS, LOW, HIGH = 2000, -0.5, 1.5


def statistics(text: str | None) -> np.ndarray:
    """Statistics of one text; a null or empty one has zeros."""
    raw = (text or "").encode()
    found = raw.split()
    n, out = len(found), np.zeros(WIDTH)
    if not n:
        return out
    seen, lines = Counter(found), [x for x in raw.split(b"\n") if x]
    lengths = np.fromiter(map(len, found), np.int64, n)
    out[: len(GROUPS)] = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _BYTES / len(raw)
    stops = sum(w[-1] in b".,;:!?" for w in found)
    out[len(GROUPS) :] = (
        np.log1p(n),
        np.log1p(len(raw)),
        lengths.mean(),
        lengths.std(),
        len(seen) / n,
        max(seen.values()) / n,
        sum(map(eq, found, found[1:])) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        (lengths == 1).mean(),
        stops / n,
        raw.count(b"http") / n,
        sum(c * c for c in seen.values()) / n / n,
    )
    return out


@dataclass(frozen=True)
class Model:
    """What is broadcast: all sizes follow from COSINES, WIDTH and BINS."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        draw = np.random.default_rng(SEED)
        w = draw.normal(size=(x.shape[1], COSINES)) / KERNEL
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        cosines = np.cos(z @ w + draw.uniform(0, 2 * np.pi, COSINES)) * np.sqrt(2 / COSINES)
        return np.hstack([cosines, z / 6, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for each row of ``doc_id, text``."""

    def make():
        def step(batch):
            x = [statistics(t) for t in texts(batch)]
            yield rows(
                doc_id=batch.column("doc_id").cast(pa.int64()),
                x=pa.array([v.tolist() for v in x], pa.list_(pa.float64())),
            )

        return step

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, WIDTH)


def _moments(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    row = train.agg(
        *[F.avg(F.col("x")[k]).alias(f"m{k}") for k in range(WIDTH)],
        *[F.stddev_pop(F.col("x")[k]).alias(f"s{k}") for k in range(WIDTH)],
    ).first()
    spread = np.array([row[f"s{k}"] for k in range(WIDTH)])
    return np.array([row[f"m{k}"] for k in range(WIDTH)]), np.where(spread > 1e-9, spread, 1.0)


def _normal_equations(train: DataFrame, model: Model) -> np.ndarray:
    """Sum of ``z' (z, y)`` over all training rows."""

    def make():
        total = np.zeros((COSINES + WIDTH + 1, COSINES + WIDTH + 2))

        def step(batch):
            if batch is not None:
                z = model.features(_matrix(batch))
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ batch.column("y").to_numpy()
                return
            at = range(0, len(total), BLOCK)
            yield rows(
                block=pa.array(list(at), pa.int64()),
                part=pa.array([total[k : k + BLOCK].tobytes() for k in at], pa.binary()),
            )

        return step

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b) for b in group.column("part").to_pylist())
        return pa.table({"block": group.column("block").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    parts = map_rows(train, make, "block long, part binary", last=True)
    found = parts.groupBy("block").applyInArrow(add, "block long, part binary").collect()
    whole = b"".join(bytes(r.part) for r in sorted(found, key=lambda r: r.block))
    return np.frombuffer(whole).reshape(COSINES + WIDTH + 1, -1)


def _calibration(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the non-decreasing share of label 1 by raw score."""

    def make():
        def step(batch):
            at = np.clip((model.raw(_matrix(batch)) - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)
            n, good = np.bincount(at, minlength=BINS), np.bincount(at, batch.column("y").to_numpy(), BINS)
            kept = np.flatnonzero(n)
            yield rows(bin=pa.array(kept), n=pa.array(n[kept].astype(float)), good=pa.array(good[kept]))

        return step

    bins = map_rows(train, make, "bin long, n double, good double")
    found = bins.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect()
    pools: list[list[float]] = []
    for r in sorted(found, key=lambda r: r.bin):
        pools.append([r.good, r.n, (r.bin + 0.5) * r.n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    good, n, centre = np.array(pools).T
    return centre / n / BINS * (HIGH - LOW) + LOW, good / n


def fit(train: DataFrame) -> Model:
    """Fit on all rows of ``x, y``; y is 0 or 1."""
    mean, spread = _moments(train)
    model = Model(mean, spread, None, np.zeros(1), np.zeros(1))
    sums = _normal_equations(train, model)
    weights = np.linalg.solve(sums[:, :-1] + RIDGE * np.eye(len(sums)), sums[:, -1])
    model = Model(mean, spread, weights, np.zeros(1), np.zeros(1))
    return Model(mean, spread, weights, *_calibration(train, model))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``doc_id, text``.

    Learns from rows of ``labels (doc_id, quality)`` whose fold is not 1 and whose document is
    there; null labels are passed over. A null text counts as empty, a null doc_id is not held
    out, repeated rows are scored each. Without a single training row every score is 0.5.
    """
    seen = land(document_statistics(docs), "statistics")
    marks = labels.where("doc_id is not null and quality in (0, 1)").where(folds("doc_id", 3) != 1)
    marks = marks.groupBy("doc_id").agg(F.max(F.col("quality").cast("double")).alias("y"))
    train = land(seen.join(marks, "doc_id").select("x", "y").repartition(SUM_TASKS), "training")
    if train.isEmpty():
        model = Model(np.zeros(WIDTH), np.ones(WIDTH), None, np.zeros(1), np.zeros(1))
    else:
        model = fit(train)
    shared = Shared(docs.sparkSession, model)

    def make():
        def step(batch):
            yield rows(doc_id=batch.column("doc_id"), score=pa.array(shared.value.score(_matrix(batch))))

        return step

    return map_rows(seen, make, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(folds("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
