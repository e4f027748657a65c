"""Language of a text by hierarchical discrimination: family first, then one against one inside it.

A text is the mean over its words of hashed features: the word and its character n-grams.
Families are not given but found: languages whose mean vectors are alike are merged, nearest
first. One linear support vector machine for each family tells it from all others, and one for
each two languages of a family tells those apart; each is fitted in a task of its own. All
machines are linear in a mean over words, so a task remembers the scores of words and adds them.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import combinations
from math import exp
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import Memo, Shared, folds, land, map_rows, per_process, rows, texts

#: Number of hashed features, and the lengths of n-grams.
WIDTH, GRAMS = 4096, (1, 2, 3)
#: About so many documents of each language are learned from, and so many in all by a family machine.
LANG_SAMPLE, FAMILY_SAMPLE = 500, 4000
#: Ridge strength, steps of a fit, and how steeply a margin becomes a probability.
RIDGE, STEPS, STEEP = 1e-4, 200, 3.0
#: Bytes of remembered word scores of a task, and words of a text whose scores are added at once.
REMEMBERED, AT_ONCE = 64 << 20, 100_000
#: The answer for texts without letters.
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters in lower case; a text without a letter has none."""
    found = _LETTERS.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def _slot(name: str) -> int:
    return crc32(name.encode()) % WIDTH


def word_slots(word: str) -> list[int]:
    """Feature numbers of a word, with repeats: itself and its n-grams with its edges."""
    edged = f"<{word}>"
    return [_slot("=" + word), *(_slot(edged[k : k + n]) for n in GRAMS for k in range(len(edged) - n + 1))]


def vector(text: str | None) -> np.ndarray:
    """Mean features of the words of a text; zeros without letters."""
    uses, out = Counter(words(text)), np.zeros(WIDTH)
    for word, n in uses.items():
        np.add.at(out, word_slots(word), n)
    return out / max(1, sum(uses.values()))


def _vectors(docs: DataFrame) -> DataFrame:
    def make():
        def step(batch):
            sizes, slots, values = [0], [], []
            for text in texts(batch):
                x = vector(text)
                at = np.flatnonzero(x)
                slots.append(at)
                values.append(x[at])
                sizes.append(sizes[-1] + len(at))
            edges = pa.array(sizes, pa.int32())
            flat = lambda parts, kind: pa.array(np.concatenate(parts or [np.empty(0)]).astype(kind))
            yield rows(
                lang=batch.column("lang"),
                part=batch.column("part"),
                slots=pa.ListArray.from_arrays(edges, flat(slots, np.int32)),
                x=pa.ListArray.from_arrays(edges, flat(values, np.float32)),
            )

        return step

    return map_rows(docs, make, "lang string, part long, slots array<int>, x array<float>")


def _dense(found: pa.Table) -> np.ndarray:
    slots, x = found["slots"].combine_chunks(), found["x"].combine_chunks()
    out = np.zeros((len(found), WIDTH), np.float32)
    row = np.repeat(np.arange(len(found)), np.diff(slots.offsets.to_numpy()))
    out[row, slots.flatten().to_numpy()] = x.flatten().to_numpy()
    return out


def families(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages in about the square root of their number of families, by average likeness of their means."""
    names = sorted(means)
    x = np.array([means[n] for n in names])
    x = x - x.mean(0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    like, groups = x @ x.T, [[k] for k in range(len(names))]
    while len(groups) > max(1, round(len(names) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: (like[np.ix_(groups[p[0]], groups[p[1]])].mean(), -p[0], -p[1]))
        groups[a] += groups.pop(b)
    return [[names[k] for k in sorted(g)] for g in groups]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a linear machine: squared hinge, both classes (y = 1 or -1) of equal weight.

    Features are scaled by the square root of their mean; accelerated gradient steps.
    """
    scale = 1 / np.sqrt(x.mean(0) + 1e-4)
    z = np.c_[x * scale, np.ones(len(x))].astype(np.float32)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    u = np.ones(z.shape[1], np.float32)
    for _ in range(20):
        u = z.T @ (share * (z @ u))
        top = float(np.linalg.norm(u))
        u /= max(top, 1e-30)
    rate = 1 / (2 * (1.1 * top + RIDGE))
    w, ahead = np.zeros(z.shape[1], np.float32), np.zeros(z.shape[1], np.float32)
    for k in range(STEPS):
        short = np.maximum(0, 1 - y * (z @ ahead))
        new = ahead + 2 * rate * (z.T @ (share * short * y) - RIDGE * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w[:-1] * scale, float(w[-1])


@dataclass(frozen=True)
class Machines:
    """Weights of the family machines in order, then of the pairs; a pair speaks for its first language."""

    groups: list[list[str]]
    pairs: list[tuple[int, str, str]]
    weights: np.ndarray
    constants: np.ndarray
    name: str = ""

    def memo(self) -> Memo:
        """The scores of words; n-grams, which many words share, are remembered too."""
        weights, width = np.ascontiguousarray(self.weights, "<f4"), len(self.constants)
        most = max(1, REMEMBERED // (200 + 4 * width))
        grams = Memo(lambda gram: weights[_slot(gram)].tobytes(), most)

        def make(word: str) -> bytes:
            edged = f"<{word}>"
            parts = [edged[k : k + n] for n in GRAMS for k in range(len(edged) - n + 1)]
            own = np.frombuffer(weights[_slot("=" + word)].tobytes() + grams.joined(parts), "<f4")
            return (own.reshape(-1, width).sum(0, dtype=float) + self.constants).astype("<f4").tobytes()

        return Memo(make, most)

    def kept_memo(self) -> Memo:
        """One memo for all tasks of a worker process that use these machines."""
        held = per_process("languages", dict)
        if self.name not in held:
            held.clear()
            held[self.name] = self.memo()
        return held[self.name]

    def decide(self, text: str | None, memo: Memo) -> tuple[str, float]:
        """The language of a text and a score from 0 to 1."""
        found, total = words(text), np.zeros(len(self.constants))
        if not found or not self.groups:
            return UNKNOWN, 0.0
        if len(self.constants):
            for k in range(0, len(found), AT_ONCE):
                total += np.frombuffer(memo.joined(found[k : k + AT_ONCE]), "<f4").reshape(-1, len(total)).sum(0, dtype=float)
        margins, family, sure = total / len(found), 0, 1.0
        first = len(self.groups) if len(self.groups) > 1 else 0
        if first:
            order = np.argsort(-margins[:first], kind="stable")
            family, sure = int(order[0]), _likely(margins[order[0]] - margins[order[1]])
        names = self.groups[family]
        votes, sums, least = Counter(), Counter(), dict.fromkeys(names, 1.0)
        for (group, a, b), m in zip(self.pairs, margins[first:].tolist()):
            if group == family:
                votes[a if m >= 0 else b] += 1
                sums[a] += m
                sums[b] -= m
                least[a], least[b] = min(least[a], _likely(m)), min(least[b], _likely(-m))
        best = min(names, key=lambda n: (-votes[n], -sums[n], n))
        return best, sure * least[best]


def _likely(margin: float) -> float:
    return 1 / (1 + exp(-max(-30.0, min(30.0, STEEP * float(margin)))))


def learn(docs: DataFrame) -> Machines:
    """Families and machines from a bounded sample of ``doc_id, text, lang`` (no nulls)."""
    spark = docs.sparkSession
    # One number for each language, as the model itself has one mean vector for each.
    counts = {r.lang: r["count"] for r in docs.groupBy("lang").count().collect()}
    if not counts:
        return Machines([], [], np.zeros((WIDTH, 0)), np.zeros(0))
    range_ = 1 << 40
    share = spark.createDataFrame([(n, int(min(1.0, LANG_SAMPLE / c) * range_)) for n, c in counts.items()], "lang string, share long")
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(range_))
    sample = docs.join(F.broadcast(share), "lang").where(spot < F.col("share")).dropDuplicates(["doc_id", "lang", "text"])
    seen = land(_vectors(sample.select("lang", spot.alias("part"), "text")), "vectors").where(F.size("slots") > 0)

    def mean(key, found):
        return pa.table({"lang": [key[0].as_py()], "x": [_dense(found).mean(0).astype("<f4").tobytes()]})

    means = seen.groupBy("lang").applyInArrow(mean, "lang string, x binary").collect()
    if not means:
        return Machines([], [], np.zeros((WIDTH, 0)), np.zeros(0))
    groups = families({r.lang: np.frombuffer(r.x, "<f4") for r in means})
    pairs = [(k, a, b) for k, g in enumerate(groups) for a, b in combinations(g, 2)]
    first = len(groups) if len(groups) > 1 else 0
    total = sum(min(c, LANG_SAMPLE) for c in counts.values())
    part = int(min(1.0, FAMILY_SAMPLE / total) * range_)
    duty = [(n, k, 1 if k == own else -1, part) for own, g in enumerate(groups) for n in g for k in range(first)]
    duty += [(n, first + k, y, range_) for k, (_, a, b) in enumerate(pairs) for n, y in ((a, 1), (b, -1))]
    if not duty:
        return Machines(groups, [], np.zeros((WIDTH, 0)), np.zeros(0))
    duties = spark.createDataFrame(duty, "lang string, machine long, y int, part_most long")
    dealt = seen.join(F.broadcast(duties), "lang").where(F.pmod(F.xxhash64("part"), F.lit(range_)) < F.col("part_most"))

    def fitted(key, found):
        w, constant = fit(_dense(found), found["y"].to_numpy().astype(np.float32))
        return pa.table({"machine": [key[0].as_py()], "w": [w.astype("<f4").tobytes()], "constant": [constant]})

    weights, constants = np.zeros((WIDTH, first + len(pairs)), np.float32), np.zeros(first + len(pairs))
    for r in dealt.groupBy("machine").applyInArrow(fitted, "machine long, w binary, constant double").collect():
        weights[:, r.machine], constants[r.machine] = np.frombuffer(r.w, "<f4"), r.constant
    return Machines(groups, pairs, weights, constants, uuid4().hex)


def language_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each row of ``doc_id, text, lang``.

    Learns from rows with a lang whose fold is not 0. A null text, or one without letters, is
    ``und`` with score 0, and so is every text if there is nothing to learn from. A null doc_id is
    not held out and not learned from; repeated rows are predicted each, and learned from once.
    An empty lang is a language like others. Other columns are not read.
    """
    docs = docs.select("doc_id", "text", "lang")
    machines = Shared(docs.sparkSession, learn(docs.where("lang is not null and doc_id is not null").where(folds("doc_id", 5) != 0)))

    def make():
        model = machines.value
        memo = model.kept_memo()

        def step(batch):
            found = [model.decide(t, memo) for t in texts(batch)]
            yield rows(
                doc_id=batch.column("doc_id").cast(pa.int64()),
                lang_pred=pa.array([f[0] for f in found], pa.string()),
                score=pa.array([f[1] for f in found], pa.float64()),
            )

        return step

    held_out = F.coalesce(folds("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out, "lang_pred", "score"
    )
