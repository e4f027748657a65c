"""Toxic spans by a linear-chain conditional random field over the words of a document.

Labels come per document, so words are labelled first: a word is *telling* if it is in clearly
more of the toxic training documents than of the others, counted over all of them, and its
occurrences in toxic documents are the labelled tokens. The field has two states, weights for
hashed features of a word and its neighbours, and transitions. Forward-backward marginals give
toxic words with offsets; their peak and sum, through a logistic fit, give the document's score.

A document is one chain, however long. It is laid out in columns of CHAIN words side by side;
what a column does to a message is one 2 x 2 table, so messages cross the edges between columns
exactly, and time is in proportion to the words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from struct import pack
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.llm.common import Memo, Shared, folds, land, map_rows, rows, texts

CHAIN = 128
#: Evidence: words of so many documents. Telling words: in so many toxic documents, log-odds and z-score at least.
LEAST_DOCUMENTS, LEAST_ODDS, LEAST_Z = 4, 2.5, 4.0
#: The fit sees about so many labelled documents, drawn by a hash of their id; the field is fitted on
#: about so many runs of CHAIN words of theirs with telling words, and as many without.
DOCUMENTS, CHAINS = 16_000, 3000
RANGE = 1 << 40
HASHED, FEATURES, STEPS, RATE, PENALTY = 1 << 14, 5, 80, 0.2, 2.0
#: Distinct words that a task counts before it gives them out.
COUNTED = 500_000
EDGES = " .,;:!?*#$%&|\"'()[]{}<>"
SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
)


def plain(word: str) -> str:
    return word.strip(EDGES).lower()


@dataclass(frozen=True)
class Evidence:
    """Log-odds of the words that tell most about the label; those of ``telling`` mark tokens."""

    odds: dict[str, float]
    telling: frozenset[str]


def _word_counts(train: DataFrame) -> DataFrame:
    """Training documents of either label that hold each word."""

    def make():
        counts: dict[str, list[int]] = {}

        def out():
            n = len(counts)
            yield rows(
                word=pa.array(list(counts), pa.string()),
                toxic=pa.array([c[1] for c in counts.values()], pa.int64()),
                clean=pa.array([c[0] for c in counts.values()], pa.int64()),
            ) if n else rows(word=pa.array([], pa.string()), toxic=pa.array([], pa.int64()), clean=pa.array([], pa.int64()))
            counts.clear()

        def step(batch):
            if batch is None:
                yield from out()
                return
            for text, y in zip(texts(batch), batch.column("y").to_pylist()):
                for w in {plain(x) for x in set((text or "").split())}:
                    counts.setdefault(w, [0, 0])[y] += 1
                if len(counts) > COUNTED:
                    yield from out()

        return step

    parts = map_rows(train.select("text", "y"), make, "word string, toxic long, clean long", last=True)
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidence(train: DataFrame) -> Evidence:
    """Counts over all training documents; the words that come to the driver are among theirs."""
    total = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1 - F.col("toxic") + 0.5)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1 - F.col("clean") + 0.5)
    )
    z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (
        _word_counts(train).where(f"word <> '' and toxic + clean >= {LEAST_DOCUMENTS}")
        .select("word", "toxic", odds.alias("odds"), z.alias("z")).where("abs(z) > 2").collect()
    )
    telling = [r.word for r in found if r.toxic >= LEAST_DOCUMENTS and r.odds >= LEAST_ODDS and r.z >= LEAST_Z]
    return Evidence({r.word: r.odds for r in found}, frozenset(telling))


def _slot(name: str) -> int:
    return crc32(name.encode()) % HASHED


def word_features(word: str, known: Evidence) -> list[int]:
    """FEATURES hashed features of one word by itself."""
    w = plain(word)
    return [_slot(n) for n in (*_own_names(word, w, known), _head(w), _tail(w))]


def _own_names(word: str, w: str, known: Evidence) -> tuple[str, str, str]:
    odds = known.odds.get(w)
    return (
        "told no" if odds is None else f"told {round(max(-6.0, min(6.0, odds)))}",
        f"word {w if w in known.telling else ''}",
        f"form {'caps' if word.isupper() else ''} {min(len(w), 12)}",
    )


def _head(w: str) -> str:
    return "head " + w[:4]


def _tail(w: str) -> str:
    return "tail " + w[-4:]


def _messages(score: np.ndarray, steps: np.ndarray, held: np.ndarray, into=None, after=None):
    """Forward and backward messages of chains in columns; with two states each is one ratio.

    ``score`` is state 1's, state 0 has zero. ``steps`` is the 2 x 2 table of transition weights.
    ``held`` marks real positions, which come first in each column. ``into`` is the forward message
    before a column's first position, ``after`` the backward one, with the weight of its position,
    behind the last; both are nan where a chain begins or ends.
    """
    e, m = np.where(held, np.exp(np.clip(score, -30, 30)), 1.0), np.exp(steps)
    ahead, back = np.empty_like(e), np.ones_like(e)
    ahead[0] = e[0]
    if into is not None:
        on = ~np.isnan(into)
        ahead[0, on] = e[0, on] * (m[0, 1] + into[on] * m[1, 1]) / (m[0, 0] + into[on] * m[1, 0])
        size, on = held.sum(0), ~np.isnan(after)
        back[size[on] - 1, on] = (m[1, 0] + after[on] * m[1, 1]) / (m[0, 0] + after[on] * m[0, 1])
    for t in range(1, len(e)):
        ahead[t] = e[t] * (m[0, 1] + ahead[t - 1] * m[1, 1]) / (m[0, 0] + ahead[t - 1] * m[1, 0])
    for t in range(len(e) - 2, -1, -1):
        ahead_of = e[t + 1] * back[t + 1]
        back[t] = np.where(held[t + 1], (m[1, 0] + ahead_of * m[1, 1]) / (m[0, 0] + ahead_of * m[0, 1]), back[t])
    return e, m, ahead, back


def _through(e: np.ndarray, m: np.ndarray, held: np.ndarray, onward: bool) -> np.ndarray:
    """What each column does to a message that passes it: 2 x 2 tables (scaled), in reading order or against it."""
    table = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, e.shape[1])).copy()
    own = m.T if onward else m
    for t in range(len(e)) if onward else range(len(e) - 1, -1, -1):
        new = np.stack([own[0, 0] * table[0] + own[0, 1] * table[1], e[t] * (own[1, 0] * table[0] + own[1, 1] * table[1])])
        new /= new.max((0, 1))
        table = np.where(held[t], new, table)
    return table


def joined_messages(score: np.ndarray, steps: np.ndarray, held: np.ndarray, place: np.ndarray):
    """Messages of long chains cut into columns: ``place`` numbers a chain's columns from 0.

    A chain's columns follow one another. Each column's effect on a message is one table, so what
    reaches a column's edge is found column by column and not position by position.
    """
    into, after = np.full(len(place), np.nan), np.full(len(place), np.nan)
    if place.max(initial=0):
        e, m = np.where(held, np.exp(np.clip(score, -30, 30)), 1.0), np.exp(steps)
        ends = np.r_[place[1:] == 0, True]
        tables, first = _through(e, m, held, True), _messages(score[:, place == 0], steps, held[:, place == 0])
        leaving = np.zeros(len(place))
        leaving[place == 0] = first[2][-1]  # padding is none: a column before another one is full
        for k in range(1, place.max() + 1):
            at = np.flatnonzero(place == k)
            into[at] = leaving[at - 1]
            t = tables[:, :, at]
            leaving[at] = (t[1, 0] + t[1, 1] * into[at]) / (t[0, 0] + t[0, 1] * into[at])
        tables = _through(e, m, held, False)
        ended = _messages(score[:, ends], steps, held[:, ends])
        entering = np.zeros(len(place))
        entering[ends] = ended[0][0] * ended[3][0]
        for k in range(place.max() - 1, -1, -1):
            at = np.flatnonzero((place == k) & ~ends)
            after[at] = entering[at + 1]
            t = tables[:, :, at]
            entering[at] = (t[1, 0] + t[1, 1] * after[at]) / (t[0, 0] + t[0, 1] * after[at])
    return _messages(score, steps, held, into, after)


def marginals(score: np.ndarray, steps: np.ndarray, held: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Probability of state 1 at each position of chains that may run over several columns."""
    _, _, ahead, back = joined_messages(score, steps, held, place)
    both = ahead * back
    return both / (1 + both)


def expected_steps(score: np.ndarray, steps: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The marginals, and the expected number of each transition."""
    e, m, ahead, back = _messages(score, steps, held)
    after = e[1:] * back[1:]
    joint = np.stack([np.full_like(after, m[0, 0]), m[0, 1] * after, ahead[:-1] * m[1, 0], ahead[:-1] * m[1, 1] * after])
    joint = (joint / joint.sum(0) * held[1:]).sum((1, 2)).reshape(2, 2)
    both = ahead * back
    return both / (1 + both), joint


@dataclass(frozen=True)
class Field:
    known: Evidence
    weights: np.ndarray
    near: np.ndarray
    steps: np.ndarray

    def memo(self) -> Memo:
        """A word's own score and whether it is telling, as two floats."""
        weight = self.weights.tolist()
        part = Memo(lambda name: weight[_slot(name)])

        def make(word: str) -> bytes:
            w = plain(word)
            own = part[_head(w)] + part[_tail(w)] + sum(map(part.__getitem__, _own_names(word, w, self.known)))
            return pack("<2f", own, w in self.known.telling)

        return Memo(make)

    def marginals(self, found: list[list[str]], memo: Memo) -> list[np.ndarray]:
        """Probability of each word of each document to be toxic."""
        sizes = np.array([len(f) for f in found])
        if not sizes.sum():
            return [np.empty(0) for _ in found]
        own = np.frombuffer(memo.joined([w for f in found for w in f]), "<f4").reshape(-1, 2)
        doc = np.repeat(np.arange(len(found)), sizes)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        score, same = own[:, 0].astype(float), doc[1:] == doc[:-1]
        score[1:] += self.near[0] * own[:-1, 1] * same
        score[:-1] += self.near[1] * own[1:, 1] * same
        chains = -(-sizes // CHAIN)
        column = np.repeat(np.cumsum(chains) - chains, sizes) + at // CHAIN
        grid = np.zeros((min(CHAIN, sizes.max()), chains.sum()))
        held = np.zeros(grid.shape, bool)
        grid[at % CHAIN, column], held[at % CHAIN, column] = score, True
        place = np.arange(chains.sum()) - np.repeat(np.cumsum(chains) - chains, chains)
        p = marginals(grid, self.steps, held, place)[at % CHAIN, column]
        return np.split(p, np.cumsum(sizes)[:-1])


def _chains(train: DataFrame, known: Evidence):
    """A bounded sample of runs of words with their labels, even over runs with and without telling words."""

    def make():
        def step(batch):
            out, has = [], []
            for text, y in zip(texts(batch), batch.column("y").to_pylist()):
                found = (text or "").split()
                for k in range(0, len(found), CHAIN):
                    part = found[k : k + CHAIN]
                    out.append(part)
                    has.append(bool(y) and any(plain(w) in known.telling for w in part))
            if out:
                yield rows(words=pa.array(out, pa.list_(pa.string())), toxic=pa.array(has, pa.bool_()))

        return step

    all_ = map_rows(train.select("text", "y"), make, "words array<string>, toxic boolean").distinct()
    many = {r.toxic: r["count"] for r in all_.groupBy("toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("words"), F.lit(RANGE)) < F.when(F.col("toxic"), _share(many.get(True), CHAINS)).otherwise(_share(many.get(False), CHAINS))
    return sorted(all_.where(drawn).collect(), key=lambda r: (r.toxic, r.words))


def _share(many: int | None, most: int) -> int:
    """Hash values below this draw about ``most`` of so many."""
    return int(min(1.0, most / max(1, many or 0)) * RANGE)


def fit_field(train: DataFrame, known: Evidence) -> Field:
    """Fit the field by gradient steps on the conditional likelihood of the sampled chains."""
    found = _chains(train, known)
    weights, near, steps = np.zeros(HASHED), np.zeros(2), np.zeros((2, 2))
    if not found:
        return Field(known, weights, near, steps)
    size = (max(len(r.words) for r in found), len(found))
    ids, y, told, held = np.zeros((*size, FEATURES), int), np.zeros(size), np.zeros(size), np.zeros(size, bool)
    cache: dict[str, list[int]] = {}
    for k, r in enumerate(found):
        n = len(r.words)
        ids[:n, k] = [cache.get(w) or cache.setdefault(w, word_features(w, known)) for w in r.words]
        told[:n, k] = [plain(w) in known.telling for w in r.words]
        y[:n, k], held[:n, k] = told[:n, k] * r.toxic, True
    before, after = np.zeros(size), np.zeros(size)
    before[1:], after[:-1] = told[:-1], told[1:]
    pair = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            pair[i, j] = ((y[:-1] == i) & (y[1:] == j) & held[1:]).sum()
    flat = np.zeros(HASHED + 6)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for k in range(1, STEPS + 1):
        weights, near, steps = flat[:HASHED], flat[HASHED : HASHED + 2], flat[HASHED + 2 :].reshape(2, 2)
        score = weights[ids].sum(2) + near[0] * before + near[1] * after
        p, expected = expected_steps(score, steps, held)
        gap = np.where(held, y - p, 0)
        slope = np.r_[
            np.bincount(ids.ravel(), np.repeat(gap.ravel(), FEATURES), HASHED),
            (gap * before).sum(), (gap * after).sum(), (pair - expected).ravel(),
        ] - PENALTY * flat
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        flat = flat + RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field(known, flat[:HASHED], flat[HASHED : HASHED + 2], flat[HASHED + 2 :].reshape(2, 2))


def toxic_spans(docs: DataFrame, field) -> DataFrame:
    """``doc_id, peak, mass, spans``: highest and summed marginal, and words of 0.5 and more.

    Offsets count code points of the text, end exclusive. A null text has no words.
    """

    def make():
        model = field.value
        memo, word = model.memo(), re.compile(r"\S+")

        def step(batch):
            ids, all_ = batch.column("doc_id").cast(pa.int64()), texts(batch)
            for k in range(0, len(all_), 500):
                part = all_[k : k + 500]
                peak, mass, spans = [], [], []
                for text, p in zip(part, model.marginals([(t or "").split() for t in part], memo)):
                    peak.append(float(p.max()) if len(p) else 0.0)
                    mass.append(float(p.sum()))
                    hit = []
                    if peak[-1] >= 0.5:
                        hit = [
                            {"start": m.start(), "end": m.end(), "p": float(q)}
                            for m, q in zip(word.finditer(text), p) if q >= 0.5
                        ]
                    spans.append(hit)
                yield rows(
                    doc_id=ids.slice(k, len(part)),
                    peak=pa.array(peak),
                    mass=pa.array(mass),
                    spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))),
                )

        return step

    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("peak", T.DoubleType()), T.StructField("mass", T.DoubleType()), T.StructField("spans", SPANS)]
    )
    return map_rows(docs.select("doc_id", "text"), make, schema)


def _signals(peak, mass, log, greatest, least):
    sure = least(greatest(peak, 1e-6), 1 - 1e-6)
    return log(sure / (1 - sure)), log(1 + mass)


def _logistic(sample) -> np.ndarray:
    """Weights of the two signals and a constant, by Newton steps with a small ridge; zeros without rows."""
    if not sample:
        return np.zeros(3)
    peak, mass, y = np.array(sorted([r.peak, r.mass, r.y] for r in sample), float).T
    x = np.stack([*_signals(peak, mass, np.log, np.maximum, np.minimum), np.ones(len(y))], 1)
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * w)
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_spans, spans`` for each row of ``doc_id, text``.

    Learns from rows of ``labels (doc_id, toxic)`` whose fold is not 0; null labels are passed
    over, and of several labels of one doc_id the larger counts. Empty texts get the score of a document without toxic words, a null doc_id is not
    held out, repeated rows are scored each. Without training rows every score is 0.5.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    marks = labels.where("doc_id is not null and toxic in (0, 1)").where(folds("doc_id", 5) != 0)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("y"))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(RANGE)) < _share(marks.count(), DOCUMENTS)
    marks = F.broadcast(land(marks.where(drawn), "marks"))  # about DOCUMENTS pairs of numbers
    train = land(docs.join(marks, "doc_id").dropDuplicates(["doc_id", "text"]), "train")
    known = evidence(train)
    field = fit_field(train, known)
    shared = Shared(spark, field)
    w = _logistic(toxic_spans(train, shared).join(marks, "doc_id").select("peak", "mass", "y").collect())
    seen = toxic_spans(docs, shared)
    a, b = _signals(F.col("peak"), F.col("mass"), F.log, lambda c, v: F.greatest(c, F.lit(v)), lambda c, v: F.least(c, F.lit(v)))
    score = 1 / (1 + F.exp(-(a * float(w[0]) + b * float(w[1]) + float(w[2]))))
    return seen.select(
        "doc_id",
        F.coalesce(folds("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
        "spans",
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
