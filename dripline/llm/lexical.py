"""Ranked lexical search by reading impact-sorted lists without random access (NRA).

Every document is reduced once to the terms that some item asks for. A task turns its documents
into shards of bounded size: in a shard each term has a list of (impact, document), greatest
impact first. An item reads its lists in parallel from the top. What has been read of a document
is the lower end of its score; the next unread impact of each list that has not shown the
document yet may be added, which gives the upper end. Reading goes on until every document whose
upper end reaches the item's last place has both ends equal, so that membership, ties and scores
are settled. The least score that still ranks is carried from shard to shard of a task.
"""

from __future__ import annotations

from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dripline.llm.common import Shared, land, map_rows, rows, texts

#: Highest places that are reported.
TOP = 20
#: Entries of a shard's lists, entries that a list reads at first, and characters of a block of items.
ENTRIES, READ, BLOCK_CHARS = 2_000_000, 256, 4_000_000
#: Parts in which an item's places are merged before the last merge.
MERGES = 64
_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_SPLIT = bytes(ord(chr(b).lower()) if b < 128 and b in _TERM else b if b in _TERM else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of digits, letters and non-ASCII characters, A-Z in lower case."""
    return text.encode().translate(_SPLIT).split() if text else []


class Items:
    """The items of a block: each one's terms with their numbers of uses, and the terms' ids."""

    def __init__(self, found: dict[int | None, Counter]):
        self.names = list(found)
        self.ids = {t: k for k, t in enumerate(sorted({t for uses in found.values() for t in uses}))}
        self.uses = [[(self.ids[t], n) for t, n in sorted(uses.items())] for uses in found.values()]


def _blocks(items: DataFrame):
    """Items in lists of about BLOCK_CHARS characters, one list at a time; rows of one id are one item."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    count = (items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS + 1
    for k in range(count):
        found: dict[int | None, Counter] = {}
        for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).toLocalIterator():
            found.setdefault(r.item_id, Counter()).update(terms(r.text))
        if found:
            yield Items(found)


def _uses(docs: DataFrame, items: Shared) -> DataFrame:
    """Of each document the number of its terms, and how often it has each term of an item."""

    def make():
        ids = items.value.ids

        def step(batch):
            size, sizes, which, uses = [], [0], [], []
            for text in texts(batch):
                found = terms(text)
                size.append(len(found))
                asked = Counter(filter(None.__ne__, map(ids.get, found)))
                which += asked
                uses += asked.values()
                sizes.append(len(which))
            edges = pa.array(sizes, pa.int32())
            yield rows(
                doc_id=batch.column("doc_id").cast(pa.int64()),
                size=pa.array(size, pa.int64()),
                terms=pa.ListArray.from_arrays(edges, pa.array(which, pa.int32())),
                uses=pa.ListArray.from_arrays(edges, pa.array(uses, pa.int64())),
            )

        return step

    return map_rows(docs.select("doc_id", "text"), make, "doc_id long, size long, terms array<int>, uses array<long>")


def ranked(lists: list[tuple[np.ndarray, np.ndarray]], size: int, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Documents 0 to size - 1 that may be among the ``most`` highest, with their scores.

    A list has documents and impacts, greatest impact first, each document once. Only scores of
    ``least`` and more count. All ties of the last place are given.
    """
    lower, read, step = np.zeros(size, np.int64), [0] * len(lists), READ
    while True:
        ahead = []
        for k, (docs, impacts) in enumerate(lists):
            a, b = read[k], min(read[k] + step, len(docs))
            lower[docs[a:b]] += impacts[a:b]
            read[k] = b
            ahead.append(int(impacts[b]) if b < len(docs) else 0)
        upper = lower + sum(ahead)
        for k, (docs, _) in enumerate(lists):
            if ahead[k]:
                upper[docs[: read[k]]] -= ahead[k]
        last = int(np.partition(lower, size - most)[size - most]) if size >= most else 0
        able = np.flatnonzero(upper >= max(last, least))
        if (upper[able] == lower[able]).all():
            return able, lower[able]
        step *= 2


class _Shard:
    """Documents of a task, searched for all items when enough have come."""

    def __init__(self, items: Items, weights: np.ndarray, documents: int, length: int):
        self.items, self.weights, self.documents, self.length = items, weights, documents, length
        self.parts: list[tuple] = []
        self.entries = 0
        #: For each item ids and scores of the highest documents so far, best first.
        self.best = [(np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)) for _ in items.names]

    def add(self, batch: pa.RecordBatch) -> None:
        ids, found = batch.column("doc_id"), batch.column("terms")
        counts = np.diff(found.offsets.to_numpy())
        self.parts.append((
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("size").to_numpy(),
            counts, found.flatten().to_numpy(), batch.column("uses").flatten().to_numpy(),
        ))
        self.entries += int(counts.sum())
        if self.entries >= ENTRIES:
            self.search()

    def search(self) -> None:
        if not self.parts:
            return
        ids, lost, size, counts, term, uses = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.entries = [], 0
        doc = np.repeat(np.arange(len(ids)), counts)
        m = 75 + 25 * size * self.documents // max(self.length, 1)
        impact = self.weights[term] * (1_000_000_000 * uses // (1000 * uses + 12 * m[doc]))
        order = np.lexsort((-impact, term))
        doc, impact = doc[order], impact[order]
        edges = np.searchsorted(term[order], np.arange(len(self.weights) + 1))
        for k, uses_of in enumerate(self.items.uses):
            lists = [(doc[edges[t] : edges[t + 1]], n * impact[edges[t] : edges[t + 1]]) for t, n in uses_of]
            best = self.best[k]
            at, score = ranked(lists, len(ids), TOP, int(best[2][-1]) if len(best[2]) >= TOP else 1)
            own = tuple(np.concatenate(c) for c in zip(best, (ids[at], lost[at], score)))
            top = np.lexsort((own[0], own[1], -own[2]))[:TOP]
            self.best[k] = tuple(c[top] for c in own)

    def found(self) -> pa.RecordBatch:
        self.search()
        many = [len(score) for _, _, score in self.best]
        ids, lost, score = (np.concatenate([b[c] for b in self.best] or [np.empty(0, np.int64)]) for c in range(3))
        return rows(
            item=pa.array(np.repeat(np.arange(len(many)), many), pa.int64()),
            doc_id=pa.array(ids, pa.int64(), mask=lost.astype(bool)),
            score=pa.array(score, pa.int64()),
        )


def _searched(uses: DataFrame, items: Shared, weights: Shared, documents: int, length: int) -> DataFrame:
    def make():
        shard = _Shard(items.value, weights.value, documents, length)

        def step(batch):
            if batch is None:
                yield shard.found()
            else:
                shard.add(batch)

        return step

    return map_rows(uses, make, "item long, doc_id long, score long", last=True)


def _ranked_first(found: DataFrame, by: list[str]) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP)


def lexical_search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``item_id, rank, doc_id, score``: the TOP highest documents of each item, scores above 0 only.

    Each row of ``docs (doc_id, text)`` is a document, so repeated rows are ranked each; a null
    doc_id is ranked last among equal scores. Rows of ``items (item_id, text)`` with one id, null
    too, are one item with all their terms. Null and empty texts have no terms. No documents, no
    items or no common terms give no rows. Other columns are not read.
    """
    spark, out = docs.sparkSession, None
    for block in _blocks(items):
        known = Shared(spark, block)
        uses = land(_uses(docs, known), "uses")
        whole = uses.agg(F.count(F.when(F.col("size") > 0, 1)).alias("n"), F.sum("size").alias("l")).first()
        n, length = whole.n, whole.l or 0
        # At most one row for each term of the block, whose size BLOCK_CHARS bounds.
        held = uses.select(F.explode("terms").alias("t")).groupBy("t").count().toPandas()
        weights = np.zeros(len(block.ids), np.int64)
        weights[held["t"].to_numpy()] = [floor(1000 * log((2 * n + 2) / (2 * df + 1))) for df in held["count"].tolist()]
        found = _searched(uses, known, Shared(spark, weights), n, length)
        found = _ranked_first(found.withColumn("merge", F.spark_partition_id() % MERGES), ["item", "merge"]).drop("rank", "merge")
        names = spark.createDataFrame(list(enumerate(block.names)), "item long, item_id long")
        part = _ranked_first(found, ["item"]).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
