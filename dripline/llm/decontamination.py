"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared in lower case without punctuation at their ends; words of punctuation only
are passed over. Three-word seeds of the test items are looked up in every document. Hits of
one item near one diagonal make a region. A seed is rare by the number of documents that hold
it; a region is aligned if it has a rare seed, or several different seeds, so that an item
copied into very many documents is still found. The alignment tolerates words changed,
inserted and left out.

Test items go through in blocks of bounded size, each a broadcast; documents are read once per
block. Regions carry the hashed words they cover, so texts are not read or moved again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.llm.common import Memo, Shared, land, map_rows, mix, rows, texts, words

SEED_WORDS = 3
#: A seed in at most this many documents, or this share of them, is rare.
RARE, RARE_SHARE = 20, 1e-4
#: Different seeds that make a region without a rare one worth aligning.
SEVERAL = 2
#: Characters of test items in one block.
BLOCK_CHARS = 4_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's best possible score from which a document counts as contaminated.
THRESHOLD = 0.5
EDGES = b" .,;:!?*#$%&|\"'()[]{}<>"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
EMPTY = 0
BITS = 22


def plain_words() -> Memo:
    """Hash of a word without punctuation at its ends, EMPTY if nothing is left."""
    from hashlib import blake2b

    def make(word: bytes) -> bytes:
        word = word.strip(EDGES)
        return blake2b(word, digest_size=8).digest() if word else EMPTY.to_bytes(8, "little")

    return Memo(make)


def plain(text: str | None, memo: Memo) -> np.ndarray:
    h = np.frombuffer(memo.joined(words(text)), "<u8")
    return h[h != EMPTY]


def seeds(h: np.ndarray) -> np.ndarray:
    """Hash of the SEED_WORDS words from each position on."""
    n = len(h) - SEED_WORDS + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, SEED_WORDS):
        out = out * _A + h[k : n + k] * _B
    return mix(out)


class Items:
    """A block of test items: their words, and a table of their seeds by hash."""

    def __init__(self, found: list[tuple[int, str]]):
        memo = plain_words()
        self.ids, self.words = [i for i, _ in found], [plain(t, memo) for _, t in found]
        hashes = [seeds(w) for w in self.words]
        item = np.repeat(np.arange(len(hashes)), np.array([len(h) for h in hashes], np.int64))
        at = np.concatenate([np.arange(len(h)) for h in hashes] or [np.empty(0, int)]).astype(np.int64)
        seed = np.concatenate(hashes or [np.empty(0, np.uint64)])
        order = np.argsort(seed, kind="stable")
        self.seed, self.item, self.at = seed[order], item[order], at[order]
        self.coarse = np.zeros(1 << BITS, bool)
        self.coarse[(self.seed >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position in the document, and index of the seed's row here, for all matches."""
        own = seeds(h)
        near = np.flatnonzero(self.coarse[(own >> np.uint64(64 - BITS)).astype(np.int64)])
        lo, hi = (np.searchsorted(self.seed, own[near], side) for side in ("left", "right"))
        count = hi - lo
        spot = np.repeat(near, count)
        row = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
        return spot, row, self.seed[row]

    def regions(self, h: np.ndarray):
        """``(item, first word, last word, seeds)`` of the hits that lie near one diagonal."""
        spot, row, seed = self.hits(h)
        item, shift = self.item[row], spot - self.at[row]
        order = np.lexsort((shift, item))
        spot, item, shift, seed = (x[order] for x in (spot, item, shift, seed))
        size = np.array([len(w) for w in self.words], np.int64)
        if not len(item):
            return
        apart = (item[1:] != item[:-1]) | (shift[1:] - shift[:-1] > size[item[1:]] // 2 + 4)
        starts = np.flatnonzero(np.r_[True, apart])
        for a, b in zip(starts, np.r_[starts[1:], len(item)]):
            n = int(size[item[a]])
            low, high = int(shift[a]) - n // 2 - 4, int(shift[b - 1]) + n + n // 2 + 4
            yield int(item[a]), max(0, low), min(len(h), high), np.unique(seed[a:b])


def align(item: np.ndarray, doc: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word lists, and the document position where it ends.

    Row by row over the item; a gap in the row is a running maximum, as gaps cost the same each.
    """
    best, end = 0, 0
    slope = np.arange(len(doc)) * -GAP
    above = np.zeros(len(doc) + 1, np.int64)
    for w in item:
        row = np.maximum(above[:-1] + np.where(doc == w, MATCH, MISMATCH), above[1:] + GAP)
        row = np.maximum(row, 0)
        row = np.maximum.accumulate(row + slope) - slope
        above[1:] = row
        at = int(row.argmax()) if len(row) else 0
        if len(row) and row[at] > best:
            best, end = int(row[at]), at + 1
    return best, end


def _regions(docs: DataFrame, items) -> DataFrame:
    def make():
        memo = plain_words()

        def step(batch):
            ids, all_ = batch.column("doc_id").to_pylist(), texts(batch)
            out = [
                (doc, item, a, h[a:b].tobytes(), s.view(np.int64).tolist())
                for doc, text in zip(ids, all_)
                for h in (plain(text, memo),)
                for item, a, b, s in items.value.regions(h)
            ]
            if out:
                doc, item, first, words_, found = zip(*out)
                yield rows(
                    doc_id=pa.array(doc, pa.int64()), item=pa.array(item, pa.int64()), first=pa.array(first, pa.int64()),
                    words=pa.array(words_, pa.binary()), seeds=pa.array(found, pa.list_(pa.int64())),
                )

        return step

    return map_rows(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make,
        "doc_id long, item long, first long, words binary, seeds array<long>",
    )


def _aligned(regions: DataFrame, items) -> DataFrame:
    def make():
        def step(batch):
            score, end = [], []
            for item, raw in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                s, e = align(items.value.words[item], np.frombuffer(raw, "<u8"))
                score.append(s / (MATCH * len(items.value.words[item])))
                end.append(e)
            ids = [items.value.ids[i] for i in batch.column("item").to_pylist()]
            yield rows(
                doc_id=batch.column("doc_id"), item_id=pa.array(ids, pa.int64()), score=pa.array(score, pa.float64()),
                end_word=pa.array(np.array(end, np.int64) + batch.column("first").to_numpy()),
            )

        return step

    return map_rows(regions, make, "doc_id long, item_id long, score double, end_word long")


def _blocks(benchmark: DataFrame):
    """The test items in lists of about BLOCK_CHARS characters, one list at a time."""
    usable = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "item_id is not null and text is not null"
    )
    total = usable.agg(F.sum(F.length("text"))).first()[0] or 0
    count = total // BLOCK_CHARS + 1
    for k in range(count):
        part = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).distinct()
        yield [(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, end_word``: pairs that reach the threshold, each once.

    ``score`` is the share of the item's best possible alignment score, ``end_word`` counts the
    document's words that are not bare punctuation. Null texts and items, null ids, and items
    or documents of fewer than SEED_WORDS such words match nothing. Repeated rows of a document
    give one row a pair.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null and text is not null")
    limit = max(RARE, int(docs.select("doc_id").count() * RARE_SHARE))
    found = None
    for block in _blocks(benchmark):
        items = Shared(spark, Items(block))
        regions = land(_regions(docs, items), "regions")
        held = regions.select("doc_id", F.explode("seeds").alias("seed"))
        rare = held.groupBy("seed").agg(F.count_distinct("doc_id").alias("n")).where(F.col("n") <= limit).select("seed")
        key = ["doc_id", "item", "first"]
        told = regions.select(*key, F.explode("seeds").alias("seed")).join(rare, "seed").select(*key).distinct()
        lone = regions.where(F.size("seeds") < SEVERAL).join(told, key, "left_semi")
        part = _aligned(regions.where(F.size("seeds") >= SEVERAL).union(lone), items).where(F.col("score") >= threshold)
        found = part if found is None else found.union(part)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("end_word")).alias("e"))).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.e")).alias("end_word"))
