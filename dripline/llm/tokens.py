"""Token ids as ORC: ordered documents, run-length encoded ids, row indexes and Bloom filters.

Rows are dealt by ranges of doc_id and sorted, so files ascend and each holds one range; the
statistics of stripes and row groups, and Bloom filters on doc_id, prune what a lookup reads.
Stripes are read in parallel. A row keeps the number of its range and of the ids before it in
that range, so a document's place among all ids follows from one total per range, however many
files a range was written to.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dripline.llm.common import map_rows, per_process, rows, texts
from dripline.session import scratch

END = 1
#: Words that an encoder remembers at once; punctuation that is split from a word before it.
REMEMBERED, BEHIND = 300_000, ".,;:!?*#$%&|"
#: Words of these letters only, which keep to one word when they are normalised.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
LATIN = re.compile(LETTERS[1:-1]).fullmatch
ALPHABET = "".join(c for c in map(chr, range(0x100)) if LATIN(c))
#: An encoder takes at most so many rows at a time, and no further row beyond so many characters.
BLOCK, BLOCK_CHARS = 1000, 4 << 20
#: Bytes of a stripe and rows between two entries of the row index.
STRIPE, STRIDE = 16 << 20, 1000
TOKENS = "doc_id long, part long, before long, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(STRIPE),
    "orc.row.index.stride": str(STRIDE),
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Encodes whole texts; equal words between blanks are encoded once and remembered.

    The tokenizer splits at white space and drops it before anything else looks at two words
    together, so the ids of a text are those of its words in turn. It also splits letters from
    punctuation, and lower-cases; so a word of Latin letters goes straight to its merges, and
    punctuation behind one is encoded by itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
        # How the merges write a letter: its bytes as characters.
        self.written = {ord(c): c if c.isascii() else cut(c)[0][0] for c in map(chr, range(0x100)) if LATIN(c)}
        self._forget()

    def _forget(self) -> None:
        """A word's number is its place among the remembered ones; their ids stand in one array."""
        self.numbers: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def _places(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; those not met before are encoded."""
        numbers, ids, ends = self.numbers, self.ids, self.ends
        merges, encode, written = self.tokenizer.model.tokenize, self.tokenizer.encode, self.written
        for word in words:
            if word not in numbers:
                if word.isascii() and word.isalpha():
                    ids.extend([t.id for t in merges(word.lower())])
                elif LATIN(word):
                    ids.extend([t.id for t in merges(word.lower().translate(written))])
                else:
                    ids.extend(encode(word, add_special_tokens=False).ids)
                ends.append(len(ids))
                numbers[word] = len(numbers)
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, one after another, and how many each has."""
        if len(self.numbers) >= REMEMBERED:
            self._forget()
        letters = pc.utf8_rtrim(words, BEHIND)
        latin = pc.match_substring_regex(letters, LETTERS)
        front = pc.if_else(latin, letters, words)
        behind = pc.if_else(latin, pc.utf8_ltrim(words, ALPHABET), "")
        parts = pa.concat_arrays([front, behind.cast(front.type)]).dictionary_encode()
        place = self._places(parts.dictionary.to_pylist())[parts.indices.to_numpy().reshape(2, -1).T.ravel()]
        ends = np.frombuffer(self.ends, np.int64)
        size = ends[place + 1] - ends[place]
        ids = _gathered(np.frombuffer(self.ids, np.int32), ends[place], size) if len(self.ids) else np.empty(0, np.int32)
        return ids, size.reshape(-1, 2).sum(1)

    def __call__(self, found: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's ids end.

        A block's words are numbered first, so that each distinct word is looked up once a block.
        """
        plain = [t.lower() if t and t.isascii() and "<|" not in t else t or "" for t in found]
        split = pc.split_pattern(pa.array([t.replace("\n", " ") for t in plain], pa.large_string()), " ")
        numbered = split.flatten().dictionary_encode()
        ids, size = self._words(numbered.dictionary)
        word, first = numbered.indices.to_numpy(), np.cumsum(size) - size
        last = np.r_[0, np.cumsum(size[word])][np.cumsum(split.value_lengths().to_numpy())]
        flat = np.insert(_gathered(ids, first[word], size[word]), last, END)
        return flat, last + np.arange(1, len(found) + 1)


def _gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of values, one after another."""
    ends = np.cumsum(size)
    at = np.repeat((first - ends + size).astype(np.int32 if max(len(values), ends[-1:].sum()) < 1 << 31 else np.int64), size)
    at += np.arange(len(at), dtype=at.dtype)
    return values[at]


def encoder(path: str) -> Encoder:
    """The encoder of this worker process, with what it remembers from earlier tasks."""
    return per_process(("encoder", path), lambda: Encoder(path))


def blocks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows that an encoder takes at a time; a very long row ends its run."""
    first = chars = 0
    for k, n in enumerate(sizes):
        chars += n
        if k + 1 == len(sizes) or k + 1 - first == BLOCK or chars >= BLOCK_CHARS:
            yield first, k + 1
            first, chars = k + 1, 0


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, part, before, ids`` in ascending order of doc_id, null first, equal ids by text.

    ``before`` counts the ids of earlier rows of the same partition, whose number is ``part``.
    """

    def make():
        encode, before, part = encoder(tokenizer), 0, TaskContext.get().partitionId()

        def step(batch):
            nonlocal before
            all_, ids = texts(batch), batch.column("doc_id").cast(pa.int64())
            for k, stop in blocks([len(t or "") for t in all_]):
                found, ends = encode(all_[k:stop])
                starts = np.r_[0, ends[:-1]]
                yield rows(
                    doc_id=ids.slice(k, len(ends)),
                    part=pa.array(np.full(len(ends), part), pa.int64()),
                    before=pa.array(starts + before, pa.int64()),
                    ids=pa.ListArray.from_arrays(
                        pa.array(np.r_[0, ends], pa.int32()), pa.array(found, pa.int32())
                    ),
                )
                before += int(ends[-1])

        return step

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return map_rows(ordered, make, TOKENS)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None) -> None:
    """Write the ids of every whole text; a null text has the end id only."""
    encoded(docs, tokenizer or default_tokenizer()).write.options(**OPTIONS).orc(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids``; ``start`` counts the ids of all documents before it.

    What is broadcast is two numbers for each task of the write.
    """
    seen = spark.read.schema(TOKENS).orc(folder)
    totals = seen.groupBy("part").agg(F.max(F.col("before") + F.size("ids")).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return seen.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the ids as little-endian 32-bit integers."""

    def make():
        def step(batch):
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy().astype("<u4")
            sizes = ids.value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            yield rows(
                doc_id=batch.column("doc_id"),
                start=batch.column("start"),
                n_tokens=pa.array(sizes, pa.int64()),
                ids_crc32=pa.array([zlib.crc32(flat[e - n : e]) for e, n in zip(ends, sizes)], pa.int64()),
            )

        return step

    return map_rows(tokens, make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write the ids to the shared folder and describe what is read back."""
    folder = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer)
    return digests(read_tokens(docs.sparkSession, folder))
