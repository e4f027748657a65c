"""Helpers shared by the operators: words, hashes, Arrow batches and landed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.session import written

#: What separates words: space and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows become Python objects, several times their size, in parts of at most so many bytes.
PART_BYTES = 4 << 20
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back, which also cuts the lineage."""
    return written(df, name)


def folds(column: str, count: int) -> Column:
    """Remainder of the unsigned crc32 of an id written as text."""
    return F.crc32(F.col(column).cast("string")) % count


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case. Bytes split exactly at the six separators."""
    return text.encode().lower().split() if text else []


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> _S30
    v *= _MIX1
    v ^= v >> _S27
    v *= _MIX2
    v ^= v >> _S31
    return v


class Memo(dict):
    """Remembers the bytes that ``make`` gives for a key; emptied when ``limit`` keys are held."""

    def __init__(self, make: Callable[[bytes], bytes], limit: int = 250_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value

    def joined(self, keys: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, keys))


class Shared:
    """A broadcast value of a class of this package; like functions, it may travel by value."""

    def __init__(self, spark: SparkSession, value):
        from pyspark import cloudpickle

        self._data, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self):
        return {"_data": self._data, "_value": None}

    @property
    def value(self):
        import pickle

        if self._value is None:
            self._value = pickle.loads(self._data.value)
        return self._value


def _kept() -> tuple[dict, set]:
    """What this worker process keeps by name, and the names that its task has asked for.

    Functions may travel to a task by value and then have fresh module variables in each, so
    both are held by a module of their own.
    """
    import sys
    from types import ModuleType

    store = sys.modules.setdefault("dripline_worker_values", ModuleType("dripline_worker_values")).__dict__
    return store.setdefault("held", {}), store.setdefault("asked", set())


def per_process(name, make: Callable[[], object]):
    """A value that a worker process keeps for its next tasks, until one does not ask for it."""
    held, asked = _kept()
    asked.add(name)
    if name not in held:
        held[name] = make()
    return held[name]


def let_go() -> None:
    """At the end of a task: drop what it did not ask for, and give freed memory back.

    Workers are used again by later stages, and by themselves keep the most that they ever held.
    """
    import ctypes

    held, asked = _kept()
    for name in held.keys() - asked:
        del held[name]
    asked.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def word_hashes() -> Memo:
    from hashlib import blake2b

    return Memo(lambda word: blake2b(word, digest_size=8).digest())


def halves(batch: pa.RecordBatch, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in order, cut where it holds more bytes than that; a single row stays whole."""
    if batch.nbytes <= most or batch.num_rows < 2:
        yield batch
    else:
        middle = batch.num_rows // 2
        yield from halves(batch.slice(0, middle), most)
        yield from halves(batch.slice(middle), most)


def map_rows(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
    schema: str,
    last: bool = False,
) -> DataFrame:
    """``mapInArrow`` with set-up once per task.

    ``make()`` runs in the task and gives the function of a batch, which sees at most PART_BYTES
    of rows, or one row. With ``last`` it is called once more with None after the final batch.
    What it gives is cut alike: a sent batch lies in memory whole on both sides.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for part in halves(batch):
                for out in step(part):
                    yield from halves(out)
        if last:
            for out in step(None):
                yield from halves(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            let_go()

    return df.mapInArrow(run, schema)


def rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(name).to_pylist()
