"""Micro-batch sinks that can be repeated: one folder per batch, replaced as a whole."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

Sink = Callable[[DataFrame, int], None]


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """A micro-batch held on the executors' disks while it is used more than once.

    Lost blocks are read again from the source, which gives the same rows for the same
    batch.
    """
    held = rows.persist(StorageLevel.DISK_ONLY)
    try:
        yield held
    finally:
        held.unpersist()


def batch_folders(path: str) -> Sink:
    """Rows of batch N go to ``batch_id=N``. A batch written again replaces what it left."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches, without the batch number."""
    return spark.read.parquet(path).drop("batch_id")


def to_each(*sinks: Sink) -> Sink:
    """The same rows to several sinks."""

    def write(rows: DataFrame, batch_id: int) -> None:
        with kept(rows) as held:
            for sink in sinks:
                sink(held, batch_id)

    return write
