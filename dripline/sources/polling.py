"""Incremental reads of a table by a high-water mark.

Each poll reads the rows past the mark through any Spark reader (JDBC, a document store,
files), so the bound is pushed into the store and the rows go straight to the executors.
Only the new mark, one value, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline.sinks.batches import batch_folders


@dataclass(frozen=True)
class Poller:
    """What to poll: ``read`` gives the whole table, ``column`` holds the mark.

    A strict bound (the default) loses rows that arrive later with the mark's own value;
    an inclusive one reads the rows on the mark again, to be removed by ``unique``.
    """

    read: Callable[[SparkSession], DataFrame]
    column: str
    first: Any
    inclusive: bool = False
    unique: tuple[str, ...] = ()

    def after(self, spark: SparkSession, mark: Any = None, upto: Any = None, ordered: bool = False) -> DataFrame:
        """Rows past the mark, and not past ``upto`` if given."""
        column, bound = F.col(self.column), F.lit(self.first if mark is None else mark)
        rows = self.read(spark).filter(column >= bound if self.inclusive else column > bound)
        if upto is not None:
            rows = rows.filter(column <= F.lit(upto))
        if self.unique:
            rows = rows.dropDuplicates(list(self.unique))
        return rows.orderBy(self.column) if ordered else rows

    def next_mark(self, spark: SparkSession, mark: Any = None) -> Any:
        """The greatest value past the mark, or the mark itself when there is none."""
        low = self.first if mark is None else mark
        latest = self.read(spark).filter(F.col(self.column) >= F.lit(low)).agg(F.max(self.column)).first()[0]
        return low if latest is None else latest


def start_polling(
    spark: SparkSession,
    poller: Poller,
    sink: Callable[[DataFrame, int], None],
    folder: str,
    interval: str = "5 seconds",
    name: str = "poll",
) -> StreamingQuery:
    """Poll at each tick of a clock stream; ``sink(rows, batch_id)`` takes what is new.

    For stores that only Spark's readers reach; files are better polled by ``polled``. The range
    of a batch is written down before its rows are read, so a batch that is repeated after a
    failure reads the same range again. Ranges and the clock's checkpoint live in ``folder``,
    which must be shared.
    """
    marks, write = f"{folder}/marks", batch_folders(f"{folder}/marks")

    def at(batch_id: int):
        return spark.read.parquet(f"{marks}/batch_id={batch_id}").first()

    def poll(_: DataFrame, batch_id: int) -> None:
        low = at(batch_id - 1)["high"] if batch_id else poller.first
        try:
            low, high = at(batch_id)
        except AnalysisException:  # the first try of this batch
            high = poller.next_mark(spark, low)
            write(spark.createDataFrame([(low, high)], ["low", "high"]), batch_id)
        if high != low or poller.inclusive:
            sink(poller.after(spark, low, high), batch_id)

    return _each_tick(spark, poll, folder, interval, name)


def start_scanning(
    spark: SparkSession,
    read: Callable[[SparkSession], DataFrame],
    sink: Callable[[DataFrame, int], None],
    folder: str,
    interval: str = "1 second",
    name: str = "scan",
) -> StreamingQuery:
    """Read the whole table at each tick, for tables without a column to hold a mark."""
    return _each_tick(spark, lambda _, batch_id: sink(read(spark), batch_id), folder, interval, name)


def _each_tick(
    spark: SparkSession, work: Callable[[DataFrame, int], None], folder: str, interval: str, name: str
) -> StreamingQuery:
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(work)
        .trigger(processingTime=interval)
        .option("checkpointLocation", f"{folder}/clock")
        .queryName(name)
        .start()
    )
