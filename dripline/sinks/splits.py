"""Several sinks fed from one pass over the rows, each with the rows of its tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dripline.operators.split import tag_rows
from dripline.session import files_of
from dripline.sinks.batches import Sink

TAG = "_tag"


def write_tagged(rows: DataFrame, tags: dict[str, Column], path: str) -> None:
    """Write all rows once, in a folder for each tag; a row is in exactly one (see ``tag_rows``)."""
    tag_rows(rows, tags, TAG).write.mode("overwrite").partitionBy(TAG).parquet(path)


def read_tagged(spark: SparkSession, path: str, tag: str, like: DataFrame) -> DataFrame:
    """The rows of one tag, of which only its own folder is read."""
    schema = T.StructType([*like.schema.fields, T.StructField(TAG, T.StringType())])
    return spark.read.schema(schema).parquet(path).where(F.col(TAG) == tag).drop(TAG)


def split_sink(tags: dict[str, Column], sinks: dict[str, Sink], folder: str) -> Sink:
    """Give each tag's rows to its sink (``main`` is for the rest); rows of tags without a sink end here.

    A batch is computed and written once, into the shared folder, however many sinks there are;
    the sinks read their own part of it, and then it goes.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        spark, path = rows.sparkSession, f"{folder}/split-{batch_id}"
        write_tagged(rows, tags, path)
        for tag, sink in sinks.items():
            sink(read_tagged(spark, path, tag, rows), batch_id)
        store, where = files_of(spark, path)
        store.delete(where, True)

    return write
