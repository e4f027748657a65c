"""One table per device, kept as one partitioned table with a small table of tags.

A folder per device would mean millions of folders. Devices share a fixed number of
hash folders instead, sorted by device inside the files, so reading one device prunes
to its folder and to the row groups that hold it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline import schemas
from dripline.sinks.batches import Sink, kept

BUCKETS = 256
_BUCKET = "bucket"


def _bucket(table_name, buckets: int):
    return F.pmod(F.xxhash64(table_name), F.lit(buckets)).cast("int")


def first_tags(records: DataFrame, tags: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Tags per device: those of its first record, as a device's table is made only once."""
    named = tags or schemas.PUMP_TAGS
    first = F.min(F.struct(*(order or ["ts"]), *named))
    rows = records.groupBy("tableName").agg(first.alias("_first"))
    return rows.select("tableName", *(F.col("_first")[t].alias(t) for t in named))


def subtable_rows(records: DataFrame, values: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Value columns with the routing column and its hash folder; records without a route fail."""
    missing = F.raise_error(F.lit("record without a table name")).cast("string")
    route = F.coalesce("tableName", missing)
    return records.select(
        route.alias("tableName"), *(values or schemas.PUMP_VALUES)
    ).withColumn(_BUCKET, _bucket(F.col("tableName"), buckets))


def write_subtables(
    records: DataFrame, path: str, batch_id: int = 0, values: list[str] | None = None, buckets: int = BUCKETS
) -> None:
    """Write a batch of records; written again, the batch replaces itself.

    The rebalance brings a folder's rows together and splits a folder that a busy
    device makes too big.
    """
    stored = stored_buckets(records.sparkSession, path)
    if stored is None:
        layout = records.sparkSession.createDataFrame([(buckets,)], "buckets int")
        layout.write.mode("overwrite").parquet(f"{path}/layout")
    elif stored != buckets:
        raise ValueError(f"the table at {path} has {stored} hash folders, not {buckets}")
    rows = subtable_rows(records, values, buckets)
    (
        rows.hint("rebalance", _BUCKET)
        .sortWithinPartitions(_BUCKET, "tableName", (values or schemas.PUMP_VALUES)[0])
        .write.partitionBy(_BUCKET)
        .mode("overwrite")
        .parquet(f"{path}/values/batch_id={batch_id}")
    )
    tags = [t for t in schemas.PUMP_TAGS if t in records.columns]
    if tags:
        first_tags(records, tags).write.mode("overwrite").parquet(f"{path}/tags/batch_id={batch_id}")


def subtable_sink(path: str, buckets: int = BUCKETS) -> Sink:
    def write(records: DataFrame, batch_id: int) -> None:
        with kept(records) as held:
            write_subtables(held, path, batch_id, None, buckets)

    return write


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """Number of hash folders that the table was made with; None if there is no table yet."""
    try:
        return spark.read.schema("buckets int").parquet(f"{path}/layout").first().buckets
    except AnalysisException:
        return None


def read_subtable(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One device's rows, from its hash folder by the count stored with the table."""
    rows, buckets = spark.read.parquet(f"{path}/values"), stored_buckets(spark, path)
    here = F.col("tableName") == table
    if buckets is not None:
        here &= F.col(_BUCKET) == _bucket(F.lit(table), buckets)
    return rows.filter(here).drop(_BUCKET, "batch_id")


def read_supertable(spark: SparkSession, path: str) -> DataFrame:
    """All devices' rows."""
    return spark.read.parquet(f"{path}/values").drop(_BUCKET, "batch_id")


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """Tags per device over all batches: the earliest batch that knows a device decides."""
    rows = spark.read.parquet(f"{path}/tags")
    tags = [c for c in rows.columns if c not in ("tableName", "batch_id")]
    first = F.min(F.struct("batch_id", *tags))
    found = rows.groupBy("tableName").agg(first.alias("_first"))
    return found.select("tableName", *(F.col("_first")[t].alias(t) for t in tags))
