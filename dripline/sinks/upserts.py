"""Documents by id, kept over batches: a later write of an id replaces the earlier one.

Rows are dealt to a fixed number of hash buckets by their id. A batch rewrites only the buckets
it touches, into folders of its own, and then writes a manifest that says where each bucket now
lies; readers follow the newest manifest, so they see a batch whole or not at all. A batch that is
repeated starts from the manifest before it and gives the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.session import files_of
from dripline.sinks.batches import kept

#: Buckets of a table; a bucket is rewritten whole, so it should hold about one file's worth of rows.
BUCKETS = 256
_BUCKET, _BATCH = "bucket", "_batch"


@dataclass(frozen=True)
class UpsertTable:
    """A table with one row per ``keys``; in a batch the greatest ``order`` wins, over batches the last one."""

    folder: str
    keys: list[str]
    order: list[str]
    buckets: int = BUCKETS

    def _manifest(self, batch_id: int) -> str:
        return f"{self.folder}/manifests/batch={batch_id}"

    def _at(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        """Bucket to the batch that wrote it, as that batch's manifest has it; at most one entry a bucket."""
        if batch_id < 0:
            return {}
        try:
            rows = spark.read.parquet(self._manifest(batch_id)).collect()
        except AnalysisException:
            raise ValueError(f"no manifest of batch {batch_id} in {self.folder}: batches must follow one another") from None
        if rows and rows[0].buckets != self.buckets:
            raise ValueError(f"the table at {self.folder} has {rows[0].buckets} buckets, not {self.buckets}")
        return {r.bucket: r.written for r in rows if r.bucket >= 0}

    def _rows(self, spark: SparkSession, at: dict[int, int], some: list[int]) -> DataFrame | None:
        paths = [f"{self.folder}/rows/batch={at[b]}/{_BUCKET}={b}" for b in some if b in at]
        return spark.read.parquet(*paths) if paths else None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """One batch, numbered from 0 without gaps (as micro-batches are)."""
        spark, before = rows.sparkSession, self._at(rows.sparkSession, batch_id - 1)
        values = [*self.order, *(c for c in rows.columns if c not in (*self.keys, *self.order))]
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        # A maximum: partial results keep an id with very many writes cheap.
        newest = rows.groupBy(*self.keys).agg(F.max(F.struct(*values)).alias("_row"))
        newest = newest.select(*self.keys, *(F.col("_row")[c].alias(c) for c in values)).withColumn(_BUCKET, bucket)
        with kept(newest.withColumn(_BATCH, F.lit(batch_id).cast("bigint"))) as fresh:
            touched = sorted(r.bucket for r in fresh.select(_BUCKET).distinct().collect())
            old = self._rows(spark, before, touched)
            if old is not None:
                both = fresh.unionByName(old.withColumn(_BUCKET, bucket))
                last = F.max(F.struct(_BATCH, *values)).alias("_row")
                merged = both.groupBy(*self.keys).agg(last)
                merged = merged.select(*self.keys, *(F.col("_row")[c].alias(c) for c in (*values, _BATCH))).withColumn(_BUCKET, bucket)
            else:
                merged = fresh
            merged.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.folder}/rows/batch={batch_id}")
        after = before | dict.fromkeys(touched, batch_id)
        # Bucket -1 keeps the layout of a table that has no rows yet.
        entries = [(b, n, self.buckets) for b, n in {**after, -1: batch_id}.items()]
        manifest = spark.createDataFrame(entries, "bucket int, written bigint, buckets int")
        manifest.coalesce(1).write.mode("overwrite").parquet(self._manifest(batch_id))
        self._remove_replaced(spark, batch_id - 1, before)

    def _remove_replaced(self, spark: SparkSession, last: int, now: dict[int, int]) -> None:
        """Once a batch follows it, a batch is never repeated: what it replaced can go."""
        if last < 1:
            return
        earlier = self._manifest(last - 1)
        store, where = files_of(spark, earlier)
        if not store.exists(where):
            return
        for bucket, written in self._at(spark, last - 1).items():
            if now.get(bucket) != written:
                store.delete(files_of(spark, f"{self.folder}/rows/batch={written}/{_BUCKET}={bucket}")[1], True)
        store.delete(where, True)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The table as its newest manifest has it; nothing before the first row."""
        store, where = files_of(spark, f"{self.folder}/manifests")
        if not store.exists(where):
            return None
        done = [s.getPath().toString() for s in store.listStatus(where)]
        done = [p for p in done if store.exists(files_of(spark, f"{p}/_SUCCESS")[1])]
        at = self._at(spark, max(int(p.rsplit("=", 1)[1]) for p in done)) if done else {}
        rows = self._rows(spark, at, sorted(at))
        return None if rows is None else rows.drop(_BATCH)
