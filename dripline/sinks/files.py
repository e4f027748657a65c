"""Lines to files in folders by the hour of their event time."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline.functions import text, times
from dripline.functions.once import with_once
from dripline.session import files_of, written
from dripline.sinks import local
from dripline.sinks.batches import kept

# How often files roll, and the bytes of a file at most.
ROLL = "3 minutes"
PART_BYTES = 100 << 20
#: Files that a task writes, where they are small; opening a file takes longer than filling it.
TASK_FILES = 50
#: A part's folder.
BY = ["dt", "hr", "part"]
#: Folders that the driver removes at a time.
REMOVERS = 16


def with_hour_buckets(lines: DataFrame, column: str = "value", strict: bool = True) -> DataFrame:
    """Add ``dt`` and ``hr`` from the line's JSON ``ts``; a blank line counts as time 0.

    A line without a readable ``ts`` fails the job when strict, else counts as time 0.
    """
    ms = F.get_json_object(column, "$.ts").try_cast("bigint")
    if strict:
        bad = F.raise_error(F.concat(F.lit("no ts in line: "), F.col(column))).cast("bigint")
        ms = F.when(~text.is_blank(F.col(column)), F.coalesce(ms, bad))
    timed = with_once(lines, "_ms", F.coalesce(ms, F.lit(0).cast("bigint")))
    return timed.select(
        F.col(column).alias("value"),
        times.time_text(F.col("_ms"), times.DAY).alias("dt"),
        times.time_text(F.col("_ms"), times.HOUR).alias("hr"),
    )


def _each(part_bytes: int) -> int:
    """Files of a slice, and of a task: many small ones, a single large one."""
    return max(1, min(TASK_FILES, PART_BYTES // part_bytes))


def _hours(bucketed: DataFrame, part_bytes: int) -> DataFrame:
    """``_dt, _hr``, the bytes a file of the hour is filled to, about its files, and its slices."""
    size = F.octet_length("value") + 1
    hours = bucketed.groupBy("dt", "hr").agg(F.sum(size).alias("_bytes"), F.max(size).alias("_longest"))
    unit = F.greatest(F.lit(part_bytes) - F.col("_longest"), F.lit(1)).alias("_unit")
    files = F.ceil(F.col("_bytes") / (0.9 * part_bytes)).alias("_files")
    slices = F.ceil(F.col("_bytes") / (0.9 * part_bytes * _each(part_bytes))).alias("_slices")
    return hours.select(F.col("dt").alias("_dt"), F.col("hr").alias("_hr"), unit, files, slices)


def with_parts(
    bucketed: DataFrame, part_bytes: int = PART_BYTES, name: str = "", hours: DataFrame | None = None, tasks: int = 0
) -> DataFrame:
    """Add ``part``, the file of its hour that a line goes to; none holds more than ``part_bytes``.

    An hour's bytes give the number of its slices, which lines join by a hash, so that a busy hour
    is cut by many tasks. Inside a slice the bytes before a line (a prefix sum) give its file; a slice
    is to hold TASK_FILES small files, of which only the last is not full, or one large file. Files
    are filled to the limit less the hour's longest line, so that no line overruns it. A line longer
    than the limit is a file of its own. With ``tasks``, slices are dealt to so many, and the lines of a
    part follow one another.
    """
    size = F.octet_length("value") + 1
    hours = _hours(bucketed, part_bytes) if hours is None else hours
    # As many rows as there are hours: Spark broadcasts them where they are few.
    rows = bucketed.join(hours, F.col("dt").eqNullSafe(F.col("_dt")) & F.col("hr").eqNullSafe(F.col("_hr")), "left")
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(F.rand(7)), "_slices"))
    if tasks:
        rows = rows.repartition(tasks, "dt", "hr", "_slice")
    before = Window.partitionBy("dt", "hr", "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / F.col("_unit"))
    return rows.select("value", "dt", "hr", F.concat(F.lit(name), F.col("_slice"), F.lit("-"), number).alias("part"))


def write_hour_buckets(bucketed: DataFrame, path: str, batch_id: int = 0, part_bytes: int = PART_BYTES) -> None:
    """Write a batch by hour, in files of at most ``part_bytes``; written again, it replaces itself.

    A batch's parts bear its number. What an earlier try left is removed first, as it may have
    had other parts.
    """
    _remove_parts(bucketed.sparkSession, path, f"b{batch_id}-")
    _write_cut(bucketed, path, part_bytes, f"b{batch_id}-")


def _write_cut(bucketed: DataFrame, path: str, part_bytes: int, name: str) -> None:
    """Cut hours into parts and write them, by as many tasks as their files ask for.

    Spark would join the tasks of few bytes, however many files those are. Lines are made and parsed once.
    """
    with kept(bucketed) as held:
        hours = written(_hours(held, part_bytes), "hours")
        files = hours.agg(F.sum("_files")).first()[0] or 0
        tasks = -(-files // _each(part_bytes)) or 1
        _write_dealt(with_parts(held, part_bytes, name, hours, tasks), path, name)


def _write_parts(parts: DataFrame, path: str) -> None:
    _write_dealt(parts.repartition(*BY).sortWithinPartitions(*BY), path)


def _write_dealt(parts: DataFrame, path: str, name: str = "") -> None:
    """Write parts whose lines follow one another in one task."""
    here = local.local_path(parts.sparkSession, path)
    if here:
        local.write_lines(parts, here, BY, name)
    else:
        parts.write.partitionBy(*BY).mode("append").text(path)


def _remove_parts(spark: SparkSession, path: str, name: str) -> None:
    """Remove the parts whose names start so."""
    here = local.local_path(spark, path)
    if here:
        local.remove(spark, [f for p in (f"dt=*/hr=*/part={name}*", f"{local.STAGED}/{name}*") for f in local.found(here, p)])
        return
    store, where = files_of(spark, f"{path}/dt=*/hr=*/part={name}*")
    _remove(store, (status.getPath() for status in store.globStatus(where) or []))


def _remove(store, folders: Iterable) -> None:
    with ThreadPoolExecutor(REMOVERS) as pool:
        list(pool.map(lambda folder: store.delete(folder, True), folders))


def start_hour_buckets(
    bucketed: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = ROLL,
    part_bytes: int = PART_BYTES,
    name: str = "hour_buckets",
) -> StreamingQuery:
    """Write a stream; a micro-batch that is repeated replaces the files it left."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_hour_buckets(batch, path, batch_id, part_bytes)

    writer = bucketed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(name)
    return (
        writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    ).start()


def part_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``dt, hr, part, row_count, part_bytes`` of every file that readers see."""
    here = local.local_path(spark, path)
    if here:
        return _shown(local.counted(spark, here, BY), path)
    lines = _visible(spark, path)
    return lines.groupBy(*BY).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.octet_length("value") + 1).alias("part_bytes")
    )


def compact_hours(spark: SparkSession, path: str, before: str, part_bytes: int = PART_BYTES) -> int:
    """Merge the small files of the hours before ``before`` (``yyyyMMddHH``); gives the number of files replaced.

    The merged files come first, which no reader sees yet; then a manifest that shows them and
    hides what they replace; then the replaced files go. A run that fails anywhere is made good
    by the next one.
    """
    runs = _manifests(spark, path)
    run = 1 + max([0, *runs])
    for _, hidden in sorted(runs.items()):  # what a failed run may have left
        _remove_hidden(spark, path, hidden)
    _remove_parts(spark, path, f"m{run}-")
    closed = F.concat("dt", "hr") < before
    sizes = written(part_sizes(spark, path).where(closed), "sizes")
    hours = sizes.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n"), F.sum("part_bytes").alias("s"))
    wasteful = hours.where(F.col("n") > 2 * F.ceil(F.col("s") / part_bytes))
    old = written(sizes.join(wasteful, ["dt", "hr"], "left_semi").select("dt", "hr", "part"), "replaced")
    replaced = old.collect()  # names of files that are about to go, which the driver removes
    if replaced:
        merged = _visible(spark, path).join(old, ["dt", "hr", "part"], "left_semi").select("value", "dt", "hr")
        _write_cut(merged, path, part_bytes, f"m{run}-")
        old.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifests/run={run}")
        _remove_hidden(spark, path, replaced)
    return len(replaced)


def _manifests(spark: SparkSession, path: str) -> dict[int, list]:
    """The files that each finished run has replaced."""
    store, where = files_of(spark, f"{path}/_manifests/run=*/_SUCCESS")
    done = [s.getPath().getParent().toString() for s in store.globStatus(where) or []]
    return {int(p.rsplit("=", 1)[1]): spark.read.parquet(p).collect() for p in done}


def _remove_hidden(spark: SparkSession, path: str, hidden: list) -> None:
    here = local.local_path(spark, path)
    if here:
        local.remove(spark, ["/".join([here, *map(local.folder_of, BY, (r.dt, r.hr, r.part))]) for r in hidden])
        return
    store, _ = files_of(spark, path)
    _remove(store, (spark._jvm.org.apache.hadoop.fs.Path(f"{path}/dt={r.dt}/hr={r.hr}/part={r.part}") for r in hidden))


def _visible(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all parts but those that a merge has replaced, or has not finished."""
    # Hours as paths: each is listed by one task. From the top, Spark would list each part by a task of its own.
    store, hours = files_of(spark, f"{path}/dt=*/hr=*")
    reader = spark.read.schema("value string, dt string, hr string, part string").option("basePath", path)
    return _shown(reader.text(hours.toString() if store.globStatus(hours) else path), path)


def _shown(rows: DataFrame, path: str) -> DataFrame:
    """Rows of all parts but those that a merge has replaced, or has not finished."""
    spark = rows.sparkSession
    runs = _manifests(spark, path)
    merged = F.regexp_extract(F.coalesce("part", F.lit("")), "^m([0-9]+)-", 1)
    rows = rows.where((merged == "") | merged.isin([str(r) for r in runs]))
    hidden = [(r.dt, r.hr, r.part) for found in runs.values() for r in found]
    if not hidden:
        return rows
    return rows.join(spark.createDataFrame(hidden, "dt string, hr string, part string"), BY, "left_anti")


def read_hour_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The lines with their ``dt`` and ``hr`` as text."""
    return _visible(spark, path).select("value", "dt", "hr")
