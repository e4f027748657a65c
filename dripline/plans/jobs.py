"""Runnable jobs: a source, a chain of operators and a sink, set up from a settings file.

A job's block under ``jobs:`` names its source and sink (a block under ``app:``, or one
written in place), the shared ``folder`` for its checkpoint and state, and its trigger
interval; without an interval it runs on what there is and ends.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dripline import schemas
from dripline.config import block
from dripline.functions import cells, text
from dripline.operators import keyed, lookup, rows, split
from dripline.plans import alarms, etl
from dripline.plans.sqljob import run_sql_job
from dripline.session import scratch
from dripline.sinks import stores
from dripline.sinks.batches import Sink, kept
from dripline.sinks.factory import batch_sink
from dripline.sinks.files import start_hour_buckets, with_hour_buckets
from dripline.sinks.jdbc import jdbc_table
from dripline.sinks.splits import split_sink
from dripline.sources.polled import polled
from dripline.sources.polling import Poller, start_polling, start_scanning
from dripline.sources.readers import open_source
from dripline.streaming.carried import running_total_stream, start_batches

JOBS: dict[str, Callable[[Job], StreamingQuery]] = {}


@dataclass
class Job:
    """One job's settings, and what they open."""

    spark: SparkSession
    config: dict[str, Any]
    name: str
    settings: dict[str, Any] = field(init=False)

    def __post_init__(self) -> None:
        known = self.config.get("jobs") or {}
        if self.name not in known:
            raise KeyError(f"no job {self.name!r} in the settings; known: {', '.join(sorted(known)) or 'none'}")
        self.settings = dict(known[self.name] or {})
        self.settings.setdefault("folder", scratch(self.spark, self.name))

    def _block(self, part: str | dict[str, Any]) -> dict[str, Any]:
        return block(self.config, part) if isinstance(part, str) else part

    @property
    def kind(self) -> str:
        return self.settings.get("job", self.name)

    @property
    def folder(self) -> str:
        return self.settings["folder"]

    @property
    def trigger(self) -> str | None:
        return self.settings.get("trigger")

    @property
    def strict(self) -> bool:
        return bool(self.settings.get("strict", True))

    def order(self, stream: DataFrame) -> list[str]:
        """The columns of the arrival order: those set, or the message log's own."""
        own = [c for c in ("offset", "partition", "topic") if c in stream.columns]
        return list(self.settings.get("order") or own)

    def source(self) -> DataFrame:
        return open_source(self.spark, self._block(self.settings["source"]))

    def sink(self, part: str = "sink") -> Sink:
        return batch_sink(self._block(self.settings[part]))

    def start(self, stream: DataFrame, sink: Sink | None = None) -> StreamingQuery:
        return start_batches(stream, sink or self.sink(), self.folder, self.name, self.trigger)


def job(start: Callable[[Job], StreamingQuery]) -> Callable[[Job], StreamingQuery]:
    JOBS[start.__name__] = start
    return start


def start_job(
    spark: SparkSession,
    config: dict[str, Any],
    name: str,
    hook: Callable[[SparkSession, dict[str, Any]], None] | None = None,
) -> StreamingQuery:
    """Start a job of the settings file; its ``job`` key says which kind, or its own name does.

    ``hook`` sees the session and the job's settings before anything starts.
    """
    made = Job(spark, config, name)
    if made.kind not in JOBS:
        raise KeyError(f"no kind of job {made.kind!r}; known: {', '.join(sorted(JOBS))}")
    if hook:
        hook(spark, made.settings)
    return JOBS[made.kind](made)


@job
def archive_lines(j: Job) -> StreamingQuery:
    """Raw lines to files by the hour of their event time."""
    bucketed = with_hour_buckets(j.source(), strict=j.strict)
    return start_hour_buckets(bucketed, j.settings["path"], f"{j.folder}/checkpoint", j.trigger, name=j.name)


@job
def pump_alarms(j: Job) -> StreamingQuery:
    """Device lines to alarm rows stamped with the start of their session."""
    lines = j.source()
    return alarms.alarm_stream_job(
        lines,
        j.order(lines),
        j.sink(),
        j.folder,
        int(j.settings.get("gap_ms", alarms.SILENCE_MS)),
        j.strict,
        j.trigger,
        j.settings.get("ttl_ms"),
    )


@job
def pump_subtables(j: Job) -> StreamingQuery:
    """Lines of infusing devices to one table per device; bad lines are left out."""
    return j.start(rows.flatten_pump(rows.in_state(rows.with_pump(j.source())), j.strict))


@job
def word_count(j: Job) -> StreamingQuery:
    """Running totals per word: the words that changed, or every total after each batch."""
    totals = keyed.word_totals(rows.explode_parts(j.source()), "word")
    writer = totals.writeStream.foreachBatch(j.sink()).outputMode(j.settings.get("mode", "update"))
    writer = writer.queryName(j.name).option("checkpointLocation", f"{j.folder}/checkpoint")
    return (writer.trigger(processingTime=j.trigger) if j.trigger else writer.trigger(availableNow=True)).start()


@job
def running_word_count(j: Job) -> StreamingQuery:
    """A new total for every single word, in the order of arrival."""
    lines = j.source()
    order = j.order(lines)
    words = lines.select(*order, F.posexplode(text.parts(F.col("value"))).alias("pos", "word"))
    return running_total_stream(
        words, ["word"], [*order, "pos"], j.sink(), j.folder, name=j.name, trigger=j.trigger
    )


@job
def young_users(j: Job) -> StreamingQuery:
    """User messages under the age limit to a table."""
    return j.start(etl.young_users(j.source(), j.strict).select("name", "age"))


@job
def print_lines(j: Job) -> StreamingQuery:
    return j.start(j.source().select("value"))


@job
def numbers_to_table(j: Job) -> StreamingQuery:
    """Numeric lines to a table; a line that is no number stops the job at its batch."""
    numbers = j.source().select(
        F.col("value").cast("int").alias("id"), F.unix_millis(F.current_timestamp()).alias("timestamp")
    )
    return j.start(numbers)


@job
def behaviors(j: Job) -> StreamingQuery:
    """Behaviour messages read, typed and sent on, as JSON or in the braced text form."""
    typed = rows.parse_json(j.source(), schemas.BEHAVIOR, strict=j.strict)
    if j.settings.get("form") == "braced":
        fields = {c: F.col(c) for c in schemas.BEHAVIOR}
        return j.start(typed.select(text.braced_text(fields).alias("value")))
    return j.start(rows.to_json_text(typed))


def _orders(j: Job) -> DataFrame:
    return rows.parse_json(j.source(), schemas.ORDER_EVENT, strict=j.strict)


@job
def order_rows(j: Job) -> StreamingQuery:
    """Order events to a warehouse table with two columns."""
    return j.start(_orders(j).select("userId", "siteId"))


@job
def order_documents(j: Job) -> StreamingQuery:
    """Order events to a document index, the last write per id: a sink that keeps ids settles it over all batches."""
    named = j.settings.get("index", "order_events"), ["orderId", "timestamp"], ["timestamp", "userId"]
    where = j._block(j.settings["sink"])
    if where.get("kind") == "upserts":
        sink = stores.document_table(*named, where["path"], int(where.get("buckets", stores.BUCKETS)))
    else:
        sink = stores.document_sink(*named, j.sink())
    return j.start(_orders(j), sink)


@job
def order_cells(j: Job) -> StreamingQuery:
    """Order events to key-value cells; the row key is a hash of the event, so replays rewrite it."""
    row_key = F.sha2(F.to_json(F.struct(*schemas.ORDER_EVENT)), 256)
    values = {
        "cid": cells.encode_long(F.col("cityId")),
        "oid": cells.encode_long(F.col("orderId")),
        "os": cells.encode_int(F.col("orderStatus")),
        "oq": cells.encode_int(F.col("quantity")),
        "sid": cells.encode_long(F.col("siteId")),
    }
    return j.start(_orders(j), stores.cell_sink(row_key, F.col("timestamp"), "cf", values, j.sink()))


@job
def weather_lines(j: Job) -> StreamingQuery:
    """Weather messages to time-series lines."""
    weather = rows.parse_json(j.source(), schemas.WEATHER, strict=j.strict)
    measurement = j.settings.get("measurement", "test")
    sink = stores.time_series_sink(measurement, ["altitude", "area"], ["temperature", "humidity"], j.sink())
    return j.start(weather, sink)


@job
def user_urls(j: Job) -> StreamingQuery:
    """One request per order event to a URL made of its user."""
    url = text.query_url(j.settings["base_url"], F.col("userId"))
    return j.start(_orders(j).select(url.alias("url")))


@job
def raw_lines(j: Job) -> StreamingQuery:
    """Raw text rows to a warehouse."""
    return j.start(j.source(), stores.raw_line_sink(j.sink()))


@job
def side_output(j: Job) -> StreamingQuery:
    """Order events of small user ids to the side sink, the others to the main one, if any."""
    limit = int(j.settings.get("limit", 100))
    sinks = {"side": j.sink("side_sink")} | ({split.MAIN: j.sink()} if "sink" in j.settings else {})
    return j.start(_orders(j), split_sink({"side": F.col("userId") < limit}, sinks, j.folder))


@job
def known_ids(j: Job) -> StreamingQuery:
    """Whether each id is in a cell table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = batch.sparkSession.read.parquet(j.settings["table"])  # as it is now
        with kept(batch) as held:
            sink(lookup.lookup_exists(held, table, "value", "row_key", j.settings.get("order")), batch_id)

    sink = j.sink()
    return j.start(j.source(), write)


@job
def known_rows(j: Job) -> StreamingQuery:
    """The row of each id in a cell table, as a map."""
    def write(batch: DataFrame, batch_id: int) -> None:
        table = batch.sparkSession.read.parquet(j.settings["table"])
        with kept(batch) as held:
            found = lookup.lookup_row(held, table, "value", j.settings.get("order"), strict=j.strict)
            sink(found, batch_id)

    sink = j.sink()
    return j.start(j.source(), write)


@job
def poll_table(j: Job) -> StreamingQuery:
    """New rows of a folder or a JDBC table, by a mark that only grows."""
    where = j._block(j.settings["source"])
    inclusive, unique = bool(where.get("inclusive", False)), tuple(where.get("unique", ()))
    if where.get("kind") == "parquet":
        schema = j.spark.read.parquet(where["path"]).schema
        return j.start(polled(j.spark, where["path"], schema, where["column"], str(where["first"]), inclusive, unique))

    def read(spark: SparkSession) -> DataFrame:
        return jdbc_table(spark, where, where["table"], where.get("split"))

    poller = Poller(read, where["column"], where["first"], inclusive, unique)
    return start_polling(j.spark, poller, j.sink(), j.folder, j.trigger or "5 seconds", j.name)


@job
def scan_table(j: Job) -> StreamingQuery:
    """Every row of a cell table again and again, as a map per row key."""
    return start_scanning(
        j.spark,
        lambda spark: rows.cells_to_map(spark.read.parquet(j.settings["table"]), j.strict),
        j.sink(),
        j.folder,
        j.trigger or "1 second",
        j.name,
    )


@job
def sql(j: Job) -> StreamingQuery:
    """A named SQL script; gives the last stream it starts."""
    results = run_sql_job(j.spark, j.config, j.settings["script"], stream=True)
    started = [r for r in results if isinstance(r, StreamingQuery)]
    if not started:
        raise ValueError(f"script {j.settings['script']!r} starts no stream")
    return started[-1]
