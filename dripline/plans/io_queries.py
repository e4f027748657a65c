"""Queries of the streaming forms, sources and sinks.

They write to fresh folders under the session's shared folder and give back what a
reader of the result sees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dripline.functions import messages, times
from dripline.operators import rows, split, windows
from dripline.plans.alarms import alarm_stream_job
from dripline.plans.inputs import SIX_HOURS_MS, WHOLE_LINES, pump_lines
from dripline.plans.keyed_queries import ALARM_SQL, SESSION_SQL, START_TEXT_SQL
from dripline.plans.registry import Tables, query
from dripline.plans.sqljob import run_sql_job
from dripline.session import scratch
from dripline.sinks import batches, files, remote, splits, stores, subtables
from dripline.sinks.jdbc import numbered
from dripline.sinks.upserts import UpsertTable
from dripline.sources import polled
from dripline.sources.polling import Poller
from dripline.sources.synthetic import with_synthetic
from dripline.streaming import carried, lateness


#: Micro-batches that a table is fed in.
SLICES = 4


#: Rows of a file that a slice is written to.
FILE_ROWS = 1_000_000


def _slices(df: DataFrame, arrival: Column) -> tuple[Column, int]:
    """The slice a row arrives in (equal shares of the rows in arrival order, a missing one first), and all rows."""
    shares = [k / SLICES for k in range(1, SLICES)]
    seen = df.agg(F.percentile_approx(arrival, shares).alias("cuts"), F.count(F.lit(1)).alias("n")).first()
    return sum((F.coalesce(arrival > cut, F.lit(False)).cast("int") for cut in seen.cuts or []), F.lit(0)), seen.n


def _feed(
    t: Tables, df: DataFrame, arrival: Column, name: str, start, closing: DataFrame | None = None, slice_: Column | None = None
) -> str:
    """Run a stream over the slices of a table, a micro-batch each; ``closing`` comes last.

    ``slice_`` numbers the slice of a row, else slices are equal shares in arrival order.

    Slices are written one after another with the same number of files, which a micro-batch takes
    at a time, oldest first.
    """
    folder = scratch(t.spark, name)
    number, rows_ = _slices(df, arrival) if slice_ is None else (slice_, df.count())
    files_ = -(-rows_ // (SLICES * FILE_ROWS)) or 1
    for k in range(SLICES):
        df.filter(number == k).repartition(files_).write.mode("append").parquet(f"{folder}/in")
    if closing is not None:
        closing.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_).parquet(f"{folder}/in")
    query_ = start(stream, folder)
    query_.awaitTermination()
    windows.refuse_dropped(query_)
    return folder


def _timed(t: Tables) -> DataFrame:
    return t.events.withColumn("ms", times.as_epoch_ms(F.col("ts")))


def _run(t: Tables, df: DataFrame, arrival: Column, name: str, start) -> DataFrame:
    """Run a stream over all slices into batch folders and read them back."""
    folder = _feed(t, df, arrival, name, lambda stream, at: start(stream, batches.batch_folders(f"{at}/out"), at))
    return batches.read_batches(t.spark, f"{folder}/out")


def _disorder_ms(df: DataFrame, arrival: Column) -> int:
    """How far rows of a later slice may lie behind those of an earlier one."""
    number = _slices(df, arrival)[0].alias("number")
    spans = df.groupBy(number).agg(F.min("ms").alias("lo"), F.max("ms").alias("hi")).orderBy("number").collect()
    behind, seen = 0, None
    for span in spans:
        lo, hi = span.lo or 0, span.hi or 0
        behind = max(behind, seen - lo if seen is not None else 0)
        seen = hi if seen is None else max(seen, hi)
    return behind


def _windowed(t: Tables, name: str, keys: list[str], width_ms: int, aggregate) -> DataFrame:
    """All windows of the events in arrival order.

    The delay covers the disorder. At the end a row without keys moves the watermark past
    every window, as the end of a bounded input does; its own window is never given out.
    """
    df = _timed(t).select("event_id", *keys, "ms")
    delay = _disorder_ms(df, F.col("event_id"))
    end = F.coalesce(F.max("ms"), F.lit(0)) + F.lit(delay + 2 * width_ms)
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema if f.name != "ms"]
    closing = df.agg(end.alias("ms")).select(*rest, "ms").select(df.columns)

    def start(stream: DataFrame, folder: str):
        timed = windows.with_event_time(stream, F.col("ms"), f"{delay} milliseconds")
        writer = aggregate(timed).writeStream.format("parquet").option("path", f"{folder}/out")
        return writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()

    return t.spark.read.parquet(_feed(t, df, F.col("event_id"), name, start, closing) + "/out")


@query(
    "stream_session_start",
    SESSION_SQL.format(arrival="event_id", where="")
    + f"SELECT event_id, user_id, {START_TEXT_SQL} AS start_date_time FROM s",
)
def stream_session_start(t: Tables) -> DataFrame:
    done = _run(
        t,
        _timed(t).select("event_id", "user_id", "ms"),
        F.col("event_id"),
        "stream-sessions",
        lambda stream, sink, folder: carried.session_stream(
            stream, ["user_id"], ["event_id"], "ms", sink, folder, SIX_HOURS_MS
        ),
    )
    return done.select("event_id", "user_id", times.time_text(F.col("session_start_ms")).alias("start_date_time"))


@query("stream_alarms", ALARM_SQL)
def stream_alarms(t: Tables) -> DataFrame:
    """The whole alarm job as a stream of device lines."""
    return _run(
        t,
        pump_lines(t),
        F.col("event_id"),
        "stream-alarms",
        lambda stream, sink, folder: alarm_stream_job(stream, ["event_id"], sink, folder, SIX_HOURS_MS, strict=False),
    )


@query(
    "stream_running_count",
    """SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS total
       FROM events""",
)
def stream_running_count(t: Tables) -> DataFrame:
    return _run(
        t,
        t.events.select("event_id", "event_type"),
        F.col("event_id"),
        "stream-count",
        lambda stream, sink, folder: carried.running_total_stream(stream, ["event_type"], ["event_id"], sink, folder),
    )


@query(
    "stream_late_rows",
    """SELECT event_id, user_id,
              epoch_us(ts) // 1000 < max(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY -event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1000 AS is_late
       FROM events""",
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Events arriving last first: all but each user's newest are late."""
    done = _run(
        t,
        _timed(t).select("event_id", "user_id", "ms", (-F.col("event_id")).alias("arrival")),
        F.col("arrival"),
        "stream-late",
        lambda stream, sink, folder: carried.late_rows_stream(stream, ["user_id"], ["arrival"], "ms", sink, folder),
    )
    return done.select("event_id", "user_id", "is_late")


@query(
    "stream_windowed_count",
    """SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS row_count
       FROM events GROUP BY 1, 2""",
)
def stream_windowed_count(t: Tables) -> DataFrame:
    """Hourly counts of a stream, all windows closed at its end."""
    counted = _windowed(
        t,
        "stream-windows",
        ["event_type"],
        3_600_000,
        lambda timed: windows.windowed_count(timed, "event_time", ["event_type"], "1 hour"),
    )
    return counted.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "row_count")


@query(
    "stream_session_windows",
    SESSION_SQL.format(arrival="epoch_us(ts) // 1000", where="")
    + """SELECT user_id, start_ms AS session_start_ms, max(ms) AS session_end_ms, count(*) AS row_count
         FROM s GROUP BY user_id, start_ms""",
)
def stream_session_windows(t: Tables) -> DataFrame:
    """Sessions of a stream, all closed at its end."""
    sessions = _windowed(
        t,
        "stream-session-windows",
        ["user_id"],
        SIX_HOURS_MS,
        lambda timed: windows.session_windows(timed, "event_time", ["user_id"], "6 hours"),
    )
    return sessions.select(
        "user_id",
        F.unix_millis("session_start").alias("session_start_ms"),
        F.unix_millis("session_end").alias("session_end_ms"),
        "row_count",
    )


@query(
    "stream_closed_sessions",
    SESSION_SQL.format(arrival="epoch_us(ts) // 1000", where="")
    + """SELECT user_id, start_ms AS session_start_ms, max(ms) AS session_end_ms, count(*) AS row_count
         FROM s GROUP BY user_id, start_ms""",
)
def stream_closed_sessions(t: Tables) -> DataFrame:
    """Sessions as their timers give them out, fed out of order; a last row without user ends all others."""
    df = _timed(t).select("event_id", "user_id", "ms")
    delay = _disorder_ms(df, F.col("event_id"))
    end = (F.coalesce(F.max("ms"), F.lit(0)) + F.lit(delay + 2 * SIX_HOURS_MS)).alias("ms")
    closing = df.agg(end).select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"), "ms")

    def start(stream: DataFrame, folder: str):
        closed = carried.closed_sessions(stream, ["user_id"], "ms", SIX_HOURS_MS, delay)
        return carried.start_batches(closed, batches.batch_folders(f"{folder}/out"), folder, "closed-sessions")

    folder = _feed(t, df, F.col("event_id"), "stream-closed", start, closing)
    return batches.read_batches(t.spark, f"{folder}/out")


@query(
    "split_sinks",
    """SELECT CASE WHEN user_id < 100 THEN 'small' WHEN event_type = 'error' THEN 'error' WHEN value > 50 THEN 'high' ELSE 'main' END
              AS tag, event_id, user_id FROM events""",
)
def split_sinks(t: Tables) -> DataFrame:
    """Three tags and the rest, each to a sink of its own from one pass over the events."""
    folder = scratch(t.spark, "split")
    tags = {"small": F.col("user_id") < 100, "error": F.col("event_type") == "error", "high": F.col("value") > 50}
    sinks = {tag: batches.batch_folders(f"{folder}/{tag}") for tag in (*tags, split.MAIN)}
    splits.split_sink(tags, sinks, folder)(t.events, 0)
    parts = [
        batches.read_batches(t.spark, f"{folder}/{tag}").select(F.lit(tag).alias("tag"), "event_id", "user_id") for tag in sinks
    ]
    return reduce(DataFrame.unionByName, parts)


DAY_MS = 86_400_000


@query(
    "stream_late_output",
    """WITH e AS (SELECT *, epoch_us(ts) // 1000 AS ms, event_id % 4 AS k FROM events),
            seen AS (SELECT k, max(max(ms)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                               - 10 * 86400000 AS reached FROM e GROUP BY k),
            m AS (SELECT e.*, ms // 86400000 * 86400000 AS start,
                         coalesce((ms // 86400000 + 1) * 86400000 <= reached, false) AS late FROM e JOIN seen USING (k))
       SELECT 'late' AS part, event_id, event_type, start AS window_start_ms, CAST(1 AS BIGINT) AS row_count FROM m WHERE late
       UNION ALL
       SELECT 'count', NULL, event_type, start, count(*) FROM m WHERE NOT late GROUP BY event_type, start""",
)
def stream_late_output(t: Tables) -> DataFrame:
    """Daily counts and, beside them, the events that come more than ten days behind earlier slices."""
    df = _timed(t).select("event_id", "event_type", "ms")
    delay = 10 * DAY_MS
    end = (F.coalesce(F.max("ms"), F.lit(0)) + F.lit(delay + 2 * DAY_MS)).alias("ms")
    closing = df.agg(end).select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"), "ms")

    def start(stream: DataFrame, folder: str):
        sinks = (batches.batch_folders(f"{folder}/{part}") for part in ("counts", "late"))
        return lateness.start_counts_and_late(stream, ["event_type"], "ms", DAY_MS, delay, *sinks, folder)

    folder = _feed(t, df, F.col("event_id"), "stream-late-output", start, closing, F.pmod("event_id", F.lit(SLICES)))
    counts, late = (batches.read_batches(t.spark, f"{folder}/{part}") for part in ("counts", "late"))
    late = late.select(
        F.lit("late").alias("part"), "event_id", "event_type", (F.floor(F.col("ms") / DAY_MS) * DAY_MS).alias("window_start_ms"),
        F.lit(1).cast("bigint").alias("row_count"),
    )
    none = F.lit(None).cast("bigint").alias("event_id")
    return late.unionByName(counts.select(F.lit("count").alias("part"), none, "event_type", "window_start_ms", "row_count"))


BUCKET_SQL = """
SELECT strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hr, count(*) AS row_count FROM events GROUP BY 1, 2
"""


def _bucket_counts(read: DataFrame) -> DataFrame:
    return read.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("row_count"))


@query("event_time_buckets", BUCKET_SQL)
def event_time_buckets(t: Tables) -> DataFrame:
    """Lines written by hour of event time, read back and counted."""
    folder = scratch(t.spark, "buckets")
    lines = t.events.select(messages.json_text(event_id=F.col("event_id"), ts=times.as_epoch_ms(F.col("ts"))).alias("value"))
    files.write_hour_buckets(files.with_hour_buckets(lines), folder)
    return _bucket_counts(files.read_hour_buckets(t.spark, folder))


@query(
    "hour_parts",
    """WITH l AS (SELECT strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hr,
                         length('{"event_id":' || event_id || ',"ts":' || epoch_us(ts) // 1000 || '}') + 1 AS n FROM events)
       SELECT dt, hr, count(*) AS row_count, CAST(sum(n) AS BIGINT) AS line_bytes, true AS within FROM l GROUP BY dt, hr""",
)
def hour_parts(t: Tables) -> DataFrame:
    """Hours in files of at most 4,000 bytes, written in two batches, one of them twice, and the first week merged."""
    folder, most = scratch(t.spark, "parts"), 4000
    events = t.events.select("event_id", messages.json_text(event_id=F.col("event_id"), ts=times.as_epoch_ms(F.col("ts"))).alias("value"))
    for batch_id in (0, 0, 1):
        lines = events.where(F.pmod("event_id", F.lit(2)) == batch_id).select("value")
        files.write_hour_buckets(files.with_hour_buckets(lines), folder, batch_id, most)
    files.compact_hours(t.spark, folder, "2024010800", most)
    sizes = files.part_sizes(t.spark, folder).groupBy("dt", "hr")
    return sizes.agg(
        F.sum("row_count").alias("row_count"), F.sum("part_bytes").alias("line_bytes"), (F.max("part_bytes") <= most).alias("within")
    )


@query("stream_event_time_buckets", BUCKET_SQL)
def stream_event_time_buckets(t: Tables) -> DataFrame:
    lines = _timed(t).select(
        "event_id", messages.json_text(event_id=F.col("event_id"), ts=F.col("ms")).alias("value")
    )
    folder = _feed(
        t,
        lines,
        F.col("event_id"),
        "stream-buckets",
        lambda stream, at: files.start_hour_buckets(
            files.with_hour_buckets(stream.select("value")), f"{at}/out", f"{at}/checkpoint", trigger=None
        ),
    )
    return _bucket_counts(files.read_hour_buckets(t.spark, f"{folder}/out"))


@query(
    "subtable_fanout",
    f"""SELECT 'hp_icu_pump_' || user_id AS "tableName", count(*) AS row_count, min(epoch_us(ts) // 1000) AS first_ts
       FROM events WHERE event_type = 'error' AND {WHOLE_LINES} GROUP BY user_id""",
)
def subtable_fanout(t: Tables) -> DataFrame:
    """Pump records written per device and read back from the whole table."""
    folder = scratch(t.spark, "subtables")
    subtables.write_subtables(_records(t), folder, buckets=32)
    back = subtables.read_supertable(t.spark, folder)
    return back.groupBy("tableName").agg(F.count(F.lit(1)).alias("row_count"), F.min("ts").alias("first_ts"))


def _records(t: Tables) -> DataFrame:
    return rows.flatten_pump(rows.in_state(rows.with_pump(pump_lines(t))))


@query(
    "subtable_tags",
    f"""SELECT DISTINCT 'hp_icu_pump_' || user_id AS "tableName", '127.0.0.1' AS host, 10003 AS port,
              'icu-pump-' || user_id AS "factoryNum", '0x00' AS "equType", 'equ-' || user_id AS "equNum"
       FROM events WHERE event_type = 'error' AND {WHOLE_LINES}""",
)
def subtable_tags(t: Tables) -> DataFrame:
    return subtables.first_tags(_records(t))


@query(
    "batch_replay",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS BIGINT) AS batch_id
       FROM orders""",
)
def batch_replay(t: Tables) -> DataFrame:
    """Two numbered batches, the first one written again after half of it: no row is lost or doubled."""
    folder = scratch(t.spark, "replay")
    write = batches.batch_folders(folder)
    is_open = F.coalesce(F.col("o_orderstatus") == "O", F.lit(False))
    first, second = (t.orders.filter(c).drop("o_orderstatus") for c in (is_open, ~is_open))
    write(first.filter("o_totalprice > 200000"), 0)
    write(first, 0)
    write(second, 1)
    merged = t.spark.read.parquet(folder)
    return merged.select("o_orderkey", "o_custkey", "o_totalprice", F.col("batch_id").cast("bigint").alias("batch_id"))


@query(
    "numbered_rows",
    "SELECT s_suppkey, s_name, CAST(7 AS BIGINT) AS batch_id FROM supplier",
)
def numbered_rows(t: Tables) -> DataFrame:
    """Rows as the JDBC writer sends them: transient columns out, batch number in."""
    marked = rows.mark_transient(t.supplier, "s_nationkey", "s_acctbal")
    return numbered(marked, 7)


PAGE_SQL = "TRY_CAST(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INTEGER)"


def _paged(t: Tables) -> DataFrame:
    page = F.nullif(F.regexp_extract("url", "[?&]page=([^&#]*)", 1), F.lit(""))
    return t.pages.select("page_id", "url", page.try_cast("int").alias("page"))


@query(
    "dead_letter_split",
    f"""SELECT page_id, {PAGE_SQL} AS page, CASE WHEN {PAGE_SQL} IS NULL THEN 'dead' ELSE 'good' END AS part
       FROM pages""",
)
def dead_letter_split(t: Tables) -> DataFrame:
    good, dead = split.dead_letters(_paged(t), F.col("page").isNotNull())
    both = good.withColumn("part", F.lit("good")).unionByName(dead.withColumn("part", F.lit("dead")))
    return both.select("page_id", "page", "part")


def _refuse_unpaged():
    """A service that takes rows with a page number and answers 400 to others."""
    return lambda buffer: 200 if all(row["paged"] for row in buffer) else 400


@query(
    "remote_dead_letters",
    f"SELECT page_id, url, 400 AS status, 2 AS attempts FROM pages WHERE {PAGE_SQL} IS NULL",
)
def remote_dead_letters(t: Tables) -> DataFrame:
    """Rows a remote service refused after one retry, as found in the dead-letter store."""
    folder = scratch(t.spark, "dead-letters")
    settings = remote.RemoteSettings(writers=4, buffer_rows=1, retries=1)
    asked = _paged(t).select("page_id", "url", F.col("page").isNotNull().alias("paged"))
    remote.remote_sink(_refuse_unpaged, settings, remote.dead_letter_folder(folder))(asked, 0)
    return t.spark.read.parquet(folder).select("page_id", "url", "status", "attempts")


def _orders_poller(t: Tables, inclusive: bool) -> Poller:
    return Poller(
        lambda _: t.orders.select("o_orderkey", "o_orderdate"),
        "o_orderdate",
        F.lit("1998-10-03").cast("timestamp_ntz"),
        inclusive,
    )


POLL_SQL = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate {} TIMESTAMP '1998-10-03'"


@query("incremental_poll", POLL_SQL.format(">"))
def incremental_poll(t: Tables) -> DataFrame:
    return _orders_poller(t, False).after(t.spark)


@query("incremental_poll_inclusive", POLL_SQL.format(">="))
def incremental_poll_inclusive(t: Tables) -> DataFrame:
    return _orders_poller(t, True).after(t.spark)


@query(
    "incremental_poll_next",
    "SELECT max(o_orderdate) AS next_mark FROM orders WHERE o_orderdate > TIMESTAMP '1998-10-03'",
)
def incremental_poll_next(t: Tables) -> DataFrame:
    """The mark the next poll starts from."""
    return _orders_poller(t, False).after(t.spark).agg(F.max("o_orderdate").alias("next_mark"))


def _polled_in_turns(t: Tables, inclusive: bool) -> DataFrame:
    """Orders that come in by date in several turns; a poll after each starts anew from its checkpoint.

    For the inclusive form some rows of a turn's last day come with the next turn.
    """
    folder = scratch(t.spark, "polled")
    orders = t.orders.select("o_orderkey", "o_orderdate").where("o_orderdate is not null")
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    turn = day * 2 + (F.pmod("o_orderkey", F.lit(2)) if inclusive else F.lit(0))
    cuts = orders.agg(F.percentile_approx(day, [0.3, 0.6]).alias("cuts")).first().cuts or []
    edges = [None, *(2 * c for c in cuts), None]
    for low, high in zip(edges, edges[1:]):
        part = orders if low is None else orders.where(turn > low)
        part = part if high is None else part.where(turn <= high)
        part.write.mode("append").parquet(f"{folder}/table")
        stream = polled.polled(
            t.spark, f"{folder}/table", orders.schema, "o_orderdate", "1993-01-01", inclusive, ("o_orderkey",)
        )
        carried.start_batches(stream, batches.batch_folders(f"{folder}/out"), folder, "polled-orders").awaitTermination()
    return batches.read_batches(t.spark, f"{folder}/out")


TURNS_SQL = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate {} TIMESTAMP '1993-01-01'"


@query("stream_polled_table", TURNS_SQL.format(">"))
def stream_polled_table(t: Tables) -> DataFrame:
    return _polled_in_turns(t, False)


@query("stream_polled_table_inclusive", TURNS_SQL.format(">="))
def stream_polled_table_inclusive(t: Tables) -> DataFrame:
    return _polled_in_turns(t, True)


@query(
    "doc_upsert_batches",
    """SELECT 'user_events' AS index, user_id || '_' || event_type AS id,
              '{"event_id":' || max(event_id) || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS body
       FROM events GROUP BY user_id, event_type""",
)
def doc_upsert_batches(t: Tables) -> DataFrame:
    """Documents whose ids come again in later batches, each batch written again before the next."""
    writes = t.events.select("event_id", "user_id", "event_type")
    ids, order = ["user_id", "event_type"], ["event_id"]

    def start(stream: DataFrame, folder: str):
        store = stores.document_table("user_events", ids, order, f"{folder}/table", buckets=16)

        def twice(batch: DataFrame, batch_id: int) -> None:
            with batches.kept(batch) as held:
                store(held, batch_id)
                store(held, batch_id)

        return carried.start_batches(stream, twice, folder, "upserts")

    folder = _feed(t, writes, F.col("event_id"), "upserts", start)
    table = UpsertTable(f"{folder}/table", ["index", "id"], order, 16).read(t.spark)
    return table.select("index", "id", "body")


SYNTHETIC_SQL = """
SELECT CAST(event_id AS INTEGER) AS f_sequence,
       CAST((event_id % 2147483648 * 1103515245 + 12345) % 2147483648 % 1000000 + 1 AS INTEGER) AS f_random,
       substring(md5(CAST(event_id AS VARCHAR)), 1, 10) AS f_random_str
FROM events
"""


@query("synthetic_columns", SYNTHETIC_SQL)
def synthetic_columns(t: Tables) -> DataFrame:
    """The synthetic table's columns, with the events' ids as its sequence."""
    return with_synthetic(t.events, F.col("event_id"))


@query("sql_script", "SELECT event_id, user_id, event_type FROM events WHERE value > 50")
def sql_script(t: Tables) -> DataFrame:
    """A named script over a declared source and sink, run as a batch."""
    folder = scratch(t.spark, "sql-script")
    config = {
        "tables": {
            "event_source": {"kind": "parquet", "path": t.path("events"), "computed": {"seen": "current_timestamp()"}},
            "event_sink": {"sink": "parquet", "path": folder},
        },
        "sql": {
            "copy_events": """
                -- keep the larger values; a comment may hold a ;
                INSERT INTO event_sink SELECT event_id, user_id, event_type FROM event_source -- as they come
                WHERE value > 50;
            """
        },
    }
    run_sql_job(t.spark, config, "copy_events")
    return t.spark.read.parquet(folder)


@query("sql_ddl_script", "SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms FROM events WHERE value > 50")
def sql_ddl_script(t: Tables) -> DataFrame:
    """A script that declares its own tables with connector options, run as a batch."""
    folder = scratch(t.spark, "sql-ddl")
    script = f"""
        /* it's a source; with a computed column */
        CREATE TABLE event_source (
            event_id BIGINT, user_id BIGINT, event_type STRING, `value` DOUBLE, ts TIMESTAMP(3),
            ms AS unix_millis(ts),
            WATERMARK FOR ts AS ts - INTERVAL '5' SECOND
        ) WITH (
            'connector' = 'filesystem', -- a folder or a file
            'path' = '{t.path("events")}', 'format' = 'parquet'
        );
        CREATE TABLE event_sink (event_id BIGINT, user_id BIGINT, event_type STRING, ms BIGINT)
        WITH ('connector' = 'filesystem', 'path' = '{folder}', 'format' = 'parquet');
        INSERT INTO event_sink (user_id, event_id, ms, event_type)
        SELECT user_id, event_id, ms, event_type FROM event_source WHERE `value` > 50
    """
    run_sql_job(t.spark, {"sql": {"copy_events": script}}, "copy_events")
    return t.spark.read.parquet(folder)
