"""Queries of the keyed, event-time and lookup operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.functions import times
from dripline.operators import keyed, lookup, rows, windows
from dripline.plans.alarms import alarm_rows
from dripline.plans.inputs import SIX_HOURS_MS, WHOLE_LINES, customer_cells, pump_lines, timed_events
from dripline.plans.registry import Tables, query

SESSION_SQL = """
WITH e AS (
  SELECT *, epoch_us(ts) // 1000 AS ms, {arrival} AS arrival FROM events {where}
), p AS (
  SELECT *, lag(ms) OVER (PARTITION BY user_id ORDER BY arrival, event_id) AS prev FROM e
), o AS (
  SELECT *, CASE WHEN prev IS NULL OR ms - prev > 21600000 THEN ms END AS opened FROM p
), s AS (
  SELECT *, last_value(opened IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY arrival, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_ms FROM o
)
"""
START_TEXT_SQL = "strftime(make_timestamp(start_ms * 1000), '%Y%m%d%H%M%S')"


def _stamped(df: DataFrame, order: list[str]) -> DataFrame:
    stamped = keyed.session_start(df, ["user_id"], order, F.col("ms"), SIX_HOURS_MS)
    return stamped.select(
        "event_id", "user_id", times.time_text(F.col("session_start_ms")).alias("start_date_time")
    )


@query(
    "session_start",
    SESSION_SQL.format(arrival="event_id", where="")
    + f"SELECT event_id, user_id, {START_TEXT_SQL} AS start_date_time FROM s",
)
def session_start(t: Tables) -> DataFrame:
    return _stamped(timed_events(t), ["event_id"])


@query(
    "session_start_out_of_order",
    SESSION_SQL.format(arrival="(event_id * 7919) % 1000003", where="")
    + f"SELECT event_id, user_id, {START_TEXT_SQL} AS start_date_time FROM s",
)
def session_start_out_of_order(t: Tables) -> DataFrame:
    shuffled = timed_events(t).withColumn("arrival", (F.col("event_id") * 7919) % 1000003)
    return _stamped(shuffled, ["arrival", "event_id"])


@query(
    "session_start_busy_keys",
    (SESSION_SQL.format(arrival="event_id", where="") + "SELECT event_id, event_type, start_ms FROM s")
    .replace("21600000", "600000")
    .replace("PARTITION BY user_id", "PARTITION BY event_type"),
)
def session_start_busy_keys(t: Tables) -> DataFrame:
    """Sessions by event type: each of the few types has so many rows that it is cut into chunks."""
    stamped = keyed.session_start(
        timed_events(t).select("event_id", "event_type", "ms"),
        ["event_type"],
        ["event_id"],
        F.col("ms"),
        600_000,
        "start_ms",
    )
    return stamped.select("event_id", "event_type", "start_ms")


BURST_SQL = "CASE WHEN event_id % 1000 = 0 THEN event_id * 1000000 WHEN event_id % 3 = 0 THEN 7 ELSE event_id END"


@query(
    "session_start_bursts",
    (SESSION_SQL.format(arrival=BURST_SQL, where="") + "SELECT event_id, event_type, start_ms FROM s")
    .replace("21600000", "600000")
    .replace("PARTITION BY user_id", "PARTITION BY event_type"),
)
def session_start_bursts(t: Tables) -> DataFrame:
    """Busy types whose arrivals lie far apart, close together and, a third of them, on one position."""
    data = timed_events(t).select("event_id", "event_type", "ms", F.expr(BURST_SQL).alias("arrival"))
    stamped = keyed.session_start(data, ["event_type"], ["arrival", "event_id"], F.col("ms"), 600_000, "start_ms")
    return stamped.select("event_id", "event_type", "start_ms")


@query(
    "session_summary",
    SESSION_SQL.format(arrival="epoch_us(ts) // 1000", where="")
    + """SELECT user_id, start_ms AS session_start_ms, max(ms) AS session_end_ms,
                count(*) AS row_count
         FROM s GROUP BY user_id, start_ms""",
)
def session_summary(t: Tables) -> DataFrame:
    return keyed.session_summary(timed_events(t), ["user_id"], F.col("ms"), SIX_HOURS_MS)


ALARM_SQL = (
    SESSION_SQL.format(arrival="event_id", where=f"WHERE {WHOLE_LINES}")
    + f""", a AS (
  SELECT *, 1 AS "alarmType", CASE WHEN event_type = 'error' THEN props ELSE '' END AS "alarmValue" FROM s
  UNION ALL
  SELECT *, 2, CASE WHEN value > 100 THEN CAST(event_id AS VARCHAR) END FROM s
  UNION ALL
  SELECT *, 3, CASE WHEN value < 10 THEN '  ' ELSE event_type END FROM s
)
SELECT 'icu-pump-' || user_id AS "factoryNum", {START_TEXT_SQL} AS "startDateTime",
       event_type AS "injectMode", "alarmType", "alarmValue", ms AS "alarmTs"
FROM a WHERE trim(coalesce("alarmValue", '')) <> ''
"""
)


@query("alarm_stream", ALARM_SQL)
def alarm_stream(t: Tables) -> DataFrame:
    """Pump lines to alarm rows: parse, stamp sessions, unpivot the alarms."""
    return alarm_rows(pump_lines(t), ["event_id"], SIX_HOURS_MS, strict=False)


@query(
    "running_count",
    """SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS total
       FROM events""",
)
def running_count(t: Tables) -> DataFrame:
    return keyed.running_total(t.events.select("event_id", "event_type"), ["event_type"], ["event_id"])


@query(
    "word_count",
    """SELECT word, count(*) AS total
       FROM (SELECT unnest(string_split(rtrim(text, ','), ',')) AS word FROM documents
             WHERE text = '' OR rtrim(text, ',') <> '')
       GROUP BY word""",
)
def word_count(t: Tables) -> DataFrame:
    return keyed.word_totals(rows.explode_parts(t.documents, "text"), "word")


@query(
    "late_rows",
    """WITH a AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, (event_id * 7919) % 1000003 AS arrival
                  FROM events)
       SELECT event_id, user_id,
              ms < max(ms) OVER (PARTITION BY user_id ORDER BY arrival, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1000 AS is_late
       FROM a""",
)
def late_rows(t: Tables) -> DataFrame:
    shuffled = timed_events(t).select(
        "event_id", "user_id", "ms", ((F.col("event_id") * 7919) % 1000003).alias("arrival")
    )
    marked = keyed.late_rows(shuffled, ["user_id"], ["arrival", "event_id"], F.col("ms"))
    return marked.select("event_id", "user_id", "is_late")


@query(
    "late_rows_global",
    """WITH a AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms, (event_id * 7919) % 1000003 AS arrival
                  FROM events)
       SELECT event_id, user_id,
              ms < max(ms) OVER (ORDER BY arrival, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1000 AS is_late
       FROM a""",
)
def late_rows_global(t: Tables) -> DataFrame:
    """One watermark for the whole stream: its chunks are windows of their own, no task sees all rows."""
    shuffled = timed_events(t).select(
        "event_id", "user_id", "ms", ((F.col("event_id") * 7919) % 1000003).alias("arrival")
    )
    marked = keyed.late_rows(shuffled, [], ["arrival", "event_id"], F.col("ms"))
    return marked.select("event_id", "user_id", "is_late")


@query(
    "windowed_count",
    """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
              event_type, count(*) AS row_count
       FROM events GROUP BY 1, 2, 3""",
)
def windowed_count(t: Tables) -> DataFrame:
    counted = windows.windowed_count(t.events, "ts", ["event_type"], "1 hour")
    return counted.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    )


@query(
    "lookup_exists",
    """SELECT d.doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS found
       FROM documents d""",
)
def lookup_exists(t: Tables) -> DataFrame:
    return lookup.lookup_exists(t.documents.select("doc_id"), t.labels, "doc_id", "doc_id", ["doc_id"])


@query(
    "lookup_row",
    """SELECT e.event_id,
              CASE WHEN c.c_custkey IS NULL THEN ''
                   ELSE 'name=' || c.c_name || ';nation=' || c.c_nationkey END AS cells, c.c_acctbal AS balance
       FROM events e LEFT JOIN customer c ON c.c_custkey = e.event_id""",
)
def lookup_row(t: Tables) -> DataFrame:
    """Events looked up by id in the customer cells: some ids are customers, most are not."""
    asked = t.events.select("event_id", F.col("event_id").cast("string").alias("id"))
    found = lookup.lookup_row(asked, customer_cells(t), "id", ["event_id"])
    return found.select("event_id", *texts_and_balance(F.col("cells")))


def texts_and_balance(cells):
    """All cells of a customer: the double as a number, since its text differs between engines."""
    others = F.map_filter(cells, lambda name, _: name != "balance")
    balance = F.try_element_at(cells, F.lit("balance")).cast("double")
    return cells_as_text(others).alias("cells"), balance.alias("balance")


def cells_as_text(cells):
    """A map as ``name=value`` pairs in name order."""
    pairs = F.transform(F.map_entries(cells), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ";")
