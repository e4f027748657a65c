"""Queries of the row, split and document operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.functions import cells, text, times
from dripline.operators import rows, split
from dripline.plans.inputs import WHOLE_LINES, customer_cells, pump_lines, timed_events
from dripline.plans.keyed_queries import texts_and_balance
from dripline.plans.registry import Tables, query


@query(
    "json_parse",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
)
def json_parse(t: Tables) -> DataFrame:
    """Whole numbers out of JSON text, every other one quoted first."""
    number = F.regexp_replace("props", r"(\d+)", r'"$1"')
    quoted = t.events.select("event_id", F.when(F.col("event_id") % 2 == 0, number).otherwise(F.col("props")).alias("value"))
    wire = quoted.select("event_id", F.from_json("value", "k string", {"mode": "FAILFAST"}).alias("m"))
    return wire.select("event_id", F.col("m.k").cast("int").alias("k"))


@query(
    "user_parse_filter",
    """SELECT c_name AS name, CAST(c_custkey % 80 AS INTEGER) AS age, CAST(c_nationkey AS INTEGER) AS gender,
              c_mktsegment AS address
       FROM customer WHERE c_custkey % 80 < 30""",
)
def user_parse_filter(t: Tables) -> DataFrame:
    """User messages as JSON text, parsed to typed records and kept under age 30."""
    age = F.col("c_custkey") % 80
    users = t.customer.select(
        F.col("c_name").alias("name"),
        age.cast("string").alias("age"),
        F.col("c_nationkey").alias("gender"),
        F.col("c_mktsegment").alias("address"),
    )
    from dripline.plans.etl import young_users

    return young_users(rows.to_json_text(users))


@query(
    "envelope_flatten",
    f"""SELECT 'hp_' || replace('icu-pump-' || user_id, '-', '_') AS "tableName",
              '127.0.0.1' AS host, 10003 AS port, 'icu-pump-' || user_id AS "factoryNum", '0x00' AS "equType",
              'equ-' || user_id AS "equNum", epoch_us(ts) // 1000 AS ts,
              CAST(value AS FLOAT) AS "presetValue", CAST(NULL AS FLOAT) AS speed,
              CAST(NULL AS INTEGER) AS "alreadyInjectTime", CAST(event_id % 100 AS INTEGER) AS "remainTime",
              CAST(NULL AS FLOAT) AS "alreadyInjectValue", CAST(NULL AS FLOAT) AS residual,
              CAST(NULL AS FLOAT) AS "pressureValue", CAST(NULL AS VARCHAR) AS "pressureUint",
              CAST(NULL AS VARCHAR) AS "workSta", CAST(NULL AS VARCHAR) AS "drugName",
              event_type AS "injectMode"
       FROM events WHERE event_type = 'error' AND {WHOLE_LINES}""",
)
def envelope_flatten(t: Tables) -> DataFrame:
    return rows.flatten_pump(rows.in_state(rows.with_pump(pump_lines(t))))


@query(
    "blank_filter",
    """SELECT event_id, CASE WHEN events.value < 10 THEN '  ' ELSE event_type END AS value
       FROM events WHERE events.value >= 10""",
)
def blank_filter(t: Tables) -> DataFrame:
    lines = t.events.select(
        "event_id", F.when(F.col("value") < 10, "  ").otherwise(F.col("event_type")).alias("value")
    )
    return rows.drop_blank(lines)


@query("typed_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 30")
def typed_filter(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_acctbal") < 30).select("c_custkey", "c_acctbal")


@query(
    "tolerant_state_filter",
    f"SELECT event_id FROM events WHERE event_type = 'error' AND {WHOLE_LINES}",
)
def tolerant_state_filter(t: Tables) -> DataFrame:
    return rows.in_state(rows.with_pump(pump_lines(t))).select("event_id")


@query(
    "route_key",
    """SELECT 'hp_' || replace(o_orderpriority, '-', '_') AS table_name, count(*) AS row_count
       FROM orders GROUP BY 1""",
)
def route_key(t: Tables) -> DataFrame:
    routed = t.orders.select(text.route_key(F.col("o_orderpriority")).alias("table_name"))
    return routed.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "time_format",
    """SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS seconds, strftime(ts, '%Y%m%d/%H') AS hour_bucket
       FROM events""",
)
def time_format(t: Tables) -> DataFrame:
    ms = F.col("ms")
    return timed_events(t).select(
        "event_id",
        times.time_text(ms).alias("seconds"),
        times.time_text(ms, times.HOUR_BUCKET).alias("hour_bucket"),
    )


@query(
    "row_to_json",
    """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
              || '","ts":' || (epoch_us(ts) // 1000) || '}' AS value
       FROM events""",
)
def row_to_json(t: Tables) -> DataFrame:
    e = timed_events(t).withColumn("ts", F.col("ms"))
    return rows.to_json_text(e, ["event_id", "user_id", "event_type", "ts"])


@query("text_template", "SELECT event_id, 'http://example.com?id=' || user_id AS url FROM events")
def text_template(t: Tables) -> DataFrame:
    url = text.query_url("http://example.com", F.col("user_id"))
    return t.events.select("event_id", url.alias("url"))


@query(
    "braced_text",
    r"""SELECT event_id, concat(chr(10), '{', chr(10), 'user_id:', user_id, ',', chr(10), 'behavior:', event_type,
              ',', chr(10), 'ts:', epoch_us(ts) // 1000, chr(10), '}', chr(10)) AS value
       FROM events""",
)
def braced_text(t: Tables) -> DataFrame:
    shown = {"user_id": F.col("user_id"), "behavior": F.col("event_type"), "ts": F.col("ms")}
    return timed_events(t).select("event_id", text.braced_text(shown).alias("value"))


SPLIT_SQL = """
WITH p AS (SELECT string_split(rtrim(text, ','), ',') AS p, text = '' OR rtrim(text, ',') <> '' AS has_parts
           FROM documents)
SELECT CASE WHEN has_parts THEN p[1] END AS id, CASE WHEN has_parts THEN p[len(p)] END AS name FROM p
"""


@query("split_head_last", SPLIT_SQL)
def split_head_last(t: Tables) -> DataFrame:
    return rows.head_and_last(t.documents, "text")


@query("table_bridge", SPLIT_SQL)
def table_bridge(t: Tables) -> DataFrame:
    """Split lines put behind a view name and read back as a table."""
    from dripline.plans.sqljob import through_view

    return through_view(rows.head_and_last(t.documents, "text"), "id_names")


@query(
    "split_explode",
    """SELECT unnest(string_split(rtrim(text, ','), ',')) AS word FROM documents
       WHERE text = '' OR rtrim(text, ',') <> ''""",
)
def split_explode(t: Tables) -> DataFrame:
    return rows.explode_parts(t.documents, "text")


ALARMS_SQL = """
WITH a AS (
  SELECT event_id, 1 AS "alarmType", CASE WHEN event_type = 'error' THEN props ELSE '' END AS "alarmValue" FROM events
  UNION ALL
  SELECT event_id, 2, CASE WHEN value > 100 THEN CAST(event_id AS VARCHAR) END FROM events
  UNION ALL
  SELECT event_id, 3, CASE WHEN value < 10 THEN '  ' ELSE event_type END FROM events
)
SELECT * FROM a WHERE trim(coalesce("alarmValue", '')) <> ''
"""


@query("ordinal_unpivot", ALARMS_SQL)
def ordinal_unpivot(t: Tables) -> DataFrame:
    alarms = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.col("props")).otherwise("").alias("alarm1"),
        F.when(F.col("value") > 100, F.col("event_id").cast("string")).alias("alarm2"),
        F.when(F.col("value") < 10, "  ").otherwise(F.col("event_type")).alias("alarm3"),
        F.lit(None).cast("string").alias("alarm4"),
    )
    return rows.unpivot_ordinal(alarms, ["alarm1", "alarm2", "alarm3", "alarm4"], ["event_id"])


@query(
    "row_to_cells",
    """SELECT CAST(o_orderkey AS VARCHAR) AS row_key, 'cf' AS family, qualifier, hex_value, o_orderkey AS cell_ts
       FROM (SELECT o_orderkey, 'oid' AS qualifier, lpad(hex(o_orderkey), 16, '0') AS hex_value FROM orders
             UNION ALL
             SELECT o_orderkey, 'cid', lpad(hex(o_custkey), 16, '0') FROM orders
             UNION ALL
             SELECT o_orderkey, 'os', hex(o_orderstatus) FROM orders)""",
)
def row_to_cells(t: Tables) -> DataFrame:
    made = rows.row_to_cells(
        t.orders,
        F.col("o_orderkey"),
        F.col("o_orderkey"),
        "cf",
        {
            "oid": cells.encode_long(F.col("o_orderkey")),
            "cid": cells.encode_long(F.col("o_custkey")),
            "os": cells.encode_text(F.col("o_orderstatus")),
        },
    )
    return made.select("row_key", "family", "qualifier", F.hex("value").alias("hex_value"), "cell_ts")


@query(
    "cells_to_map",
    """SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance
       FROM customer""",
)
def cells_to_map(t: Tables) -> DataFrame:
    got = rows.cells_to_map(customer_cells(t))
    return got.select(
        "row_key",
        F.col("cells")["name"].alias("name"),
        F.col("cells")["nation"].cast("int").alias("nation"),
        F.col("cells")["balance"].cast("double").alias("balance"),
    )


@query(
    "cell_names",
    """SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'name=' || c_name || ';nation=' || c_nationkey AS cells,
              c_acctbal AS balance
       FROM customer""",
)
def cell_names(t: Tables) -> DataFrame:
    got = rows.cells_to_map(customer_cells(t))
    return got.select("row_key", *texts_and_balance(F.col("cells")))


@query("scan_row_keys", "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS row_key FROM customer")
def scan_row_keys(t: Tables) -> DataFrame:
    return rows.scan_row_keys(customer_cells(t))


@query(
    "line_protocol",
    r"""SELECT 'orders,priority=' || regexp_replace(o_orderpriority, '([,= ])', '\\\1', 'g') || ',status='
              || o_orderstatus || ' customer=' || o_custkey || ',key=' || o_orderkey AS value
       FROM orders""",
)
def line_protocol(t: Tables) -> DataFrame:
    named = t.orders.select(
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("key"),
        F.col("o_custkey").alias("customer"),
    )
    return rows.time_series_lines(named, "orders", ["priority", "status"], ["key", "customer"])


@query(
    "doc_upsert",
    """SELECT 'customer_orders' AS index, o_custkey || '_' || o_orderstatus AS id,
              '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderkey":'
              || max(o_orderkey) || '}' AS body
       FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def doc_upsert(t: Tables) -> DataFrame:
    writes = t.orders.select("o_custkey", "o_orderstatus", "o_orderkey")
    docs = rows.documents(writes, "customer_orders", ["o_custkey", "o_orderstatus"], ["o_orderkey"])
    return rows.latest_documents(docs, ["o_orderkey"])


@query("transient_columns", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def transient_columns(t: Tables) -> DataFrame:
    return rows.drop_transient(rows.mark_transient(t.supplier, "s_acctbal"))


@query(
    "side_output",
    """SELECT CASE WHEN user_id < 100 THEN 'small' ELSE 'main' END AS tag, event_type, count(*) AS row_count
       FROM events GROUP BY 1, 2""",
)
def side_output(t: Tables) -> DataFrame:
    tagged = split.tag_rows(t.events, {"small": F.col("user_id") < 100})
    return tagged.groupBy("tag", "event_type").agg(F.count(F.lit(1)).alias("row_count"))


@query("side_output_rows", "SELECT event_id, user_id FROM events WHERE user_id < 100")
def side_output_rows(t: Tables) -> DataFrame:
    return split.split_by(t.events, {"small": F.col("user_id") < 100})["small"].select("event_id", "user_id")
