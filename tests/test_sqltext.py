"""Script text, declared tables, and streams whose watermark would drop rows."""

import pytest
from pyspark.sql import functions as F

from dripline.operators import keyed, windows
from dripline.plans import sqljob, sqltext
from dripline.sinks import writers
from test_streaming import SCHEMA, feed

TABLE = """CREATE TABLE numbers (
  f_sequence INT, f_random INT, ts AS current_timestamp(), d DECIMAL(10, 2), at TIMESTAMP(3),
  WATERMARK FOR at AS at - INTERVAL '5' SECOND
) WITH ('connector' = 'datagen', 'rows-per-second' = '5',
  'fields.f_sequence.kind' = 'sequence', 'fields.f_sequence.start' = '1', 'fields.f_sequence.end' = '9')"""


def test_statements():
    script = "/* it's; */ a \";--\" ; -- '\n INSERT INTO `t;` SELECT 6/2-1, '/*', 'it''s';;"
    assert sqltext.statements(script) == ['a ";--"', "INSERT INTO `t;` SELECT 6/2-1, '/*', 'it''s'"]
    assert sqltext.statements(" ; ") == []


@pytest.mark.parametrize("script", ["a 'b", 'a "b', "a `b", "a /* b"])
def test_open_quotes_fail(script):
    with pytest.raises(ValueError, match="unmatched .* in line 1"):
        sqltext.statements(script)


def test_declared():
    table = sqltext.declared(TABLE)
    assert table.columns == {"f_sequence": "INT", "f_random": "INT", "d": "DECIMAL(10, 2)", "at": "timestamp"}
    assert table.computed == {"ts": "current_timestamp()"}
    assert table.watermark == {"column": "at", "delay": "5 seconds"}
    assert sqltext.settings_of(table, sink=False) == {"kind": "datagen", "rows_per_second": 5, "start": 1, "end": 9}
    assert sqltext.declared("CREATE TABLE t (a INT) USING parquet") is None


def test_unknown_options_fail():
    for old, new in (("rows-per-second", "rows"), ("'datagen'", "'other'"), ("'5',", "5,"), ("f_random INT", "f_random")):
        with pytest.raises(ValueError):
            sqltext.settings_of(sqltext.declared(TABLE.replace(old, new)), sink=False)


def test_generated_tables_take_any_columns(spark, tmp_path):
    source = """CREATE TABLE readings (
      id BIGINT, level SMALLINT, name VARCHAR(8), share DOUBLE, ok BOOLEAN, price DECIMAL(10, 2), at TIMESTAMP(3), twice AS id * 2
    ) WITH ('connector' = 'datagen', 'fields.id.kind' = 'sequence', 'fields.id.start' = '5', 'fields.id.end' = '204',
      'fields.level.min' = '-3', 'fields.level.max' = '3', 'fields.name.length' = '8', 'fields.share.kind' = 'random'{});"""
    sink = f"CREATE TABLE s (id BIGINT, level SMALLINT, name STRING, share DOUBLE, ok BOOLEAN, twice BIGINT) WITH ('connector' = 'filesystem', 'path' = '{tmp_path}/s');"
    script = source.format("") + sink + "INSERT INTO s SELECT id, level, name, share, ok, twice FROM readings"
    sqljob.run_sql_job(spark, {"sql": {"j": script}}, "j")
    got = spark.read.parquet(f"{tmp_path}/s").orderBy("id").collect()
    assert [r.id for r in got] == list(range(5, 205)) and all(r.twice == 2 * r.id for r in got)
    assert {r.level for r in got} == set(range(-3, 4)) and {len(r.name) for r in got} == {8}
    assert {r.ok for r in got} == {True, False} and len({r.share for r in got}) > 150
    few = source.format(", 'number-of-rows' = '7'")
    sqljob.run_sql_job(spark, {"sql": {"j": few}}, "j")
    assert spark.table("readings").count() == 7
    endless = few.replace("'fields.id.kind' = 'sequence', 'fields.id.start' = '5', 'fields.id.end' = '204',", "").replace(", 'number-of-rows' = '7'", "")
    with pytest.raises(ValueError, match="number-of-rows"):
        sqljob.run_sql_job(spark, {"sql": {"j": endless}}, "j")
    with pytest.raises(ValueError, match="unknown options"):
        sqljob.run_sql_job(spark, {"sql": {"j": source.format(", 'fields.other.min' = '1'")}}, "j")


def test_insert_needs_the_sinks_columns(spark, tmp_path):
    sink = f"CREATE TABLE s (a INT, b STRING) WITH ('connector' = 'filesystem', 'path' = '{tmp_path}/s');"
    sqljob.run_sql_job(spark, {"sql": {"j": sink + "INSERT INTO s (b) SELECT 7 AS x"}}, "j")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/s").collect()] == [(None, "7")]
    with pytest.raises(ValueError, match="2 columns given"):
        sqljob.run_sql_job(spark, {"sql": {"j": sink + "INSERT INTO s (b) SELECT 7, 8"}}, "j")


def test_file_sinks_need_a_checkpoint(spark, tmp_path):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="needs a checkpoint"):
        writers.start_sink(stream, {"sink": "parquet", "path": str(tmp_path)}, "s")


@pytest.mark.parametrize("delay,fails", [("0 seconds", True), ("1000 seconds", False)])
def test_rows_behind_the_watermark_are_not_dropped_unseen(spark, tmp_path, delay, fails):
    rows = [("a", k, 1_000_000 - 10_000 * k) for k in range(80)]  # newest first
    stream = feed(spark, str(tmp_path), rows, [20, 40, 60])
    timed = windows.with_event_time(stream, F.col("ts"), delay)
    counted = windows.windowed_count(timed, "event_time", ["key"], "10 seconds")
    writer = counted.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if fails:
        with pytest.raises(ValueError, match="behind the watermark"):
            windows.refuse_dropped(query)
    else:
        windows.refuse_dropped(query)


def test_one_watermark_for_all_keys(spark):
    rows = [("ab"[k % 2], k, (k * 7919) % 997) for k in range(500)]
    got = keyed.late_rows(spark.createDataFrame(rows, SCHEMA), [], ["seq"], F.col("ts"), 100, floor_rows=20)
    seen, want = -1, {}
    for _, seq, ts in rows:
        seen = max(seen, ts)
        want[seq] = ts < seen - 100
    assert {r.seq: r.is_late for r in got.collect()} == want
