"""Streams fed in several files: same rows as the batch form, also after a failure."""

import random
import time

import pytest
from pyspark.sql import functions as F

from dripline.operators import keyed, windows
from dripline.plans import alarms
from dripline.sinks import batches
from dripline.streaming import carried, lateness
from test_keyed import expected_sessions, made_rows
from test_rows import PUMP

SCHEMA = "key string, seq bigint, ts bigint"


def feed(spark, folder, rows, cuts, schema=SCHEMA):
    """Rows as one file per cut, read one file per micro-batch in order."""
    edges = [0, *cuts, len(rows)]
    for a, b in zip(edges, edges[1:]):
        part = rows[a:b]
        random.Random(a).shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


CUTS = [[], [1], [100, 200, 300], [399]]


@pytest.mark.parametrize("cuts", CUTS)
def test_sessions(spark, tmp_path, cuts):
    rows = made_rows(11)
    stream = feed(spark, str(tmp_path), rows, cuts)
    sink = batches.batch_folders(f"{tmp_path}/out")
    carried.session_stream(
        stream, ["key"], ["seq"], "ts", sink, str(tmp_path), ttl_ms=3_600_000
    ).awaitTermination()
    got = batches.read_batches(spark, f"{tmp_path}/out")
    assert set(got.columns) == {"key", "seq", "ts", "session_start_ms"}
    assert {r.seq: r.session_start_ms for r in got.collect()} == expected_sessions(rows)
    assert spark.read.parquet(f"{tmp_path}/out").select("batch_id").distinct().count() == len(cuts) + 1


def test_totals_and_late_rows(spark, tmp_path):
    rows = made_rows(12)
    df = spark.createDataFrame(rows, SCHEMA)
    for name, start, whole in (
        ("totals", lambda s, sink, f: carried.running_total_stream(s, ["key"], ["seq"], sink, f),
         keyed.running_total(df, ["key"], ["seq"])),
        ("sums", lambda s, sink, f: carried.running_total_stream(s, ["key"], ["seq"], sink, f, value="ts"),
         keyed.running_total(df, ["key"], ["seq"], F.col("ts"))),
        ("late", lambda s, sink, f: carried.late_rows_stream(s, ["key"], ["seq"], "ts", sink, f),
         keyed.late_rows(df, ["key"], ["seq"], F.col("ts"))),
    ):
        folder = str(tmp_path / name)
        stream = feed(spark, folder, list(rows), [50, 250])
        start(stream, batches.batch_folders(f"{folder}/out"), folder).awaitTermination()
        got = batches.read_batches(spark, f"{folder}/out").select(whole.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())), name


@pytest.mark.parametrize("fail_after_write", [False, True])
def test_restart_after_failure(spark, tmp_path, fail_after_write):
    """A batch fails in its sink and the job starts again: no row is lost or doubled."""
    rows = made_rows(13)
    stream = feed(spark, str(tmp_path), rows, [100, 200, 300])
    store, failures = batches.batch_folders(f"{tmp_path}/out"), [2]

    def sink(df, batch_id):
        if fail_after_write:
            store(df, batch_id)
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("lost the store")
        store(df, batch_id)

    def run():
        carried.session_stream(stream, ["key"], ["seq"], "ts", sink, str(tmp_path)).awaitTermination()

    with pytest.raises(Exception, match="lost the store"):
        run()
    run()
    got = batches.read_batches(spark, f"{tmp_path}/out").collect()
    assert len(got) == len(rows) and {r.seq: r.session_start_ms for r in got} == expected_sessions(rows)


def test_silent_keys_are_forgotten(spark, tmp_path):
    """A key unheard of for the TTL starts anew; one heard of in time goes on."""
    at, sink = str(tmp_path), batches.batch_folders(f"{tmp_path}/out")
    for n, wait in ((0, 0), (1, 0), (2, 7)):
        time.sleep(wait)
        stream = feed(spark, at, [("a", n, 1000 + n)], [])
        carried.session_stream(stream, ["key"], ["seq"], "ts", sink, at, ttl_ms=6_000 if wait else 60_000).awaitTermination()
    got = {r.seq: r.session_start_ms for r in batches.read_batches(spark, f"{at}/out").collect()}
    assert got == {0: 1000, 1: 1000, 2: 1000}
    at, sink = f"{at}/short", batches.batch_folders(f"{at}/short-out")
    for n, wait in ((0, 0), (1, 4)):
        time.sleep(wait)
        stream = feed(spark, at, [("a", n, 1000 + n)], [])
        carried.session_stream(stream, ["key"], ["seq"], "ts", sink, at, ttl_ms=1_000).awaitTermination()
    got = {r.seq: r.session_start_ms for r in batches.read_batches(spark, f"{tmp_path}/short-out").collect()}
    assert got == {0: 1000, 1: 1001}


def test_odd_rows_of_a_stream(spark, tmp_path):
    """NULL keys, orders, times and large whole numbers, in columns beside the ones that are used."""
    schema = "key string, seq bigint, ts bigint, big bigint, tags array<string>, m map<string,int>, s struct<a:int,b:string>"
    far = 2**60 + 1
    rows = [(None, 1, 5, far, ["x"], {"k": 1}, (1, None)), (None, None, 3, None, None, None, None), ("a", 2, None, far, [], {}, (None, "b")), ("a", 3, far, None, ["y", None], {"k": None}, (2, "c"))]
    stream = feed(spark, str(tmp_path), rows, [1], schema)
    sink = batches.batch_folders(f"{tmp_path}/out")
    carried.running_total_stream(stream, ["key"], ["seq"], sink, str(tmp_path), value="big").awaitTermination()
    got = batches.read_batches(spark, f"{tmp_path}/out")
    want = keyed.running_total(spark.createDataFrame(rows, schema).withColumn("at", F.coalesce("seq", F.lit(1.5))), ["key"], ["at"], F.col("big")).drop("at")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_sessions_are_closed_by_their_timers(spark, tmp_path):
    """Sessions out of order within the delay, restarted after each file; the last one stays open."""
    rows = [("a", 0, 1), ("b", 1, 10), ("a", 2, 100_000), ("a", 3, 60_001), ("b", 4, 300_000), (None, 5, 290_000), ("a", 6, 900_000), ("a", 7, 2_000_000)]
    at, sink = str(tmp_path), batches.batch_folders(f"{tmp_path}/out")
    for part in (rows[:4], rows[4:7], rows[7:]):
        stream = feed(spark, at, part, [])
        carried.start_batches(carried.closed_sessions(stream, ["key"], "ts", 60_000, 100_000), sink, at, "closed").awaitTermination()
    got = {tuple(r) for r in batches.read_batches(spark, f"{at}/out").collect()}
    assert got == {("a", 1, 100_000, 3), ("b", 10, 10, 1), (None, 290_000, 290_000, 1), ("b", 300_000, 300_000, 1), ("a", 900_000, 900_000, 1)}


def test_late_rows_go_to_their_own_sink(spark, tmp_path):
    """Rows behind the watermark by a whole window come out as they came; others are counted, over a restart."""
    at = str(tmp_path)
    counts, late = (batches.batch_folders(f"{at}/{part}") for part in ("counts", "late"))
    parts = [[("a", 0, 1_000), ("a", 1, 1_500), (None, 2, 12_000)], [("a", 3, 1_900), ("a", 4, 9_999), ("b", None, 11_000), (None, 5, None)], [("a", 6, 50_000)], [("b", 7, 13_000)]]
    for part in parts:
        stream = feed(spark, at, part, [])
        lateness.start_counts_and_late(stream, ["key"], "ts", 1_000, 2_000, counts, late, at, salts=2).awaitTermination()
    late_rows = batches.read_batches(spark, f"{at}/late")
    assert {tuple(r) for r in late_rows.select("key", "seq", "ts").collect()} == {("a", 3, 1_900), ("a", 4, 9_999), (None, 5, None), ("b", 7, 13_000)}
    got = {tuple(r) for r in batches.read_batches(spark, f"{at}/counts").collect()}
    assert got == {("a", 1_000, 2), (None, 12_000, 1), ("b", 11_000, 1)}


def test_alarm_job(spark, tmp_path):
    """Alarms over two files: the session goes on, blank and all-zero alarms are told apart."""
    stamps = [0, 60_000, 120_001, 120_002]
    values = [PUMP.replace("1685417984666", str(1685417984666 + s)) for s in stamps]
    values[1] = values[1].replace('"alarm2":"00000000000000000000000000000010"', '"alarm2":"  "')
    rows = [(v, i) for i, v in enumerate([values[0], "  ", values[1], values[2], values[3]])]
    stream = feed(spark, str(tmp_path), rows, [2], "value string, offset bigint")
    sink = batches.batch_folders(f"{tmp_path}/out")
    alarms.alarm_stream_job(stream, ["offset"], sink, str(tmp_path)).awaitTermination()
    got = batches.read_batches(spark, f"{tmp_path}/out")
    assert got.columns == alarms.ALARM_COLUMNS
    starts = {(r.alarmTs - 1685417984666, r.startDateTime) for r in got.collect()}
    assert starts == {(0, "20230530033944"), (60_000, "20230530033944"), (120_001, "20230530034144"),
                      (120_002, "20230530034144")}
    assert got.count() == 15
    batch = alarms.alarm_rows(spark.createDataFrame(rows, "value string, offset bigint"), ["offset"])
    assert sorted(map(str, batch.collect())) == sorted(map(str, got.collect()))


def test_strict_alarm_job_stops_at_a_bad_line(spark):
    df = spark.createDataFrame([(PUMP, 0), ("{bad", 1)], "value string, offset bigint")
    with pytest.raises(Exception):
        alarms.alarm_rows(df, ["offset"]).collect()
    assert alarms.alarm_rows(df, ["offset"], strict=False).count() == 4


def test_session_windows_agree_with_stamps(spark, tmp_path):
    rows = sorted(((k, s, t) for k, s, t in made_rows(14) if t), key=lambda r: r[2])
    rows.append(("end", 10_000, 3_000_000_000_000))
    stream = feed(spark, str(tmp_path), rows, [150])
    timed = windows.with_event_time(stream, F.col("ts"), "0 seconds")
    found = windows.session_windows(timed, "event_time", ["key"], "60 seconds")
    q = found.writeStream.format("memory").queryName("closed").outputMode("append")
    q.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = {(r.key, int(r.session_start.timestamp() * 1000), r.row_count) for r in spark.table("closed").collect()}
    want = keyed.session_summary(spark.createDataFrame(rows[:-1], SCHEMA), ["key"], F.col("ts"))
    assert got == {(r.key, r.session_start_ms, r.row_count) for r in want.collect()}


def test_word_count_stream_updates(spark, tmp_path):
    rows = [("a", 0, 0), ("b", 1, 0), ("a", 2, 0)]
    stream = feed(spark, str(tmp_path), rows, [2])
    totals = keyed.word_totals(stream, "key")
    q = totals.writeStream.format("memory").queryName("words").outputMode("complete")
    q.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert {(r.key, r.total) for r in spark.table("words").collect()} == {("a", 2), ("b", 1)}


def test_arrival_time(spark):
    df = windows.with_arrival_time(spark.createDataFrame([(1,)], "x int"))
    assert dict(df.dtypes)["ts"] == "timestamp" and df.first().ts is not None


def test_many_keys_share_calls_and_missing_keys_keep_apart(spark, tmp_path):
    """Keys are dealt to few buckets, whose rows a call folds key by key; a missing key is a key of its own."""
    schema, rng = "user bigint, seq bigint, ts bigint", random.Random(5)
    rows = [(rng.choice([None, 0, *range(300)]), n, 1_000_000 + 1_000 * n - rng.randrange(9_000)) for n in range(900)]
    df = spark.createDataFrame(rows, schema)
    assert carried._marked(df, ["user"]).select("_bucket").distinct().count() <= carried.BUCKETS
    late = str(tmp_path / "late")
    stream = feed(spark, late, list(rows), [400], schema)
    carried.late_rows_stream(stream, ["user"], ["seq"], "ts", batches.batch_folders(f"{late}/out"), late).awaitTermination()
    want = keyed.late_rows(df, ["user"], ["seq"], F.col("ts")).select("seq", "is_late").collect()
    got = batches.read_batches(spark, f"{late}/out").select("seq", "is_late").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    closed = str(tmp_path / "closed")
    stream = feed(spark, closed, [*rows, (-1, 900, 9_000_000_000), (-1, 901, 9_000_000_001)], [400, 900, 901], schema)
    sink = batches.batch_folders(f"{closed}/out")
    carried.start_batches(carried.closed_sessions(stream, ["user"], "ts", 60_000, 20_000), sink, closed, "closed").awaitTermination()
    found = {}
    for user, _, ts in sorted(rows, key=lambda r: r[2]):
        runs = found.setdefault(user, [])
        if runs and ts - runs[-1][1] <= 60_000:
            runs[-1] = (runs[-1][0], ts, runs[-1][2] + 1)
        else:
            runs.append((ts, ts, 1))
    got = [tuple(r) for r in batches.read_batches(spark, f"{closed}/out").collect() if r.user != -1]
    assert sorted(got, key=str) == sorted(((u, *s) for u, runs in found.items() for s in runs), key=str)
