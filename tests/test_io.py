"""Sources, sinks, settings and SQL jobs."""

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from dripline import config, session
from dripline.functions import cells
from dripline.operators import rows
from dripline.plans import etl, sqljob
from dripline.sinks import batches, files, jdbc, local, remote, splits, stores, subtables, upserts, writers
from dripline.sources import kafka, polled, polling, readers, synthetic
from dripline.streaming.carried import start_batches
from test_rows import PUMP

KAFKA = {"bootstrap.servers": "h1:9092,h2:9092", "topic": "t1, t2", "group.id": "g", "auto.offset.reset": "earliest"}


def test_kafka_options():
    assert kafka.kafka_options({**KAFKA, "security.protocol": "SSL"}) == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "t1,t2",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "kafka.security.protocol": "SSL",
    }
    at = kafka.kafka_options({**KAFKA, "start.from": {"timestamp": 1591286400000}})
    assert at["startingTimestamp"] == "1591286400000" and "startingOffsets" not in at
    offsets = {"topic": "t1,t2", "t1": "0:182,1:183", "t2": "0:5"}
    got = kafka.kafka_options({**KAFKA, "start.from": {"offset": offsets}})
    assert json.loads(got["startingOffsets"]) == {"t1": {"0": 182, "1": 183}, "t2": {"0": 5}}
    assert kafka.kafka_options({**KAFKA, "max.rows": 10})["maxOffsetsPerTrigger"] == "10"


@pytest.mark.parametrize("bad", [
    {"auto.offset.reset": "middle"},
    {"start.from": {"offset": {"topic": "t1", "t1": "0:1"}}},
    {"start.from": {"offset": {"topic": "t3", "t3": "0:1"}}},
    {"start.from": {"timestamp": 1, "offset": {"t1": "0:1"}}},
])
def test_kafka_options_refused(bad):
    with pytest.raises(ValueError):
        kafka.kafka_options({**KAFKA, **bad})


def test_kafka_sink_options():
    got = writers.kafka_sink_options({"bootstrap.servers": "h", "topic": "t", "transaction.timeout.ms": 1000})
    assert got == {"kafka.bootstrap.servers": "h", "topic": "t", "kafka.acks": "all", "kafka.transaction.timeout.ms": "1000"}
    with pytest.raises(ValueError):
        writers.kafka_sink_options({"bootstrap.servers": "h", "topic": "t", "semantic": "EXACTLY_ONCE"})


def test_open_source(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    assert readers.open_source(spark, {"kind": "text", "path": str(tmp_path)}, stream=False).count() == 2
    assert readers.open_source(spark, {"kind": "text", "path": str(tmp_path), "max_files": 1}).isStreaming
    assert readers.open_source(spark, {"kind": "datagen", "end": 5}, stream=False).count() == 5
    with pytest.raises(ValueError, match="unknown source"):
        readers.open_source(spark, {"kind": "pigeon"})
    got = readers.from_items(spark, ["123456", "1111"]).collect()
    assert [r.value for r in got] == ["123456", "1111"]


def test_synthetic_rows(spark):
    got = synthetic.synthetic_table(spark, 1, 1000, 1, 50, 40).collect()
    assert [r.f_sequence for r in got] == list(range(1, 1001))
    assert all(1 <= r.f_random <= 50 and len(r.f_random_str) == 40 for r in got)
    assert len({r.f_random for r in got}) == 50
    assert synthetic.synthetic_stream(spark, end=3).isStreaming


def orders(spark, *rows_):
    return spark.createDataFrame(list(rows_), "order_id string, ts string")


def test_poller_bounds(spark):
    table = orders(spark, ("a", "2020-10-10 23:00:00"), ("b", "2020-10-10 23:00:01"), ("c", "2020-10-11 00:00:00"))
    strict = polling.Poller(lambda _: table, "ts", "2020-10-10 23:00:00")
    assert [r.order_id for r in strict.after(spark, ordered=True).collect()] == ["b", "c"]
    assert strict.next_mark(spark) == "2020-10-11 00:00:00"
    assert strict.next_mark(spark, "2020-10-11 00:00:00") == "2020-10-11 00:00:00"
    loose = polling.Poller(lambda _: table, "ts", "2020-10-10 23:00:00", True, ("order_id",))
    assert loose.after(spark).count() == 3
    assert loose.after(spark, "2020-10-11 00:00:00").count() == 1


def test_poll_reaches_the_scan(spark, tmp_path):
    orders(spark, ("a", "1"), ("b", "2")).write.parquet(str(tmp_path / "t"))
    poller = polling.Poller(lambda s: s.read.parquet(str(tmp_path / "t")), "ts", "1")
    plan = poller.after(spark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,1)" in plan


def test_polling_stream(spark, tmp_path):
    """Rows that come in while polling are taken once; a failed poll repeats its range."""
    table = str(tmp_path / "table")
    orders(spark, ("a", "1"), ("b", "2")).write.parquet(table)
    store, failures = batches.batch_folders(str(tmp_path / "out")), ["first"]

    def sink(df, batch_id):
        if failures:
            failures.pop()
            raise RuntimeError("store is away")
        store(df, batch_id)

    poller = polling.Poller(lambda s: s.read.parquet(table), "ts", "0")

    def start():
        return polling.start_polling(spark, poller, sink, str(tmp_path), "200 milliseconds")

    def wait(q, count):
        limit = time.time() + 60
        while time.time() < limit:
            if q.exception():
                raise q.exception()
            try:
                if batches.read_batches(spark, str(tmp_path / "out")).count() >= count:
                    return
            except Exception as e:
                assert "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER" in str(e) or "does not exist" in str(e), e
            time.sleep(0.3)
        raise AssertionError("no rows in time")

    q = start()
    with pytest.raises(Exception, match="store is away"):
        q.awaitTermination(60)
    q = start()
    try:
        wait(q, 2)
        orders(spark, ("c", "3")).write.mode("append").parquet(table)
        wait(q, 3)
        time.sleep(1)
    finally:
        q.stop()
    got = batches.read_batches(spark, str(tmp_path / "out")).collect()
    assert sorted(r.order_id for r in got) == ["a", "b", "c"]


def test_hour_buckets(spark, tmp_path):
    late = PUMP.replace("1685417984666", "1685417984666000")
    df = spark.createDataFrame([(PUMP,), ("  ",), (late,)], "value string")
    files.write_hour_buckets(files.with_hour_buckets(df), str(tmp_path / "b"))
    got = files.read_hour_buckets(spark, str(tmp_path / "b"))
    where = {(r.dt, r.hr): r.value for r in got.collect()}
    assert where[("20230530", "03")] == PUMP and where[("19700101", "00")] == "  " and len(where) == 3
    bad = spark.createDataFrame([("{}",)], "value string")
    with pytest.raises(Exception, match="no ts in line"):
        files.with_hour_buckets(bad).collect()
    assert files.with_hour_buckets(bad, strict=False).first().dt == "19700101"


def test_files_of_an_hour_are_bounded_by_bytes(spark, tmp_path):
    """Lines of many lengths, one longer than the limit, repeats among them; a batch written again replaces itself."""
    rng, at = random.Random(4), str(tmp_path / "b")
    lines = ["x" * rng.randrange(90) for _ in range(800)] + ["same line"] * 400 + ["é" * 30] * 20
    df = spark.createDataFrame([(v, "20240101", "05") for v in lines], "value string, dt string, hr string").repartition(5)
    for _ in range(2):
        files.write_hour_buckets(df, at, 3, 1_000)
    sizes = files.part_sizes(spark, at).collect()
    assert sum(r.row_count for r in sizes) == len(lines) and max(r.part_bytes for r in sizes) <= 1_000
    assert sum(r.part_bytes for r in sizes) == sum(len(v.encode()) + 1 for v in lines)
    on_disk = [p.stat().st_size for p in (tmp_path / "b").rglob("part-*")]
    assert len(on_disk) == len(sizes) and max(on_disk) <= 1_000
    long = spark.createDataFrame([("y" * 5_000, "20240101", "06"), ("z", "20240101", "06")], "value string, dt string, hr string")
    files.write_hour_buckets(long, at, 4, 1_000)
    assert files.part_sizes(spark, at).where("hr = '06'").count() == 2


def test_small_files_are_full_and_dealt_to_many_tasks(spark, tmp_path):
    """Only the last file of a slice is not full, and few bytes in many files do not end in one task."""
    at = str(tmp_path / "b")
    lines = spark.range(6_000).selectExpr("lpad(id, 19, '0') AS value", "'20240101' AS dt", "lpad(id % 3, 2, '0') AS hr")
    files.write_hour_buckets(lines, at, 0, 400)
    sizes = files.part_sizes(spark, at).collect()
    assert sum(r.row_count for r in sizes) == 6_000 and max(r.part_bytes for r in sizes) <= 400
    slices = -(-40_000 // (360 * files.TASK_FILES))
    assert len(sizes) <= 3 * (-(-40_000 // 380) + slices)
    writers = {p.name.split("-")[1] for p in (tmp_path / "b").rglob("part-*.txt")}
    assert len(writers) > 3


def _hadoop_bytes(spark):
    return sum(s.getBytesWritten() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")


def test_small_local_files_are_not_opened_by_hadoop(spark, tmp_path):
    """Each file that Hadoop opens costs processes; they are written, counted and removed without it."""
    at = str(tmp_path / "b")
    lines = spark.range(3_000).selectExpr("lpad(id, 19, '0') AS value", "'20240101' AS dt", "lpad(id % 3, 2, '0') AS hr")
    before = _hadoop_bytes(spark)
    for _ in range(2):
        files.write_hour_buckets(lines, at, 0, 400)
    sizes = files.part_sizes(spark, at).collect()
    assert sum(r.part_bytes for r in sizes) == 60_000 and max(r.part_bytes for r in sizes) <= 400
    assert _hadoop_bytes(spark) - before < 60_000
    assert {p.name for p in (tmp_path / "b").iterdir()} == {"dt=20240101"}


def test_parts_are_the_same_with_and_without_hadoop(spark, tmp_path, monkeypatch):
    """Missing and empty lines, line ends inside lines, names to be escaped: same folders, lines, counts and removals."""
    days = [None, "20240101", "a=b/c:%{x}"]
    rows = [(f"{d}-{n}" * (n % 5), d, f"0{n % 2}", f"b{n % 3}-0-0") for d in days for n in range(12)]
    rows += [(None, "20240102", "01", "b0-0-0"), ("a\rb\r\nc\n", "20240102", "01", "b0-0-0"), ("\ufeffé", "20240102", "02", None)]
    df = spark.createDataFrame(rows, "value string, dt string, hr string, part string").repartition(3)
    here, found = local.local_path, {}
    for hadoop in (True, False):
        at = str(tmp_path / str(hadoop))
        monkeypatch.setattr(local, "local_path", (lambda *_: None) if hadoop else here)
        files._write_parts(df, at)
        folders = sorted(str(p.relative_to(at)) for p in (tmp_path / str(hadoop)).glob("dt=*/hr=*/part=*"))
        lines = sorted(map(repr, files._visible(spark, at).select("value", *files.BY).collect()))
        sizes = sorted(map(repr, files.part_sizes(spark, at).collect()))
        monkeypatch.setattr(local, "local_path", here)
        assert sizes == sorted(map(repr, files.part_sizes(spark, at).collect()))
        assert len(list((tmp_path / str(hadoop)).rglob(".part-*.crc"))) == len(folders)
        monkeypatch.setattr(local, "local_path", (lambda *_: None) if hadoop else here)
        files._remove_parts(spark, at, "b0-")
        found[hadoop] = folders, lines, sizes, sorted(str(p.relative_to(at)) for p in (tmp_path / str(hadoop)).glob("dt=*/hr=*/part=*"))
    assert found[True] == found[False] and len(found[True][0]) > len(found[True][3]) > 0


def test_a_changed_byte_is_seen(spark, tmp_path):
    at = str(tmp_path / "b")
    files.write_hour_buckets(spark.createDataFrame([("x" * 3_000, "20240101", "05")], "value string, dt string, hr string"), at)
    assert files.part_sizes(spark, at).first().part_bytes == 3_001
    (file,) = (tmp_path / "b").rglob("part-*.txt")
    file.write_bytes(b"y" + file.read_bytes()[1:])
    for read in (files.part_sizes, files.read_hour_buckets):
        with pytest.raises(Exception, match="(?i)checksum"):
            read(spark, at).collect()


def test_a_failed_write_shows_nothing(spark, tmp_path):
    at = tmp_path / "b"
    bad = spark.range(100).selectExpr("IF(id = 99, raise_error('no'), id) AS value", "'20240101' AS dt", "'05' AS hr", "concat('b0-', id) AS part")
    with pytest.raises(Exception, match="no"):
        local.write_lines(bad.withColumn("value", F.col("value").cast("string")).coalesce(1), str(at), files.BY)
    assert list(at.iterdir()) == []


def test_parts_are_moved_once(tmp_path, monkeypatch):
    """Into an open folder too; a move that was cut short or is done again ends the same."""
    staged, to = tmp_path / "s", tmp_path / "t"
    for folder, part, name in ((staged, "p=1", "a"), (staged, "p=2", "b"), (to, "p=2", "c")):
        (folder / "d=1" / part).mkdir(parents=True)
        (folder / "d=1" / part / name).write_text(name)
    move = local._mover(str(to), 2)
    with monkeypatch.context() as patch, pytest.raises(FileNotFoundError):  # what can't be moved is no move that was done
        patch.setattr(local.os, "rename", lambda *_: (to / "none").stat())
        move(str(staged))
    for _ in range(2):
        move(str(staged))
        assert sorted(str(p.relative_to(to)) for p in to.rglob("[abc]")) == ["d=1/p=1/a", "d=1/p=2/b", "d=1/p=2/c"]
    assert not staged.exists()


def test_closed_hours_are_compacted(spark, tmp_path):
    """Many small files become few, no line changes, open hours stay; a run that failed midway is not seen."""
    at = str(tmp_path / "b")
    schema = "value string, dt string, hr string"
    for n in range(6):
        files.write_hour_buckets(spark.createDataFrame([(f"{n}-{h}-{k}", "20240101", f"0{h}") for h in (1, 2) for k in range(3)], schema), at, n)
    want = sorted(map(tuple, files.read_hour_buckets(spark, at).collect()))
    assert files.compact_hours(spark, at, "2024010102") == 6
    assert sorted(map(tuple, files.read_hour_buckets(spark, at).collect())) == want
    assert {(r.hr, r["count"]) for r in files.part_sizes(spark, at).groupBy("hr").count().collect()} == {("01", 1), ("02", 6)}
    assert len(list((tmp_path / "b").glob("dt=*/hr=01/part=*"))) == 1
    # A run that has written its merged files, but no manifest yet.
    merged = files.read_hour_buckets(spark, at).where("hr = '02'")
    files._write_parts(files.with_parts(merged, name="m2-"), at)
    assert sorted(map(tuple, files.read_hour_buckets(spark, at).collect())) == want
    assert files.compact_hours(spark, at, "2024010103") == 6
    assert sorted(map(tuple, files.read_hour_buckets(spark, at).collect())) == want
    # A run that has written its manifest, but removed nothing yet: readers do not see what it replaced.
    files._write_parts(spark.createDataFrame([("0-2-0", "20240101", "02")], schema).withColumn("part", F.lit("b0-0-0")), at)
    assert sorted(map(tuple, files.read_hour_buckets(spark, at).collect())) == want
    assert files.compact_hours(spark, at, "2024010103") == 0 and files.part_sizes(spark, at).count() == 2


def test_hour_pruning(spark, tmp_path):
    df = spark.createDataFrame([(PUMP,), ("",)], "value string")
    files.write_hour_buckets(files.with_hour_buckets(df), str(tmp_path / "b"))
    one = files.read_hour_buckets(spark, str(tmp_path / "b")).filter("dt = '20230530' AND hr = '03'")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()


def test_subtables(spark, tmp_path):
    second = PUMP.replace("icu-pump-30-1001", "icu-pump-30-1002")
    moved = PUMP.replace("127.0.0.1", "10.0.0.1").replace("1685417984666", "1685417984999")
    df = spark.createDataFrame([(PUMP,), (second,), (moved,)], "value string")
    records = rows.flatten_pump(rows.with_pump(df))
    path = str(tmp_path / "t")
    subtables.subtable_sink(path)(records, 0)
    subtables.subtable_sink(path)(records, 0)
    subtables.subtable_sink(path)(records.limit(1), 1)
    one = subtables.read_subtable(spark, path, "hp_icu_pump_30_1001")
    assert one.count() == 3 and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    assert subtables.read_supertable(spark, path).count() == 4
    tags = {r.tableName: r.host for r in subtables.read_tags(spark, path).collect()}
    assert tags == {"hp_icu_pump_30_1001": "127.0.0.1", "hp_icu_pump_30_1002": "127.0.0.1"}
    nameless = rows.flatten_pump(rows.with_pump(spark.createDataFrame([('{"data":{}}',)], "value string")))
    with pytest.raises(Exception, match="without a table name"):
        subtables.write_subtables(nameless, path, 2)


class Recorder:
    """A JDBC stand-in: keeps statements, for the order of delete and write."""

    def __init__(self):
        self.statements = []

    def __call__(self, spark, options, statement):
        self.statements.append(statement)


JDBC = {"jdbcUrl": "jdbc:none://x", "driverClassName": "no.Driver", "username": "u", "password": "p"}


def test_jdbc_sink_deletes_before_writing(spark):
    run = Recorder()
    with pytest.raises(Exception, match="no.Driver"):
        jdbc.jdbc_sink(JDBC, "orders", run)(spark.range(1), 7)
    assert run.statements == ["DELETE FROM orders WHERE batch_id = 7"]
    again = Recorder()
    with pytest.raises(Exception, match="no.Driver"):
        jdbc.jdbc_sink({**JDBC, "semantic": "AT_LEAST_ONCE"}, "orders", again)(spark.range(1), 7)
    assert again.statements == []


def test_jdbc_options():
    got = jdbc.jdbc_options({**JDBC, "batch.size": 3}, "orders")
    assert got == {"url": "jdbc:none://x", "dbtable": "orders", "batchsize": "3", "numPartitions": "5",
                   "driver": "no.Driver", "user": "u", "password": "p"}
    with pytest.raises(ValueError):
        jdbc.jdbc_options(JDBC, "orders; drop table x")


def test_letters_stop_the_batch_and_its_offset(spark, tmp_path):
    """Digits are written; a letter fails the batch, and the next run starts at that batch again."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.txt").write_text("1\n2\n")
    store = batches.batch_folders(out)

    def start():
        lines = readers.text_lines(spark, str(source), max_files=1).select(F.col("value").cast("int").alias("id"))
        writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", str(tmp_path / "c"))
        return writer.trigger(availableNow=True).start()

    start().awaitTermination()
    (source / "b.txt").write_text("3\nx\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        start().awaitTermination()
    assert sorted(r.id for r in batches.read_batches(spark, out).collect()) == [1, 2]
    commits = [p.name for p in (tmp_path / "c" / "commits").iterdir() if not p.name.startswith(".")]
    assert commits == ["0"]


def flaky(path):
    """Refuses odd ids always, and ids over 10 on the first attempt of each task."""

    def connect():
        seen = set()

        def send(buffer):
            key = tuple(r["id"] for r in buffer)
            if any(i % 2 for i in key):
                raise OSError("refused")
            if max(key) > 10 and key not in seen:
                seen.add(key)
                return 503
            with open(path, "a") as f:
                f.write("".join(f"{i}\n" for i in key))
            return 201

        return send

    return connect


def test_remote_sink(spark, tmp_path):
    sent, dead = tmp_path / "sent", str(tmp_path / "dead")
    settings = remote.RemoteSettings(writers=2, buffer_rows=1, retries=1, success_codes=(200, 201))
    sink = remote.remote_sink(flaky(str(sent)), settings, remote.dead_letter_folder(dead))
    sink(spark.range(20), 0)
    assert sorted(map(int, sent.read_text().split())) == list(range(0, 20, 2))
    got = spark.read.parquet(dead)
    assert sorted(r.id for r in got.collect()) == list(range(1, 20, 2))
    assert {(r.status, r.attempts) for r in got.collect()} == {(-1, 2)} and "dt" in got.columns


def test_remote_retry_counts(spark, tmp_path):
    settings = remote.RemoteSettings(writers=1, buffer_rows=1, retries=1, success_codes=(200, 201))
    got = remote.send_rows(spark.createDataFrame([(2,), (12,), (3,)], "id int"), flaky(str(tmp_path / "s")), settings)
    assert {r.id: (r.status, r.attempts) for r in got.collect()} == {2: (201, 1), 12: (201, 2), 3: (-1, 2)}


def test_remote_settings():
    block = {"threshold": {"numWriters": 3, "bufferSize": 10, "retries": 3, "successCode": "200,201", "timeout": 100}}
    got = remote.RemoteSettings.of(block)
    assert (got.writers, got.buffer_rows, got.retries, got.success_codes) == (3, 10, 3, (200, 201))
    with pytest.raises(ValueError):
        remote.dead_letter_sink({"storage": "pigeon", "table": "t"})
    assert callable(remote.dead_letter_sink({"storage": "hdfs", "table": "t", "hdfs": {"path": "/x"}}))
    assert callable(remote.dead_letter_sink({"storage": "mysql", "table": "t", "mysql": JDBC}))
    assert callable(remote.dead_letter_sink({"storage": "kafka", "table": "t", "kafka": KAFKA}))


def test_store_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 0), (1, 5, 1), (2, 5, 0)], "orderId bigint, timestamp bigint, seq int")

    def stored(name, make):
        make(batches.batch_folders(str(tmp_path / name)))(df, 0)
        return batches.read_batches(spark, str(tmp_path / name))

    docs = stored("docs", lambda s: stores.document_sink("order_events", ["orderId", "timestamp"], ["seq"], s))
    assert sorted(r.id for r in docs.collect()) == ["1_5", "2_5"]
    made = stored("cells", lambda s: stores.cell_sink(
        F.concat_ws("_", "orderId", "seq"), F.col("timestamp"), "cf", {"oid": cells.encode_long(F.col("orderId"))}, s))
    assert made.count() == 3
    shown = stored("lines", lambda s: stores.time_series_sink("m", ["orderId"], ["seq"], s))
    assert sorted(r.value for r in shown.collect()) == ["m,orderId=1 seq=0", "m,orderId=1 seq=1", "m,orderId=2 seq=0"]
    raw = stored("raw", lambda s: stores.raw_line_sink(s, "orderId"))
    assert raw.count() == 3


def test_to_each(spark, tmp_path):
    both = batches.to_each(batches.batch_folders(f"{tmp_path}/a"), batches.batch_folders(f"{tmp_path}/b"))
    both(spark.range(3), 0)
    assert all(batches.read_batches(spark, f"{tmp_path}/{x}").count() == 3 for x in "ab")


CONFIG = """
app:
  kafka.source: {topic: t, bootstrap.servers: "${TEST_HOST}"}
  influx:
    mydb: {jdbcUrl: "http://a"}
    other: {jdbcUrl: "http://b"}
tables:
  numbers:
    kind: datagen
    end: 20
    computed: {ts: current_timestamp()}
    watermark: {column: ts, delay: 0 seconds}
  kept: {sink: parquet, path: "%s"}
sql:
  copy: |
    -- a comment; with a semicolon
    INSERT INTO kept SELECT f_sequence, f_random_str FROM numbers WHERE f_random_str <> 'a;--b'; -- end
    SELECT count(*) AS n FROM numbers
"""


def test_config(monkeypatch, tmp_path):
    with pytest.raises(KeyError, match="TEST_HOST"):
        config.parse_config(CONFIG)
    monkeypatch.setenv("TEST_HOST", "h:9092")
    (tmp_path / "c.yml").write_text(CONFIG)
    got = config.load_config(str(tmp_path / "c.yml"))
    assert config.block(got, "kafka.source")["bootstrap.servers"] == "h:9092"
    assert config.block(got, "influx", "other") == {"jdbcUrl": "http://b"}
    with pytest.raises(KeyError, match="mydb, other"):
        config.block(got, "influx", "third")


def test_sql_job(spark, monkeypatch, tmp_path):
    monkeypatch.setenv("TEST_HOST", "h")
    cfg = config.parse_config(CONFIG % (tmp_path / "out"))
    wrote, counted = sqljob.run_sql_job(spark, cfg, "copy")
    assert wrote is None and counted.first().n == 20
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20
    with pytest.raises(KeyError, match="known: copy"):
        sqljob.run_sql_job(spark, cfg, "other_job")


def test_sql_job_as_stream(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    cfg = {
        "tables": {
            "src": {"kind": "parquet", "path": str(tmp_path / "in")},
            "dst": {"sink": "parquet", "path": str(tmp_path / "out"), "trigger": "available_now", "checkpoint": f"{tmp_path}/c"},
        },
        "sql": {"job": "INSERT INTO dst SELECT id * 2 AS twice FROM src"},
    }
    (query,) = sqljob.run_sql_job(spark, cfg, "job", stream=True)
    query.awaitTermination()
    assert sorted(r.twice for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(0, 20, 2))


def test_statements():
    assert sqljob.statements("a 'x;--y' ; -- c;\n b;;\n") == ["a 'x;--y'", "b"]


def test_stream_through_view(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "in"))
    stream = readers.parquet_rows(spark, str(tmp_path / "in"))
    assert sqljob.through_view(stream, "bridged").isStreaming


def test_young_users(spark):
    ages = ['"29"', "30", "31", "null", '"8"']
    df = spark.createDataFrame([(f'{{"name":"n{i}","age":{a}}}',) for i, a in enumerate(ages)], "value string")
    assert sorted(r.age for r in etl.young_users(df).collect()) == [8, 29]


def test_console_and_memory_sinks(spark, capsys, monkeypatch, tmp_path):
    writers.write_sink(spark.range(2), {"sink": "memory", "name": "kept_rows"})
    assert spark.table("kept_rows").count() == 2
    spark.range(2).write.parquet(str(tmp_path / "in"))
    stream, log = readers.parquet_rows(spark, str(tmp_path / "in")), str(tmp_path / "log")

    # A task's prints go to the log of its executor, here to a file.
    def to_file(lines, prefix=None):
        with open(log, "a") as out:
            out.writelines(f"{prefix}> {line}\n" for line in lines)

    monkeypatch.setattr(writers, "print_lines", to_file)
    writers.start_sink(stream, {"sink": "console", "prefix": "side:", "trigger": "available_now"}, "shown").awaitTermination()
    assert sorted((tmp_path / "log").read_text().split("\n")) == ["", 'side:> {"id":0}', 'side:> {"id":1}']
    monkeypatch.undo()
    writers.print_lines(iter(["a", "b"]), "side:")
    writers.print_lines(iter(["c"]))
    assert capsys.readouterr().out == "side:> a\nside:> b\nc\n"
    with pytest.raises(ValueError, match="unknown sink"):
        writers.write_sink(spark.range(1), {"sink": "pigeon"})


def test_requests_in_flight_with_deadlines(spark, tmp_path):
    """A slow, a failing and a hanging service: all rows come back once, slow requests overlap, hanging ones end."""

    def mixed():
        def send(buffer):
            first = buffer[0]["id"]
            if first % 10 == 7:
                time.sleep(60)
            if first % 10 == 8:
                raise OSError("lost")
            time.sleep(0.05)
            return 503 if first % 10 == 9 else 200

        return send

    settings = remote.RemoteSettings(writers=1, buffer_rows=1, retries=1, timeout_seconds=0.6, in_flight=20, queued=3, delay_seconds=0.01)
    began = time.time()
    got = remote.send_rows(spark.range(100), mixed, settings).collect()
    assert time.time() - began < 40
    want = {7: (remote.FAILED, 2), 8: (remote.FAILED, 2), 9: (503, 2)}
    assert [(r.id, r.status, r.attempts) for r in got] == [(k, *want.get(k % 10, (200, 1))) for k in sorted(r.id for r in got)] and len(got) == 100
    sink = remote.remote_sink(mixed, settings, remote.dead_letter_sink({"storage": "hbase", "table": "t", "hbase": {"path": str(tmp_path)}}))
    sink(spark.range(20), 0)
    dead = rows.cells_to_map(batches.read_batches(spark, str(tmp_path / "t"))).collect()
    assert sorted((json.loads(r.cells["row"])["id"], int(r.cells["status"])) for r in dead) == [(7, -1), (8, -1), (9, 503), (17, -1), (18, -1), (19, 503)]


def test_bodies():
    buffer = [{"a": 1, "b": "x\ty\nz\\"}, {"a": None, "b": "é"}]
    assert remote.json_lines(buffer).decode().split("\n")[1] == '{"a": null, "b": "é"}'
    assert remote.delimited(["b", "a"])(buffer).decode() == "x\\\ty\\nz\\\\\t1\né\t\\N\n"
    given = remote.RemoteSettings.of({"threshold": {"inFlight": 8, "queueCapacity": 5, "backOff": 3}})
    assert (given.in_flight, given.queued, given.back_off) == (8, 5, 3.0)


def test_split_sinks_compute_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            seen.add(part.num_rows)
            yield part

    df = spark.range(90).withColumn("v", F.when(F.col("id") > 2, F.col("id"))).mapInArrow(counted, "id long, v long")
    sinks = {tag: batches.batch_folders(f"{tmp_path}/{tag}") for tag in ("low", "even", "main")}
    splits.split_sink({"low": F.col("v") < 10, "even": F.col("id") % 2 == 0}, sinks, str(tmp_path / "work"))(df, 0)
    got = {tag: sorted(r.id for r in batches.read_batches(spark, f"{tmp_path}/{tag}").collect()) for tag in sinks}
    assert got["low"] == list(range(3, 10)) and got["even"] == [0, 2, *range(10, 90, 2)] and got["main"] == [1, *range(11, 90, 2)]
    assert seen.value == 90 and not list((tmp_path / "work").glob("split-*"))


def test_upserts_over_batches(spark, tmp_path):
    """Ids over several batches, one batch cut off and two repeated; replaced folders go, NULL ids are one id."""
    table, want, rng = upserts.UpsertTable(str(tmp_path / "t"), ["k"], ["n"], buckets=4), {}, random.Random(6)
    assert table.read(spark) is None
    for batch_id in range(6):
        rows = [(rng.choice(["a", "b", "c", "d", None]), rng.randrange(9), f"{batch_id}-{k}") for k in range(rng.randrange(4))]
        df = spark.createDataFrame(rows, "k string, n int, v string")
        if batch_id == 3:
            with pytest.raises(Exception):
                table.write(df.withColumn("v", F.raise_error(F.lit("lost"))), batch_id)
            assert {r.k: r.v for r in table.read(spark).collect()} == want
        table.write(df, batch_id)
        if batch_id % 2:
            table.write(df, batch_id)
        for k in {r[0] for r in rows}:
            want[k] = max((n, v) for key, n, v in rows if key == k)[1]
        got = table.read(spark)
        assert got is None and not want or {r.k: r.v for r in got.collect()} == want and got.count() == len(want)
    assert len(list((tmp_path / "t" / "manifests").iterdir())) <= 2
    live = {r.written for r in spark.read.parquet(str(tmp_path / "t" / "manifests" / "batch=5")).where("bucket >= 0").collect()}
    held = {int(p.parent.name.split("=")[1]) for p in (tmp_path / "t" / "rows").glob("batch=*/bucket=*")}
    assert live <= held and len(held - live) <= 2
    with pytest.raises(ValueError, match="follow one another"):
        table.write(spark.createDataFrame([("a", 1, "x")], "k string, n int, v string"), 9)
    with pytest.raises(ValueError, match="4 buckets"):
        upserts.UpsertTable(str(tmp_path / "t"), ["k"], ["n"], buckets=8).read(spark)


def test_polled_table(spark, tmp_path):
    """Polls of a growing folder, each started anew: late rows on the mark are lost when strict and taken once when inclusive."""
    turns = [[(1, 5, "a"), (2, 6, "b"), (3, 7, "c")], [(4, 7, "d"), (5, 9, "e")], [], [(6, 9, "f"), (7, 9, None), (8, None, "x"), (9, 12, "z")]]
    for inclusive, want in ((False, [2, 3, 5, 9]), (True, [1, 2, 3, 4, 5, 6, 7, 9])):
        at = f"{tmp_path}/{inclusive}"
        for rows in turns:
            if rows:
                spark.createDataFrame(rows, "id int, m int, s string").coalesce(1).write.mode("append").parquet(f"{at}/in")
            stream = polled.polled(spark, f"{at}/in", "s string, id int", "m", "5", inclusive, ("id",))
            start_batches(stream, batches.batch_folders(f"{at}/out"), at, "polled").awaitTermination()
        got = batches.read_batches(spark, f"{at}/out")
        assert sorted(r.id for r in got.collect()) == want and got.columns == ["s", "id"]
    with pytest.raises(Exception, match="ids"):
        stream = polled.polled(spark, f"{at}/in", "id int", "m", "5", True)
        start_batches(stream, batches.batch_folders(f"{at}/no"), f"{at}/no", "refused").awaitTermination()


def test_polls_read_only_row_groups_past_the_mark(spark, tmp_path):
    spark.range(100_000).repartitionByRange(4, "id").write.option("parquet.block.size", 20_000).parquet(str(tmp_path / "t"))
    reader = polled.PolledReader({"path": str(tmp_path / "t"), "column": "id", "first": "-1"}, ["id"])
    end = reader.latestOffset()
    assert end == {"mark": 99_999, "ids": None}
    every, some = reader.partitions(reader.initialOffset(), end), reader.partitions({"mark": 74_000, "ids": None}, end)
    assert len({p.path for p in every}) == 4 and len({p.path for p in some}) <= 2
    assert sum(b.num_rows for p in some for b in reader.read(p)) == 99_999 - 74_000
    assert reader.partitions(end, end) == []


class NamedSession:
    """The part of a session that names the shared folder and the master."""

    def __init__(self, folder=None, master="spark://x"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master


def test_shared_dir(spark):
    assert session.shared_dir(NamedSession("hdfs://x/named/")) == "hdfs://x/named"
    assert session.scratch(NamedSession("hdfs://x/named/"), "a").startswith("hdfs://x/named/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(NamedSession())
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_one_device_is_read_by_the_stored_count(spark, tmp_path):
    from dripline import schemas

    names = [*schemas.PUMP_VALUES, *schemas.PUMP_TAGS]
    records = spark.range(40).select(
        F.concat(F.lit("pump_"), F.col("id") % 20).alias("tableName"), *(F.col("id").cast("string").alias(n) for n in names)
    )
    path = f"{tmp_path}/pumps"
    subtables.write_subtables(records, path, 0, buckets=32)
    assert all(subtables.read_subtable(spark, path, f"pump_{k}").count() == 2 for k in range(20))
    with pytest.raises(ValueError, match="32 hash folders"):
        subtables.write_subtables(records, path, 1, buckets=8)


def test_whole_numbers_beside_nulls_stay_whole(spark):
    rows = spark.createDataFrame([(2**53 + 1,), (None,)], "n bigint")
    settings = remote.RemoteSettings.of({"threshold": {"retries": 0, "successCode": "404"}})
    sent = remote.send_rows(rows, lambda: lambda buffer: 500 if buffer[0]["n"] == 2**53 + 1 else 404, settings)
    got = {r.n: (r.status, r.attempts) for r in sent.collect()}
    assert got == {2**53 + 1: (500, 1), None: (404, 1)}
