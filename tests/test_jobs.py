"""Jobs started from settings, with files in place of message logs and stores."""

import json
import struct
from pathlib import Path

import pytest

from dripline import config, schemas
from dripline.plans import jobs
from dripline.sinks import batches, files, subtables
from test_rows import PUMP

ORDERS = [
    {"userId": u, "orderId": o, "siteId": 3, "cityId": 1, "orderStatus": 0, "price": 0.5, "quantity": 4, "timestamp": t}
    for u, o, t in [(99, 1, 10), (100, 1, 10), (5, 2, 11)]
]


@pytest.fixture
def run(spark, tmp_path):
    """Run a job over the given lines to its end; gives what its sink holds."""

    def go(name, lines, **settings):
        spark.createDataFrame(
            [(line, n) for n, line in enumerate(lines)], "value string, offset bigint"
        ).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        made = {
            "source": {"kind": "parquet", "path": str(tmp_path / "in")},
            "sink": {"kind": "folders", "path": str(tmp_path / "out")},
            "folder": str(tmp_path / "job"),
            **settings,
        }
        jobs.start_job(spark, {"jobs": {name: made}}, name).awaitTermination()
        return lambda: batches.read_batches(spark, str(tmp_path / "out")).collect()

    return go


def test_archive_lines(spark, run, tmp_path):
    run("archive_lines", [PUMP, ""], path=str(tmp_path / "archive"))
    got = files.read_hour_buckets(spark, str(tmp_path / "archive")).collect()
    assert {(r.dt, r.hr) for r in got} == {("20230530", "03"), ("19700101", "00")}


def test_pump_alarms(run):
    assert sorted(r.alarmType for r in run("pump_alarms", [PUMP, " "])()) == [1, 2, 3, 4]


def test_pump_subtables(spark, run, tmp_path):
    idle = PUMP.replace('"state":"0x02"', '"state":"0x01"')
    run("pump_subtables", [PUMP, idle, "bad"], sink={"kind": "subtables", "path": str(tmp_path / "t"), "buckets": 4})
    assert [r.tableName for r in subtables.read_supertable(spark, str(tmp_path / "t")).collect()] == ["hp_icu_pump_30_1001"]


def test_word_counts(run):
    assert {(r.word, r.total) for r in run("word_count", ["a,b,a", ""])()} == {("a", 2), ("b", 1), ("", 1)}


def test_running_word_count(run):
    got = run("running_word_count", ["a,b,a", "a"])()
    assert sorted((r.word, r.total) for r in got) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]


def test_young_users(run):
    lines = ['{"name":"x","age":"28","gender":1}', '{"name":"y","age":30}']
    assert [tuple(r) for r in run("young_users", lines)()] == [("x", 28)]


def test_numbers_to_table(run):
    assert sorted(r.id for r in run("numbers_to_table", ["1", "22"])()) == [1, 22]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run("numbers_to_table", ["x"])


def test_behaviors(run):
    line = '{"user_id":"7","item_id":1,"category_id":"2","behavior":"buy","ts":5}'
    want = {"user_id": "7", "item_id": 1, "category_id": 2, "behavior": "buy", "ts": 5}
    assert json.loads(run("behaviors", [line])()[0].value) == want


def test_braced_behaviors(run):
    line = '{"user_id":"7","item_id":1,"category_id":"2","behavior":"buy","ts":5}'
    assert run("behaviors", [line], form="braced")()[0].value.startswith("\n{\nuser_id:7,\n")


@pytest.mark.parametrize("name,check", [
    ("order_rows", lambda rows: {(r.userId, r.siteId) for r in rows} == {(99, 3), (100, 3), (5, 3)}),
    ("order_documents", lambda rows: {(r.id, json.loads(r.body)["userId"]) for r in rows} == {("1_10", 100), ("2_11", 5)}),
    ("order_cells", lambda rows: len(rows) == 15 and len({r.row_key for r in rows}) == 3
        and {bytes(r.value) for r in rows if r.qualifier == "oq"} == {struct.pack(">i", 4)}),
    ("raw_lines", lambda rows: len(rows) == 3),
    ("print_lines", lambda rows: len(rows) == 3),
])
def test_order_jobs(run, name, check):
    assert check(run(name, [json.dumps(o) for o in ORDERS])())


def test_user_urls(run):
    got = run("user_urls", [json.dumps(o) for o in ORDERS], base_url="http://example.com")()
    assert "http://example.com?id=99" in {r.url for r in got}


def test_weather_lines(run):
    got = run("weather_lines", ['{"temperature":11,"humidity":4,"area":"北","altitude":1000}'], measurement="weather")()
    assert got[0].value == "weather,altitude=1000,area=北 humidity=4,temperature=11"


def test_side_output(spark, run, tmp_path):
    side = {"kind": "folders", "path": str(tmp_path / "side")}
    main = run("side_output", [json.dumps(o) for o in ORDERS], side_sink=side)()
    assert [r.userId for r in main] == [100]
    assert {r.userId for r in batches.read_batches(spark, str(tmp_path / "side")).collect()} == {5, 99}


def test_lookups(spark, run, tmp_path):
    table = str(tmp_path / "person")
    spark.createDataFrame([("1111", "cf", "s_n", bytearray(b"x"), 1)], schemas.CELLS).write.parquet(table)
    got = run("known_ids", ["123456", "1111"], table=table)()
    assert {(r.value, r.found) for r in got} == {("123456", False), ("1111", True)}


def test_row_lookups(spark, run, tmp_path):
    table = str(tmp_path / "person")
    spark.createDataFrame([("1111", "cf", "s_n", bytearray(b"x"), 1)], schemas.CELLS).write.parquet(table)
    got = run("known_rows", ["123456", "1111"], table=table)()
    assert {r.value: r.cells for r in got} == {"123456": {}, "1111": {"n": "x"}}


def test_scan_table(spark, tmp_path):
    table = str(tmp_path / "person")
    spark.createDataFrame([("1111", "cf", "s_n", bytearray(b"x"), 1)], schemas.CELLS).write.parquet(table)
    made = {"table": table, "folder": str(tmp_path / "job"), "trigger": "200 milliseconds",
            "sink": {"kind": "folders", "path": str(tmp_path / "out")}}
    seen = []
    q = jobs.start_job(spark, {"jobs": {"scan_table": made}}, "scan_table", hook=lambda s, settings: seen.append(settings))
    try:
        while len(list(tmp_path.glob("out/batch_id=*/_SUCCESS"))) < 2:
            assert q.isActive
            q.awaitTermination(0.2)
    finally:
        q.stop()
    assert seen[0]["table"] == table
    got = batches.read_batches(spark, str(tmp_path / "out"))
    assert {tuple(r.cells.items()) for r in got.collect()} == {(("n", "x"),)} and got.count() >= 2


def test_example_settings(spark, monkeypatch):
    for name in ("KAFKA_SERVERS", "JDBC_URL", "JDBC_USER", "JDBC_PASSWORD", "SHARED"):
        monkeypatch.setenv(name, "x")
    got = config.load_config(str(Path(__file__).parents[1] / "conf" / "application.yml"))
    for name in got["jobs"]:
        made = jobs.Job(spark, got, name)
        assert made.kind in jobs.JOBS
        if "sink" in made.settings:
            assert callable(made.sink())


def test_unknown_jobs(spark):
    with pytest.raises(KeyError, match="known: a"):
        jobs.start_job(spark, {"jobs": {"a": {}}}, "b")
    with pytest.raises(KeyError, match="archive_lines"):
        jobs.start_job(spark, {"jobs": {"a": {}}}, "a")
