"""Keyed operators against plain Python, with busy keys cut into many chunks and not."""

import random

import pytest
from pyspark.sql import functions as F

from dripline.operators import keyed, skew

FLOORS = [1, 3, 10, 1_000_000]


def made_rows(seed: int, count: int = 400):
    """Rows (key, seq, ts): one key holds a third, times jump back, stand still and go missing."""
    rng = random.Random(seed)
    rows, clock = [], dict.fromkeys(["hot", "a", "b", "c", None], 1_685_417_984_666)
    for seq in range(count):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        clock[key] += rng.choice([0, 1_000, 59_999, 60_000, 60_001, 60_001, 200_000, -30_000, -90_000])
        rows.append((key, seq, None if rng.random() < 0.03 else clock[key]))
    return rows


def expected_sessions(rows, gap=60_000):
    last, start, out = {}, {}, {}
    for key, seq, ts in rows:
        ts = ts or 0
        if key not in last or ts - last[key] > gap:
            start[key] = ts
        last[key] = ts
        out[seq] = start[key]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, seq bigint, ts bigint").repartition(5)


@pytest.mark.parametrize("floor", FLOORS)
@pytest.mark.parametrize("seed", [1, 2])
def test_sessions(spark, seed, floor):
    rows = made_rows(seed)
    got = keyed.session_start(frame(spark, rows), ["key"], ["seq"], F.col("ts"), floor_rows=floor)
    assert got.columns == ["key", "seq", "ts", "session_start_ms"]
    assert {r.seq: r.session_start_ms for r in got.collect()} == expected_sessions(rows)


@pytest.mark.parametrize("step,sessions", [(59_999, 1), (60_000, 1), (60_001, 2)])
def test_gap_bound_is_strict(spark, step, sessions):
    df = frame(spark, [("d", 0, 5_000), ("d", 1, 5_000 + step)])
    got = keyed.session_start(df, ["key"], ["seq"], F.col("ts"))
    assert got.select("session_start_ms").distinct().count() == sessions


def test_late_row_moves_the_last_time_back(spark):
    df = frame(spark, [("d", 0, 100_000), ("d", 1, 10_000), ("d", 2, 71_000)])
    got = keyed.session_start(df, ["key"], ["seq"], F.col("ts"))
    assert [r.session_start_ms for r in got.orderBy("seq").collect()] == [100_000, 100_000, 71_000]


@pytest.mark.parametrize("floor", FLOORS)
def test_summary(spark, floor):
    rows = [(k, s, t) for k, s, t in made_rows(3) if t is not None]
    got = keyed.session_summary(frame(spark, rows), ["key"], F.col("ts"), floor_rows=floor)
    in_time = sorted(rows, key=lambda r: r[2])
    want = {}
    stamped = expected_sessions([(k, i, t) for i, (k, _, t) in enumerate(in_time)])
    for i, (k, _, t) in enumerate(in_time):
        end, n = want.get((k, stamped[i]), (0, 0))
        want[(k, stamped[i])] = (max(end, t), n + 1)
    assert {(r.key, r.session_start_ms): (r.session_end_ms, r.row_count) for r in got.collect()} == want


@pytest.mark.parametrize("floor", FLOORS)
def test_running_values(spark, floor):
    rows = made_rows(4)
    df = frame(spark, rows)
    totals = {r.seq: r.total for r in keyed.running_total(df, ["key"], ["seq"], floor_rows=floor).collect()}
    sums = keyed.running_total(df, ["key"], ["seq"], F.col("ts") % 1000, floor_rows=floor)
    sums = {r.seq: r.total for r in sums.collect()}
    late = keyed.late_rows(df, ["key"], ["seq"], F.col("ts"), floor_rows=floor)
    late = {r.seq: r.is_late for r in late.collect()}
    count, total, top = {}, {}, {}
    for key, seq, ts in rows:
        count[key] = count.get(key, 0) + 1
        assert totals[seq] == count[key]
        if ts is not None:
            total[key] = total.get(key, 0) + ts % 1000
            top[key] = max(top.get(key, ts), ts)
        assert sums[seq] == total.get(key)
        assert late[seq] == (None if ts is None else ts < top[key] - 1000)


def test_empty_input(spark):
    df = frame(spark, made_rows(1)).filter("seq < 0")
    assert keyed.session_start(df, ["key"], ["seq"], F.col("ts")).count() == 0
    assert keyed.running_total(df, ["key"], ["seq"]).count() == 0


def test_chunks_are_bounded_and_ordered(spark):
    rows = [("hot", i, 0) for i in range(5_000)] + [(f"k{i}", i, 0) for i in range(100)]
    got, of_busy = skew.with_chunks(frame(spark, rows), ["key"], ["seq"], floor_rows=100)
    assert of_busy.count() == 5_000
    chunks = got.groupBy("key", "_chunk").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    chunks = chunks.orderBy("key", "_chunk").collect()
    hot = [c for c in chunks if c.key == "hot"]
    assert len(hot) >= 50 and max(c.n for c in hot) <= 101
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert all(c["_chunk"] == 0 for c in chunks if c.key != "hot")


def test_one_shuffle_of_the_rows(spark, tmp_path):
    """Only the final window moves whole rows; all else is per key or per chunk."""
    path = str(tmp_path / "rows")
    frame(spark, made_rows(1)).withColumn("payload", F.lit("x")).write.parquet(path)
    got = keyed.session_start(spark.read.parquet(path), ["key"], ["seq"], F.col("ts"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert sum("_chunk" in line for line in shuffles) == 2
    assert plan.count("payload") > 0 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_word_totals(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("",)], "word string")
    assert {(r.word, r.total) for r in keyed.word_totals(df, "word").collect()} == {("a", 2), ("b", 1), ("", 1)}


def bursts(name):
    """Positions of one busy key, in seven ways that leave equal shares of the range too full."""
    rng = random.Random(8)
    return {
        "one far out": [*range(4_000), 10_000_000],
        "geometric": [int(1.01**k) for k in range(4_000)],
        "one position": [7] * 4_000,
        "half on one": [7] * 2_000 + [rng.randrange(10**6) for _ in range(2_000)],
        "nulls": [None] * 1_500 + [7] * 1_500 + list(range(1_000)),
        "two bursts": [rng.randrange(300) + 10**12 * (k % 2) for k in range(4_000)],
        "large": [2**60 + 300 * k for k in range(4_000)],
    }[name]


@pytest.mark.parametrize("name", ["one far out", "geometric", "one position", "half on one", "nulls", "two bursts", "large"])
def test_bursts_are_cut_at_quantiles(spark, name):
    """No chunk of a busy key above twice its share, in order, and the same sessions as in one window."""
    rows = [("hot", p, k * 1000 % 977_000, k) for k, p in enumerate(bursts(name))] + [("k", 5, 0, 0)]
    df = spark.createDataFrame(rows, "key string, seq long, ts long, id long")
    order = ["seq", "id"]
    chunks, of_busy = skew.with_chunks(df, ["key"], order, floor_rows=100)
    assert of_busy.count() == len(rows) - 1
    at = F.struct(*order)
    hot = chunks.where("key = 'hot'").groupBy("_chunk").agg(F.count("*").alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
    hot = hot.orderBy("_chunk").collect()
    first = lambda s: (s.seq is not None, s.seq or 0, s.id)
    assert max(c.n for c in hot) <= 200 and all(first(a.hi) < first(b.lo) for a, b in zip(hot, hot[1:]))
    got = keyed.session_start(df, ["key"], order, F.col("ts"), floor_rows=100).collect()
    want = keyed.session_start(df, ["key"], order, F.col("ts"), floor_rows=1_000_000).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_rows_without_an_order_are_still_cut(spark):
    rows = [("hot", 1, k) for k in range(3_000)]
    got, _ = skew.with_chunks(frame(spark, rows), ["key"], ["seq"], floor_rows=100)
    assert got.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 200
    total = keyed.running_total(frame(spark, rows), ["key"], ["seq"], floor_rows=100).collect()
    assert sorted(r.total for r in total) == list(range(1, 3_001))


def test_summary_of_copies(spark):
    """A third of all rows share one key and time."""
    rows = [("hot", i, 7_000) for i in range(500)] + [("hot", 900 + i, i * 200_000) for i in range(1000)]
    got = keyed.session_summary(frame(spark, rows), ["key"], F.col("ts"), floor_rows=50).collect()
    assert len(got) == 1000 and {r.session_start_ms: r.row_count for r in got}[0] == 501
    assert sum(r.row_count for r in got) == 1500
