"""Lookups against plain Python, with broadcast and with busy keys spread."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from dripline import schemas
from dripline.operators import lookup


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def asked(spark, count=600):
    rng = random.Random(7)
    ids = ["hot"] * (count // 3) + [None] * (count // 6)
    ids += [str(rng.randrange(60)) for _ in range(count - len(ids))]
    return [(i, k) for i, k in enumerate(ids)]


def person(spark):
    known = ["hot", "1", "1", "2", "33", None, "unused"]
    return spark.createDataFrame([(k,) for k in known], "row_key string")


def check_exists(spark, floor):
    rows = asked(spark)
    df = spark.createDataFrame(rows, "seq int, id string")
    got = lookup.lookup_exists(df, person(spark), "id", "row_key", ["seq"], floor_rows=floor)
    assert got.columns == ["seq", "id", "found"]
    want = {(s, k): k in ("hot", "1", "2", "33") for s, k in rows}
    found = got.collect()
    assert len(found) == len(rows) and {(r.seq, r.id): r.found for r in found} == want


def test_exists_broadcast(spark):
    check_exists(spark, 1000)


@pytest.mark.parametrize("floor", [1, 10, 1000])
def test_exists_spread(spark, no_broadcast, floor):
    check_exists(spark, floor)


def test_busy_keys_go_to_many_tasks(spark, no_broadcast, tmp_path):
    df = spark.createDataFrame([(i, "hot") for i in range(4000)], "seq int, id string")
    df.write.parquet(str(tmp_path / "asked"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = spark.read.parquet(str(tmp_path / "asked"))
        got = lookup.lookup_exists(read, person(spark), "id", "row_key", ["seq"], floor_rows=100)
        per_task = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(per_task) == 4 and max(r["count"] for r in per_task) < 2000


@pytest.mark.parametrize("floor", [5, 1000])
def test_row(spark, no_broadcast, floor):
    cells = spark.createDataFrame(
        [("hot", "cf", "i_age", bytearray(struct.pack(">i", 5)), 1), ("1", "cf", "s_name", bytearray(b"n"), 1)],
        schemas.CELLS,
    )
    rows = asked(spark)
    df = spark.createDataFrame(rows, "seq int, id string")
    got = lookup.lookup_row(df, cells, "id", ["seq"], floor_rows=floor).collect()
    want = {"hot": {"age": "5"}, "1": {"name": "n"}}
    assert len(got) == len(rows) and all(r.cells == want.get(r.id, {}) for r in got)


def test_stream_lookup(spark, tmp_path):
    spark.createDataFrame([(0, "hot"), (1, "9")], "seq int, id string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("seq int, id string").parquet(str(tmp_path / "in"))
    found = lookup.lookup_exists(stream, person(spark), "id", "row_key")
    q = found.writeStream.format("memory").queryName("looked_up").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.id, r.found) for r in spark.table("looked_up").collect()} == {("hot", True), ("9", False)}
