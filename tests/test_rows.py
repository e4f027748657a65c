"""Row operators at their edges."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from dripline import schemas
from dripline.functions import cells, text, times
from dripline.operators import rows, split

# A whole pump message.
PUMP = (
    '{"host":"127.0.0.1","port":10003,"code":-1,"header":{},"data":{"factoryNum":"icu-pump-30-1001",'
    '"equType":"0x00","equNum":"icu-pump-30-equ-1001","workSta":"work-sta-1001","deptName":"病房 2",'
    '"roomNo":"ICU-601","bedNo":"601-01","state":"0x02","drugName":"生理盐水","injectMode":"0x02",'
    '"presetValue":12.345,"speed":6.04,"alreadyInjectTime":65,"remainTime":35,"alreadyInjectValue":10.001,'
    '"residual":2,"alarm1":"00000000000000000000000000000001","alarm2":"00000000000000000000000000000010",'
    '"alarm3":"00000000000000000000000000000011","alarm4":"00000000000000000000000000000100",'
    '"pressureValue":30.01,"pressureUint":"0x03"},"ts":1685417984666}'
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_json_takes_quoted_numbers(spark):
    df = lines(spark, '{"name":"x","age":"28"}', '{"age":28}', '{"age":null}', "{}")
    got = rows.parse_json(df, schemas.USER).collect()
    assert [r.age for r in got] == [28, 28, None, None]
    assert got[0].name == "x" and rows.parse_json(df, schemas.USER).dtypes[1] == ("age", "int")


@pytest.mark.parametrize("bad", ["nope", '{"age":2', '{"age":"z"}'])
def test_parse_json_strict_and_tolerant(spark, bad):
    df = lines(spark, bad)
    with pytest.raises(Exception):
        rows.parse_json(df, schemas.USER).collect()
    assert rows.parse_json(df, schemas.USER, strict=False).first().age is None


def test_flatten_pump(spark):
    got = rows.flatten_pump(rows.with_pump(lines(spark, PUMP)), strict=True)
    assert got.columns == ["tableName", *schemas.PUMP_TAGS, *schemas.PUMP_VALUES]
    row = got.first()
    assert row.tableName == "hp_icu_pump_30_1001"
    assert (row.host, row.port, row.ts) == ("127.0.0.1", 10003, 1685417984666)
    assert row.residual == 2.0 and row.remainTime == 35 and row.drugName == "生理盐水"


def test_flatten_pump_needs_a_serial_number(spark):
    df = rows.with_pump(lines(spark, '{"data":{"state":"0x02"},"ts":1}'))
    assert rows.flatten_pump(df).first().tableName is None
    with pytest.raises(Exception, match="factoryNum"):
        rows.flatten_pump(df, strict=True).collect()


def test_state_filter_never_fails(spark):
    df = lines(spark, PUMP, PUMP[:200], "x", "", None, "{}", '{"data":{"state":" "}}', '{"data":{"state":"0x01"}}',
               '{"data":{}}', '{"data":{"state":"0x02"}}')
    assert rows.in_state(rows.with_pump(df)).count() == 2


def test_blank(spark):
    df = lines(spark, "", "  ", "\t\n\r", "　", " ", " ", "x", None)
    assert [r.value for r in rows.drop_blank(df).collect()] == [" ", "x"]


SPLITS = {
    "a,b,a": ["a", "b", "a"],
    "a,,b": ["a", "", "b"],
    "a,b,,": ["a", "b"],
    ",a": ["", "a"],
    "": [""],
    ",,": [],
    "a,b,,\n": ["a", "b", "", "\n"],
}


@pytest.mark.parametrize("line,want", SPLITS.items())
def test_parts(spark, line, want):
    df = lines(spark, line)
    assert [r.word for r in rows.explode_parts(df).collect()] == want
    row = rows.head_and_last(df).first()
    assert (row.id, row.name) == ((want[0], want[-1]) if want else (None, None))


def test_other_delimiters(spark):
    for d in "|.^]-\\":
        assert lines(spark, f"a{d}b{d}").select(text.parts(F.col("value"), d).alias("p")).first().p == ["a", "b"]


def test_unpivot(spark):
    df = spark.createDataFrame([("d", None, "", " ", "0" * 32), ("e", "x", None, None, None)],
                               "k string, a string, b string, c string, d string")
    got = rows.unpivot_ordinal(df, ["a", "b", "c", "d"], ["k"]).collect()
    assert [tuple(r) for r in got] == [("d", 4, "0" * 32), ("e", 1, "x")]


def test_time_text(spark):
    df = spark.createDataFrame([(1685417987352,), (0,)], "ts bigint")
    got = df.select(times.time_text(F.col("ts")).alias("s"), times.time_text(F.col("ts"), times.HOUR_BUCKET).alias("b"))
    assert [tuple(r) for r in got.collect()] == [("20230530033947", "20230530/03"), ("19700101000000", "19700101/00")]


def test_json_text(spark):
    df = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    assert rows.to_json_text(df).first().value == '{"a":1,"c":"é"}'
    assert rows.to_json_text(df, ["c", "b"], keep_nulls=True).first().value == '{"c":"é","b":null}'


def test_braced_text(spark):
    df = spark.createDataFrame([("7", 3, None)], "user_id string, item_id bigint, behavior string")
    shown = df.select(text.braced_text({c: F.col(c) for c in df.columns}).alias("v")).first().v
    assert shown == "\n{\nuser_id:7,\nitem_id:3,\nbehavior:null\n}\n"


def test_time_series_lines(spark):
    df = spark.createDataFrame(
        [(11, -4, "北", 1000), (1, 2, "a b,c=d", 5), (None, 3, "", 1), (None, None, "上", 2)],
        "temperature bigint, humidity bigint, area string, altitude bigint",
    )
    got = rows.time_series_lines(df, "weather", ["altitude", "area"], ["temperature", "humidity"])
    assert [r.value for r in got.collect()] == [
        "weather,altitude=1000,area=北 humidity=-4,temperature=11",
        "weather,altitude=5,area=a\\ b\\,c\\=d humidity=2,temperature=1",
        "weather,altitude=1 humidity=3",
    ]


def test_text_field(spark):
    df = spark.createDataFrame([('a"b\\c',)], "note string")
    assert rows.time_series_lines(df, "m", [], ["note"]).first().value == 'm note="a\\"b\\\\c"'


def doubles():
    rng = random.Random(5)
    fixed = [0.0, -0.0, 1.0, -1.5, 0.1, 1 / 3, 1e300, -2.5e-300, 5e-324, 2.2250738585072014e-308,
             1.7976931348623157e308, 7.999999999999999, 8.0, math.inf, -math.inf, math.nan]
    return fixed + [math.ldexp(rng.uniform(-1, 1), rng.randint(-1000, 1000)) for _ in range(500)]


def test_double_cells(spark):
    df = spark.createDataFrame([(d, bytearray(struct.pack(">d", d))) for d in doubles()], "d double, b binary")
    got = df.select("b", cells.decode_double(F.col("b")).alias("back"), cells.encode_double(F.col("d")).alias("e"))
    for row in got.collect():
        assert struct.pack(">d", row.back) == bytes(row.b)
        assert bytes(row.e) == bytes(row.b)


def test_float_and_whole_number_cells(spark):
    floats = [struct.unpack(">f", struct.pack(">f", f))[0] for f in (0.0, -1.5, 0.1, 1e-45, 3.4e38, math.inf)]
    df = spark.createDataFrame([(bytearray(struct.pack(">f", f)), f) for f in floats], "b binary, f double")
    for row in df.select("f", cells.decode_float(F.col("b")).cast("double").alias("x")).collect():
        assert row.x == row.f
    whole = [0, 1, -1, 2**31 - 1, -(2**31)]
    df = spark.createDataFrame(
        [(i, bytearray(struct.pack(">i", i)), i * 2**32 + 7, bytearray(struct.pack(">q", i * 2**32 + 7))) for i in whole],
        "i int, b binary, l bigint, c binary",
    )
    got = df.select(
        "*", cells.decode_int(F.col("b")).alias("i2"), cells.decode_long(F.col("c")).alias("l2"),
        cells.encode_int(F.col("i")).alias("b2"), cells.encode_long(F.col("l")).alias("c2"),
    )
    for r in got.collect():
        assert (r.i2, r.l2, r.b2, r.c2) == (r.i, r.l, r.b, r.c)


def cell_rows(spark, *rows_):
    return spark.createDataFrame([(k, "cf", q, bytearray(v), t) for k, q, v, t in rows_], schemas.CELLS)


def test_cells_to_map(spark):
    df = cell_rows(
        spark,
        ("r", "i_age", struct.pack(">i", -5), 1),
        ("r", "s_name", b"old", 1),
        ("r", "s_name", "né".encode(), 2),
        ("r", "d_w", struct.pack(">d", 2.5), 1),
        ("r", "f_h", struct.pack(">f", 1.5), 1),
        ("r", "i_both", struct.pack(">i", 9), 5),
        ("r", "s_both", b"later name wins", 1),
        ("q", "i_age", struct.pack(">i", 7), 1),
    )
    got = {r.row_key: r.cells for r in rows.cells_to_map(df).collect()}
    assert got == {
        "r": {"age": "-5", "name": "né", "w": "2.5", "h": "1.5", "both": "later name wins"},
        "q": {"age": "7"},
    }


@pytest.mark.parametrize("qualifier", ["x_age", "age", "i_a_b", "i_"])
def test_unknown_cells(spark, qualifier):
    df = cell_rows(spark, ("r", qualifier, b"abcd", 1), ("r", "s_ok", b"v", 1))
    with pytest.raises(Exception, match="cannot read cell"):
        rows.cells_to_map(df).collect()
    assert rows.cells_to_map(df, strict=False).first().cells == {"ok": "v"}


def test_row_to_cells_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1, None, 5)], "id bigint, a int, ts bigint")
    got = rows.row_to_cells(df, F.col("id"), F.col("ts"), "cf",
                            {"id": cells.encode_long(F.col("id")), "a": cells.encode_int(F.col("a"))})
    assert [(r.row_key, r.qualifier, r.cell_ts) for r in got.collect()] == [("1", "id", 5)]
    assert {n: t for n, t in got.dtypes} == {f.name: f.dataType.simpleString() for f in schemas.CELLS}


def test_documents_last_write_wins(spark):
    df = spark.createDataFrame([(1, 10, 0, "a"), (1, 10, 1, "b"), (2, 10, 0, "c"), (None, 1, 5, "d")],
                               "orderId bigint, timestamp bigint, seq int, note string")
    docs = rows.documents(df, "order_events", ["orderId", "timestamp"], ["seq"])
    got = {r.id: r.body for r in rows.latest_documents(docs, ["seq"]).collect()}
    assert got["1_10"] == '{"orderId":1,"timestamp":10,"seq":1,"note":"b"}' and "2_10" in got


def test_transient_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rows.drop_transient(rows.mark_transient(df, "a", "c")).columns == ["b"]
    assert rows.drop_transient(df, ["b"]).columns == ["a", "c"]
    assert rows.drop_transient(df).columns == ["a", "b", "c"]


def test_split_puts_each_row_in_one_part(spark):
    df = spark.createDataFrame([(99,), (100,), (None,), (5,)], "userId bigint")
    parts = split.split_by(df, {"small": F.col("userId") < 100, "tiny": F.col("userId") < 10})
    got = {k: sorted(str(r.userId) for r in v.collect()) for k, v in parts.items()}
    assert got == {"small": ["5", "99"], "tiny": [], "main": ["100", "None"]}


def test_dead_letters(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    good, dead = split.dead_letters(df, F.col("x") > 0)
    assert [r.x for r in good.collect()] == [1] and {r.x for r in dead.collect()} == {-1, None}


def test_each_line_is_parsed_once(spark):
    df = rows.in_state(rows.with_pump(rows.drop_blank(lines(spark, PUMP))))
    plan = rows.flatten_pump(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
