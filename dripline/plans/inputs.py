"""Reference inputs made by Spark from the given tables: pump lines, cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dripline.functions import cells, messages, times
from dripline.functions.once import with_once
from dripline.operators import rows
from dripline.plans.registry import Tables

SIX_HOURS_MS = 6 * 3600 * 1000
BLANK_BELOW, CUT_BELOW = 2, 4


def timed_events(t: Tables) -> DataFrame:
    return t.events.withColumn("ms", times.as_epoch_ms(F.col("ts")))


def pump_lines(t: Tables) -> DataFrame:
    """One pump message line per event, beside its arrival number.

    The device is the user, errors are the infusing state. Events of the smallest values
    come as blank lines, those of slightly larger ones as lines cut short.
    """
    e = timed_events(t)
    is_error = F.col("event_type") == "error"
    data = F.struct(
        F.concat(F.lit("icu-pump-"), F.col("user_id")).alias("factoryNum"),
        F.lit("0x00").alias("equType"),
        F.concat(F.lit("equ-"), F.col("user_id")).alias("equNum"),
        F.lit("ICU").alias("deptName"),
        F.when(is_error, "0x02").otherwise("0x01").alias("state"),
        F.col("event_type").alias("injectMode"),
        F.col("value").alias("presetValue"),
        (F.col("event_id") % 100).cast("string").alias("remainTime"),
        F.when(is_error, F.col("props")).otherwise("").alias("alarm1"),
        F.when(F.col("value") > 100, F.col("event_id").cast("string")).alias("alarm2"),
        F.when(F.col("value") < 10, "  ").otherwise(F.col("event_type")).alias("alarm3"),
    )
    line = messages.json_text(
        host=F.lit("127.0.0.1"), port=F.lit(10003), code=F.lit(-1), data=data, ts=F.col("ms")
    )
    value = (
        F.when(F.col("value") < BLANK_BELOW, F.lit("  "))
        .when(F.col("value") < CUT_BELOW, F.substring("line", 1, 80))
        .otherwise(F.col("line"))
    )
    return with_once(e, "line", line).select("event_id", value.alias("value"))


# The rows of ``pump_lines`` that are whole messages, for the SQL side.
WHOLE_LINES = f"value >= {CUT_BELOW}"


def customer_cells(t: Tables) -> DataFrame:
    """Customers as typed cells: text, whole number and double."""
    c = t.customer
    return rows.row_to_cells(
        c,
        F.col("c_custkey"),
        F.col("c_custkey"),
        "cf",
        {
            "s_name": cells.encode_text(F.col("c_name")),
            "i_nation": cells.encode_int(F.col("c_nationkey")),
            "d_balance": cells.encode_double(F.col("c_acctbal")),
        },
    )
