"""Synthetic rows: a sequence, a seeded number and a seeded text.

The columns are a formula of the sequence number, so the same rows come out on every
run and every executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Multiplier, increment and modulus of the number formula.
MULTIPLIER, INCREMENT, MODULUS = 1103515245, 12345, 2147483648


def random_number(n: Column, low: int, high: int) -> Column:
    """A number in ``low..high``, fixed by ``n``."""
    # n is cut first, so that the product cannot leave BIGINT.
    mixed = (F.pmod(n, F.lit(MODULUS)) * MULTIPLIER + INCREMENT) % MODULUS
    return (mixed % (high - low + 1) + low).cast("int")


def random_text(n: Column, length: int) -> Column:
    """Hex text of the given length, fixed by ``n``."""
    blocks = [F.md5(n.cast("string"))]
    while 32 * len(blocks) < length:
        blocks.append(F.md5(F.concat(n.cast("string"), F.lit(f"#{len(blocks)}"))))
    return F.substring(F.concat(*blocks), 1, length)


def with_synthetic(df: DataFrame, n: Column, low: int = 1, high: int = 1_000_000, length: int = 10) -> DataFrame:
    """``f_sequence``, ``f_random`` and ``f_random_str`` from a sequence number."""
    return df.select(
        n.cast("int").alias("f_sequence"),
        random_number(n, low, high).alias("f_random"),
        random_text(n, length).alias("f_random_str"),
    )


def field_column(n: Column, name: str, kind: str, salt: int, spec: dict) -> Column:
    """A declared column from the row's number, counted from 0: a sequence, or values fixed by number and ``salt``.

    Whole numbers, fractions, texts and truth values can be random; a time is that of reading.
    """
    plain = kind.lower().split("(")[0].strip()
    if spec.get("kind") == "sequence":
        return (n + spec.get("start", 1)).cast(kind)
    mixed = n * 31 + salt
    low, high = spec.get("min", 1), spec.get("max", 1_000_000)
    if plain in _WHOLE:
        most = _WHOLE[plain]
        return random_number(mixed, max(low, -most - 1), min(high, most)).cast(kind)
    if plain in ("float", "double", "decimal"):
        return ((random_number(mixed, 0, MODULUS - 2) / (MODULUS - 2)) * (high - low) + low).cast(kind)
    if plain in ("string", "varchar", "char"):
        return random_text(mixed, spec.get("length", 100))
    if plain == "boolean":
        return random_number(mixed, 0, 1) == 1
    if plain.startswith("timestamp"):
        return F.current_timestamp()
    raise ValueError(f"column {name} of type {kind} can't be generated")


# The greatest number of each type.
_WHOLE = {"tinyint": 127, "smallint": 32767, "int": 2147483647, "integer": 2147483647, "bigint": MODULUS - 2}


def _declared(rows: DataFrame, n: Column, columns: dict[str, str], fields: dict[str, dict], start: int, *rest) -> DataFrame:
    """The declared columns; the three known names without a spec of their own follow the known formulas."""
    low, high, length = rest
    formula = {
        "f_sequence": (n + start).cast("int"),
        "f_random": random_number(n + start, low, high),
        "f_random_str": random_text(n + start, length),
    }
    return rows.select(*(
        (formula[c] if c in formula and c not in fields else field_column(n, c, kind, salt, fields.get(c, {}))).alias(c)
        for salt, (c, kind) in enumerate(columns.items())
    ))


def _row_count(start: int, end: int, columns: dict[str, str] | None, fields: dict[str, dict], rows: int | None) -> int | None:
    """Rows until the shortest sequence or the set number ends; None where neither is there."""
    ends = [f["end"] - f.get("start", 1) + 1 for f in fields.values() if f.get("kind") == "sequence" and "end" in f]
    if columns is None or "f_sequence" in columns and "f_sequence" not in fields:
        ends.append(end - start + 1)
    return min([*ends, *([] if rows is None else [rows])], default=None)


def synthetic_table(
    spark: SparkSession, start: int = 1, end: int = 1000, low: int = 1, high: int = 1_000_000, length: int = 10,
    rows_per_second: int = 5, columns: dict[str, str] | None = None, fields: dict[str, dict] | None = None,
    number_of_rows: int | None = None,
) -> DataFrame:
    """The three known columns, or the declared ones, as a batch: it needs a sequence's end or a number of rows."""
    count = _row_count(start, end, columns, fields or {}, number_of_rows)
    if count is None:
        raise ValueError("a generated table without a sequence that ends needs number-of-rows in a batch")
    if columns is None:
        return with_synthetic(spark.range(start, start + count), F.col("id"), low, high, length)
    return _declared(spark.range(count), F.col("id"), columns, fields or {}, start, low, high, length)


def synthetic_stream(
    spark: SparkSession, start: int = 1, end: int = 1000, low: int = 1, high: int = 1_000_000, length: int = 10,
    rows_per_second: int = 5, columns: dict[str, str] | None = None, fields: dict[str, dict] | None = None,
    number_of_rows: int | None = None,
) -> DataFrame:
    """The same rows at a steady rate; none follow after the end. Without declared columns the reader's ``ts`` is there too."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    count = _row_count(start, end, columns, fields or {}, number_of_rows)
    rows = ticks if count is None else ticks.filter(F.col("value") < count)
    if columns is not None:
        return _declared(rows, F.col("value"), columns, fields or {}, start, low, high, length)
    n = F.col("value") + start
    return rows.select(
        n.cast("int").alias("f_sequence"), random_number(n, low, high).alias("f_random"),
        random_text(n, length).alias("f_random_str"), F.col("timestamp").alias("ts"),
    )
