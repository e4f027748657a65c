"""Splitting of busy keys.

A key that holds a large share of the rows would make one huge task in a window or a
join. The functions here cut such keys into parts that hash to different tasks.

``busy_keys`` keeps a key only if it has more rows than one part may hold, and a part
holds at least 1/MAX_PARTS of all rows. So there are never more than MAX_PARTS busy
keys, nor more than 2 * MAX_PARTS parts, whatever the input: that bound is what allows
the broadcasts below. Chunks that are too full are fewer still: MAX_PARTS / 2 at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dripline.session import written

MAX_PARTS = 100_000
FLOOR_ROWS = 1_000

CHUNK = "_chunk"
_ROWS, _LO, _HI, _PARTS, _SIZE = "_rows", "_lo", "_hi", "_parts", "_part_rows"


def _key_alias(key: str) -> str:
    return f"_busy_{key}"


def same_keys(left: list[str], right: list[str]) -> Column:
    """Key equality in which NULL equals NULL, as in a grouping; without keys all rows are one group."""
    return reduce(lambda a, b: a & b, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)), F.lit(True))


def busy_keys(
    df: DataFrame, keys: list[str], position: Column | None = None, floor_rows: int = FLOOR_ROWS
) -> DataFrame:
    """Keys with more rows than one part may hold, and how many parts each needs."""
    sums = [F.count(F.lit(1)).alias(_ROWS)]
    if position is not None:
        sums += [F.min(position).cast("double").alias(_LO), F.max(position).cast("double").alias(_HI)]
    per_key = df.groupBy(*keys).agg(*sums)
    total = per_key.agg(F.sum(_ROWS)).scalar()
    size = F.greatest(F.lit(floor_rows).cast("double"), total / F.lit(MAX_PARTS))
    bounds = [_LO, _HI] if position is not None else []
    return (
        per_key.withColumn(_SIZE, size)
        .filter(F.col(_ROWS) > F.col(_SIZE))
        .select(
            *(F.col(k).alias(_key_alias(k)) for k in keys),
            *bounds,
            F.ceil(F.col(_ROWS) / F.col(_SIZE)).cast("bigint").alias(_PARTS),
        )
    )


def with_chunks(
    df: DataFrame, keys: list[str], order: list[str], floor_rows: int = FLOOR_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Add ``_chunk``: 0 for ordinary keys, else a number that never falls along ``order``.

    Gives all rows, and the rows of busy keys only. Windows over (keys, _chunk) see a
    bounded slice of a busy key; what earlier slices contribute is a small per-chunk
    summary, made from the second.

    A chunk is first an equal share of the key's range of ``order[0]``, which suits a dense
    sequence. What comes in bursts leaves some chunks with more than twice their share: those
    are cut at quantiles, from a mergeable sketch of each, and again until none is left. Rows on
    one position are cut by the next order column, and rows equal in all of them, whose order is
    open, by a hash. Only rows that are wholly equal stay together.
    """
    busy = F.broadcast(busy_keys(df, keys, F.col(order[0]), floor_rows))
    every = _number(df, busy, keys, F.col(order[0]), "left", CHUNK)
    of_busy = _number(df, busy, keys, F.col(order[0]), "inner", CHUNK)
    ladder = _positions(df, order)
    total = df.agg(F.count(F.lit(1))).scalar()
    most = 2 * F.greatest(F.lit(floor_rows).cast("double"), total / F.lit(MAX_PARTS))
    for _ in range(ROUNDS):
        counts = of_busy.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias(_ROWS))
        full = counts.filter(F.col(_ROWS) > most).select(*(F.col(k).alias(_key_alias(k)) for k in keys), F.col(CHUNK).alias(_AT))
        cuts = written(_cut_points(of_busy, full, keys, ladder), "cuts")
        if cuts.isEmpty():
            break
        every, of_busy = (_refined(rows, cuts, keys, ladder, df.columns) for rows in (every, of_busy))
    return every, of_busy


#: Quantiles that cut a chunk which is too full, and rounds of cutting at most (numbers stay in 64 bits).
SHARES, ROUNDS = 63, 6
_AT, _RUNG, _CUTS = "_at_chunk", "_rung", "_cuts"


def _positions(df: DataFrame, order: list[str]) -> list[Column]:
    """What rows may be cut by, one after another: the order's leading numbers, then a hash of the row."""
    kinds = dict(df.dtypes)
    numbers = []
    for c in order:
        if kinds[c] not in ("tinyint", "smallint", "int", "bigint", "float", "double"):
            return numbers
        numbers.append(F.col(c))
    hashed = [F.col(f"`{c}`").cast("string") if kinds[c].startswith("map") else F.col(f"`{c}`") for c in df.columns]
    return [*numbers, F.shiftrightunsigned(F.xxhash64(*hashed), 1)]


def _of_chunk(rows: DataFrame, found: DataFrame, keys: list[str], how: str) -> DataFrame:
    return rows.join(F.broadcast(found), same_keys([*keys, CHUNK], [*(_key_alias(k) for k in keys), _AT]), how)


def _cut_points(of_busy: DataFrame, full: DataFrame, keys: list[str], ladder: list[Column]) -> DataFrame:
    """For each chunk that is too full the first position in which its rows differ, and that position's quantiles."""
    rows = _of_chunk(of_busy, full, keys, "left_semi")
    shares = [k / (SHARES + 1) for k in range(1, SHARES + 1)]
    seen = rows.groupBy(*keys, CHUNK).agg(
        *(
            f.alias(f"{name}{k}")
            for k, p in enumerate(ladder)
            for name, f in (("_differ", (F.min(p) < F.max(p)) | ((F.count(p) > 0) & (F.count(p) < F.count(F.lit(1))))), ("_q", F.percentile_approx(p, shares, 4000)))
        )
    )
    rung = F.coalesce(*(F.when(F.col(f"_differ{k}"), F.lit(k)) for k in range(len(ladder)))) if ladder else F.lit(None)
    cuts = F.coalesce(*(F.when(F.col(f"_differ{k}"), F.array_distinct(F.col(f"_q{k}").cast("array<double>"))) for k in range(len(ladder)))) if ladder else F.lit(None)
    out = seen.select(*(F.col(k).alias(_key_alias(k)) for k in keys), F.col(CHUNK).alias(_AT), rung.cast("int").alias(_RUNG), cuts.alias(_CUTS))
    return out.filter(F.col(_RUNG).isNotNull())


def _refined(rows: DataFrame, cuts: DataFrame, keys: list[str], ladder: list[Column], columns: list[str]) -> DataFrame:
    """Chunks numbered anew: those with cut points by the interval or the very cut point a row is on, NULL first."""
    position = F.coalesce(*(F.when(F.col(_RUNG) == k, p.cast("double")) for k, p in enumerate(ladder)))
    below = F.size(F.filter(_CUTS, lambda c: c < position))
    inside = F.when(position.isNull(), 0).otherwise(1 + 2 * below + F.array_contains(_CUTS, position).cast("int"))
    joined = _of_chunk(rows, cuts, keys, "left")
    number = F.col(CHUNK) * (2 * SHARES + 3) + F.coalesce(F.when(F.col(_RUNG).isNotNull(), inside), F.lit(0))
    return joined.select(*(F.col(f"`{c}`") for c in columns), number.cast("bigint").alias(CHUNK))


def _number(df: DataFrame, busy: DataFrame, keys: list[str], position: Column, how: str, out: str) -> DataFrame:
    number = F.width_bucket(position.cast("double"), F.col(_LO), F.col(_HI), F.col(_PARTS))
    joined = df.join(busy, same_keys(keys, [_key_alias(k) for k in keys]), how)
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns),
        F.coalesce(number, F.lit(0).cast("bigint")).alias(out),
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: list[str],
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """Left join to a table with one row per key, with busy left keys spread over many tasks.

    ``spread_by`` names left columns that differ between rows of one key. Each busy key's
    single right row is copied once per part, at most 2 * MAX_PARTS copies in all.
    Where Catalyst knows the right side to be under the broadcast threshold it needs no
    spreading, and the plain join becomes a broadcast join.
    """
    if fits_broadcast(right):
        return left.join(right, F.col(left_key) == F.col(right_key), "left")
    salt_left, salt_right = "_salt_left", "_salt_right"
    busy = busy_keys(left, [left_key], None, floor_rows)
    alias = _key_alias(left_key)
    split_left = (
        left.join(F.broadcast(busy), F.col(left_key).eqNullSafe(F.col(alias)), "left")
        .withColumn(
            salt_left,
            F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col(_PARTS)), F.lit(0)),
        )
        .drop(alias, _PARTS)
    )
    split_right = (
        right.join(F.broadcast(busy), F.col(right_key) == F.col(alias), "left")
        .withColumn(
            salt_right,
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)),
        )
        .drop(alias, _PARTS)
    )
    on = (F.col(left_key) == F.col(right_key)) & (F.col(salt_left) == F.col(salt_right))
    return split_left.join(split_right, on, "left").drop(salt_left, salt_right)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of ``df`` is under the session's broadcast threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit
