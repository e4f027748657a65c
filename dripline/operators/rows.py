"""Row operators: each maps a batch or streaming DataFrame without a shuffle,
except the two that gather rows (``cells_to_map``, ``latest_documents``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dripline import schemas
from dripline.functions import cells, messages, text, times


def parse_json(df: DataFrame, fields: dict[str, str], column: str = "value", strict: bool = True) -> DataFrame:
    """JSON text to typed columns; numbers may be quoted. Other columns are dropped."""
    wire = schemas.text_leaves(fields)
    parsed = messages.with_parsed(df.select(column), "_m", F.col(column), wire, strict)
    return parsed.select(*messages.typed(F.col("_m"), fields, strict))


def drop_blank(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(~text.is_blank(F.col(column)))


def with_pump(
    df: DataFrame, column: str = "value", strict: bool = False, data: list[str] | None = None
) -> DataFrame:
    """Parse pump lines once, into a struct column ``pump`` beside the others.

    ``data`` names the inner fields that are needed; the parser skips the rest.
    """
    return messages.with_parsed(df, "pump", F.col(column), schemas.pump_wire(data), strict)


def in_state(df: DataFrame, state: str = "0x02") -> DataFrame:
    """Rows whose pump is in the given state; bad lines have no state and are dropped."""
    return df.filter(F.col("pump.data.state") == state)


def flatten_pump(df: DataFrame, strict: bool = False) -> DataFrame:
    """The flat pump record in sink order: routing key, tags, values.

    A record without a serial number has no table to go to: that fails when strict and
    leaves the routing key NULL otherwise.
    """
    envelope = {k: schemas.PUMP_ENVELOPE[k] for k in ("host", "port", "ts")}
    names = [*schemas.PUMP_TAGS, *schemas.PUMP_VALUES]
    inner = {k: schemas.PUMP_DATA[k] for k in names if k in schemas.PUMP_DATA}
    flat = df.select(
        *messages.typed(F.col("pump"), envelope, strict),
        *messages.typed(F.col("pump.data"), inner, strict),
    )
    route = text.route_key(F.col("factoryNum"))
    if strict:
        missing = F.raise_error(F.lit("pump record without factoryNum")).cast("string")
        route = F.coalesce(route, missing)
    return flat.select(route.alias("tableName"), *names)


def format_time(df: DataFrame, epoch_ms: str, pattern: str = times.SECONDS, out: str = "time_text") -> DataFrame:
    return df.withColumn(out, times.time_text(F.col(epoch_ms), pattern))


def to_json_text(df: DataFrame, columns: list[str] | None = None, out: str = "value", keep_nulls: bool = False) -> DataFrame:
    """One JSON text column from the named columns, or from the whole row."""
    names = columns or df.columns
    return df.select(messages.json_text(keep_nulls, **{c: F.col(c) for c in names}).alias(out))


def head_and_last(df: DataFrame, column: str = "value", delimiter: str = ",") -> DataFrame:
    """First part as ``id`` and last part as ``name``; a line of delimiters only gives NULLs."""
    split = df.select(text.parts(F.col(column), delimiter).alias("_p"))
    return split.select(F.get("_p", F.lit(0)).alias("id"), F.try_element_at("_p", F.lit(-1)).alias("name"))


def explode_parts(df: DataFrame, column: str = "value", delimiter: str = ",", out: str = "word") -> DataFrame:
    """One row per part of each line."""
    return df.select(F.explode(text.parts(F.col(column), delimiter)).alias(out))


def unpivot_ordinal(
    df: DataFrame, columns: list[str], keep: list[str], number: str = "alarmType", value: str = "alarmValue"
) -> DataFrame:
    """One row per non-blank column, numbered from 1 in column order."""
    entries = F.array(
        *(F.struct(F.lit(i).alias("n"), F.col(c).alias("v")) for i, c in enumerate(columns, 1))
    )
    present = F.filter(entries, lambda e: ~text.is_blank(e["v"]))
    rows = df.select(*keep, F.explode(present).alias("_e"))
    return rows.select(*keep, F.col("_e.n").alias(number), F.col("_e.v").alias(value))


def row_to_cells(
    df: DataFrame, row_key: Column, cell_ts: Column, family: str, values: dict[str, Column]
) -> DataFrame:
    """One row per named value, as a cell ``(row_key, family, qualifier, value, cell_ts)``.

    The row key should be stable (a business key or a hash), so a replay rewrites the
    same cells. Values are bytes; NULL ones make no cell.
    """
    entries = F.array(*(F.struct(F.lit(q).alias("q"), v.alias("v")) for q, v in values.items()))
    present = F.filter(entries, lambda e: e["v"].isNotNull())
    rows = df.select(row_key.cast("string").alias("row_key"), cell_ts.alias("cell_ts"), F.explode(present).alias("_e"))
    return rows.select(
        "row_key",
        F.lit(family).alias("family"),
        F.col("_e.q").alias("qualifier"),
        F.col("_e.v").alias("value"),
        "cell_ts",
    )


def cells_to_map(df: DataFrame, strict: bool = True) -> DataFrame:
    """Cells to one map ``name -> text`` per row key.

    Only the newest version of a cell counts; if two qualifiers share a name, the later
    one in (family, qualifier) order wins. A qualifier of another form fails the job
    when strict, else its cell is left out. The winner per name is found with partial
    aggregates, so a map is gathered from as many entries as it holds.
    """
    name, shown = cells.cell_name(F.col("qualifier")), cells.cell_text(F.col("qualifier"), F.col("value"))
    if strict:
        problem = F.concat(F.lit("cannot read cell "), F.coalesce(F.col("qualifier"), F.lit("null")))
        name = F.coalesce(name, F.raise_error(problem).cast("string"))
        shown = F.coalesce(shown, F.raise_error(problem).cast("string"))
    decoded = df.select(
        "row_key", name.alias("name"), F.struct("family", "qualifier", "cell_ts", shown.alias("shown")).alias("_cell")
    )
    if not strict:
        decoded = decoded.filter(F.col("name").isNotNull() & F.col("_cell.shown").isNotNull())
    newest = decoded.groupBy("row_key", "name").agg(F.max("_cell").alias("_cell"))
    return newest.groupBy("row_key").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "_cell.shown"))).alias("cells")
    )


def scan_row_keys(df: DataFrame) -> DataFrame:
    """Row keys of a cell table, each once."""
    return df.select("row_key").distinct()


def time_series_lines(
    df: DataFrame, measurement: str, tags: list[str], fields: list[str], out: str = "value"
) -> DataFrame:
    shown = {
        f: text.quoted(F.col(f)) if dict(df.dtypes)[f] == "string" else F.col(f) for f in fields
    }
    line = text.line_protocol(measurement, {t: F.col(t) for t in tags}, shown)
    return df.select(line.alias(out)).filter(F.col(out).isNotNull())


def documents(df: DataFrame, index: str, id_columns: list[str], order: list[str] | None = None) -> DataFrame:
    """Index name, document id and JSON body of each row, with ``order`` kept beside them."""
    body = messages.json_text(**{c: F.col(c) for c in df.columns})
    return df.select(
        F.lit(index).alias("index"),
        text.doc_id(*(F.col(c) for c in id_columns)).alias("id"),
        body.alias("body"),
        *(order or []),
    )


def latest_documents(df: DataFrame, order: list[str]) -> DataFrame:
    """The last body per document id: a later write replaces an earlier one.

    A maximum, not a window: partial results keep an id with very many writes cheap.
    """
    last = F.max(F.struct(*order, "body"))["body"]
    return df.groupBy("index", "id").agg(last.alias("body"))


def drop_transient(df: DataFrame, marked: list[str] | None = None) -> DataFrame:
    """Leave out columns named here or carrying ``{"transient": true}`` in their metadata."""
    flagged = {f.name for f in df.schema.fields if f.metadata.get("transient")}
    return df.drop(*flagged, *(marked or []))


def mark_transient(df: DataFrame, *columns: str) -> DataFrame:
    return df.withMetadata(columns[0], {"transient": True}) if len(columns) == 1 else mark_transient(
        mark_transient(df, columns[0]), *columns[1:]
    )
