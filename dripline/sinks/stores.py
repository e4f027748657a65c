"""Documents, cells and time-series lines: row shapes on the shared batch writers.

The store itself is behind a ``Sink`` (remote service, JDBC table or batch folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from dripline.operators import rows as row_ops
from dripline.sinks.batches import Sink
from dripline.sinks.upserts import BUCKETS, UpsertTable


def document_sink(
    index: str, id_columns: list[str], order: list[str], store: Sink, latest: bool = True
) -> Sink:
    """Documents with one write per id and batch: the last one in ``order``, unless the store settles that itself."""

    def write(rows: DataFrame, batch_id: int) -> None:
        docs = row_ops.documents(rows, index, id_columns, order)
        store(row_ops.latest_documents(docs, order) if latest else docs, batch_id)

    return write


def document_table(index: str, id_columns: list[str], order: list[str], folder: str, buckets: int = BUCKETS) -> Sink:
    """Documents kept over batches: the last write of an id replaces the ones before it."""
    table = UpsertTable(folder, ["index", "id"], order, buckets)
    return document_sink(index, id_columns, order, table.write, latest=False)


def cell_sink(row_key, cell_ts, family: str, values: dict, store: Sink) -> Sink:
    """Rows as key-value cells, each written once."""

    def write(rows: DataFrame, batch_id: int) -> None:
        store(row_ops.row_to_cells(rows, row_key, cell_ts, family, values), batch_id)

    return write


def time_series_sink(measurement: str, tags: list[str], fields: list[str], store: Sink) -> Sink:
    def write(rows: DataFrame, batch_id: int) -> None:
        store(row_ops.time_series_lines(rows, measurement, tags, fields), batch_id)

    return write


def raw_line_sink(store: Sink, column: str = "value") -> Sink:
    """Raw text rows, as a warehouse's stream load takes them."""

    def write(rows: DataFrame, batch_id: int) -> None:
        store(rows.select(column), batch_id)

    return write
