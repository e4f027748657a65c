"""A polled table as a stream: its offset is the mark, kept in the query's own checkpoint.

The table is a folder of Parquet files that grows (or one file). A poll reads the statistics of
row groups to find the greatest mark, and the row groups that can hold rows past the last mark
become the partitions of the micro-batch; each task reads its own, filtered by the bounds.

``strict`` (the default) takes rows past the mark and loses rows that come later with the mark's
own value. ``inclusive`` keeps the ids of the rows on the mark in the offset: rows that come later
with that value are taken by the next poll, and none is taken twice.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Tasks and the planner's process may not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules["dripline"])

FORMAT = "polled_table"
#: Bytes of row groups that one task reads.
PARTITION_BYTES = 128 << 20


class RowGroups(InputPartition):
    """Row groups of one file, and the bounds a poll takes of them."""

    def __init__(self, path: str, groups: list[int], start: dict, end: dict):
        self.path, self.groups, self.start, self.end = path, groups, start, end


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class PolledReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.column, self.names = options["path"], options["column"], names
        self.ids = [c for c in options.get("ids", "").split(",") if c]
        self.first, self.inclusive = options["first"], options.get("inclusive", "false") == "true"
        if self.inclusive and not self.ids:
            raise ValueError("an inclusive poll needs ids, the columns that name a row")

    def _files(self) -> list[Any]:
        store, at = _open(self.path)
        if store.get_file_info(at).type == fs.FileType.File:
            return [(store, at)]
        found = store.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True))
        hidden = lambda f: any(p[:1] in "._" for p in f.path[len(at) :].split("/") if p and "=" not in p)
        return [(store, f.path) for f in found if f.type == fs.FileType.File and not hidden(f)]

    def _groups(self) -> Iterator[tuple[Any, str, int, int, Any, Any, pa.DataType]]:
        """Row groups with any mark: their file, number, bytes, least and greatest mark."""
        for store, path in self._files():
            with store.open_input_file(path) as file:
                parquet = pq.ParquetFile(file)
                kind = parquet.schema_arrow.field(self.column).type
                leaf = parquet.metadata.schema.names.index(self.column)
                for k in range(parquet.num_row_groups):
                    group = parquet.metadata.row_group(k)
                    seen = group.column(leaf).statistics
                    if seen is None or not seen.has_min_max:
                        raise ValueError(f"{path} has no statistics of {self.column}; a poll would read it whole")
                    yield store, path, k, group.total_byte_size, _whole(seen.min, kind), _whole(seen.max, kind), kind

    def initialOffset(self) -> dict:
        return {"mark": None, "ids": None}

    def latestOffset(self) -> dict:
        groups = list(self._groups())
        if not groups:
            return self.initialOffset()
        mark = max(g[5] for g in groups)
        first = _whole(pa.scalar(self.first).cast(groups[0][6]).as_py(), groups[0][6])
        if mark < first or mark == first and not self.inclusive:
            return self.initialOffset()
        return {"mark": mark, "ids": self._on_mark(groups, mark) if self.inclusive else None}

    def _on_mark(self, groups: list, mark) -> str:
        """The ids of the rows on the mark: as many as share the table's greatest value."""
        found: set[str] = set()
        for store, path, k, _, _, most, kind in groups:
            if most == mark:
                with store.open_input_file(path) as file:
                    rows = pq.ParquetFile(file).read_row_group(k, columns=[self.column, *self.ids])
                found.update(_names(rows.filter(pc.equal(rows[self.column], _mark(mark, kind))), self.ids))
        return json.dumps(sorted(found))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start == end or end["mark"] is None:
            return []
        out: list[RowGroups] = []
        size = 0
        for _, path, k, bytes_, least, most, kind in self._groups():
            low = _whole(pa.scalar(self.first).cast(kind).as_py(), kind) if start["mark"] is None else start["mark"]
            if least <= end["mark"] and (most >= low if self.inclusive else most > low):
                if out and out[-1].path == path and size + bytes_ <= PARTITION_BYTES:
                    out[-1].groups.append(k)
                    size += bytes_
                else:
                    out.append(RowGroups(path, [k], start, end))
                    size = bytes_
        return out

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        store, _ = _open(self.path)
        needed = list(dict.fromkeys([*self.names, self.column, *self.ids]))
        with store.open_input_file(partition.path) as file:
            parquet = pq.ParquetFile(file)
            kind = parquet.schema_arrow.field(self.column).type
            start, end = partition.start, partition.end
            fresh = start["mark"] is None
            low, high = pa.scalar(self.first).cast(kind) if fresh else _mark(start["mark"], kind), _mark(end["mark"], kind)
            before = set() if fresh or not self.inclusive else set(json.loads(start["ids"]))
            upto = set(json.loads(end["ids"])) if self.inclusive else set()
            for batch in parquet.iter_batches(row_groups=partition.groups, columns=needed):
                mark = batch.column(self.column)
                past = pc.greater_equal(mark, low) if self.inclusive else pc.greater(mark, low)
                batch = batch.filter(pc.and_(past, pc.less_equal(mark, high)))
                if self.inclusive and batch.num_rows:
                    # On a mark, the offsets say which rows were there.
                    mark, names = batch.column(self.column), _names(pa.table(batch), self.ids)
                    on_low = [not fresh and m for m in pc.equal(mark, low).to_pylist()]
                    on_high = pc.equal(mark, high).to_pylist()
                    batch = batch.filter(pa.array(
                        [not (a and n in before) and (not b or n in upto) for a, b, n in zip(on_low, on_high, names)], pa.bool_()
                    ))
                if batch.num_rows:
                    yield batch.select(self.names)


def _whole(value, kind: pa.DataType) -> int | str:
    """A mark as an offset holds it: text stays text, numbers and times become whole numbers."""
    return value if isinstance(value, str) else pa.scalar(value, kind).cast(_bits(kind)).cast(pa.int64()).as_py()


def _mark(value: int | str, kind: pa.DataType) -> pa.Scalar:
    return pa.scalar(value, kind) if isinstance(value, str) else pa.scalar(value, pa.int64()).cast(_bits(kind)).cast(kind)


def _bits(kind: pa.DataType) -> pa.DataType:
    return pa.int32() if pa.types.is_date32(kind) else pa.int64()


def _names(rows: pa.Table, ids: list[str]) -> list[str]:
    return [json.dumps(row, default=str) for row in zip(*(rows[c].to_pylist() for c in ids))]


class PolledTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema) -> PolledReader:
        return PolledReader(dict(self.options), schema.names)


def polled(
    spark: SparkSession, path: str, schema, column: str, first: str, inclusive: bool = False, ids: tuple[str, ...] = ()
) -> DataFrame:
    """A stream of the rows past the mark, each once. ``first`` is the mark before the first poll, as text.

    A replayed micro-batch has the same bounds; a strict one may then also hold rows that came in
    since with marks inside them. The rows of a file must be complete when the file appears, as they
    are with Spark's writers, and marks need statistics. Rows without a mark are not read.
    """
    spark.dataSource.register(PolledTable)
    options = {"path": path, "column": column, "first": first, "inclusive": str(inclusive).lower(), "ids": ",".join(ids)}
    return spark.readStream.format(FORMAT).options(**options).schema(schema).load()
