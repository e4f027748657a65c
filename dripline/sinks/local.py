"""Folders of lines on a file system that Python reaches.

Hadoop's local file system starts a process for the rights of each file, checksum file and folder
that it makes where its native library is missing, and Spark copies all settings for each file it
reads, one task at a time. With many small files that is nearly all of the time. Here tasks write the
same folders themselves, staged first, then moved into place, and count their lines.
"""

from __future__ import annotations

import errno
import glob
import os
import re
import shutil
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterable
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dripline.session import files_of

# Tasks run these functions, maybe without this package: they travel by value.
cloudpickle.register_pickle_by_value(sys.modules["dripline"])

#: Bytes that a checksum of Hadoop's local file system is of.
SUM_BYTES = 512
#: Folder of what is not in place yet; readers pass over it.
STAGED = "_temporary"
#: Tasks for each core that move, remove or count folders.
MOVERS = 4
#: Bytes that are counted at a time, whole checksums of them.
READ_BYTES = 8192 * SUM_BYTES
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as Python takes it, or none where only Hadoop reaches it."""
    store, where = files_of(spark, path)
    return store.makeQualified(where).toUri().getPath() if store.getUri().getScheme() == "file" else None


def folder_of(column: str, value: str | None) -> str:
    """A partition's folder as Spark names it."""
    text = _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE
    return f"{column}={text}"


def value_of(folder: str) -> str | None:
    """The value that a folder's name stands for."""
    text = folder.split("=", 1)[1]
    return None if text == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), text)


def _sums(data: memoryview, each: int) -> bytes:
    sums = [zlib.crc32(data[k : k + each]) for k in range(0, len(data), each)]
    return struct.pack(f">{len(sums)}I", *sums)


class _Lines:
    """A file of lines, with the checksum file beside it that Hadoop's local file system keeps."""

    def __init__(self, folder: str, name: str):
        os.makedirs(folder)
        self.file, self.sums, self.rest = open(f"{folder}/{name}", "xb"), open(f"{folder}/.{name}.crc", "xb"), b""
        self.sums.write(b"crc\0" + struct.pack(">i", SUM_BYTES))

    def write(self, data: memoryview) -> None:
        self.file.write(data)
        data = memoryview(self.rest + bytes(data))
        whole = len(data) - len(data) % SUM_BYTES
        self.sums.write(_sums(data[:whole], SUM_BYTES))
        self.rest = bytes(data[whole:])

    def close(self) -> None:
        self.sums.write(_sums(memoryview(self.rest), SUM_BYTES))
        self.file.close()
        self.sums.close()


def _writer(at: str, by: list[str]) -> Callable:
    """Write a task's lines under a folder of its own, which is its one row."""
    made = uuid.uuid4()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        context = TaskContext.get()
        mine, name = f"{at}/{context.taskAttemptId()}", f"part-{context.partitionId():05d}-{made}-c000.txt"
        last, out = None, None
        try:
            for batch in filter(len, batches):
                lines, keys = batch.column(0).cast(pa.large_binary()), batch.columns[1:]
                starts = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset :]
                data, row = memoryview(lines.buffers()[2] or b""), 0
                # Where runs of lines of the same folder end.
                for end in np.unique(np.concatenate([pc.run_end_encode(k).run_ends.to_numpy() for k in keys])).tolist():
                    key = [k[row].as_py() for k in keys]
                    if key != last:
                        if out:
                            out.close()
                        out, last = _Lines("/".join([mine, *map(folder_of, by, key)]), name), key
                    out.write(data[starts[row] : starts[end]])
                    row = end
        finally:
            if out:
                out.close()
        if out:
            yield pa.RecordBatch.from_pydict({"folder": [mine]})

    return write


def write_lines(lines: DataFrame, path: str, by: list[str], name: str = "") -> None:
    """Append the column ``value`` as lines, a file for each folder of the columns ``by``.

    The lines of a folder follow one another in one task. What a task that fails or is repeated left
    is not moved; what a run that died left stays under ``STAGED`` with its name.
    """
    at = f"{path}/{STAGED}/{name}{uuid.uuid4().hex}"
    line = F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).cast("binary")
    os.makedirs(at)
    try:
        staged = lines.select(line.alias("line"), *by).mapInArrow(_writer(at, by), "folder string").collect()
        _deal(lines.sparkSession, [row.folder for row in staged], _mover(path, len(by)))
    finally:
        shutil.rmtree(at, ignore_errors=True)
        with suppress(OSError):  # another run has its own there
            os.rmdir(f"{path}/{STAGED}")


def _mover(path: str, levels: int) -> Callable:
    def move(staged: str, to: str, level: int) -> None:
        """Move folders of the last level as a whole, or their files where a folder is there; done twice is as once."""
        try:
            entries = os.listdir(staged)
        except FileNotFoundError:  # another try has moved it
            return
        if level < levels:
            os.makedirs(to, exist_ok=True)
        for name in entries:
            if level + 1 < levels or not _renamed(f"{staged}/{name}", f"{to}/{name}"):
                move(f"{staged}/{name}", f"{to}/{name}", level + 1)
        with suppress(FileNotFoundError):
            os.rmdir(staged)

    return lambda folder: move(folder, path, 0)


def _renamed(source: str, to: str) -> bool:
    """Move a file or folder, unless a folder with files is there."""
    try:
        os.rename(source, to)
    except FileNotFoundError:  # another try has moved it
        if os.path.lexists(source):
            raise
    except OSError as error:
        if error.errno not in (errno.ENOTEMPTY, errno.EEXIST):
            raise
        return False
    return True


def _deal(spark: SparkSession, folders: list[str], do: Callable[[str], None]) -> None:
    """Do it with each folder, in tasks."""
    if folders:
        context = spark.sparkContext
        context.parallelize(folders, min(len(folders), MOVERS * context.defaultParallelism)).foreach(do)


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    _deal(spark, list(folders), _gone)


def _gone(folder: str) -> None:
    try:
        shutil.rmtree(folder)
    except FileNotFoundError:  # it is gone, or another try removes it too
        if os.path.exists(folder):
            shutil.rmtree(folder)


def found(path: str, pattern: str) -> list[str]:
    return glob.glob(f"{glob.escape(path)}/{pattern}")


def counted(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """``by, row_count, part_bytes`` of every folder of the columns ``by`` that has lines."""
    folders = found(path, "/".join(f"{c}=*" for c in by))
    tasks = min(len(folders), MOVERS * spark.sparkContext.defaultParallelism) or 1
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(f,) for f in folders], tasks), "folder string")
    schema = pa.schema([*((c, pa.string()) for c in by), ("row_count", pa.int64()), ("part_bytes", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = [[*map(value_of, f.split("/")[-len(by) :]), *_counted(f)] for f in batch.column(0).to_pylist()]
            rows = [row for row in rows if row[-2]]
            columns = zip(*rows) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(count, ", ".join([*(f"{c} string" for c in by), "row_count bigint, part_bytes bigint"]))


def _counted(folder: str) -> tuple[int, int]:
    """Lines of a folder and their bytes, with one for the end of each."""
    rows = size = 0
    for entry in os.scandir(folder):
        if entry.name.startswith((".", "_")):
            continue
        if not entry.name.endswith(".txt"):
            raise ValueError(f"not a file of plain lines: {entry.path}")
        ends = text = 0
        last, first = b"", True
        for data in _read(folder, entry.name):
            if first and data.startswith(b"\xef\xbb\xbf"):  # Spark passes over this mark too
                data = data[3:]
            feeds, returns = data.count(b"\n"), data.count(b"\r")
            text += len(data) - feeds - returns
            # Lines end as Spark's reader takes them: by a line feed, a return, or both.
            ends += feeds + returns - (data.count(b"\r\n") if returns else 0) - (last == b"\r" and data[:1] == b"\n")
            last, first = data[-1:] or last, False
        n = ends + (last not in (b"", b"\n", b"\r"))
        rows, size = rows + n, size + text + n
    return rows, size


def _read(folder: str, name: str) -> Iterable[bytes]:
    """A file in pieces, which must agree with its checksums where it has them."""
    try:
        with open(f"{folder}/.{name}.crc", "rb") as file:
            sums = file.read()
    except FileNotFoundError:
        sums = b""
    each, at = struct.unpack(">i", sums[4:8])[0] if sums else SUM_BYTES, 8
    with open(f"{folder}/{name}", "rb") as file:
        while data := file.read(READ_BYTES // SUM_BYTES * each):
            if sums:
                want = sums[at : (at := at + 4 * -(-len(data) // each))]
                if _sums(memoryview(data), each) != want:
                    raise OSError(f"checksum error: {folder}/{name}")
            yield data
