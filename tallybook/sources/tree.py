"""M1 for very large trees: a pointer source that lists and reads in tasks.

Spark's file sources list every file on the driver. Here the driver lists folders down to a given
depth and no files below; a task walks its folder, in any store pyarrow can open, and reads the
files that are small enough for a pointer. Every file gives a row, empty and too large ones too.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallybook.sources.pointers import POINTER_MAX_BYTES, read_pointer

# Tasks get this module's code with them, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "pointer_tree"
SCHEMA = "path string, value string, size bigint"
BATCH = 4096


def _store(root: str) -> tuple[pafs.FileSystem, str]:
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    files, base = pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)
    return files, base.rstrip("/")


@dataclass
class Share(InputPartition):
    """The files of a folder, with all folders below it or without, that fall to one task."""

    folder: str
    deep: bool
    number: int
    of: int


class TreeReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.depth, self.shares = options["path"], int(options.get("depth", 1)), int(options.get("shares", 1))
        self.most = POINTER_MAX_BYTES

    def partitions(self) -> list[InputPartition]:
        files, base = _store(self.root)
        level, found = [base], []
        for _ in range(self.depth):
            found += [(folder, False) for folder in level]
            below = (files.get_file_info(pafs.FileSelector(folder)) for folder in level)
            level = [info.path for listed in below for info in listed if info.type == pafs.FileType.Directory]
        found += [(folder, True) for folder in level]
        return [Share(folder, deep, k, self.shares) for folder, deep in found for k in range(self.shares)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        files, base = _store(self.root)
        rows: list[tuple[str, str | None, int]] = []
        for info in files.get_file_info(pafs.FileSelector(partition.folder, recursive=partition.deep)):
            if info.type != pafs.FileType.File:
                continue
            path = info.path[len(base) + 1 :]
            if zlib.crc32(path.encode()) % partition.of != partition.number:
                continue
            text = None
            if info.size <= self.most:
                with files.open_input_stream(info.path, compression=None) as source:
                    text = source.read().decode("utf-8", "replace")
            rows.append((path, text, info.size))
            if len(rows) == BATCH:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


def _batch(rows: list[tuple[str, str | None, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "value", "size"])


class PointerTree(DataSource):
    """Files below ``path``: path below it, text (null if too large for a pointer) and size.

    ``depth`` is how far down the driver lists folders; ``shares`` deals the files of each such folder to as many tasks.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return TreeReader(self.options)


def scan_tree(spark: SparkSession, root: str, depth: int = 1, shares: int = 1) -> DataFrame:
    """path, version, oid, size, well_formed, file_size of every file below ``root``, listed and read by tasks.

    The rows of ``scan_pointers``, and one for each empty or too large file besides: empty files are not well formed,
    of too large ones nothing but ``file_size`` is known. Choose ``depth`` so that folders are many, and ``shares`` where a single folder holds
    most files. A folder that goes away between listing and reading is an error.
    """
    spark.dataSource.register(PointerTree)
    files = spark.read.format(FORMAT).option("depth", str(depth)).option("shares", str(shares)).load(root)
    found = read_pointer(files.withColumnRenamed("size", "file_size"))
    return found.select("path", "version", "oid", "size", F.coalesce("well_formed", F.lit(False)).alias("well_formed"), "file_size")
