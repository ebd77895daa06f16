"""Listings of stored media files, as a data source of Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Rows handed on at once; a folder's own entries are the most a task holds.
BATCH_ROWS = 10_000
#: Folders are opened level by level on the driver until there are as many to deal out, or no more.
MIN_FOLDERS = 64
_SHAPE = pa.schema([("path", pa.string()), ("size", pa.int64())])


def open_store(root: str) -> tuple[fs.FileSystem, str]:
    """(file system, folder in it) of a path or address."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    system, base = fs.FileSystem.from_uri(root)
    return system, base.rstrip("/")


class _Folder(InputPartition):
    def __init__(self, path: str, deep: bool):
        self.path, self.deep = path, deep


class _Reader(DataSourceReader):
    def __init__(self, root: str, min_folders: int):
        self.root, self.min_folders = root, min_folders

    def partitions(self) -> list[InputPartition]:
        """One folder each. Files that lie above the folders dealt out are listed by tasks of their own."""
        system, base = open_store(self.root)
        above, level = [], [base]
        while level and len(level) < self.min_folders:
            below = [e.path for path in level for e in system.get_file_info(fs.FileSelector(path)) if e.type == fs.FileType.Directory]
            above += level
            level = below
        return [*(_Folder(path, False) for path in above), *(_Folder(path, True) for path in level)]

    def read(self, partition: _Folder) -> Iterator[pa.RecordBatch]:
        system, base = open_store(self.root)
        open_, paths, sizes = [partition.path], [], []
        while open_:
            for entry in system.get_file_info(fs.FileSelector(open_.pop())):
                if entry.type == fs.FileType.Directory:
                    open_ += [entry.path] if partition.deep else []
                    continue
                paths.append(entry.path[len(base) + 1:])
                sizes.append(entry.size)
                if len(paths) >= BATCH_ROWS:
                    yield pa.record_batch([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=_SHAPE)
                    paths, sizes = [], []
        if paths:
            yield pa.record_batch([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=_SHAPE)


class StoredFiles(DataSource):
    """``spark.read.format("stored_files").option("root", ...)``: (path, size) of the files below."""

    @classmethod
    def name(cls) -> str:
        return "stored_files"

    def schema(self) -> str:
        return "path STRING, size BIGINT"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["root"], int(self.options.get("min_folders", MIN_FOLDERS)))


def list_artifacts(spark: SparkSession, root: str, min_folders: int = MIN_FOLDERS) -> DataFrame:
    """(path, size) of the files below ``root``, empty ones included; paths relative to it.

    The driver reads the names of the upper folders until there are ``min_folders`` to deal out; a task
    lists one folder at a time and hands rows on in batches. No file is opened. Spark's own file scans
    would leave out empty files.
    """
    spark.dataSource.register(StoredFiles)
    return spark.read.format("stored_files").option("root", root).option("min_folders", min_folders).load()
