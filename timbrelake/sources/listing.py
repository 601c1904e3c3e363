"""Listing of files by the executors: a data source whose partitions are folders."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from timbrelake.session import ship_package

#: File systems that the executors can list by themselves.
LISTED = ("file", "hdfs", "s3", "s3a", "gs")
#: The driver opens folders level by level until there are so many to list.
FOLDERS = 256
#: Names in a batch.
ROWS = 10_000
SCHEMA = "path string, modificationTime timestamp, length bigint"


def glob_pattern(glob: str) -> re.Pattern:
    """Regular expression of a file name pattern with ``*``, ``?``, ``[...]`` and ``{a,b}``."""
    out, i, depth = [], 0, 0
    while i < len(glob):
        c = glob[i]
        if c == "\\" and i + 1 < len(glob):
            i += 1
            out.append(re.escape(glob[i]))
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "[" and "]" in glob[i + 2 :]:
            end = glob.index("]", i + 2)
            inner = glob[i + 1 : end].replace("\\", "\\\\")
            out.append("[" + ("^" + inner[1:] if inner[0] in "!^" else inner) + "]")
            i = end
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(c))
        i += 1
    return re.compile("".join(out) + r"\Z")


def _shown(name: str) -> bool:
    """Whether a name counts: those of Spark's own and of hidden files do not."""
    return not name.startswith(".") and (not name.startswith("_") or "=" in name)


class _Store:
    """Entries of a folder, by the local file system or by Arrow's for its scheme."""

    def __init__(self, root: str) -> None:
        scheme = root.split(":", 1)[0]
        self.local = scheme == "file"
        if self.local:
            self.prefix = "file:"
            return
        from pyarrow import fs

        self.system, inside = fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", root))
        self.prefix = root[: len(root) - len(inside)]

    def entries(self, folder: str) -> Iterator[tuple[str, bool, float, int]]:
        """Place, whether it is a folder, time and length of what lies in a folder; in no order."""
        if self.local:
            with os.scandir(re.sub("^file:/+", "/", folder)) as found:
                for entry in found:
                    if _shown(entry.name):
                        known = entry.stat()
                        yield self.prefix + entry.path, entry.is_dir(), known.st_mtime, known.st_size
            return
        from pyarrow import fs

        for info in self.system.get_file_info(fs.FileSelector(folder[len(self.prefix) :], recursive=False)):
            if _shown(info.base_name):
                is_dir = info.type == fs.FileType.Directory
                yield self.prefix + info.path, is_dir, info.mtime.timestamp() if info.mtime else 0.0, info.size or 0


@dataclass
class Folder(InputPartition):
    """A folder to list, with what is below it or without."""

    path: str
    deep: bool


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root, self.glob = options["path"], options.get("glob", "*")
        self.recursive = options.get("recursive", "true") == "true"
        self.folders = int(options.get("folders", FOLDERS))

    def partitions(self) -> list[Folder]:
        """Folders are opened until there are enough of them; opened ones are listed without their folders."""
        if not self.recursive:
            return [Folder(self.root, False)]
        store, opened, level = _Store(self.root), [], [self.root]
        while level and len(opened) + len(level) < self.folders:
            below = [place for folder in level for place, is_dir, _, _ in store.entries(folder) if is_dir]
            opened += level
            level = sorted(below)
        return [Folder(f, False) for f in opened] + [Folder(f, True) for f in level]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, pattern, open_, rows = _Store(self.root), glob_pattern(self.glob), [partition.path], []
        while open_:
            for place, is_dir, time, size in store.entries(open_.pop()):
                if is_dir:
                    if partition.deep:
                        open_.append(place)
                elif size and pattern.match(place.rsplit("/", 1)[1]):
                    rows.append((place, int(time * 1000) * 1000, size))
                    if len(rows) == ROWS:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    path, time, size = zip(*rows)
    kinds = (pa.string(), pa.timestamp("us", "UTC"), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip((path, time, size), kinds)], ["path", "modificationTime", "length"])


class FolderListing(DataSource):
    """``spark.read.format("folder_listing")`` with the options ``path``, ``glob``, ``recursive`` and ``folders``."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def list_folders(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True, folders: int = FOLDERS) -> DataFrame | None:
    """``path, modificationTime, length`` of the files below ``root`` whose names match, listed by the executors.

    The driver opens folders level by level until there are ``folders`` of them and holds only
    these; each is then a partition, which lists what is below it in batches. Names that begin
    with a dot, or with an underscore and hold no ``=``, and empty files do not count, as in Spark's
    own sources.
    None if the executors cannot list the file system of ``root``.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = system.makeQualified(place)
    if full.toUri().getScheme() not in LISTED or re.search(r"[*?\[{]", root):
        return None
    if not system.exists(full):
        raise FileNotFoundError(root)
    ship_package(spark)
    spark.dataSource.register(FolderListing)
    options = {"path": full.toString(), "glob": glob, "recursive": str(recursive).lower(), "folders": str(folders)}
    return spark.read.format("folder_listing").options(**options).load()
