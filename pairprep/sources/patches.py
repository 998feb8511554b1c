"""Patch files of any size as a table of their sections, read in byte ranges.

A section begins at a line that starts with a file header and goes on to the next one; what stands in
front of the first header is a section too. A file is cut into ranges of split_bytes: a range gives the sections that begin in it, so it skips to
its first header and reads past its end until the last one is complete. A task has one large range
or several small ones, as Spark deals its own files, and holds no more than a block and one section.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pairprep import constants as C
from pairprep.operators.slices import bounded_batches

HEADER = b"diff --git "
SPLIT_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
# What opening a file counts for, in bytes.
OPEN_BYTES = 64 << 10
# Files that Spark's reader takes apart by their name.
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".passthrough")
# Files that `write_patches` puts in a folder, and the key in their path.
FOLDER_FILES = 4096
FILE_NAME = r"/(-?[0-9]+)-[0-9]+-[0-9]+\.patch$"


@dataclass(frozen=True)
class ByteRange:
    path: str
    start: int
    end: int
    size: int


@dataclass
class Ranges(InputPartition):
    ranges: tuple[ByteRange, ...]


def dealt(ranges: list[ByteRange], split: int, tasks: int) -> list[Ranges]:
    """The ranges in order, to about as many tasks as asked for; a task gets no more than SPLIT_BYTES
    unless a single range is larger."""
    cost = [r.end - r.start + OPEN_BYTES for r in ranges]
    room = max(split + OPEN_BYTES, min(SPLIT_BYTES, sum(cost) // max(tasks, 1)))
    found, held = [[]], 0
    for r, c in zip(ranges, cost):
        if found[-1] and held + c > room:
            found.append([])
            held = 0
        found[-1].append(r)
        held += c
    return [Ranges(tuple(r)) for r in found]


def sections(read, size: int, start: int, end: int, block: int = BLOCK_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of the sections that begin in [start, end) of a file of `size` bytes;
    read(offset, length) gives its bytes."""
    mark = b"\n" + HEADER
    # `held` begins at byte `at`, one earlier than the range, since a line end stands before a header.
    at = done = look = max(start - 1, 0)
    held = bytearray()
    begins = 0 if start == 0 else None
    while True:
        found = held.find(mark, look - at)
        while found < 0 and done < size:
            look = max(look, done - len(mark) + 1)
            keep = look if begins is None else begins
            del held[: keep - at]
            at = keep
            more = read(done, min(block, size - done))
            if not more:
                raise OSError(f"the file ends at {done} of {size} bytes")
            held += more
            done += len(more)
            found = held.find(mark, look - at)
        if begins is not None:
            yield begins, bytes(held[begins - at : len(held) if found < 0 else found + 1])
        if found < 0 or at + found + 1 >= end:
            return
        begins = look = at + found + 1


class PatchSource(DataSource):
    """`spark.read.format("patches")`: path, position and diff of every section below a folder."""

    @classmethod
    def name(cls) -> str:
        return "patches"

    def schema(self) -> str:
        return f"path string, position long, {C.DIFF} string"

    def reader(self, schema) -> DataSourceReader:
        return PatchReader(self.options)


class PatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.tasks = int(options.get("tasks", 1))
        if self.split < 1:
            raise ValueError("splitBytes must be positive")

    def partitions(self) -> list[Ranges]:
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(self.path)
        found = where.get_file_info(fs.FileSelector(root, recursive=True))
        shown = [f for f in found if f.is_file and f.size and not f.base_name.startswith(("_", "."))]
        ranges = [
            ByteRange(f.path, at, min(at + self.split, f.size), f.size)
            for f in sorted(shown, key=lambda f: f.path)
            for at in range(0, f.size, self.split)
        ]
        return dealt(ranges, self.split, self.tasks)

    def read(self, partition: Ranges) -> Iterator[tuple]:
        from pyarrow import fs

        where, _ = fs.FileSystem.from_uri(self.path)
        for r in partition.ranges:
            with where.open_input_file(r.path) as file:
                for position, data in sections(lambda at, n: file.read_at(n, at), r.size, r.start, r.end):
                    yield r.path, position, data.decode("utf-8", "replace")


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def write_patches(df: DataFrame, path: str, key: str = C.KEY, text: str = C.DIFF) -> None:
    """Every row that has a text as a UTF-8 file of its own, ended by a line end; FILE_NAME finds its key.

    The tasks write the files where they stay, FOLDER_FILES to a folder, so nothing is listed or moved
    by the driver when they are done. A file is named by key, task and row: a table that gives a
    repeated task the same rows again, as a stored one does, leaves the same files.
    """
    uri = _uri(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        where, root = fs.FileSystem.from_uri(uri)
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                folder = f"{root}/{task:06d}-{n // FOLDER_FILES:06d}"
                if n % FOLDER_FILES == 0:
                    where.create_dir(folder)
                with where.open_output_stream(f"{folder}/{name}-{task}-{n}.patch") as file:
                    file.write(data.as_buffer())
                    file.write(b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    bounded_batches(df.sparkSession)
    rows = df.where(F.col(text).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("null")), text)
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def read_patch_sections(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, position, diff): the sections of all patch files below a folder, UTF-8; position is the
    byte a section begins at, so the sections of a path by position make its file again. Empty files
    have none; names that begin with a dot or an underscore are left out; bytes that are no UTF-8
    become U+FFFD."""
    spark.dataSource.register(PatchSource)
    uri = _uri(path)
    tasks = spark.sparkContext.defaultParallelism
    return spark.read.format("patches").options(splitBytes=split_bytes, tasks=tasks).load(uri)


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out."""
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


def _listed(uri: str, folder: str):
    """What is in a folder, by its path below the root."""
    from pyarrow import fs

    where, root = fs.FileSystem.from_uri(uri)
    found = where.get_file_info(fs.FileSelector(f"{root}/{folder}" if folder else root))
    return [(f"{folder}/{f.base_name}" if folder else f.base_name, f) for f in found if not _hidden(f.base_name)]


def _folders(spark: SparkSession, uri: str) -> tuple[list[str], int, int, bool]:
    """All folders, how many files they have, what reading those costs, and whether any is packed. Tasks
    list the folders, a level at a time; only folders reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                here = _listed(uri, folder)
                files = [(name, f.size) for name, f in here if f.is_file and f.size]
                rows = [(name, 0, 0, False) for name, f in here if not f.is_file]
                packed = any(name.endswith(PACKED) for name, _ in files)
                rows.append((None, len(files), sum(size + OPEN_BYTES for _, size in files), packed))
                names = ["folder", "files", "cost", "packed"]
                types = [pa.string(), pa.int64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    found, level, files, cost, packed = [], [""], 0, 0, False
    while level:
        found += level
        rows = _dealt_folders(spark, level).mapInArrow(run, "folder string, files long, cost long, packed boolean")
        summed = rows.groupBy("folder").agg(F.sum("files").alias("files"), F.sum("cost").alias("cost"), F.max("packed").alias("packed"))
        level = []
        for row in summed.collect():
            if row.folder is None:
                files, cost, packed = files + row.files, cost + row.cost, packed or row.packed
            else:
                level.append(row.folder)
    return found, files, cost, packed


def _dealt_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    tasks = min(len(folders), 4 * spark.sparkContext.defaultParallelism)
    return spark.createDataFrame(pa.table({"folder": pa.array(folders, pa.string())})).repartition(tasks)


def _as_uri(path: str) -> str:
    """A path as Java writes it in a URI: letters of all languages stay."""

    def escaped(found: re.Match) -> str:
        c = found.group()
        return quote(c, safe="") if c < "\x80" or unicodedata.category(c) in ("Cc", "Zs", "Zl", "Zp") else c

    return re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/]", escaped, path)


def read_whole(spark: SparkSession, path: str) -> DataFrame | None:
    """(path, value) of all files below a folder that are not empty, or None where Spark has to read them:
    where pyarrow knows no folder there, or a file is packed.

    Tasks list the folders and then deal the files out, so the driver does not know them."""
    from pyarrow import fs

    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        full = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    except Py4JJavaError:
        return None
    uri, shown = re.sub("^file:/+", "file:///", full.toASCIIString()), re.sub("^file:/+", "file:/", full.toString()).rstrip("/")
    try:
        where, root = fs.FileSystem.from_uri(uri)
        if where.get_file_info(root).type != fs.FileType.Directory:
            return None
    except (pa.ArrowException, OSError, ImportError):
        return None
    folders, files, cost, packed = _folders(spark, uri)
    if packed:
        return None
    bounded_batches(spark)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [name for name, f in _listed(uri, folder) if f.is_file and f.size]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["name"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as pa
        from pyarrow import fs

        where, root = fs.FileSystem.from_uri(uri)
        paths, texts, held = [], [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with where.open_input_stream(f"{root}/{name}", compression=None) as file:
                    texts.append(file.read())
                paths.append(f"{shown}/{_as_uri(name)}")
                held += len(texts[-1])
                if held >= BLOCK_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "value"])
                    paths, texts, held = [], [], 0
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.binary())], ["path", "value"])

    tasks = max(min(files, max(spark.sparkContext.defaultParallelism, -(-cost // SPLIT_BYTES))), 1)
    dealt = _dealt_folders(spark, folders).mapInArrow(names, "name string").repartition(tasks)
    found = dealt.mapInArrow(read, "path string, value binary")
    return found.select("path", F.col("value").cast("string").alias("value"))
