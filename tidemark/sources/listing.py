"""Files below a folder, listed and opened by the tasks themselves.

Spark's own listing passes over every name that starts with ``_`` or ``.`` and every empty file. A
snapshot must not vanish for its name, so folders are listed level by level: each level is a table of folders
whose tasks list them, written before the next one. No list of paths passes the driver.
"""

from __future__ import annotations

import io
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.stores import Stores, qualified, stores_of
from tidemark.staging import Stage

_ENTRY_SCHEMA = "path STRING, relative STRING, length BIGINT, is_folder BOOLEAN"
_NAMES = ["path", "relative", "length", "is_folder"]
_ENTRIES_PER_BATCH = 4096
_BYTES_PER_TASK = 64 << 20
_BUFFER = 1 << 20


def read_bytes(stores: Stores, uri: str) -> bytes:
    system, path = stores.located(uri)
    with system.open_input_file(path) as stream:
        return stream.read()


def open_ranges(stores: Stores, uri: str, buffer: int = _BUFFER) -> io.BufferedReader:
    """The file as a stream that reads the ranges it is asked for."""
    system, path = stores.located(uri)
    return io.BufferedReader(system.open_input_file(path), buffer)


def _entries(stores: Stores, path: str, relative: str) -> Iterator[tuple[str, str, int, bool]]:
    """Path, path below the input folder, length and whether it is a folder, of what a folder holds.

    Folders of the operating system are read entry by entry. Arrow's stores give the entries of one folder at once.
    """
    before = f"{relative}/" if relative else ""
    if stores.is_local(path):
        with os.scandir(stores.located(path)[1]) as entries:
            for entry in entries:
                folder = entry.is_dir()
                yield f"{path}/{entry.name}", before + entry.name, 0 if folder else _length(entry), folder
        return
    from pyarrow import fs

    system, inside = stores.located(path)
    for info in system.get_file_info(fs.FileSelector(inside)):
        yield f"{path}/{info.base_name}", before + info.base_name, info.size or 0, info.type == fs.FileType.Directory


def _length(entry: os.DirEntry) -> int:
    try:
        return entry.stat().st_size
    except FileNotFoundError:  # a link to nothing; opening it will say so
        return 0


def _batches(entries: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for entry in entries:
        block.append(entry)
        if len(block) == _ENTRIES_PER_BATCH:
            yield _batch(block)
            block = []
    yield _batch(block)


def _batch(block: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*block, strict=True)) or [[]] * 4
    kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)


def folder_lister(stores: Stores) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Entries of the folders in (path, relative) batches, some thousand at a time."""

    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, relative in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield from _batches(_entries(stores, path, relative))

    return list_folders


def list_folder(spark: SparkSession, folder: str, stage: Stage | None = None) -> DataFrame:
    """``path``, ``relative`` (path below the folder) and ``length`` of every file below ``folder``."""
    from pyarrow import fs

    stage, root, stores = stage or Stage(spark), qualified(spark, folder), stores_of(spark)
    system, inside = stores.located(root)
    if system.get_file_info(inside).type != fs.FileType.Directory:
        raise FileNotFoundError(f"Input folder not found: {folder}")
    found, depth = None, 0
    folders = spark.createDataFrame([(root, "")], "path STRING, relative STRING")
    while True:
        level = stage.write(folders.mapInArrow(folder_lister(stores), _ENTRY_SCHEMA), f"listed-{depth}")
        files = level.filter(~F.col("is_folder")).drop("is_folder")
        found, depth = files if found is None else found.unionByName(files), depth + 1
        folders = level.filter("is_folder").select("path", "relative")
        count = folders.count()
        if not count:
            return found
        folders = folders.repartition(min(count, 4 * spark.sparkContext.defaultParallelism))


def spread(files: DataFrame) -> DataFrame:
    """The files dealt to tasks: as many as there are cores, more where the files are large."""
    count, length = files.agg(F.count(F.lit(1)), F.sum("length")).first()
    tasks = max(files.sparkSession.sparkContext.defaultParallelism, (length or 0) // _BYTES_PER_TASK)
    return files.repartition(max(1, min(count, tasks)))


def matching(path_below, patterns: Iterable[str]):
    """Whether a path below the folder fits a pattern; a pattern may start at any folder."""
    return path_below.rlike(rf"^(?:.*/)?(?:{'|'.join(map(pattern_regex, patterns))})\z")


def pattern_regex(pattern: str) -> str:
    """Regular expression of a glob: ``*`` and ``?`` stay within a name, ``**`` crosses folders."""
    parts = []
    for name in pattern.strip("/").split("/"):
        parts.append("(?:[^/]+/)*" if name == "**" else _name_regex(name) + "/")
    return "".join(parts).removesuffix("/")


def _name_regex(name: str) -> str:
    regex, i = [], 0
    while i < len(name):
        char, i = name[i], i + 1
        end = name.find("]", i + 1 + (name[i : i + 1] == "!"))
        if char == "[" and end > 0:
            body, i = name[i:end].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&"), end + 1
            regex.append(f"[^/{body[1:]}]" if body[0] == "!" else f"[{body}]".replace("[^", "[\\^"))
        else:
            regex.append({"*": "[^/]*", "?": "[^/]"}.get(char) or _quoted(char))
    return "".join(regex)


def _quoted(char: str) -> str:
    return char if char.isalnum() or not char.isascii() else f"\\x{ord(char):02x}"
