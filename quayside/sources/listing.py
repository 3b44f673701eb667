"""File listings as frames, made by tasks; contents are never read for them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quayside.session import materialize
from quayside.sources.storage import open_store, qualified

LISTING_SCHEMA = "source string, source_name string, n_bytes bigint, modified_at timestamp"
_ENTRY_SCHEMA = f"{LISTING_SCHEMA}, is_folder boolean"
_BATCH = 10_000


def name_pattern(glob: str) -> re.Pattern:
    """Regular expression for a file name pattern: ``*``, ``?``, ``[...]`` and ``{a,b}``, case-sensitive."""
    out, open_braces, in_class = [], 0, False
    for c in glob:
        if in_class:
            out.append("^" if c == "!" and out[-1] == "[" else c)
            in_class = c != "]"
        elif c == "[":
            in_class = True
            out.append(c)
        elif c == "{":
            open_braces += 1
            out.append("(?:")
        elif c == "}" and open_braces:
            open_braces -= 1
            out.append(")")
        else:
            out.append({"*": ".*", "?": "."}.get(c) or ("|" if c == "," and open_braces else re.escape(c)))
    return re.compile("".join(out), re.DOTALL)


def is_hidden(name: str) -> bool:
    """Names that Spark's own listings leave out: of writes under way, checksums and marks."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(folder: str, connection: Mapping[str, str]) -> Iterator[dict]:
    """Files and folders of a folder, with times to the millisecond as Spark has them; a file is its own only entry."""
    store, inside = open_store(folder, connection)
    info = store.get_file_info(inside)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(folder)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(inside))
    for entry in found:
        if not is_hidden(entry.base_name):
            yield {
                "source": folder if entry is info else f"{folder.rstrip('/')}/{entry.base_name}", "source_name": entry.base_name,
                "n_bytes": entry.size, "modified_at": entry.mtime_ns and entry.mtime_ns // 1_000_000 * 1000, "is_folder": entry.type == fs.FileType.Directory,
            }


def list_folders(folders: DataFrame, glob: str | None, connection: Mapping[str, str]) -> DataFrame:
    """What lies in the folders (``source``), one task for a share of them: all sub-folders, and the files that match."""
    types = [("source", pa.string()), ("source_name", pa.string()), ("n_bytes", pa.int64()),
             ("modified_at", pa.timestamp("us", "UTC")), ("is_folder", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, schema = name_pattern(glob or "*"), pa.schema(types)
        held: list[dict] = []
        for batch in batches:
            for folder in batch.column("source").to_pylist():
                for entry in _entries(folder, connection):
                    if entry["is_folder"] or pattern.fullmatch(entry["source_name"]):
                        held.append(entry)
                    if len(held) >= _BATCH:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held = []
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    return folders.select("source").mapInArrow(run, _ENTRY_SCHEMA)


def list_files(
    spark: SparkSession, path: str, glob: str | None = None, recursive: bool = False,
    connection: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files under a folder: ``source`` (full path), ``source_name``, ``n_bytes``, ``modified_at``.

    Tasks ask the store, and a level of folders is one round: all folders of a level are listed side by side, and what
    they hold is written to the shared folder. The driver knows the number of folders of a level, never a
    file. A listing is made once, so all that is read from it is of one moment. Hidden names are left out as by
    Spark. The glob is case-sensitive; ``connection`` (endpoint, keys, SSL) holds for this listing alone.
    A path that isn't there fails; an empty folder has no rows.
    """
    cores = spark.sparkContext.defaultParallelism
    folders = spark.createDataFrame([(qualified(spark, path),)], "source string")
    levels, n_folders = [], 1
    while n_folders:
        dealt = folders.repartition(min(n_folders, 8 * cores)) if n_folders > 1 else folders.coalesce(1)
        found = materialize(list_folders(dealt, glob, dict(connection or {})), "listing")
        levels.append(found.where("not is_folder").drop("is_folder"))
        folders = found.where("is_folder").select("source")
        n_folders = folders.count() if recursive else 0
    return reduce(DataFrame.unionByName, levels).coalesce(cores)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; the files below are not listed."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
