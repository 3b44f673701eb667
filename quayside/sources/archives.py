"""Lines of the first CSV member of zip archives.

Archives are opened where the tasks run and read as a stream: neither the archive nor its member
is ever held whole, so neither size is limited. What one deflated member cannot be is split, so
one archive is one task up to the line frame; everything after that is spread by lines.
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import json
import zipfile
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.storage import open_store

READ_BYTES = 8 << 20

BLOCK_SCHEMA = (
    "source string, target_table string, kind string, target_key string, header_key string, "
    "first_line_no bigint, text string, member string, header string, status string, "
    "error string, member_bytes bigint, n_blocks bigint, n_lines bigint"
)


@dataclass(frozen=True)
class CsvFormat:
    """How the delimited text is written."""

    sep: str = ","
    header: bool = True
    infer_schema: bool = True
    encoding: str = "UTF-8"
    decode_errors: str = "strict"
    quote: str = '"'
    escape: str = "\\"
    block_bytes: int = 1 << 20
    connection: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def all_text(cls, **changes) -> CsvFormat:
        """Every column stays text, as for dictionary files in a legacy character set; no byte is refused."""
        return cls(**{"infer_schema": False, "encoding": "windows-1251", "decode_errors": "replace", **changes})


def header_key(columns: list[str]) -> str:
    """Short name for a set of columns in this order; starts with a letter."""
    return "h" + hashlib.md5(json.dumps(columns).encode()).hexdigest()


def target_key(target: str) -> str:
    """Short name for a table; starts with a letter."""
    return "t" + hashlib.md5(target.encode()).hexdigest()


def column_names(fields: list[str]) -> list[str]:
    """Header fields as unique column names, the way Spark's CSV reader makes them.

    A name made so that another field has already, in any case, gets underscores until none has it.
    """
    lowered = [f.lower() for f in fields]
    made = [not f or lowered.count(f.lower()) > 1 for f in fields]
    taken = {low for low, new in zip(lowered, made) if not new}
    names = []
    for i, field in enumerate(fields):
        name = field
        if made[i]:
            name = f"{field}{i}" if field else f"_c{i}"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        names.append(name)
    return names


def text_blocks(stream, encoding: str, errors: str, size: int) -> Iterator[str]:
    """Decoded text, cut at line breaks only; one block is about ``size`` bytes.

    All kinds of line breaks come out as ``\\n``, which is what the JVM splits fastest.
    """
    decoder = codecs.getincrementaldecoder(encoding)(errors)
    pending: list[str] = []
    while raw := stream.read(size):
        text = decoder.decode(raw)
        # A closing \r may be the first half of a \r\n, so it is not a place to cut.
        cut = max(text.rfind("\n"), text.rfind("\r", 0, max(len(text) - 1, 0))) + 1
        if cut:
            yield plain_breaks("".join(pending) + text[:cut])
            pending = []
        pending.append(text[cut:])
    if rest := "".join(pending) + decoder.decode(b"", final=True):
        yield plain_breaks(rest)


def plain_breaks(text: str) -> str:
    """Text with every line break as one character."""
    return text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text


def _take_first_line(blocks: Iterator[str]) -> tuple[str | None, int, str]:
    """First line that is not blank, its number, and what follows it in its block."""
    number = 0
    for block in blocks:
        while block:
            line, _, block = block.partition("\n")
            if line.strip():
                return line, number, block
            number += 1
    return None, number, ""


def open_zip(handle) -> zipfile.ZipFile:
    """Archive behind a store's file handle, read in pieces of ``READ_BYTES``."""
    try:
        return zipfile.ZipFile(io.BufferedReader(handle, READ_BYTES))
    except pa.ArrowInvalid as error:  # what a store says when the file is too short to be one
        raise zipfile.BadZipFile("File is not a zip file") from error


def _read_member(handle, source: str, csv_format: CsvFormat, found: dict) -> Iterator[dict]:
    """Blocks of the first CSV member; what is known about the file is put into ``found``."""
    with open_zip(handle) as archive:
        member = next((m for m in archive.infolist() if m.filename.lower().endswith(".csv")), None)
        if member is None:
            found["status"] = "no_csv"
            return
        found.update(member=member.filename, member_bytes=member.file_size)
        encoding = csv_format.encoding
        if codecs.lookup(encoding).name == "utf-8":
            encoding = "utf-8-sig"
        with archive.open(member) as stream:
            blocks = text_blocks(stream, encoding, csv_format.decode_errors, csv_format.block_bytes)
            first, number, rest = _take_first_line(blocks)
            if first is None:
                found["status"] = "empty_csv"
                return
            fields = next(csv.reader([first], delimiter=csv_format.sep, quotechar=csv_format.quote,
                                     escapechar=csv_format.escape or None))
            if csv_format.header:
                columns = column_names(fields)
                number += 1
            else:
                columns = [f"_c{i}" for i in range(len(fields))]
                rest = f"{first}\n{rest}"
            found.update(header=json.dumps(columns), header_key=header_key(columns))
            if rest:
                yield {"first_line_no": number, "text": rest}
                number += rest.count("\n")
            for block in blocks:
                yield {"first_line_no": number, "text": block}
                number += block.count("\n")
            found["status"] = "processed"


def read_archive(source: str, csv_format: CsvFormat) -> Iterator[dict]:
    """Rows of one archive: its blocks, then one row about the file. Never raises for a bad file."""
    found: dict = {}
    n_blocks = n_lines = 0
    try:
        store, path = open_store(source, csv_format.connection)
        with store.open_input_file(path) as handle:
            for block in _read_member(handle, source, csv_format, found):
                yield {"kind": "line", "header_key": found["header_key"], "member": found["member"], **block}
                n_blocks += 1
                n_lines += sum(1 for line in block["text"].split("\n") if line.strip(" "))
    except Exception as error:  # one bad archive must not stop the others
        found.update(status="failed", error=f"{type(error).__name__}: {error}")
    yield {"kind": "file", "n_blocks": n_blocks, "n_lines": n_lines, **found, "header_key": "all"}


def open_archives(sources: DataFrame, csv_format: CsvFormat) -> DataFrame:
    """Blocks and file rows of the archives in ``sources`` (``source``, ``target_table``)."""
    block_type = T.StructType.fromDDL(BLOCK_SCHEMA)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [
            pa.field(f.name, pa.int64() if f.dataType.typeName() == "long" else pa.string())
            for f in block_type
        ]
        schema = pa.schema(fields)
        for batch in batches:
            for row in batch.to_pylist():
                known = {
                    "source": row["source"],
                    "target_table": row["target_table"],
                    "target_key": target_key(row["target_table"]),
                }
                for block in read_archive(row["source"], csv_format):
                    yield pa.RecordBatch.from_pylist([{**known, **block}], schema=schema)

    return sources.select("source", "target_table").mapInArrow(read, BLOCK_SCHEMA)


def split_lines(blocks: DataFrame) -> DataFrame:
    """One row per line that is not blank, next to the file rows (``line`` is NULL there)."""
    pieces = F.posexplode_outer(F.split("text", "\n")).alias("offset", "line")
    kept = [c for c in blocks.columns if c not in ("text", "first_line_no")]
    return (
        blocks.select(*kept, "first_line_no", pieces)
        .where((F.col("kind") == "file") | (F.trim("line") != ""))
        .select(*kept, (F.col("first_line_no") + F.col("offset")).alias("line_no"), "line")
    )


def tasks_for(sources: DataFrame, bytes_per_task: int = 128 << 20) -> int:
    """Number of tasks to open the archives with: one per archive, fewer when they are small."""
    spark = sources.sparkSession
    n_files, n_bytes = sources.agg(F.count("*"), F.sum("n_bytes")).first()
    by_size = -(-(n_bytes or 0) // bytes_per_task)
    return max(1, min(n_files, max(by_size, 2 * spark.sparkContext.defaultParallelism)))


def scan_archives(sources: DataFrame, csv_format: CsvFormat) -> DataFrame:
    """Lines ``(source, member, line_no, line)`` of listed archives; the header line is line 0.

    A member that turns out to be damaged part way has given some lines by then. Loads leave
    those out by the file's status, which needs the whole scan first.
    """
    opened = open_archives(sources, csv_format).where("kind = 'line'")
    return split_lines(opened).select("source", "member", "line_no", "line")
