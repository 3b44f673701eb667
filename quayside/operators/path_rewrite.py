"""Replacing an old address in many text objects, into a new place."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import base_name, literal_pattern
from quayside.session import materialize
from quayside.sources.archives import tasks_for
from quayside.sources.storage import open_store, qualified

#: Bytes of an object that a task holds at a time.
PIECE_BYTES = 8 << 20


def rewrite_paths(frame: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Rows with every ``old`` in the column replaced; the others are passed on as they are."""
    return frame.withColumn(column, replaced(F.col(column), old, new))


def replaced(text: Column, old: str, new: str) -> Column:
    """Text with a literal replaced wherever it occurs."""
    fixed = F.regexp_replace(text, literal_pattern(old), new.replace("\\", "\\\\").replace("$", "\\$"))
    return F.when(text.contains(old), fixed).otherwise(text)


def residual(frame: DataFrame, column: str, old: str) -> DataFrame:
    """One row: in how many rows ``old`` is still found; 0 after a rewrite."""
    return frame.agg(F.count_if(F.col(column).contains(old)).alias("residual"))


def write_text_objects(objects: DataFrame, folder_uri: str, ending: str | None = None, root: str | None = None) -> None:
    """Each ``body`` as an object of its own, in another folder.

    Below ``root``, a folder that the objects were read from, each keeps its whole path (as scans
    give it, URL-encoded); without one it is named like the last part of its ``file_path``, which has to be
    unique. Only names with ``ending`` are written, if one is given. Tasks write their own
    objects; writing one again replaces it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(folder_uri)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                place = f"{folder}/{name}"
                store.create_dir(place.rpartition("/")[0], recursive=True)
                with store.open_output_stream(place) as handle:
                    handle.write(body.encode())
            yield batch.select([0])

    path = F.col("file_path")
    if root is None:
        name = base_name(path)
    else:
        decoded = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
        top = "/" + re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*", "", root).strip("/") + "/"
        below = F.when(F.startswith(decoded, F.lit(top)), F.substring(decoded, len(top) + 1, 1 << 30))
        name = F.coalesce(below, F.raise_error(F.concat(F.lit(f"not below {top}: "), decoded)))
    named = objects.select(name.alias("name"), "body")
    if ending:
        named = named.where(F.col("name").endswith(ending))
    written = named.mapInArrow(write, "name string")
    written.write.format("noop").mode("overwrite").save()


class Replacement:
    """Replaces ``old`` in bytes that come in pieces, leftmost first, also where it lies across pieces; counts what it found."""

    def __init__(self, old: str, new: str):
        if not old:
            raise ValueError("nothing to replace")
        self.old, self.new = old.encode(), new.encode()
        self.found = 0

    def __call__(self, pieces: Iterator[bytes]) -> Iterator[bytes]:
        held = b""
        for piece in pieces:
            parts = (held + piece).split(self.old)
            self.found += len(parts) - 1
            # The end may be the start of one more.
            cut = max(0, len(parts[-1]) - len(self.old) + 1)
            held = parts[-1][cut:]
            parts[-1] = parts[-1][:cut]
            yield self.new.join(parts)
        yield held


def rewrite_objects(
    objects: DataFrame, root: str, folder_uri: str, old: str, new: str,
    connection: Mapping[str, str] | None = None, piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Listed objects (``source``, ``n_bytes``) below ``root`` copied to another folder, each ``old`` in them replaced.

    Gives ``source``, ``target``, ``n_bytes`` as written and ``n_replaced``. Objects go through a task in pieces, so one may be
    larger than memory; the text is UTF-8, and bytes that are not are passed on. Each keeps its path below ``root``; one
    that is not below it fails the job. Writing one again replaces it. The copy is made once, by this call.
    """
    return _through(objects, qualified(objects.sparkSession, root), folder_uri, old, new, connection, piece_bytes)


def count_in_objects(
    objects: DataFrame, old: str, connection: Mapping[str, str] | None = None, piece_bytes: int = PIECE_BYTES
) -> DataFrame:
    """``source`` and ``n_found`` of each listed object: how often ``old`` is in it, read in pieces; 0 after a rewrite to what does not hold ``old``."""
    found = _through(objects, None, None, old, "", connection, piece_bytes)
    return found.select("source", F.col("n_replaced").alias("n_found"))


def _through(
    objects: DataFrame, top: str | None, folder_uri: str | None, old: str, new: str,
    connection: Mapping[str, str] | None, piece_bytes: int,
) -> DataFrame:
    """Each object read through a ``Replacement``, and written if there is a folder; what came of it, as a written frame."""
    schema = pa.schema([("source", pa.string()), ("target", pa.string()), ("n_bytes", pa.int64()), ("n_replaced", pa.int64())])

    def copy(source: str) -> dict:
        replacement, target, n_bytes = Replacement(old, new), None, 0
        store, path = open_store(source, connection)
        # Without a compression, as the stores would guess one by the name.
        with store.open_input_stream(path, compression=None) as handle:
            pieces = replacement(iter(lambda: handle.read(piece_bytes), b""))
            if folder_uri is None:
                n_bytes = sum(map(len, pieces))
            else:
                if not source.startswith(f"{top}/"):
                    raise ValueError(f"not below {top}: {source}")
                target = f"{folder_uri.rstrip('/')}/{source[len(top) + 1:]}"
                there, place = open_store(target, connection)
                there.create_dir(place.rpartition("/")[0], recursive=True)
                with there.open_output_stream(place, compression=None) as out:
                    for piece in pieces:
                        n_bytes += out.write(piece)
        return {"source": source, "target": target, "n_bytes": n_bytes, "n_replaced": replacement.found}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([copy(source) for source in batch.column(0).to_pylist()], schema=schema)

    spread = objects.select("source").repartition(tasks_for(objects))
    return materialize(spread.mapInArrow(run, "source string, target string, n_bytes bigint, n_replaced bigint"), "rewritten-objects")
