"""What the operators share: joins that survive hot keys, packed rows, Arrow output."""

from __future__ import annotations

import contextlib
import ctypes
import inspect
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is hot when it holds over 1 / SPREAD of all rows, so there are never more than SPREAD of them.
SPREAD = 4096

#: The white space of the contracts, as in ``[\x20\x09-\x0D]``; what ``bytes.split()`` and ``bytes.strip()`` take.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def attach(rows: DataFrame, keys: DataFrame, on: Sequence[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` with ``keys``, one row per key, when some keys may hold a large part of ``rows``.

    ``size`` of ``keys`` is how many of the ``total`` rows each key holds. Hot keys, at most
    ``SPREAD`` by their definition, are broadcast and their rows stay where they are; the others
    are joined by a shuffle in which no key has more than its 1 / SPREAD. ``keys`` must be written
    (it is read three times) and of narrow rows, and the keys in ``rows`` not null.
    """
    hot = F.col(size) * F.lit(SPREAD) > F.lit(total)
    few = keys.where(hot)
    stay = rows.join(F.broadcast(few), list(on))
    move = rows.join(F.broadcast(few.select(*on)), list(on), "left_anti").join(keys.where(~hot), list(on), how)
    return stay.unionByName(move)


def salted(rows: DataFrame, keys: DataFrame, on: Sequence[str], by: str, salts: int = 16, hint: str | None = None) -> DataFrame:
    """Join many ``rows`` with far fewer ``keys``, one row per key; each key's rows are dealt to ``salts`` places by ``by``.

    Keys are repeated for each place. What a key still holds too much of, adaptive execution splits. ``hint`` names a
    join, where the size of the keys before they are repeated tells too little.
    """
    placed = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    repeated = keys.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return placed.join(repeated.hint(hint) if hint else repeated, [*on, "__salt"]).drop("__salt")


def release() -> None:
    """Give memory that this process holds but no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A function of batches that gives the memory of its task back to the system, as workers go on to other stages."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """The same for a function of a group's table, or of the two tables of a pair of groups: after each of them."""

    def alone(table: pa.Table) -> pa.Table:
        made = run(table)
        release()
        return made

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        made = run(left, right)
        release()
        return made

    # Spark counts the arguments.
    return alone if len(inspect.signature(run).parameters) == 1 else pair


class Bits:
    """A set of whole numbers by their low bits: what was put in is found, and a few others with it.

    Made in tasks by Spark's own bitmaps, so the driver and each task get ``size`` / 8 bytes, 32 MB at most: beyond
    that more others are found, which costs time only.
    """

    LEAST, MOST = 1 << 20, 1 << 28

    def __init__(self, rows: DataFrame, number: Column, n: int):
        """Of ``n`` rows the column ``number`` (long)."""
        self.size = min(self.MOST, max(self.LEAST, 1 << (16 * n).bit_length()))
        place = (number.bitwiseAND(F.lit(self.size - 1)) + 1).alias("place")
        maps = rows.select(place).groupBy(F.bitmap_bucket_number("place").alias("at")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
        )
        whole = np.zeros(self.size // 8, np.uint8)
        # At most 8,192 maps of 4 KB; in one job, as an iterator would run one for each partition.
        found = maps.toArrow()
        for at, bits in zip(found.column("at").to_numpy(), found.column("bits")):
            whole[(at - 1) * 4096 :][: 4096] = np.frombuffer(bits.as_buffer(), np.uint8)
        self._shared = rows.sparkSession.sparkContext.broadcast(whole)

    def has(self, numbers: np.ndarray) -> np.ndarray:
        """Which of the numbers (signed or not) may be in the set; for use in tasks."""
        at = numbers.view(np.uint64) & np.uint64(self.size - 1)
        return (self._shared.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def packed(docs: DataFrame, *extra: Column) -> DataFrame:
    """``rest`` (all columns but the text), ``text`` and what else is named: no clash with names used in between."""
    rest = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns if c != "text"])
    return docs.select(rest.alias("rest"), F.col("text").alias("text"), *extra)


def unpacked(frame: DataFrame, columns: Sequence[str], results: Iterable[str] = ()) -> DataFrame:
    """The documents' columns in their order, then the results; an old column gives way to a result of its name."""
    results = list(results)
    old = [F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in columns if c not in results]
    return frame.select(*old, *results)


def rest_field(docs: DataFrame) -> T.StructField:
    """The field that ``packed`` makes."""
    return T.StructField("rest", T.StructType([f for f in docs.schema.fields if f.name != "text"]))


def arrow_batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A batch from lists, arrays or numpy arrays by name."""
    made = []
    for field in schema:
        values = columns[field.name]
        made.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(made, schema=schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(name).to_pylist()


def bytes_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """The UTF-8 of a text column."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()


def spark_schema(fields: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def slices(batch: pa.RecordBatch, name: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of text, a row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    ends = np.flatnonzero(np.diff(np.cumsum(sizes) // most, append=-1)) + 1
    start = 0
    for end in ends.tolist():
        yield batch.slice(start, end - start)
        start = end


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Neighbouring rows of equal keys, from batches that are sorted by them; holds one run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            part = batch.slice(start, end - start)
            key = tuple(part.column(k)[0].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield pa.Table.from_batches(held)
