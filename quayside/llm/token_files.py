"""Token ids as raw files, and a minimal perfect hash index from document key to its place in them."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, slices, spark_schema, texts_of
from quayside.llm.word_ids import tokenizer_of, word_ids
from quayside.session import scratch_path
from quayside.sources.storage import open_store

#: Keys of one perfect hash function, on average.
KEYS_PER_BUCKET = 2048
#: Bits per key that are left at each level of a function.
_GAMMA = 2.0
_FINGERPRINT = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """64 bits, well mixed."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of keys that are given as two 64-bit hashes.

    Each level has a bit for about every half key: keys alone on their bit end there, the others try the
    next level. A key's slot is the number of bits set before its own, so n keys fill 0 .. n - 1.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.starts = np.cumsum([0, *[int(bits.sum()) for bits in levels]])
        self.ranks = [np.cumsum(bits) - bits for bits in levels]

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            salted = _mix(high + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) ^ low
        return (_mix(salted) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        if len(high) and len(np.unique(np.stack([high, low]), axis=1)[0]) != len(high):
            raise ValueError("keys must differ")
        levels = []
        while len(high):
            size = max(8, int(len(high) * _GAMMA))
            place = cls._place(high, low, len(levels), size)
            bits = np.bincount(place, minlength=size) == 1
            levels.append(bits)
            again = ~bits[place]
            high, low = high[again], low[again]
        return cls(levels)

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for some keys that were not built in; a bounded number of steps for each."""
        out = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, bits in enumerate(self.levels):
            place = self._place(high[left], low[left], level, len(bits))
            hit = bits[place]
            out[left[hit]] = self.starts[level] + self.ranks[level][place[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels)], "<u4").tobytes()
        return head + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The function and how many bytes it took."""
        count = int(np.frombuffer(data, "<u4", 1)[0])
        sizes = np.frombuffer(data, "<u4", count, 4).tolist()
        at, levels = 4 + 4 * count, []
        for size in sizes:
            n = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, n, at), count=size).astype(bool))
            at += n
        return cls(levels), at


_PLACE = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u8")])


def pack_bucket(high: np.ndarray, low: np.ndarray, shard: np.ndarray, offset: np.ndarray, n: np.ndarray) -> bytes:
    """A bucket's function, then by slot: fingerprint, shard, first id and number of ids."""
    function = PerfectHash.build(high, low)
    places = np.zeros(len(high), _PLACE)
    slot = function.slots(high, low)
    places["mark"][slot] = (_mix(low) >> _FINGERPRINT).astype(np.uint32)
    for name, values in (("shard", shard), ("offset", offset), ("n", n)):
        places[name][slot] = values
    return function.to_bytes() + places.tobytes()


def find_in_bucket(data: bytes, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys, and which of them are there by their fingerprint."""
    function, at = PerfectHash.from_bytes(data)
    places = np.frombuffer(data, _PLACE, offset=at)
    slot = function.slots(high, low)
    found = slot >= 0
    found[found] = places["mark"][slot[found]] == (_mix(low[found]) >> _FINGERPRINT).astype(np.uint32)
    return places[np.where(found, slot, 0)] if len(places) else np.zeros(len(high), _PLACE), found


@dataclass(frozen=True)
class TokenFiles:
    """Where a written set lies: ``ids-<shard>.bin`` (raw ids of ``width`` bytes), ``shards`` and ``index`` (tables)."""

    path: str
    buckets: int
    width: int


def _hashes(doc_id: str, copy: str) -> list[Column]:
    return [F.xxhash64(doc_id, copy).alias("high"), F.xxhash64(F.lit(1), copy, doc_id).alias("low")]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> TokenFiles:
    """Encode texts, end each with ``end_id``, and write the ids in ascending doc_id order.

    Documents are dealt out by ranges of doc_id; a task encodes its range and streams one raw file of
    little-endian ids (written aside and renamed when whole, so a repeated task does no harm). An id takes
    two bytes if the vocabulary has room in them, else four. Only places go on: (shard, first id, number
    of ids) by key, into a table of perfect hash buckets.

    The key is (doc_id, copy), copy counting rows of one doc_id from 0; a null doc_id is a key before all
    others. A null or empty text is the end id alone. Other columns are not read; no rows, no files.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    kind = docs.schema["doc_id"].dataType
    schema = spark_schema([
        ("doc_id", kind), ("copy", T.LongType()), ("shard", T.IntegerType()), ("offset", T.LongType()), ("n", T.LongType())
    ])
    arrow = to_arrow_schema(schema)
    width = 2 if max(tokenizer_of(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        shard = TaskContext.get().partitionId()
        store, folder = open_store(path)
        store.create_dir(folder, recursive=True)
        part, handle, at, last, copy = f"{folder}/_{uuid.uuid4().hex}.part", None, 0, object(), 0
        for batch in batches:
            for piece in slices(batch):
                rows: dict[str, list] = {name: [] for name in arrow.names}
                keys = piece.column("doc_id").to_pylist()
                for key, ids in zip(keys, encoder.encode([t or "" for t in texts_of(piece)])):
                    handle = handle or store.open_output_stream(part)
                    own = np.append(np.frombuffer(ids, np.uint32), np.uint32(end_id))
                    handle.write(own.astype(f"<u{width}").tobytes())
                    copy = copy + 1 if key == last else 0
                    last, n = key, len(own)
                    for name, value in zip(arrow.names, (key, copy, shard, at, n)):
                        rows[name].append(value)
                    at += n
                yield arrow_batch(arrow, rows)
        if handle:
            handle.close()
            store.move(part, f"{folder}/ids-{shard:08d}.bin")

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(write, schema).write.parquet(f"{path}/places")
    places = spark.read.schema(schema).parquet(f"{path}/places")

    # One row per shard: the ids of all shards before it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = places.groupBy("shard").agg(F.sum("n").alias("n_ids"))
    shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")).write.parquet(f"{path}/shards")

    buckets = places.count() // KEYS_PER_BUCKET + 1

    def build(group: pd.DataFrame) -> pd.DataFrame:
        high, low = (group[c].to_numpy(np.int64).view(np.uint64) for c in ("high", "low"))
        data = pack_bucket(high, low, *(group[c].to_numpy() for c in ("shard", "offset", "n")))
        return pd.DataFrame({"bucket": [group["bucket"].iloc[0]], "data": [data]})

    hashed = places.select(*_hashes("doc_id", "copy"), "shard", "offset", "n")
    hashed = hashed.withColumn("bucket", F.pmod("high", F.lit(buckets)))
    hashed.groupBy("bucket").applyInPandas(build, "bucket long, data binary").write.parquet(f"{path}/index")
    return TokenFiles(path, buckets, width)


def read_by_key(spark: SparkSession, files: TokenFiles, keys: DataFrame) -> DataFrame:
    """Look keys (doc_id, copy) up in the index and read their ids back from the raw files.

    Returns doc_id, copy, start (ids of all documents before it), n and ids (binary, 32-bit little-endian) for the
    keys that are there. Keys meet their bucket by a shuffle, then the places found go to the shard they
    lie in, where the file is read in order of place.
    """
    return _read(spark, files, keys, "ids binary", lambda raw: raw)


def checksums_by_key(spark: SparkSession, files: TokenFiles, keys: DataFrame) -> DataFrame:
    """As ``read_by_key``, with the CRC-32 of the ids (ids_crc32) in their place."""
    return _read(spark, files, keys, "ids_crc32 long", zlib.crc32)


def _read(spark: SparkSession, files: TokenFiles, keys: DataFrame, field: str, use) -> DataFrame:
    kind = keys.schema["doc_id"].dataType
    wanted = keys.select("doc_id", "copy", *_hashes("doc_id", "copy"))
    wanted = wanted.withColumn("bucket", F.pmod("high", F.lit(files.buckets)))
    index = spark.read.schema("bucket long, data binary").parquet(f"{files.path}/index")
    found_schema = spark_schema([
        ("doc_id", kind), ("copy", T.LongType()), ("shard", T.IntegerType()), ("offset", T.LongType()), ("n", T.LongType())
    ])

    def look_up(asked: pa.Table, bucket: pa.Table) -> pa.Table:
        if not asked.num_rows or not bucket.num_rows:
            return to_arrow_schema(found_schema).empty_table()
        high, low = (asked.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
        places, there = find_in_bucket(bucket.column("data")[0].as_py(), high, low)
        columns = [asked.column("doc_id"), asked.column("copy"), *(pa.array(places[c].astype(np.int64)) for c in ("shard", "offset", "n"))]
        table = pa.table(columns, names=found_schema.names).filter(pa.array(there))
        return table.cast(to_arrow_schema(found_schema))

    found = wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(look_up, found_schema)
    shards = spark.read.schema("shard int, start long").parquet(f"{files.path}/shards")
    located = found.join(shards, "shard").repartition("shard").sortWithinPartitions("shard", "offset")
    schema = T.StructType([*spark_schema([
        ("doc_id", kind), ("copy", T.LongType()), ("start", T.LongType()), ("n", T.LongType())
    ]).fields, *T._parse_datatype_string(field).fields])
    arrow = to_arrow_schema(schema)
    path, width, name = files.path, files.width, schema.fields[-1].name

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        shard, handle = None, None
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in arrow.names}
            size = 0
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    if handle:
                        handle.close()
                    shard = row["shard"]
                    handle = store.open_input_file(f"{folder}/ids-{shard:08d}.bin")
                raw = handle.read_at(width * row["n"], width * row["offset"])
                if len(raw) != width * row["n"]:
                    raise OSError(f"shard {shard} ends before {row}")
                raw = np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()
                values = (row["doc_id"], row["copy"], row["start"] + row["offset"], row["n"], use(raw))
                for c, value in zip(arrow.names, values):
                    rows[c].append(value)
                size += len(raw) if name == "ids" else 0
                if size > 8 << 20:
                    yield arrow_batch(arrow, rows)
                    rows, size = {c: [] for c in arrow.names}, 0
            yield arrow_batch(arrow, rows)
        if handle:
            handle.close()

    return located.mapInArrow(read, schema)


def written_keys(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """All keys (doc_id, copy) that were written."""
    return spark.read.parquet(f"{files.path}/places").select("doc_id", "copy")
