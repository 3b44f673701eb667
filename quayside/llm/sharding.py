"""Sharding by rendezvous hashing: stable record keys over weighted shards, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import materialize

#: Rows that are numbered together; the numbering's tasks and its one small window follow the row count.
BLOCK = 50_000


def rendezvous(key: Column, shards: Sequence[tuple[int, float]]) -> Column:
    """The shard that draws the lowest exponential time, its weight as rate, from the hash of (key, shard).

    A draw depends on the key and that shard alone. So a new shard takes only the rows for which its own
    draw is lowest, and all others stay where they are; rows follow the weights. A null key is one more key.
    """
    if not shards or any(weight <= 0 for _, weight in shards):
        raise ValueError("shards are needed, each with a positive weight")
    draws = []
    for shard, weight in shards:
        # 52 bits of the hash as a number strictly between 0 and 1.
        uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("long")), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
        draws.append(F.struct((-F.ln(uniform) / F.lit(float(weight))).alias("time"), F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def numbered(rows: DataFrame, group: str, name: str) -> DataFrame:
    """Add a gapless number from 0 within each group, without ever holding a group in one task.

    Rows are written once with their place in the input. Places are cut into blocks of ``BLOCK``; only a
    count per (group, block) is summed up in order, and rows are numbered within their block.
    """
    placed = materialize(rows.withColumn("__place", F.monotonically_increasing_id()), "placed")
    # The upper bits of the place are the input partition, the lower 33 its row.
    partition = F.shiftright("__place", 33)
    block = partition * F.lit(1 << 20) + F.expr(f"(__place & {(1 << 33) - 1}) div {BLOCK}")
    blocked = placed.withColumn("__block", block)
    counts = blocked.groupBy(group, "__block").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("__n").over(earlier)
    starts = counts.select(group, "__block", F.coalesce(before, F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy(group, "__block").orderBy("__place")) - 1
    joined = blocked.withColumn("__within", within).join(starts, [group, "__block"])
    return joined.withColumn(name, (F.col("__start") + F.col("__within")).cast("long")).drop(
        "__place", "__block", "__within", "__start"
    )


def shard_documents(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, grown_weight: float = 1.0, key: str = "doc_id"
) -> DataFrame:
    """Where every document goes: shard, gapless slot in it, and the shard after one more was added.

    The text itself is neither shuffled nor written: only key, size and checksum travel.

    Returns doc_id, size (UTF-8 bytes and 1; null text: 1), text_crc32 (null text: that of no bytes),
    law ("key"), shard, slot, grown_shard. Repeated rows have one row each, in the same shard. A null
    key is a key like others. Empty input gives no rows; other columns are not read.
    """
    shards = [(i, float(w)) for i, w in enumerate(weights)]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), shards).alias("shard"),
        rendezvous(F.col(key), [*shards, (len(shards), float(grown_weight))]).alias("grown_shard"),
    )
    return numbered(rows, "shard", "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * 16, key: str = "doc_id") -> None:
    """Whole documents as Parquet below ``shard=<n>``; hot shards are spread over tasks by the text."""
    shards = [(i, float(w)) for i, w in enumerate(weights)]
    placed = docs.withColumn("shard", rendezvous(F.col(key), shards))
    spread = F.pmod(F.xxhash64(key, "text"), F.lit(64))
    placed.repartition("shard", spread).write.partitionBy("shard").parquet(path)
