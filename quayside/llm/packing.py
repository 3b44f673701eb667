"""Packing documents into sequences of bounded length by the sum of squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, slices, spark_schema, texts_of, tidy
from quayside.llm.word_ids import word_ids
from quayside.session import materialize, session_settings

#: Pieces that one task packs together.
GROUP = 4096
#: A sequence of a round is final when at most this share of it is empty; the others are packed again.
MAX_EMPTY = 0.002
#: Rounds before all that is left is final.
MAX_ROUNDS = 6
#: Texts of one Arrow batch, which a task holds on both sides, the JVM in buffers of up to twice its size.
BATCH = 500


def sum_of_squares(lengths: Sequence[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and final fill of the sequence for each length.

    ``count[g]`` is how many open sequences have a gap of g. A piece goes where the sum of the squared
    counts becomes smallest: into a gap g, count[g] falls and count[g - length] rises by one; a new
    sequence adds one to count[size - length]. Full sequences count no more. Among equals the smallest
    gap is taken, and no new sequence while an old one is as good. Longer pieces go first.
    """
    lengths = np.asarray(lengths, np.int64)
    count = np.zeros(size + 1, np.int64)
    open_with: list[list[int]] = [[] for _ in range(size + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0
    gaps: list[int] = []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        gap = -1
        if n < size:
            change = 2 * (count[: size - n] - count[n:size]) + 2
            # The gap that becomes 0 is not counted any more.
            change[0] = 1 - 2 * count[n]
            change[count[n:size] == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if change[best] <= 2 * count[size - n] + 1:
                gap = best + n
        if gap < 0:
            where, gap = made, size
            made += 1
            gaps.append(size)
        else:
            where = open_with[gap].pop()
            count[gap] -= 1
        sequence[k], offset[k] = where, size - gap
        gap -= n
        gaps[where] = gap
        if gap:
            count[gap] += 1
            open_with[gap].append(where)
    fill = size - np.array(gaps, np.int64)
    return sequence, offset, fill[sequence] if len(lengths) else sequence


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids: doc_id, piece, start, length, ids_crc32, and ids (binary) if wanted.

    A document's ids end with ``end_id``; only one longer than ``size`` is cut, and its last piece may be
    shorter. A null or empty text is the end id alone. No shuffle; other columns are not read.
    """
    fields = [("doc_id", docs.schema["doc_id"].dataType), ("piece", T.IntegerType()), ("start", T.LongType()),
              ("length", T.LongType()), ("ids_crc32", T.LongType())]
    schema = spark_schema([*fields, ("ids", T.BinaryType())] if with_ids else fields)
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch):
                rows: dict[str, list] = {name: [] for name in arrow.names}
                keys = part.column("doc_id").to_pylist()
                for key, ids in zip(keys, encoder.encode([t or "" for t in texts_of(part)])):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * size)):
                        own = ids[at : at + 4 * size]
                        values = (key, number, at // 4, len(own) // 4, zlib.crc32(own), own)
                        for name, value in zip(arrow.names, values):
                            rows[name].append(value)
                yield arrow_batch(arrow, rows)

    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)


def _packer(size: int, number: int, last: bool):
    """Packs one group of a round."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        sequence, offset, fill = sum_of_squares(group["length"].to_numpy(), size)
        rows = group["__row"].to_numpy()
        # A sequence is called by its first row, which no other sequence of the round holds, and the round.
        names = np.full(int(sequence.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(names, sequence, rows)
        final = np.full(len(rows), True) if last else size - fill <= MAX_EMPTY * size
        return pd.DataFrame({
            "__row": rows, "length": group["length"], "sequence_id": names[sequence] * 8 + number, "offset": offset, "final": final
        })

    return pack


def pack_pieces(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """Pieces with the sequence_id and the offset in it where each lies; sequences hold at most ``size``.

    Full pieces are sequences of their own. The others are packed in groups of about ``GROUP``, dealt by a
    hash of their row, so that no task grows with the input; whatever lies in sequences that are not
    nearly full goes into fewer groups in the next round, until it fits one. Each round is written.

    Every row is placed once, repeated rows too. No rows, no sequences. Columns named sequence_id or offset
    give way.
    """
    row = F.monotonically_increasing_id()
    with session_settings(pieces.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH)}):
        pieces = materialize(pieces.drop("sequence_id", "offset").withColumn("__row", row), "pieces")
    placed = [pieces.where(F.col("length") >= size).select("__row", (F.col("__row") * 8).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = pieces.where(F.col("length") < size).select("__row", "length")
    schema = "__row long, length long, sequence_id long, offset long, final boolean"
    for number in range(1, MAX_ROUNDS + 1):
        count = rest.count()
        groups = -(-count // GROUP)
        last = groups <= 1 or number == MAX_ROUNDS

        dealt = rest.withColumn("__group", F.pmod(F.xxhash64("__row", F.lit(number)), F.lit(max(1, groups))))
        done = materialize(dealt.groupBy("__group").applyInPandas(_packer(size, number, last), schema), "packed")
        placed.append(done.where("final").select("__row", "sequence_id", "offset"))
        if last:
            break
        rest = done.where("not final").select("__row", "length")
    everything = placed[0]
    for more in placed[1:]:
        everything = everything.unionByName(more)
    return pieces.join(everything, "__row").drop("__row")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (binary) of each sequence, from packed pieces with their ids; at most one sequence each."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda all, part: F.concat(all, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Cut and pack whole documents: one row per piece with its sequence and offset."""
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, size, with_ids), size)
