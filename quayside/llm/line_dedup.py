"""Line dedup: lines found in many documents stay only in one of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm.common import arrow_batch, attach, bytes_of, packed, rest_field, spark_schema, tidy, unpacked
from quayside.session import materialize

#: Rows of one Arrow batch of line keys.
_ROWS = 50_000


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of a line without white space at its ends, A-Z in lower case; None for a key that is too short."""
    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id and key of each different line of each row."""
    schema = spark_schema([("doc_id", docs.schema["doc_id"].dataType), ("key", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys = [], []
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), bytes_of(batch)):
                found = {line_key(line, min_chars) for line in text.split(b"\n")} - {None}
                keys += found
                ids += [doc] * len(found)
                if len(keys) > _ROWS:
                    yield arrow_batch(arrow, {"doc_id": ids, "key": keys})
                    ids, keys = [], []
        yield arrow_batch(arrow, {"doc_id": ids, "key": keys})

    some = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text")
    return some.mapInArrow(tidy(explode), schema)


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """Documents without the lines that at least ``min_docs`` of them share, but for the largest id that has them.

    Adds n_lines (before) and n_dropped, replaces the text, keeps the other columns. Line keys are written
    once; counting combines per task first, and keys of very many lines are joined by broadcast (``attach``),
    so a line in every document shuffles no more than any other. Only the last join moves texts.

    A null or empty text has one empty line and comes out empty. Rows of one doc_id are one document to the
    count, and each loses its lines; a null doc_id takes no part and keeps all lines. A line that one
    document repeats counts once and goes or stays with all its repeats. No documents, no rows.
    """
    lines = materialize(line_keys(docs, min_chars), "line-keys")
    per_doc = lines.groupBy("doc_id", "key").agg(F.count("*").alias("n"))
    shared = per_doc.groupBy("key").agg(
        F.count("*").alias("n_docs"), F.sum("n").alias("n_rows"), F.max("doc_id").alias("keeper")
    )
    shared = materialize(shared.where(F.col("n_docs") >= min_docs).select("key", "n_rows", "keeper"), "shared-lines")
    gone = attach(lines, shared, ["key"], "n_rows", lines.count()).where(F.col("doc_id") != F.col("keeper"))
    gone = gone.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("key").alias("gone"))

    # Rows without an id match nothing, however many they are; the second key deals them to all tasks. It is no
    # constant on either side, which Spark would take out of the keys.
    dealt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id"))
    gone = gone.withColumn("__part", F.xxhash64("__id"))
    rows = packed(docs, F.col("doc_id").alias("__id"), dealt.alias("__part")).join(gone, ["__id", "__part"], "left")
    rows = rows.select("rest", "text", "gone")
    schema = T.StructType([rest_field(docs), *spark_schema([
        ("text", T.StringType()), ("n_lines", T.LongType()), ("n_dropped", T.LongType())
    ]).fields])
    arrow = to_arrow_schema(schema)

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, dropped = [], [], []
            for text, keys in zip(bytes_of(batch), batch.column("gone").to_pylist()):
                old = (text or b"").split(b"\n")
                keys = set(keys or ())
                new = [line for line in old if line_key(line, min_chars) not in keys] if keys else old
                texts.append(b"\n".join(new))
                before.append(len(old))
                dropped.append(len(old) - len(new))
            made = pa.array(texts, pa.binary()).cast(pa.string())
            rest = batch.column("rest").cast(arrow.field("rest").type)
            yield arrow_batch(arrow, {"rest": rest, "text": made, "n_lines": before, "n_dropped": dropped})

    return unpacked(rows.mapInArrow(tidy(reassemble), schema), docs.columns, ["n_lines", "n_dropped"])
