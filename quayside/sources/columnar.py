"""Parquet by path, tables by name, and what the files say about themselves."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sources.storage import open_store

FOOTER_SCHEMA = "source string, status string, error string, n_rows bigint, layout string"


def read_parquet(
    spark: SparkSession,
    paths: str | list[str],
    connection: Mapping[str, str] | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Parquet scan; ``connection`` (endpoint, keys, SSL) holds for this read alone."""
    reader = spark.read.options(**(connection or {})).option("mergeSchema", merge_schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def read_footers(sources: DataFrame, connection: Mapping[str, str] | None = None) -> DataFrame:
    """Row count and column layout of each listed Parquet file; unreadable files are ``failed``.

    Only footers are read, in the tasks, so one damaged file is told apart without a failed job.
    """
    connection = dict(connection or {})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("source", pa.string()), ("status", pa.string()), ("error", pa.string()),
             ("n_rows", pa.int64()), ("layout", pa.string())]
        )
        for batch in batches:
            rows = []
            for source in batch.column(0).to_pylist():
                row = {"source": source, "status": "processed"}
                try:
                    store, path = open_store(source, connection)
                    with store.open_input_file(path) as handle:
                        footer = pq.ParquetFile(handle)
                        layout = [[f.name, str(f.type)] for f in footer.schema_arrow]
                        row.update(n_rows=footer.metadata.num_rows, layout=json.dumps(layout))
                except Exception as error:  # one bad file must not stop the others
                    row.update(status="failed", error=f"{type(error).__name__}: {error}")
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return sources.select("source").mapInArrow(read, FOOTER_SCHEMA)


def data_files(frame: DataFrame) -> DataFrame:
    """Rows and bytes of each file behind a frame that was read from files."""
    return (
        frame.select(
            F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")
        )
        .groupBy("file_path")
        .agg(F.count("*").alias("record_count"), F.max("file_size").alias("file_size_in_bytes"))
    )
