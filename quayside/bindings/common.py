"""Helpers the bindings share."""

from __future__ import annotations

import itertools
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.tables import ensure_namespace
from quayside.session import scratch_path
from quayside.sources.storage import open_store

ROWS_PER_ARCHIVE = 1_000_000
ROWS_PER_WRITE = 10_000

_landed: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unique_name(prefix: str) -> str:
    """Name no other query uses."""
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def scratch_namespace(spark: SparkSession, prefix: str) -> str:
    """New namespace whose tables lie in the shared scratch folder."""
    name = unique_name(prefix)
    ensure_namespace(spark, name, scratch_path(spark, name))
    return name


def land_archives(named: DataFrame, landing: str) -> None:
    """Write rows with a ``name`` column as zipped CSV files, one archive per name.

    A task writes the archives of its names one after the other, as streams.
    """
    columns = [c for c in named.columns if c != "name"]
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in columns])
    write_archives(named.select("name", F.to_csv(values).alias("line")), ",".join(columns), landing)


def write_archives(lines: DataFrame, header: str, landing: str, ending: str = ".csv") -> None:
    """Zip the ``line`` rows of each ``name`` below a header line; no header, no lines."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(landing)
        store.create_dir(folder, recursive=True)
        rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for name, group in itertools.groupby(rows, key=lambda row: row[0]):
            part = f"{folder}/_{name}.{uuid.uuid4().hex}.part"
            with (
                store.open_output_stream(part) as handle,
                zipfile.ZipFile(handle, "w", zipfile.ZIP_DEFLATED) as archive,
                archive.open(f"{name}{ending}", "w") as member,
            ):
                member.write(f"{header}\n".encode() if header else b"")
                while header and (some := list(itertools.islice(group, ROWS_PER_WRITE))):
                    member.write("".join(f"{line}\n" for _, line in some).encode())
            store.move(part, f"{folder}/{name}.zip")
        yield from ()

    n_tasks = 2 * lines.sparkSession.sparkContext.defaultParallelism
    ordered = lines.repartition(n_tasks, "name").sortWithinPartitions("name", "line")
    ordered.mapInArrow(write, "name string").write.format("noop").mode("overwrite").save()


def with_archive_names(events: DataFrame, group: Column) -> DataFrame:
    """Add the ``name`` of the archive each row goes into: one per group and million rows of it."""
    labelled = events.withColumn("group", group)
    parts = labelled.groupBy("group").agg(F.ceil(F.count("*") / F.lit(ROWS_PER_ARCHIVE)).alias("parts"))
    part = F.pmod(F.col("event_id"), F.col("parts")).cast("string")
    named = labelled.join(parts, "group").withColumn("name", F.concat_ws("_", "group", part))
    return named.drop("group", "parts")


def events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the ``name`` of the archive of its day."""
    return with_archive_names(table(spark, sf_dir, "events"), F.date_format("ts", "'events'_yyyyMMdd"))


def events_landing(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``events`` as zipped CSV files by day; made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        landing = scratch_path(spark, "landing")
        land_archives(events_by_day(spark, sf_dir), landing)
        _landed[key] = landing
    return _landed[key]


# The same archive names in SQL.
EVENT_ARCHIVES_SQL = f"""
  SELECT e.*, 'events_' || strftime(ts, '%Y%m%d') || '_' || CAST(event_id % parts AS VARCHAR) AS archive
  FROM events e
  JOIN (SELECT CAST(ts AS DATE) AS day, CAST(ceil(count(*) / {ROWS_PER_ARCHIVE}.0) AS BIGINT) AS parts
        FROM events GROUP BY 1) d ON CAST(e.ts AS DATE) = d.day
"""
EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"}


def as_events(rows: DataFrame) -> DataFrame:
    """Loaded rows with the column types of ``events``."""
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in EVENT_TYPES.items()])
