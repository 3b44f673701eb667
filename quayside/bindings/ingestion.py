"""Loads: ``events`` delivered as archives and as Parquet files, loaded back into tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.bindings.common import (
    EVENT_ARCHIVES_SQL, EVENT_TYPES, as_events, events_by_day, events_landing, land_archives, scratch_namespace, table,
    unique_name, with_archive_names, write_archives,
)
from quayside.functions import names
from quayside.functions.measures import megabytes
from quayside.operators import audit
from quayside.operators.path_rewrite import write_text_objects
from quayside.operators.top_k import latest
from quayside.plans import load_log
from quayside.plans.archive_load import ARCHIVES, ArchiveLoader, parse_lines
from quayside.plans.loading import Tiers
from quayside.plans.parquet_load import ParquetLoader
from quayside.session import scratch_path
from quayside.sources import archives
from quayside.sources.archives import CsvFormat
from quayside.sources.listing import list_files
from quayside.streaming.archive_stream import start_archive_stream

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
# Days that a first load, and a second one, take of ``events``.
FIRST_UNTIL, LOADED_UNTIL = "2024-01-06", "2024-01-11"

_loaded: dict[tuple, ArchiveLoader] = {}


def _tiers(spark: SparkSession, raw: str) -> Tiers:
    return Tiers.under(scratch_path(spark, "tiers"), raw)


def discover_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, events_landing(spark, sf_dir), ARCHIVES)
    return files.select("source_name", (F.col("n_bytes") > 0).alias("has_bytes")).orderBy("source_name")


def zip_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, events_landing(spark, sf_dir), ARCHIVES).withColumn("target_table", F.lit("events"))
    spread = files.repartition(archives.tasks_for(files))
    lines = archives.scan_archives(spread, CsvFormat())
    return as_events(parse_lines(lines, list(EVENT_TYPES), CsvFormat()).select("record.*"))


def _before(day: str) -> Column:
    return F.col("ts") < F.lit(day).cast("timestamp_ntz")


def loaded_in_part(spark: SparkSession, sf_dir: str) -> ArchiveLoader:
    """Loader that took ``events`` by day in two loads, after which the later days arrived; made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        events, landing = events_by_day(spark, sf_dir), scratch_path(spark, "landing")
        loader = ArchiveLoader(spark, _tiers(spark, landing), table="events")
        land_archives(events.where(_before(FIRST_UNTIL)), landing)
        loader.run()
        land_archives(events.where(~_before(FIRST_UNTIL) & _before(LOADED_UNTIL)), landing)
        loader.run()
        land_archives(events.where(~_before(LOADED_UNTIL)), landing)
        _loaded[key] = loader
    return _loaded[key]


def loaded_whole(spark: SparkSession, sf_dir: str) -> ArchiveLoader:
    """Loader that took all of ``events`` by day in three loads."""
    events, landing = events_by_day(spark, sf_dir), scratch_path(spark, "landing")
    loader = ArchiveLoader(spark, _tiers(spark, landing), table="events")
    for part in (_before(FIRST_UNTIL), ~_before(FIRST_UNTIL) & _before(LOADED_UNTIL), ~_before(LOADED_UNTIL)):
        land_archives(events.where(part), landing)
        loader.run()
    return loader


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = loaded_in_part(spark, sf_dir)
    return load_log.pending_files(loader.discover(), loader.log.outcomes()).select("source_name", "target_table")


def already_loaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = loaded_in_part(spark, sf_dir)
    return load_log.already_loaded_files(loader.discover(), loader.log.outcomes()).select("source_name", "target_table")


def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = audit.commit_history(loaded_whole(spark, sf_dir).log.outcomes())
    number = F.row_number().over(Window.partitionBy("target_table").orderBy("committed_at", "load_id"))
    return history.select(
        "target_table", number.cast("bigint").alias("commit"), "operation", "added_files", "added_records", "total_records"
    )


def latest_total_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = audit.with_summary(audit.commit_history(loaded_whole(spark, sf_dir).log.outcomes()))
    newest = latest(history, ["committed_at", "load_id"])
    return newest.select(F.col("summary")["total-records"].cast("bigint").alias("total_rows"))


def commit_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``events`` in two loads, of which the second stopped after its intents and was run again by the next run."""
    events, landing = events_by_day(spark, sf_dir), scratch_path(spark, "landing")
    loader = ArchiveLoader(spark, _tiers(spark, landing), table="events")
    land_archives(events.where(_before(LOADED_UNTIL)), landing)
    loader.run()
    land_archives(events.where(~_before(LOADED_UNTIL)), landing)
    pending = load_log.pending_files(loader.discover(), loader.log.outcomes())
    loader.log.write_intents(f"L1-{loader.job}-stopped", pending)
    loader.run()
    history = audit.commit_history(loader.log.outcomes(), replayed=loader.log.replayed())
    return history.select("target_table", "operation", "added_files", "added_records", "total_records")


def load_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(spark, _tiers(spark, events_landing(spark, sf_dir)), table="events")
    loader.run()
    return loader.log.outcomes().select(
        "source_name", "target_table", "status", "n_rows", F.col("loaded_at").isNotNull().alias("is_stamped")
    )


def ingest_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(spark, _tiers(spark, events_landing(spark, sf_dir)), table="events")
    loader.run()
    return as_events(loader.table("events"))


def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(spark, _tiers(spark, events_landing(spark, sf_dir)), table="events")
    loader.run()
    name = loader.register(scratch_namespace(spark, "bronze"), "events")
    return spark.sql(f"SELECT event_type, count(*) AS n_events FROM {name} GROUP BY event_type")


def ingest_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    events = table(spark, sf_dir, "events")
    land_archives(with_archive_names(events, F.concat(F.lit("Évents-"), "event_type")), landing)
    loader = ArchiveLoader(spark, _tiers(spark, landing))
    loader.run()
    targets = [row["target_table"] for row in loader.log.processed().select("target_table").distinct().collect()]
    rows = [loader.table(t).select(F.lit(t).alias("target_table"), "event_id") for t in targets]
    kind = F.regexp_replace("target_table", "_[0-9]+$", "").alias("target_table")
    counted = reduce(DataFrame.unionByName, rows).groupBy(kind)
    return counted.agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_events"))


def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents``, whose columns have names that loads use themselves; texts travel in one line."""
    docs = table(spark, sf_dir, "documents")
    landing = scratch_path(spark, "landing")
    named = docs.withColumn("name", F.concat_ws("_", F.lit("documents"), "source", "lang"))
    land_archives(named.withColumn("text", F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")), landing)
    loader = ArchiveLoader(spark, _tiers(spark, landing), table="documents")
    loader.run()
    text = F.coalesce(F.decode(F.unbase64("text"), "UTF-8"), F.lit("")).alias("text")
    loaded = loader.table("documents")
    return loaded.select(*[text if f.name == "text" else F.col(f.name).cast(f.dataType) for f in docs.schema])


def ingest_rerun_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(spark, _tiers(spark, events_landing(spark, sf_dir)), table="events")
    loader.run()
    second_run = loader.run().first()["processed"]
    return loader.table("events").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("event_id").alias("n_events"),
        F.lit(second_run).cast("bigint").alias("second_run"),
    )


def ingest_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_by_day(spark, sf_dir)
    early = _before(LOADED_UNTIL)
    landing = scratch_path(spark, "landing")
    land_archives(events.where(early).drop("props"), landing)
    loader = ArchiveLoader(spark, _tiers(spark, landing), table="events")
    loader.run()
    land_archives(events.where(~early), landing)
    loader.run()
    return as_events(loader.table("events"))


def ingest_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(
        spark, _tiers(spark, events_landing(spark, sf_dir)), CsvFormat.all_text(), table="events"
    )
    loader.run()
    return loader.table("events").select(*EVENT_TYPES)


def ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch_path(spark, "remote")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(raw)
    loader = ParquetLoader(spark, _tiers(spark, raw), "orders")
    loader.run()
    loader.run()
    status = F.regexp_extract("_source", "o_orderstatus=([^/]+)", 1).alias("o_orderstatus")
    return loader.table("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", status
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings with a checkpoint each go into one table; each stream is started twice."""
    events, name = events_by_day(spark, sf_dir), unique_name("events")
    tiers = scratch_path(spark, "tiers")
    for part in (_before(LOADED_UNTIL), ~_before(LOADED_UNTIL)):
        landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
        land_archives(events.where(part), landing)
        loader = ArchiveLoader(spark, Tiers.under(tiers, landing), table="events")
        for _ in range(2):
            start_archive_stream(loader, checkpoint, name).awaitTermination()
    return as_events(loader.table("events"))


def stream_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the archives are no archives when the stream first meets them; mended, they load by the same checkpoint."""
    events, landing = events_by_day(spark, sf_dir), scratch_path(spark, "landing")
    broken = F.dayofmonth("ts") % 3 == 0
    land_archives(events.where(~broken), landing)
    bodies = events.where(broken).groupBy("name").agg(F.lit("not an archive").alias("body"))
    write_text_objects(bodies.select(F.concat("name", F.lit(".zip")).alias("file_path"), "body"), landing, ".zip")
    loader = ArchiveLoader(spark, _tiers(spark, landing), table="events")
    checkpoint, name = scratch_path(spark, "stream"), unique_name("events")
    start_archive_stream(loader, checkpoint, name).awaitTermination()
    land_archives(events.where(broken), landing)
    start_archive_stream(loader, checkpoint, name, retry_after=0).awaitTermination()
    return as_events(loader.table("events"))


def _mixed_landing(spark: SparkSession, sf_dir: str) -> str:
    """``events`` by day, where the archives of some days lack what a load needs."""
    landing = scratch_path(spark, "landing")
    events = events_by_day(spark, sf_dir)
    kind = F.dayofmonth("ts") % 5
    land_archives(events.where(kind > 2), landing)
    lines = events.select("name", F.to_csv(F.struct("event_id")).alias("line"), kind.alias("kind"))
    write_archives(lines.where("kind = 0"), "event_id", landing, ending=".txt")
    write_archives(lines.where("kind = 1").groupBy("name").agg(F.lit("").alias("line")), "", landing)
    broken = lines.where("kind = 2").groupBy("name").agg(F.lit("not an archive").alias("body"))
    write_text_objects(broken.select(F.concat("name", F.lit(".zip")).alias("file_path"), "body"), landing, ".zip")
    return landing


def classify_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _mixed_landing(spark, sf_dir), ARCHIVES).withColumn("target_table", F.lit("events"))
    opened = archives.open_archives(files.repartition(archives.tasks_for(files)), CsvFormat()).where("kind = 'file'")
    size = megabytes(F.col("member_bytes"))
    return opened.select(
        names.base_name(F.col("source")).alias("source_name"), "status", (size >= 0).alias("has_size")
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader = ArchiveLoader(spark, _tiers(spark, _mixed_landing(spark, sf_dir)), table="events")
    runs = [loader.run().withColumn("run", F.lit(number)) for number in (1, 2)]
    return reduce(DataFrame.unionByName, runs)


QUERIES = {
    "discover_archives": discover_archives,
    "zip_csv_scan": zip_csv_scan,
    "pending_files": pending_files,
    "already_loaded_files": already_loaded_files,
    "commit_history": commit_history,
    "latest_total_records": latest_total_records,
    "commit_operations": commit_operations,
    "load_log_rows": load_log_rows,
    "ingest_fan_in": ingest_fan_in,
    "registered_table": registered_table,
    "ingest_fan_out": ingest_fan_out,
    "ingest_documents": ingest_documents,
    "ingest_rerun_idempotent": ingest_rerun_idempotent,
    "ingest_schema_merge": ingest_schema_merge,
    "ingest_all_text": ingest_all_text,
    "ingest_parquet": ingest_parquet,
    "stream_ingest": stream_ingest,
    "stream_retry": stream_retry,
    "classify_archives": classify_archives,
    "run_summary": run_summary,
}

ORACLES = {
    "discover_archives": f"SELECT DISTINCT archive || '.zip' AS source_name, true AS has_bytes FROM ({EVENT_ARCHIVES_SQL})",
    "zip_csv_scan": EVENTS_SQL,
    "pending_files": f"""
        SELECT DISTINCT archive || '.zip' AS source_name, 'events' AS target_table
        FROM ({EVENT_ARCHIVES_SQL}) WHERE ts >= TIMESTAMP '{LOADED_UNTIL} 00:00:00'""",
    "already_loaded_files": f"""
        SELECT DISTINCT archive || '.zip' AS source_name, 'events' AS target_table
        FROM ({EVENT_ARCHIVES_SQL}) WHERE ts < TIMESTAMP '{LOADED_UNTIL} 00:00:00'""",
    "commit_history": f"""
        WITH commits AS (
          SELECT CASE WHEN ts < TIMESTAMP '{FIRST_UNTIL} 00:00:00' THEN 1 WHEN ts < TIMESTAMP '{LOADED_UNTIL} 00:00:00' THEN 2
                      ELSE 3 END AS commit, count(DISTINCT archive) AS added_files, count(*) AS added_records
          FROM ({EVENT_ARCHIVES_SQL}) GROUP BY 1)
        SELECT 'events' AS target_table, CAST(commit AS BIGINT) AS commit, 'append' AS operation, added_files, added_records,
               CAST(sum(added_records) OVER (ORDER BY commit) AS BIGINT) AS total_records
        FROM commits""",
    "latest_total_records": "SELECT count(*) AS total_rows FROM events",
    "commit_operations": f"""
        WITH commits AS (
          SELECT ts >= TIMESTAMP '{LOADED_UNTIL} 00:00:00' AS late, count(DISTINCT archive) AS added_files,
                 count(*) AS added_records
          FROM ({EVENT_ARCHIVES_SQL}) GROUP BY 1)
        SELECT 'events' AS target_table, CASE WHEN late THEN 'replay' ELSE 'append' END AS operation, added_files,
               added_records, CAST(sum(added_records) OVER (ORDER BY late) AS BIGINT) AS total_records
        FROM commits""",
    "load_log_rows": f"""
        SELECT archive || '.zip' AS source_name, 'events' AS target_table, 'processed' AS status,
               count(*) AS n_rows, true AS is_stamped
        FROM ({EVENT_ARCHIVES_SQL}) GROUP BY archive""",
    "ingest_fan_in": EVENTS_SQL,
    "registered_table": "SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type",
    "ingest_fan_out": """
        SELECT 'events_' || event_type AS target_table, count(*) AS n_rows, count(DISTINCT event_id) AS n_events
        FROM events GROUP BY event_type""",
    "ingest_documents": "SELECT * REPLACE (coalesce(text, '') AS text) FROM documents",
    "ingest_rerun_idempotent": """
        SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_events, CAST(0 AS BIGINT) AS second_run FROM events""",
    "ingest_schema_merge": f"""
        SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN ts >= TIMESTAMP '{LOADED_UNTIL} 00:00:00' THEN props END AS props FROM events""",
    "ingest_all_text": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id,
               event_type, CAST(value AS VARCHAR) AS value, props FROM events""",
    "ingest_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus FROM orders",
    "stream_ingest": EVENTS_SQL,
    "stream_retry": EVENTS_SQL,
    "classify_archives": f"""
        SELECT DISTINCT archive || '.zip' AS source_name,
               CASE day(ts) % 5 WHEN 0 THEN 'no_csv' WHEN 1 THEN 'empty_csv' WHEN 2 THEN 'failed'
                                ELSE 'processed' END AS status,
               CASE WHEN day(ts) % 5 IN (1, 3, 4) THEN true END AS has_size
        FROM ({EVENT_ARCHIVES_SQL})""",
    "run_summary": f"""
        SELECT run, count(DISTINCT archive) AS found,
               count(DISTINCT archive) FILTER (run = 1 AND day(ts) % 5 > 2) AS processed,
               count(DISTINCT archive) FILTER (day(ts) % 5 < 2 OR run = 2 AND day(ts) % 5 > 2) AS skipped,
               count(DISTINCT archive) FILTER (day(ts) % 5 = 2) AS failed,
               count(DISTINCT archive) FILTER (day(ts) % 5 > 2) AS logged
        FROM ({EVENT_ARCHIVES_SQL}), (VALUES (1), (2)) r(run) GROUP BY run""",
}
