"""Log of loads: what was tried, from which file into which table, and how it ended.

The log is a Parquet folder with one sub-folder per load and phase. Writing a phase replaces
just that sub-folder, so a repeated load repeats no log rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import read_or_empty

# Statuses a file can have in the log or in a run's summary.
INTENT = "intent"
REPLAY = "replay"
PROCESSED = "processed"
ALREADY_LOGGED = "already_logged"
NO_CSV = "no_csv"
EMPTY_CSV = "empty_csv"
FAILED = "failed"
SKIPPED = (ALREADY_LOGGED, NO_CSV, EMPTY_CSV)

ROW_SCHEMA = (
    "source string, source_name string, target_table string, status string, n_rows bigint, "
    "n_bytes bigint, error string, loaded_at timestamp"
)
LOG_SCHEMA = f"{ROW_SCHEMA}, load_id string, phase string"
LOG_COLUMNS = [
    "load_id", "source", "source_name", "target_table", "status", "n_rows", "n_bytes", "error", "loaded_at",
]
KEY = ["source", "target_table"]


def pending_files(discovered: DataFrame, log: DataFrame) -> DataFrame:
    """Discovered files that the log does not have as loaded into the same table.

    No broadcast hint: the log grows with the landing area, and its size on disk tells Spark
    which join to take.
    """
    return discovered.join(log.where(F.col("status") == PROCESSED).select(*KEY), KEY, "left_anti")


def already_loaded_files(discovered: DataFrame, log: DataFrame) -> DataFrame:
    """Discovered files that the log has as loaded into the same table."""
    return discovered.join(log.where(F.col("status") == PROCESSED).select(*KEY), KEY, "left_semi")


def due_again(log: DataFrame, after: float, at_most: float = 86_400.0) -> DataFrame:
    """Files whose last try failed, as listed rows, once they have waited long enough: ``after`` seconds, twice as long
    after each further failure, a day at most."""
    last = F.struct("loaded_at", "load_id")
    tried = log.groupBy(*KEY).agg(
        F.max_by("status", last).alias("status"), F.max_by("source_name", last).alias("source_name"),
        F.max_by("n_bytes", last).alias("n_bytes"), F.max("loaded_at").alias("tried_at"),
        F.count_if(F.col("status") == FAILED).alias("n_failed"),
    )
    wait = F.least(F.lit(float(after)) * F.pow(F.lit(2.0), F.col("n_failed") - 1), F.lit(float(at_most)))
    waited = F.current_timestamp().cast("double") - F.col("tried_at").cast("double")
    return tried.where((F.col("status") == FAILED) & (waited >= wait)).select("source", "source_name", "n_bytes", "target_table")


def log_rows(files: DataFrame) -> DataFrame:
    """Files with their outcome as log rows, stamped with the time of the query."""
    return files.withColumn("loaded_at", F.current_timestamp())


def summary_counts(found: Column | int, statuses: DataFrame, logged: Column | int) -> DataFrame:
    """One row: found, processed, skipped, failed, logged. ``statuses`` has one row per file."""
    as_column = lambda value: value if isinstance(value, Column) else F.lit(value)
    return statuses.agg(
        as_column(found).cast("bigint").alias("found"),
        F.count_if(F.col("status") == PROCESSED).alias("processed"),
        F.count_if(F.col("status").isin(*SKIPPED)).alias("skipped"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
        as_column(logged).cast("bigint").alias("logged"),
    )


class LoadLog:
    """The log at a path. One writer per target table is a precondition."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def rows(self) -> DataFrame:
        """Everything in the log, both phases."""
        return read_or_empty(self.spark, self.path, LOG_SCHEMA)

    def outcomes(self) -> DataFrame:
        """Final statuses, one row per file and load."""
        return self.rows().where("phase = 'done'").select(*LOG_COLUMNS)

    def processed(self) -> DataFrame:
        """Files that count as loaded."""
        return self.outcomes().where(F.col("status") == PROCESSED)

    def intents(self, load_id: str) -> DataFrame:
        """Files a load set out to load."""
        return self.spark.read.schema(ROW_SCHEMA).parquet(f"{self.path}/load_id={load_id}/phase={INTENT}")

    def write_intents(self, load_id: str, files: DataFrame) -> None:
        """Record what a load is about to take, before any data is written."""
        rows = files.select(
            "source", "source_name", "target_table", F.lit(INTENT).alias("status"),
            F.lit(None).cast("bigint").alias("n_rows"), "n_bytes", F.lit(None).cast("string").alias("error"),
        )
        self._write(load_id, INTENT, rows)

    def is_announced(self, load_id: str) -> bool:
        """Whether a load wrote its intents before."""
        return not self.rows().where((F.col("load_id") == load_id) & (F.col("phase") == INTENT)).isEmpty()

    def write_replay(self, load_id: str) -> None:
        """Record that an announced load is run again, before its data is replaced."""
        again = self.intents(load_id).drop("loaded_at").withColumn("status", F.lit(REPLAY))
        self._write(load_id, REPLAY, again)

    def replayed(self) -> DataFrame:
        """Loads that were run again, by ``load_id``."""
        return self.rows().where(F.col("phase") == REPLAY).select("load_id").distinct()

    def write_outcomes(self, load_id: str, files: DataFrame) -> None:
        """Record how a load ended; the last step of a load."""
        self._write(load_id, "done", files)

    def _write(self, load_id: str, phase: str, files: DataFrame) -> None:
        rows = log_rows(files).select(*LOG_COLUMNS[1:])
        rows.write.mode("overwrite").parquet(f"{self.path}/load_id={load_id}/phase={phase}")

    def loads(self) -> DataFrame:
        """One row per load with the number of intents and outcomes."""
        return self.rows().groupBy("load_id").agg(
            F.count_if(F.col("phase") == INTENT).alias("intended"),
            F.count_if(F.col("phase") == "done").alias("finished"),
        )

    def state(self) -> tuple[int, list[str]]:
        """Number of loads, and those that did not record how all of their files ended.

        With one writer per table that is the last load at most.
        """
        unfinished = F.when(F.col("finished") < F.col("intended"), F.col("load_id"))
        row = self.loads().agg(
            F.count("*").alias("n"), F.array_sort(F.collect_list(unfinished)).alias("unfinished")
        ).first()
        return row["n"], row["unfinished"]


def fingerprint(files: DataFrame) -> tuple[str, int]:
    """Hash of a list of files that does not depend on their order, and their number."""
    combined = F.bit_xor(F.xxhash64("source", "target_table", "n_bytes"))
    row = files.agg(F.hex(combined).alias("hash"), F.count("*").alias("n")).first()
    return row["hash"], row["n"]
