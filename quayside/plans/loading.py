"""What all loads share: tiers, run order, replay, table layout, summary.

A load writes, in this order: its intents to the log, its data below ``load_id=<id>`` of the
target, its outcomes to the log. A load that stopped in between is run again with its own file
list and id, and replaces what it had written.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators import tables
from quayside.plans import load_log
from quayside.plans.load_log import LoadLog
from quayside.session import materialize
from quayside.sources.delimited import quote

SOURCE_COLUMN = "_source"
# Columns that a table has of its own; a file that brings one fails, and no other.
RESERVED_COLUMNS = (SOURCE_COLUMN, "load_id")
# Beside the tables' folders in a warehouse; no table may take the name.
LOG_FOLDER = "_load_log"
PARALLEL_TABLES = 8


@dataclass(frozen=True)
class Tiers:
    """The three storage areas."""

    raw: str
    stage: str
    warehouse: str

    @classmethod
    def under(cls, root: str, raw: str | None = None) -> Tiers:
        """The three areas as sub-folders of one."""
        return cls(raw or f"{root}/raw", f"{root}/stage", f"{root}/warehouse")


class Loader:
    """Incremental, replay-safe load of a raw area into tables."""

    def __init__(self, spark: SparkSession, tiers: Tiers, merge_schema: bool = True, log_path: str | None = None):
        self.spark = spark
        self.tiers = tiers
        self.merge_schema = merge_schema
        self.job = ""
        self.log = LoadLog(spark, log_path or f"{tiers.warehouse}/{LOG_FOLDER}")

    def name_job(self, *settings) -> None:
        """Mark of the settings that decide what a load writes; loads carry it, and only their own job replays them."""
        described = json.dumps([type(self).__name__, self.merge_schema, *settings])
        self.job = hashlib.md5(described.encode()).hexdigest()

    @staticmethod
    def check_target(target: str) -> None:
        if target == LOG_FOLDER or not target:
            raise ValueError(f"{target!r} cannot be a table")

    # What a kind of file has to say.

    def discover(self) -> DataFrame:
        """Listed files with their ``target_table``."""
        raise NotImplementedError

    def load_files(self, load_id: str, files: DataFrame) -> DataFrame:
        """Write the data of a load; give back ``source, target_table, status, error, n_rows``."""
        raise NotImplementedError

    def portions(self, load_id: str, pending: DataFrame, n_pending: int) -> Iterator[tuple[str, DataFrame]]:
        """Loads to take the pending files in; one, unless a kind of file needs more."""
        if n_pending:
            yield load_id, pending

    # The run.

    def run(self) -> DataFrame:
        """Load what is new. One row: found, processed, skipped, failed, logged."""
        n_loads, unfinished = self.log.state()
        done = [self.replay(load_id) for load_id in unfinished if f"-{self.job}-" in load_id]
        discovered = self.discover()
        found = discovered.count()
        if not found:
            return self.summary(0, done, 0)
        logged = self.log.outcomes()
        pending = load_log.pending_files(discovered, logged)
        combined, n_pending = load_log.fingerprint(pending)
        already = found - n_pending
        if done:  # what was just run again counts as processed, not as skipped
            before = logged.where(~F.col("load_id").isin(done))
            already = load_log.already_loaded_files(discovered, before).count()
        for load_id, part in self.portions(f"L{n_loads}-{self.job}-{combined}", pending, n_pending):
            self.log.write_intents(load_id, part)
            done.append(self.load(load_id))
        return self.summary(found, done, already)

    def retry_failed(self, after: float) -> str | None:
        """Load again what failed and has waited for ``after`` seconds or, after more failures, longer; the load's id, if any."""
        again = materialize(load_log.due_again(self.log.outcomes(), after), "again")
        combined, n_files = load_log.fingerprint(again)
        if not n_files:
            return None
        load_id = f"L{self.log.state()[0]}-{self.job}-{combined}"
        self.log.write_intents(load_id, again)
        return self.load(load_id)

    def replay(self, load_id: str) -> str:
        """Run an announced load again; the log tells it from one that ran through."""
        self.log.write_replay(load_id)
        return self.load(load_id)

    def load(self, load_id: str) -> str:
        """Run, or run again, one announced load."""
        intents = self.log.intents(load_id)
        others = self.log.outcomes().where(F.col("load_id") != load_id)
        # What another load has put into the same table meanwhile is not put there twice.
        outcomes = self.load_files(load_id, load_log.pending_files(intents, others))
        named = intents.select("source", "source_name", "target_table", "n_bytes")
        ended = named.join(outcomes, load_log.KEY, "left")
        self.log.write_outcomes(load_id, ended.fillna({"status": load_log.ALREADY_LOGGED, "n_rows": 0}))
        return load_id

    def summary(self, found: int, load_ids: Iterable[str], already: int) -> DataFrame:
        """Counts of a run; ``logged`` is all that was ever loaded."""
        statuses = self.log.outcomes().where(F.col("load_id").isin(*load_ids)).select("status")
        logged = self.log.processed().count()
        counts = load_log.summary_counts(found, statuses, logged)
        return counts.withColumn("skipped", F.col("skipped") + F.lit(already))

    # Tables.

    def table_path(self, target: str) -> str:
        """Folder of a target table."""
        return f"{self.tiers.warehouse}/{target}"

    def latest_loads(self, but: str | None = None) -> dict[str, str]:
        """Latest load of each table; a load that is run again must not ask itself, so it is left out."""
        loads = self.log.processed().where(F.lit(True) if but is None else F.col("load_id") != but)
        latest = F.max_by("load_id", F.struct("loaded_at", "load_id"))
        return {r["target_table"]: r["load_id"] for r in
                loads.groupBy("target_table").agg(latest.alias("load_id")).collect()}

    def load_schema(self, target: str, load_id: str | None) -> T.StructType | None:
        """Columns of a table as a load wrote them, without the partition column."""
        if load_id is None:
            return None
        return self.spark.read.parquet(f"{self.table_path(target)}/load_id={load_id}").schema

    def table_schema(self, target: str) -> T.StructType | None:
        """Columns of a table so far; None when there is none.

        Every load writes all columns the table has by then, so its latest load tells.
        """
        return self.load_schema(target, self.latest_loads().get(target))

    def table(self, target: str) -> DataFrame:
        """Rows of a table; only loads whose outcome is logged are seen."""
        schema = self.table_schema(target)
        if schema is None:
            raise ValueError(f"nothing was loaded into {target}")
        schema = T.StructType([*schema, T.StructField("load_id", T.StringType())])
        rows = self.spark.read.schema(schema).parquet(self.table_path(target))
        loads = self.log.processed().where(F.col("target_table") == target)
        return rows.join(loads.select("load_id").distinct(), "load_id", "left_semi")

    def register(self, namespace: str, target: str) -> str:
        """Make a table known to the catalog under ``namespace``; gives back its full name.

        Only loads whose outcome is logged become partitions, so readers by name never see a load
        that is still being written. To be called again after a run; no data is touched.
        """
        schema = self.table_schema(target)
        if schema is None:
            raise ValueError(f"nothing was loaded into {target}")
        name = f"{namespace}.{target}"
        tables.ensure_namespace(self.spark, namespace)
        tables.drop_table(self.spark, name)
        tables.create_external(self.spark, name, schema, "load_id", self.table_path(target))
        loads = self.log.processed().where(F.col("target_table") == target).select("load_id").distinct()
        tables.add_partitions(self.spark, name, "load_id", [row["load_id"] for row in loads.collect()])
        return name

    def write_table(self, load_id: str, target: str, rows: DataFrame) -> None:
        """Put a load's rows in place; doing it again replaces them."""
        rows.write.mode("overwrite").parquet(f"{self.table_path(target)}/load_id={load_id}")


def reserved(columns: Iterable[str]) -> list[str]:
    """Names among the columns that tables have of their own."""
    return [c for c in columns if c.lower() in RESERVED_COLUMNS]


def apart_from_log(target: Column, mark: Column) -> Column:
    """The table name, with a mark where it would be the log's folder."""
    return F.when(target == LOG_FOLDER, F.concat_ws("_", target, mark)).otherwise(target)


def for_each_table(work: Callable, arguments: Iterable[tuple]) -> list:
    """Start the jobs of several target tables side by side."""
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        return list(pool.map(lambda values: work(*values), arguments))


def merged_columns(existing: list[str], layouts: Iterable[list[str]]) -> list[str]:
    """Columns of a table, then new ones in the order they are met; case does not tell apart."""
    columns = {name.lower(): name for name in existing}
    for layout in layouts:
        for name in layout:
            columns.setdefault(name.lower(), name)
    return list(columns.values())


def pick(columns: list[str], layout: list[str], source: str | None = None) -> list[Column]:
    """Select list giving ``columns`` from a frame with ``layout``; missing ones are NULL text."""
    has = {name.lower(): name for name in layout}
    prefix = f"{source}." if source else ""
    return [
        (F.col(prefix + quote(has[c.lower()])) if c.lower() in has else F.lit(None).cast("string")).alias(c)
        for c in columns
    ]


def without(rows: DataFrame, sources: DataFrame, column: str = "source") -> DataFrame:
    """Rows of all but the given sources. Their number decides the join, so no hint is given."""
    return rows.join(sources.select(F.col("source").alias(column)), column, "left_anti")
