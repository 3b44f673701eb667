"""Parquet files of a remote area into one table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.plans import load_log
from quayside.plans.loading import SOURCE_COLUMN, Loader, Tiers, merged_columns, reserved
from quayside.session import materialize, read_or_empty, scratch_path
from quayside.sources.archives import tasks_for
from quayside.sources.columnar import read_footers, read_parquet
from quayside.sources.delimited import quote
from quayside.sources.listing import list_files

FILES_PER_LOAD = 20_000
INTEGERS = ("tinyint", "smallint", "int", "bigint")
REALS = ("float", "double")


class ParquetLoader(Loader):
    """Load of all ``*.parquet`` below the raw area, with the connection options of that area.

    File paths have to pass through the driver to be read by Spark, so many files are taken in
    several loads of at most about ``files_per_load`` each; together they take all of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        tiers: Tiers,
        table: str,
        connection: Mapping[str, str] | None = None,
        merge_schema: bool = True,
        log_path: str | None = None,
        files_per_load: int = FILES_PER_LOAD,
    ):
        super().__init__(spark, tiers, merge_schema, log_path)
        self.target = table
        self.connection = connection
        self.files_per_load = files_per_load
        self.check_target(table)
        self.name_job()

    def discover(self) -> DataFrame:
        files = list_files(self.spark, self.tiers.raw, "*.parquet", recursive=True, connection=self.connection)
        return files.withColumn("target_table", F.lit(self.target))

    def portions(self, load_id: str, pending: DataFrame, n_pending: int) -> Iterator[tuple[str, DataFrame]]:
        n = -(-n_pending // self.files_per_load)
        if n:
            # Written once, apart by portion, so that no portion repeats the listing and the look into the log.
            dealt = pending.withColumn("portion", F.pmod(F.xxhash64("source"), F.lit(n)).cast("int"))
            path = scratch_path(self.spark, "pending")
            dealt.write.partitionBy("portion").parquet(path)
            for i in range(n):
                yield f"{load_id}-{i}", read_or_empty(self.spark, f"{path}/portion={i}", pending.schema)

    def load_files(self, load_id: str, files: DataFrame) -> DataFrame:
        spread = files.select("source").repartition(tasks_for(files, bytes_per_task=1 << 30))
        footers = materialize(read_footers(spread, self.connection), "footers")
        groups = (
            footers.where(F.col("status") == load_log.PROCESSED)
            .groupBy("layout")
            .agg(F.array_sort(F.collect_list("source")).alias("sources"))
            .orderBy(F.col("sources")[0])
            .collect()
        )
        existing = self.load_schema(self.target, self.latest_loads(but=load_id).get(self.target))
        columns = [] if existing is None else [(f.name, f.dataType) for f in existing if f.name != SOURCE_COLUMN]
        declared = {name.lower(): data_type.simpleString() for name, data_type in columns}
        fixed = set(declared)
        names = [name for name, _ in columns]
        parts, problems = [], {}
        for group in groups:
            part = read_parquet(self.spark, group["sources"], self.connection)
            types = {f.name.lower(): f.dataType.simpleString() for f in part.schema}
            problem = self._misfit(types, declared, fixed)
            if problem:
                problems[group["layout"]] = problem
                continue
            for name, data_type in types.items():
                declared[name] = data_type if name not in declared else wider(declared[name], data_type)
            names = merged_columns(names, [part.columns])
            parts.append(part)
        if parts:
            rows = [_shaped(part, names, declared) for part in parts]
            self.write_table(load_id, self.target, reduce(DataFrame.unionByName, rows))
        reason = F.lit(None).cast("string")
        for layout, problem in problems.items():
            reason = F.when(F.col("layout") == layout, F.lit(problem)).otherwise(reason)
        return footers.select(
            "source", F.lit(self.target).alias("target_table"),
            F.when(reason.isNotNull(), load_log.FAILED).otherwise(F.col("status")).alias("status"),
            F.coalesce("error", reason).alias("error"),
            F.when((F.col("status") == load_log.PROCESSED) & reason.isNull(), F.col("n_rows")).otherwise(0)
            .cast("bigint").alias("n_rows"),
        )

    def _misfit(self, types: dict[str, str], declared: dict[str, str], fixed: set[str]) -> str | None:
        """Why files of this layout cannot go into the table, or None."""
        if own := reserved(types):
            return f"{', '.join(own)}: tables keep the name for themselves"
        if declared and not self.merge_schema and set(types) != set(declared):
            return "columns differ from the table's"
        for name, found in types.items():
            if name not in declared:
                continue
            common = wider(declared[name], found)
            if common is None or (name in fixed and common != declared[name]):
                return f"{name}: {found} does not fit {declared[name]}"
        return None


def wider(one: str, other: str) -> str | None:
    """Type that holds the values of both without loss, or None."""
    if one == other:
        return one
    for family in (INTEGERS, REALS):
        if one in family and other in family:
            return max(one, other, key=family.index)
    return None


def plain_path(encoded: Column) -> Column:
    """Path as listings give it, from the URL-encoded form of ``_metadata.file_path``."""
    decoded = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _shaped(part: DataFrame, names: list[str], declared: dict[str, str]) -> DataFrame:
    has = {c.lower(): c for c in part.columns}
    values = [
        (F.col(quote(has[c.lower()])) if c.lower() in has else F.lit(None)).cast(declared[c.lower()]).alias(c)
        for c in names
    ]
    return part.select(*values, plain_path(F.col("_metadata.file_path")).alias(SOURCE_COLUMN))
