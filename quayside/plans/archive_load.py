"""Zipped CSV files into one table (fan-in) or into a table per file (fan-out).

Archives are opened once, in tasks; their lines go to the stage tier, kept apart by table and
header. Types are found and tables written from there, where the lines of one big archive are
already spread over many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import column_types, names
from quayside.plans import load_log
from quayside.plans.loading import (
    SOURCE_COLUMN, Loader, Tiers, apart_from_log, for_each_table, merged_columns, pick, reserved, without,
)
from quayside.session import materialize, read_or_empty, session_settings
from quayside.sources import archives
from quayside.sources.archives import CsvFormat
from quayside.sources.delimited import quote
from quayside.sources.listing import list_files

ARCHIVES = "*.zip"
SAMPLE_ROWS = 50_000
# Row groups are what the lines of one archive are spread by when they are read back.
STAGE_ROW_GROUP = 32 << 20
_FILE_SCHEMA = (
    "source string, target_table string, member string, header string, status string, error string, "
    "member_bytes bigint, n_blocks bigint, n_lines bigint"
)
_LINE_SCHEMA = "source string, line string"
# The file of a row until it is written: no header can have the name, as line breaks end its line.
_FILE = "\nfile"


class ArchiveLoader(Loader):
    """Load of all ``*.zip`` of the raw area.

    With ``table`` all files go into that one; else each goes into the table that its name says:
    by ``routes`` where a prefix matches, by its own safe name otherwise.
    """

    def __init__(
        self,
        spark: SparkSession,
        tiers: Tiers,
        csv: CsvFormat = CsvFormat(),
        table: str | None = None,
        routes: Mapping[str, str] = names.DEFAULT_ROUTES,
        merge_schema: bool = True,
        log_path: str | None = None,
    ):
        super().__init__(spark, tiers, merge_schema, log_path)
        self.csv = csv
        self.target = table
        self.routes = routes
        for name in [*([] if table is None else [table]), *routes.values()]:
            self.check_target(name)
        self.name_job(csv.sep, csv.header, csv.infer_schema, csv.encoding, csv.decode_errors, csv.quote, csv.escape)

    def discover(self) -> DataFrame:
        return self.assign_targets(list_files(self.spark, self.tiers.raw, ARCHIVES, connection=self.csv.connection))

    def assign_targets(self, files: DataFrame) -> DataFrame:
        """Add ``target_table`` to listed files."""
        if self.target is not None:
            return files.withColumn("target_table", F.lit(self.target))
        return route_files(files, self.routes, self.log.processed())

    def load_files(self, load_id: str, files: DataFrame) -> DataFrame:
        stage = f"{self.tiers.stage}/{load_id}"
        stage_lines(files, self.csv, stage)
        opened = read_or_empty(self.spark, f"{stage}/kind=file", _FILE_SCHEMA)
        layouts: dict[str, list[list[str]]] = {}
        good = opened.where(F.col("status") == load_log.PROCESSED)
        found = good.groupBy("target_table", "header").agg(F.min("source").alias("s"))
        for row in found.orderBy("target_table", "s").collect():
            layouts.setdefault(row["target_table"], []).append(json.loads(row["header"]))
        damaged = opened.where((F.col("status") == load_log.FAILED) & (F.col("n_blocks") > 0))
        has_damaged = bool(damaged.take(1))

        latest = self.latest_loads(but=load_id)

        def load_target(target: str, headers: list[list[str]]) -> DataFrame:
            existing = self.load_schema(target, latest.get(target))
            of_target = good.where(F.col("target_table") == target)
            return self._load_target(
                load_id, stage, target, existing, headers, of_target, damaged if has_damaged else None
            )

        profiles = for_each_table(load_target, layouts.items())
        outcome = opened.select("source", "target_table", "status", "error")
        if not profiles:
            return outcome.withColumn("n_rows", F.lit(0).cast("bigint"))
        per_file = reduce(DataFrame.unionByName, profiles)
        drift = F.col("status") == load_log.PROCESSED
        return outcome.join(per_file, load_log.KEY, "left").select(
            *load_log.KEY,
            F.when(drift & F.col("problem").isNotNull(), load_log.FAILED).otherwise(F.col("status")).alias("status"),
            F.coalesce("error", "problem").alias("error"),
            F.when(drift & F.col("problem").isNull(), F.coalesce("n_rows", F.lit(0))).otherwise(0)
            .cast("bigint").alias("n_rows"),
        )

    def _load_target(
        self, load_id: str, stage: str, target: str, existing: T.StructType | None, headers: list[list[str]],
        opened: DataFrame, damaged: DataFrame | None,
    ) -> DataFrame:
        """Write one table of a load; give back ``source, target_table, n_rows, problem``."""
        declared = {} if existing is None else {f.name: f.dataType for f in existing if f.name != SOURCE_COLUMN}
        allowed = [h for h in headers if not reserved(h)]
        accepted, refused = accept_layouts(allowed, list(declared), self.merge_schema) if allowed else ([], [])
        refused = refused + [h for h in headers if reserved(h)]
        columns = merged_columns(list(declared), accepted)
        refused_files = opened.where(F.col("header").isin([json.dumps(h) for h in refused])).select(
            *load_log.KEY, F.lit(0).cast("bigint").alias("n_rows"),
            F.lit("columns differ from the table's, or have a name that tables keep for themselves").alias("problem"),
        )
        if not accepted:
            return refused_files

        def rows_of(share: float) -> DataFrame:
            """Parsed rows, or a share of them that is drawn before the parsing."""
            parts = []
            for header in accepted:
                lines = self._lines(stage, target, header)
                lines = lines if share == 1 else lines.sample(share, seed=1)
                parts.append(parse_lines(lines, header, self.csv).select(F.col("source").alias(_FILE), *pick(columns, header, "record")))
            rows = reduce(DataFrame.unionByName, parts)
            return rows if damaged is None else without(rows, damaged, _FILE)

        rows = rows_of(1)
        taken = opened.where(F.col("header").isin([json.dumps(h) for h in accepted]))
        counts = taken.select("source", F.col("n_lines").alias("n_rows"))
        fixed = {name: data_type.simpleString() for name, data_type in declared.items()}
        types, misfits = self._find_types(rows_of, columns, fixed, counts)
        checked = counts.withColumn("target_table", F.lit(target))
        if misfits is None:
            checked = checked.withColumn("problem", F.lit(None).cast("string"))
        else:
            checked = checked.join(misfits, "source", "left")
            rows = without(rows, misfits, _FILE)
        typed = [F.col(quote(c)).cast(types[c]).alias(c) for c in columns]
        self.write_table(load_id, target, rows.select(*typed, F.col(_FILE).alias(SOURCE_COLUMN)))
        checked = checked.select("source", "target_table", "n_rows", "problem")
        return checked.unionByName(refused_files) if refused else checked

    def _lines(self, stage: str, target: str, header: list[str]) -> DataFrame:
        folder = f"target_key={archives.target_key(target)}/header_key={archives.header_key(header)}"
        return read_or_empty(self.spark, f"{stage}/kind=line/{folder}", _LINE_SCHEMA)

    def _find_types(
        self, rows_of: Callable[[float], DataFrame], columns: list[str], declared: dict[str, str], counts: DataFrame
    ) -> tuple[dict[str, str], DataFrame | None]:
        """Types of the columns, and the files that do not fit those declared (or None).

        Columns without a declared type get the narrowest that all rows allow. A few rows say
        what to expect; then all rows are held against it, and the costly tests are left to the
        values that do not meet it. The outcome does not depend on which rows were the few.
        """
        new = [c for c in columns if c not in declared] if self.csv.infer_schema else []
        total = counts.agg(F.sum("n_rows")).first()[0] or 0
        some = rows_of(min(1, SAMPLE_ROWS / max(total, 1)))
        seen = _masks_by_name(column_types.column_masks(some, _FILE, _quoted(new)), new) if new else {}
        held = [c for c, t in declared.items() if t != "string"]
        guessed = {c: column_types.narrowest(mask) if mask else None for c, mask in seen.items()}
        expected: dict[str, str | None] = {c: declared[c] for c in held}
        expected.update({c: t for c, t in guessed.items() if t != "string"})
        misfits = None
        if expected:
            names = list(expected)
            masks = column_types.column_masks(rows_of(1), _FILE, _quoted(names), list(expected.values()))
            masks = materialize(masks.withColumnRenamed(_FILE, "source"), "masks")
            for name, mask in _masks_by_name(masks, names).items():
                if name in seen:
                    seen[name] |= mask
            misfits = _files_that_do_not_fit(masks, {name: declared[name] for name in held})
        types = {c: declared.get(c) or column_types.narrowest(seen.get(c)) for c in columns}
        return types, misfits


def _quoted(columns: list[str]) -> list[Column]:
    return [F.col(quote(c)) for c in columns]


def _masks_by_name(masks: DataFrame, names: list[str]) -> dict[str, int]:
    """Mask of each column over all files; 0 where no value was looked at."""
    rows = masks.groupBy("position").agg(F.bit_or("mask").alias("mask")).collect()
    found = {row["position"]: row["mask"] for row in rows}
    return {name: found.get(i) or 0 for i, name in enumerate(names)}


def _files_that_do_not_fit(masks: DataFrame, declared: dict[str, str]) -> DataFrame | None:
    """``source, problem`` of files with values the declared types cannot hold; None without any."""
    problem = F.lit(None).cast("string")
    for i, (name, kind) in enumerate(declared.items()):
        wrong = (F.col("position") == i) & column_types.does_not_fit(F.col("mask"), kind)
        problem = F.when(wrong, f"{name}: not {kind}").otherwise(problem)
    if not declared:
        return None
    misfits = (
        masks.select("source", problem.alias("problem"))
        .where("problem IS NOT NULL")
        .groupBy("source")
        .agg(F.array_join(F.array_sort(F.collect_list("problem")), "; ").alias("problem"))
    )
    return misfits if misfits.take(1) else None


def stage_lines(files: DataFrame, csv: CsvFormat, stage: str) -> None:
    """Open archives and put their lines and file rows into the stage tier, in one pass.

    The listing is spread by count again, since few bytes of it stand for many bytes of archive.
    """
    spread = files.select("source", "target_table").repartition(archives.tasks_for(files))
    rows = archives.split_lines(archives.open_archives(spread, csv)).drop("line_no")
    with session_settings(files.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": "16"}):
        writer = rows.write.mode("overwrite").option("parquet.block.size", STAGE_ROW_GROUP)
        writer.partitionBy("kind", "target_key", "header_key").parquet(stage)


def parse_lines(lines: DataFrame, header: list[str], csv: CsvFormat) -> DataFrame:
    """Lines as a ``record`` of text columns; surplus fields are dropped, missing ones NULL."""
    schema = ", ".join(f"{quote(name)} string" for name in header)
    options = {
        "sep": csv.sep, "quote": csv.quote, "escape": csv.escape,
        "mode": "PERMISSIVE", "nullValue": "", "emptyValue": "",
    }
    return lines.select("source", F.from_csv("line", schema, options).alias("record"))


def accept_layouts(
    headers: list[list[str]], existing: list[str], merge_schema: bool
) -> tuple[list[list[str]], list[list[str]]]:
    """Headers a table takes, and those it refuses when columns may not be merged."""
    if merge_schema:
        return headers, []
    fixed = {c.lower() for c in (existing or headers[0])}
    fits = [h for h in headers if {c.lower() for c in h} == fixed]
    return fits, [h for h in headers if h not in fits]


def route_files(files: DataFrame, routes: Mapping[str, str], loaded: DataFrame) -> DataFrame:
    """Table per file: the mapped one, else the safe name of the file.

    Where different names fold to the same table, each gets its full hash at its end. A name that was
    loaded before keeps its table, whatever arrives later.
    """
    named = names.route_by_prefix(files.withColumn("stem", names.stem(F.col("source_name"))), "stem", routes)
    safe = named.withColumn("safe", names.table_name_or_fallback(F.col("stem")))
    kept = (
        loaded.select(names.stem(F.col("source_name")).alias("stem"), F.col("target_table").alias("kept"))
        .groupBy("stem")
        .agg(F.min("kept").alias("kept"))
    )
    free = safe.where("mapped_table IS NULL").select("stem", "safe")
    earlier = kept.select("stem", names.table_name_or_fallback(F.col("stem")).alias("safe"))
    shared = (
        free.unionByName(earlier).distinct().groupBy("safe").agg((F.count("*") > 1).alias("is_shared"))
    )
    own = F.when(F.col("is_shared"), F.concat_ws("_", "safe", names.full_hash(F.col("stem")))).otherwise(F.col("safe"))
    return (
        safe.join(shared, "safe", "left")
        .join(kept, "stem", "left")
        .select(*files.columns, F.coalesce("mapped_table", "kept", apart_from_log(own, names.full_hash(F.col("stem")))).alias("target_table"))
    )

