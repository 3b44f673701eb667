"""Load jobs for spark-submit.

    spark-submit load.py archives --raw /landing --stage /stage --warehouse /warehouse --table arrivals
    spark-submit load.py archives --raw /landing ... --all-text          (a table per file, by name)
    spark-submit load.py parquet  --raw s3a://bucket/raw ... --table arrivals --connection fs.s3a.endpoint=...

Settings of the delimited text can come from the environment: ZIP_DIR, CSV_SEP, CSV_HEADER,
INFER_SCHEMA, CSV_ENCODING, TABLE_NAME.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quayside.functions.names import DEFAULT_ROUTES  # noqa: E402
from quayside.plans.archive_load import ArchiveLoader  # noqa: E402
from quayside.plans.loading import Loader, Tiers  # noqa: E402
from quayside.plans.parquet_load import ParquetLoader  # noqa: E402
from quayside.session import build_session  # noqa: E402
from quayside.sources.archives import CsvFormat  # noqa: E402
from quayside.streaming.archive_stream import start_archive_stream  # noqa: E402


def is_true(text: str) -> bool:
    return text.strip().lower() in ("true", "1", "yes")


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    env = os.environ.get
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("kind", choices=["archives", "parquet"])
    parser.add_argument("--raw", default=env("ZIP_DIR"), help="landing area")
    parser.add_argument("--stage", required=True)
    parser.add_argument("--warehouse", required=True)
    parser.add_argument("--log", help="load log; below the warehouse unless given")
    parser.add_argument("--table", default=env("TABLE_NAME"), help="one table for all files")
    parser.add_argument("--sep", default=env("CSV_SEP", ","))
    parser.add_argument("--header", type=is_true, default=is_true(env("CSV_HEADER", "true")))
    parser.add_argument("--infer-schema", type=is_true, default=is_true(env("INFER_SCHEMA", "true")))
    parser.add_argument("--encoding", default=env("CSV_ENCODING"))
    parser.add_argument("--all-text", action="store_true", help="every column stays text; windows-1251 unless set")
    parser.add_argument("--routes", type=json.loads, default=DEFAULT_ROUTES, help="JSON of file name prefix to table")
    parser.add_argument("--no-merge", action="store_true", help="refuse files with other columns")
    parser.add_argument("--connection", action="append", default=[], metavar="KEY=VALUE", help="option of the raw area")
    parser.add_argument("--register", metavar="NAMESPACE", help="make the loaded tables known to the catalog")
    parser.add_argument("--stream", metavar="CHECKPOINT", help="take new archives as a stream, with this checkpoint")
    parsed = parser.parse_args(arguments)
    if not parsed.raw:
        parser.error("--raw or ZIP_DIR is needed")
    if parsed.kind == "parquet" and parsed.stream:
        parser.error("--stream is for archives")
    if parsed.kind == "parquet" and not parsed.table:
        parser.error("--table is needed for Parquet files")
    return parsed


def make_loader(spark, options: argparse.Namespace) -> Loader:
    tiers = Tiers(options.raw, options.stage, options.warehouse)
    connection = dict(pair.split("=", 1) for pair in options.connection)
    if options.kind == "parquet":
        return ParquetLoader(spark, tiers, options.table, connection, not options.no_merge, options.log)
    given = {"sep": options.sep, "header": options.header, "connection": connection}
    if options.encoding:
        given["encoding"] = options.encoding
    if options.all_text:
        csv = CsvFormat.all_text(**given)
    else:
        csv = CsvFormat(infer_schema=options.infer_schema, **given)
    return ArchiveLoader(spark, tiers, csv, options.table, options.routes, not options.no_merge, options.log)


def main(arguments: list[str] | None = None) -> dict:
    options = parse(arguments)
    spark = build_session("load")
    loader = make_loader(spark, options)
    if options.stream:
        start_archive_stream(loader, options.stream, "load").awaitTermination()
    summary = loader.run().first().asDict()
    if options.register:
        targets = loader.log.processed().select("target_table").distinct().collect()
        for row in targets:
            loader.register(options.register, row["target_table"])
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
