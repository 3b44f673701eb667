"""Archive load driven by Spark's streaming file source.

The stream's checkpoint remembers which files were seen, the load log which were loaded. Each
micro-batch is one load whose id comes from the checkpoint's query id, which outlives restarts and
which no other checkpoint has, and the batch number. So a batch that is run again after a failure
replaces what it had written, and no batch replaces another's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.functions import names
from quayside.plans import load_log
from quayside.plans.archive_load import ARCHIVES, ArchiveLoader

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_archive_stream(
    loader: ArchiveLoader, checkpoint: str, query_name: str, trigger: dict | None = None,
    files_per_batch: int | None = None, retry_after: float = 600.0,
) -> StreamingQuery:
    """Start loading new archives of the raw area; by default take what is there and stop.

    The file source offers a path once. Files that failed are tried again from the log, when the stream starts and in each
    micro-batch, as soon as ``retry_after`` seconds have gone by since, twice as many after each further failure.
    """
    loader.retry_failed(retry_after)
    reader = loader.spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", ARCHIVES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    reader = reader.options(**loader.csv.connection)
    listed = reader.load(loader.tiers.raw).select(
        F.col("path").alias("source"),
        names.base_name(F.col("path")).alias("source_name"),
        F.col("length").alias("n_bytes"),
    )

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"S{query_name}-{loader.job}-{query_id}-{batch_id}"
        files = loader.assign_targets(batch)
        done_before = loader.log.outcomes().where(F.col("load_id") != load_id)
        again = load_log.due_again(done_before, retry_after).join(files.select(*load_log.KEY), load_log.KEY, "left_anti")
        offered = load_log.pending_files(files, done_before).select(*again.columns).unionByName(again)
        run = loader.replay if loader.log.is_announced(load_id) else loader.load
        loader.log.write_intents(load_id, offered)
        run(load_id)

    return (
        listed.writeStream.queryName(query_name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(load_batch)
        .start()
    )
