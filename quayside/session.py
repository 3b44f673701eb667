"""Session defaults and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The sizing the jobs were specified with.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.broadcastTimeout": "360",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with the defaults above.

    ``shuffle_partitions`` is the starting point that adaptive execution merges from: about two
    to three times the cores of the cluster. Left out, the cluster's own setting stays.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="quayside-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path in the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the next plan real sizes to
    choose its joins by.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet at ``path``, or no rows when nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the actions inside the block only."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def default_cores() -> int:
    """Cores for local runs."""
    return int(os.environ.get("BENCH_CPUS", "8"))
