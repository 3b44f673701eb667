"""Opening files from inside tasks, whatever store they are in."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyarrow import fs
from pyspark.sql import SparkSession

# Reader option -> connection argument of the task-side S3 client.
S3_ARGUMENTS = {
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
}


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's listings give it: with its scheme, one slash after ``file:``, none at the end."""
    match = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", path, re.DOTALL)
    if not match:
        root = spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")
        path = f"{root.rstrip('/')}/{path.lstrip('/')}" if not root.startswith("file:") else f"file:{os.path.abspath(path)}"
        match = re.match(r"([^:]+):(.*)", path, re.DOTALL)
    scheme, rest = match[1], match[2].rstrip("/") or "/"
    return f"file:/{rest.lstrip('/')}" if scheme == "file" else f"{scheme}:{rest}"


def open_store(path: str, connection: Mapping[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    """File system and the path inside it, for a path as Spark's listing gives it.

    The path is taken as is, never URL-decoded, so names with ``%`` or ``#`` stay whole.
    """
    connection = connection or {}
    match = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", path, re.DOTALL)
    scheme, rest = (match[1].lower(), match[2]) if match else ("file", path)
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, inside = rest.lstrip("/").partition("/")
    if scheme in ("s3", "s3a", "s3n"):
        arguments = {name: connection[key] for key, name in S3_ARGUMENTS.items() if key in connection}
        if connection.get("fs.s3a.connection.ssl.enabled") == "false":
            arguments["scheme"] = "http"
        return fs.S3FileSystem(**arguments), f"{authority}/{inside}"
    if scheme in ("hdfs", "viewfs"):
        host, _, port = authority.partition(":")
        return fs.HadoopFileSystem(host or "default", int(port or 0)), f"/{inside}"
    store, root = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, f"{root.rstrip('/')}/{inside}" if root.strip("/") else inside
