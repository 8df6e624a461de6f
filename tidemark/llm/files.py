"""Files on the folder that the whole cluster shares."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset in local mode (tests), below a temporary one of this machine."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or getattr(shared_dir, "own", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        base = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet on the shared folder and read it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _filesystem(uri: str):
    """A pyarrow file system and the path on it, for local, HDFS and object-store addresses."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def open_output(uri: str):
    """A stream that writes a new file; parent folders are made."""
    files, path = _filesystem(uri)
    files.create_dir(os.path.dirname(path), recursive=True)
    return files.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable reader of a file."""
    files, path = _filesystem(uri)
    return files.open_input_file(path)


def attempt_name(prefix: str) -> str:
    """A file name that no other attempt of any task has: only files named in a committed manifest count."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return f"{prefix}-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}" if task else f"{prefix}-{uuid.uuid4().hex}"
