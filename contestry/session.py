"""Session helpers and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster job brings its own."""
    scratch = _local_folder()
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("contestry")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(CHECKPOINT_DIR, f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder is None:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        folder = _local_folder()
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path (not yet created) under the shared folder."""
    path = f"{shared_folder(spark)}/contestry/{label}-{uuid.uuid4().hex}"
    for folders in _scopes[-1:]:
        folders.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was stored in the shared folder inside the ``with`` block.

    Frames that read such folders can't be used afterwards; write the result
    elsewhere before the block ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; no error if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage and survives lost executors. Unlike ``checkpoint()`` the
    result keeps column pruning, filter pushdown and file-size statistics, on
    which Spark decides whether a side is small enough to broadcast. With
    ``partition_by`` (the last column) a filter on it reads the matching files only.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
