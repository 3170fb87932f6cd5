"""A stored copy of a landing folder whose files may be added, rewritten or deleted.

A refresh lists the folder (names, sizes and times, no contents) and compares the list with
the inventory of the run before. Only new and changed files are read; their rows go to
a folder of the run's own. The inventory says which run holds the rows that count
for each file, so rows of rewritten and deleted files are left out by a join and nothing
stored is rewritten. ``compact`` does that when too much of the store is out of date.

A run is over once its inventory is there, which is written last. A run that fails before
leaves rows that no inventory names, and the next one writes over them. A file that is
rewritten between the listing and the reading differs from its inventory, so the next
refresh reads it again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestry.session import delete_folder
from contestry.sources.files import LINEAGE, read_csv, with_file_lineage

_RUN = "_run"
_INVENTORY = f"source_file string, path string, size long, modified timestamp, change string, {_RUN} long"
#: what a file is, compared with the run before
NEW, CHANGED, SAME, GONE = "new", "changed", "same", "gone"
#: files that one job reads; their names pass through the driver
FILES_PER_JOB = 10_000


def list_files(spark: SparkSession, landing: str, glob: str = "*.csv") -> DataFrame:
    """(source_file, path, size, modified) of every file below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return files.load(landing).select(
        F.col("_metadata.file_path").alias("source_file"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def last_run(spark: SparkSession, target: str) -> int:
    """The number of the last run that is over, 0 before the first."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/inventory/run=*/_SUCCESS")
    found = done.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(done)
    return max((int(f.getPath().getParent().getName()[4:]) for f in found or []), default=0)


def inventory(spark: SparkSession, target: str, run: int | None = None) -> DataFrame:
    """(source_file, path, size, modified, change, _run) after a run, the last by default.

    ``change`` tells new, changed, same and gone files; gone ones have no ``_run``, the
    others have the number of the run that read them.
    """
    run = last_run(spark, target) if run is None else run
    if not run:
        return spark.createDataFrame([], _INVENTORY)
    return spark.read.schema(_INVENTORY).parquet(f"{target}/inventory/run={run}")


def compared(before: DataFrame, now: DataFrame, run: int) -> DataFrame:
    """The inventory of ``run`` from the one before and the files that are there now."""
    old = before.filter(F.col("change") != GONE).select(
        "source_file", *(F.col(c).alias(f"old_{c}") for c in ("path", "size", "modified", _RUN))
    )
    like = (F.col("size") == F.col("old_size")) & (F.col("modified") == F.col("old_modified"))
    change = (
        F.when(F.col("path").isNull(), GONE).when(F.col("old_path").isNull(), NEW).when(like, SAME).otherwise(CHANGED)
    )
    return now.join(old, "source_file", "full").select(
        "source_file",
        F.coalesce("path", "old_path").alias("path"),
        F.coalesce("size", "old_size").alias("size"),
        F.coalesce("modified", "old_modified").alias("modified"),
        change.alias("change"),
        F.when(change == SAME, F.col(f"old_{_RUN}")).when(change != GONE, F.lit(run)).cast("long").alias(_RUN),
    )


def _literal(path: str) -> str:
    """A path whose own brackets and stars are no pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def refresh_landing(
    spark: SparkSession,
    landing: str,
    target: str,
    schema: T.StructType,
    glob: str = "*.csv",
    files_per_job: int = FILES_PER_JOB,
) -> DataFrame:
    """Take what changed in a landing folder since the last refresh; the new inventory.

    Headers are checked against the schema. Nothing is read if nothing changed.
    """
    before = last_run(spark, target)
    run = before + 1
    path = f"{target}/listed/run={run}"
    compared(inventory(spark, target, before), list_files(spark, landing, glob), run).write.mode("overwrite").parquet(path)
    listed = spark.read.schema(_INVENTORY).parquet(path)
    if before and listed.filter(F.col("change") != SAME).isEmpty():
        return inventory(spark, target, before)

    rows = f"{target}/rows/{_RUN}={run}"
    stored = T.StructType([*schema.fields, *LINEAGE.fields])
    spark.createDataFrame([], stored).write.mode("overwrite").parquet(rows)
    paths: list[str] = []

    def read() -> None:
        if paths:
            with_file_lineage(read_csv(spark, paths, schema, glob="*")).write.mode("append").parquet(rows)
            paths.clear()

    for row in listed.filter(F.col("change").isin(NEW, CHANGED)).select("path").toLocalIterator():
        paths.append(_literal(row.path))
        if len(paths) >= files_per_job:
            read()
    read()
    listed.write.mode("overwrite").parquet(f"{target}/inventory/run={run}")
    return inventory(spark, target, run)


def read_landing(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows of the files as of the last refresh, with their lineage."""
    live = inventory(spark, target).filter(F.col(_RUN).isNotNull()).select("source_file", _RUN)
    whole = T.StructType([*schema.fields, *LINEAGE.fields, T.StructField(_RUN, T.LongType())])
    rows = spark.read.schema(whole).parquet(f"{target}/rows")
    return rows.join(live, ["source_file", _RUN], "left_semi").select(*schema.fieldNames(), *LINEAGE.fieldNames())


def compact(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Store the rows that count as one run, in files of even size, and delete the runs before.

    Readers that started before have to read again. The new inventory.
    """
    before = last_run(spark, target)
    run = before + 1
    read_landing(spark, target, schema).hint("rebalance").write.mode("overwrite").parquet(f"{target}/rows/{_RUN}={run}")
    kept = inventory(spark, target, before).filter(F.col("change") != GONE)
    (
        kept.withColumns({"change": F.lit(SAME), _RUN: F.lit(run).cast("long")})
        .write.mode("overwrite")
        .parquet(f"{target}/inventory/run={run}")
    )
    for old in range(1, run):
        for folder in (f"rows/{_RUN}={old}", f"inventory/run={old}", f"listed/run={old}"):
            delete_folder(spark, f"{target}/{folder}")
    return inventory(spark, target, run)
