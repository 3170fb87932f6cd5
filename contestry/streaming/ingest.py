"""Incremental ingest: CSV folder -> bronze -> silver tables.

All three streams are stateless appends with a checkpoint each: a run takes the
files that came since the last one (``availableNow``), writes them and stops.
Files may differ in their columns and their order: each is read by its own header.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contestry.functions.names import COMPETITION_ALIASES, TEAM_ALIASES
from contestry.operators.quality import (
    RESULT_RULES,
    enforce,
    observe_rules,
    upcoming_rules,
)
from contestry.plans import silver
from contestry.sources.files import (
    LINEAGE,
    header_columns,
    read_csv,
    union_by_name,
    with_file_lineage,
)
from contestry.sources.tables import read_merged


def read_csv_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New CSV files below ``path`` (glob patterns allowed), all with the same columns.

    Headers are checked against the schema: a file with other columns or another
    order stops the stream. ``store_drops`` takes files that differ.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


_FILES = "path string, modificationTime timestamp, length long, content binary"


def store_drops(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Append new CSV files to a raw table, each by the names in its own header.

    Known columns take their type from ``schema``, new ones are strings, missing
    ones null; so a column that files gain is kept from the first such file on. The
    stream itself holds file names only, ``files_per_batch`` at a time. A batch goes
    to a folder of its own, which a repeated batch overwrites.
    """
    empty = spark.createDataFrame([], T.StructType(schema.fields + LINEAGE.fields))
    empty.write.mode("ignore").parquet(f"{target}/batch=-1")

    def store(batch: DataFrame, number: int) -> None:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for row in batch.collect():  # at most files_per_batch names
            by_header.setdefault(tuple(header_columns(spark, row.path)), []).append(row.path)
        types = {f.name: f for f in schema.fields}
        parts = []
        for header, paths in by_header.items():
            own = T.StructType([types.get(c, T.StructField(c, T.StringType())) for c in header])
            parts.append(with_file_lineage(read_csv(spark, paths, own, glob="*")))
        if parts:
            union_by_name(parts).write.mode("overwrite").parquet(f"{target}/batch={number}")

    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )
    writer = names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def read_drops(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The raw table of ``store_drops`` with all columns of all files, known ones first."""
    stored = read_merged(spark, target).drop("batch")
    known = [*schema.fieldNames(), *LINEAGE.fieldNames()]
    return stored.select(*known, *(c for c in stored.columns if c not in known))


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A growing parquet table as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def bronze_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw rows of like files with ingest date and source file."""
    return with_file_lineage(read_csv_stream(spark, path, schema))


def results_stream(
    bronze: DataFrame,
    teams: silver.Aliases = TEAM_ALIASES,
    competitions: silver.Aliases = COMPETITION_ALIASES,
) -> DataFrame:
    """Bronze stream to played contests; rule failures are in the query's progress."""
    scored = silver.scored(bronze, teams, competitions)
    return enforce(observe_rules(scored, RESULT_RULES, "results"), RESULT_RULES)


def upcoming_stream(
    bronze: DataFrame,
    as_of: dt.date,
    teams: silver.Aliases = TEAM_ALIASES,
    competitions: silver.Aliases = COMPETITION_ALIASES,
) -> DataFrame:
    ahead = silver.upcoming_matches(bronze, as_of, teams, competitions)
    return observe_rules(ahead, upcoming_rules(as_of), "upcoming")


def run_ingest(
    spark: SparkSession,
    landing: str,
    target: str,
    schema: T.StructType,
    as_of: dt.date,
    teams: silver.Aliases = TEAM_ALIASES,
    competitions: silver.Aliases = COMPETITION_ALIASES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One incremental run; returns the bronze, results and upcoming tables.

    Gold is a batch refresh over the returned silver tables (``plans.gold``).
    """
    bronze, checkpoints = f"{target}/bronze", f"{target}/_checkpoints"
    store_drops(spark, landing, bronze, f"{checkpoints}/bronze", schema).awaitTermination()

    whole = T.StructType(schema.fields + LINEAGE.fields)
    raw = read_table_stream(spark, f"{bronze}/batch=*", whole)
    played = results_stream(raw, teams, competitions)
    ahead = upcoming_stream(raw, as_of, teams, competitions)
    queries = [
        append_stream(played, f"{target}/results", f"{target}/_checkpoints/results"),
        append_stream(ahead, f"{target}/upcoming", f"{target}/_checkpoints/upcoming"),
    ]
    for query in queries:
        query.awaitTermination()

    def table(name: str, df: DataFrame) -> DataFrame:
        return spark.read.schema(df.schema).parquet(f"{target}/{name}")

    return read_drops(spark, bronze, schema), table("results", played), table("upcoming", ahead)
