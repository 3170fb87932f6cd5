"""Streams from and to tables of the catalog, partitioned by the date of ingest.

A stream writes many small files. Days that are stored are copied to a merged table, in
files of even size, and ``read_days`` takes each day from where it is whole: a day whose
two row counts differ got rows after it was merged, and is merged again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contestry.functions.names import COMPETITION_ALIASES, TEAM_ALIASES
from contestry.plans import silver
from contestry.streaming.ingest import bronze_stream, results_stream, upcoming_stream

DAY, SILVER_DAY = "_ingest_date", "_silver_ingest_date"


def read_stream(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog as a stream of the rows that are appended to it."""
    return spark.readStream.table(name)


def append_to(df: DataFrame, name: str, checkpoint: str, day: str = DAY) -> StreamingQuery:
    """Append what is there now to a table, which is made if it does not exist.

    The table's columns are those of the first run; each batch of rows counts once,
    however often it is written.
    """
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(day)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(name)
    )


def _days(df: DataFrame, day: str, count: str) -> DataFrame:
    return df.groupBy(day).agg(F.count("*").alias(count))


def _unmerged(stored: DataFrame, merged: DataFrame, day: str) -> DataFrame:
    """The days of ``stored`` that ``merged`` does not hold whole; one row for each."""
    counts = _days(stored, day, "_rows").join(
        _days(merged, day, "_merged").withColumnRenamed(day, "_day"), F.col(day).eqNullSafe(F.col("_day")), "left"
    )
    return counts.filter(~F.col("_rows").eqNullSafe(F.col("_merged"))).select(day)


def _among(day: str, days: list[dt.date | None]) -> Column:
    """Whether a row is of one of the days; true or false, never unknown."""
    own = F.col(day).isNotNull() & F.col(day).isin([d for d in days if d is not None])
    return own | F.col(day).isNull() if None in days else own


def merge_days(spark: SparkSession, name: str, merged: str, day: str = DAY) -> list[dt.date]:
    """Copy the days that are not merged yet to the table ``merged``; the days copied.

    Only these days are read, and only they are replaced. A stream may append meanwhile.
    """
    stored = spark.table(name)
    columns = [c for c in stored.columns if c != day]
    if not spark.catalog.tableExists(merged):
        # as an option of the table, so that every overwriting insert replaces just the days it brings
        empty = stored.limit(0).select(*columns, day).write.format("parquet").partitionBy(day)
        empty.option("partitionOverwriteMode", "dynamic").saveAsTable(merged)
    days = [r[0] for r in _unmerged(stored, spark.table(merged), day).collect()]  # a row for each day
    if days:
        rows = stored.filter(_among(day, days)).select(*columns, day)
        rows.hint("rebalance", F.col(day)).write.insertInto(merged, overwrite=True)
        spark.catalog.refreshTable(merged)
    return sorted(days, key=str)


def read_days(spark: SparkSession, name: str, merged: str, day: str = DAY) -> DataFrame:
    """All rows of a streamed table: merged days from their merged files, others as they came."""
    stored, copied = spark.table(name), spark.table(merged)
    # as filters, of which a join would make a shuffle with all rows of a day in one task
    open_days = [r[0] for r in _unmerged(stored, copied, day).collect()]  # a row for each day
    return stored.filter(_among(day, open_days)).unionByName(copied.filter(~_among(day, open_days)))


def run_ingest(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    tables: tuple[str, str, str],
    checkpoint: str,
    as_of: dt.date,
    teams: silver.Aliases = TEAM_ALIASES,
    competitions: silver.Aliases = COMPETITION_ALIASES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One incremental run from CSV files to the bronze, results and upcoming tables named."""
    bronze, results, upcoming = tables
    append_to(bronze_stream(spark, landing, schema), bronze, f"{checkpoint}/bronze").awaitTermination()
    raw = read_stream(spark, bronze)
    stamped = lambda df: df.withColumn(SILVER_DAY, F.current_date())
    queries = [
        append_to(stamped(results_stream(raw, teams, competitions)), results, f"{checkpoint}/results", SILVER_DAY),
        append_to(stamped(upcoming_stream(raw, as_of, teams, competitions)), upcoming, f"{checkpoint}/upcoming", SILVER_DAY),
    ]
    for query in queries:
        query.awaitTermination()
    return spark.table(bronze), spark.table(results), spark.table(upcoming)
