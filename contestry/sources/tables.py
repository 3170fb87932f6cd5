"""Managed tables: full refresh, append, create-table-as-select."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(
    df: DataFrame,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """Replace the table with ``df``, schema included, and return the stored table.

    With ``partition_by`` that column comes last, and a filter on it reads its folders only.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").format("parquet").saveAsTable(name, partitionBy=partition_by)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(92) + chr(39))}'")
    if properties:
        pairs = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    return spark.table(name)


def append_table(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("append").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def append_merged(df: DataFrame, name: str) -> DataFrame:
    """Append by column name; columns that the table does not have yet are added to it first.

    Rows stored before are null there, and so are new rows in columns that ``df`` lacks.
    A value that does not fit the type of its column fails the append.
    """
    spark = df.sparkSession
    known = {f.name.lower(): f for f in spark.table(name).schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    given = {c.lower(): c for c in df.columns}
    target = spark.table(name).schema.fields
    rows = df.select(
        *(
            (F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        )
    )
    rows.write.insertInto(name)
    return spark.table(name)


def create_table_as(spark: SparkSession, name: str, query: str) -> DataFrame:
    """``CREATE OR REPLACE TABLE name AS query`` for the built-in parquet catalog."""
    return save_table(spark.sql(query), name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder whose files gained columns over time, with all columns."""
    return spark.read.option("mergeSchema", True).parquet(path)
