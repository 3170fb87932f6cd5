"""CSV folders in, with lineage columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# what ``with_file_lineage`` adds
LINEAGE = T.StructType([T.StructField("_ingest_date", T.DateType()), T.StructField("source_file", T.StringType())])


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str = "*.csv"
) -> DataFrame:
    """All CSV files of a folder with a fixed schema.

    Headers are checked against the schema, so a reordered file fails instead of
    filling the wrong columns. Every call reads the files as they are now, also
    those rewritten under their old name.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", glob)
        .csv(path)
    )


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> T.StructType:
    """Column names from the header and types from the values (all of them by default)."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling_ratio)
        .csv(path)
        .schema
    )


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Header of a folder of like files; reads one line."""
    return spark.read.option("header", True).csv(path).columns


def evolved_schema(schema: T.StructType, columns: Sequence[str]) -> T.StructType:
    """``schema`` plus the columns it does not know yet, as strings, at the end."""
    known = set(schema.fieldNames())
    return T.StructType(
        schema.fields + [T.StructField(c, T.StringType()) for c in columns if c not in known]
    )


def read_csv_drops(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Folders whose columns differ, merged by name.

    Each folder is read in the column order of its own header. Known columns take
    their type from ``schema``, new ones are strings, missing ones null.
    """
    types = {field.name: field for field in schema.fields}
    drops = []
    for path in paths:
        fields = [
            types.get(c, T.StructField(c, T.StringType())) for c in header_columns(spark, path)
        ]
        drops.append(read_csv(spark, path, T.StructType(fields)))
    return union_by_name(drops)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns missing in one are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Ingest date and the file each row came from (needs a file source)."""
    return df.withColumns(
        {"_ingest_date": F.current_date(), "source_file": F.col("_metadata.file_path")}
    )


def with_source_tag(df: DataFrame, tag: str) -> DataFrame:
    """Ingest time and a literal source name."""
    return df.withColumns({"ingestTimestamp": F.current_timestamp(), "sourceFile": F.lit(tag)})


def with_competition(df: DataFrame, competition: str | None = None) -> DataFrame:
    """Add Competition as given, or as the name of the folder the file lies in."""
    if competition is not None:
        return df.withColumn("Competition", F.lit(competition))
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return df.withColumn("Competition", F.url_decode(folder))


def to_silver_lineage(df: DataFrame) -> DataFrame:
    """Keep bronze lineage under its own names and stamp the silver stage."""
    return df.withColumnsRenamed(
        {"ingestTimestamp": "ingestTimestampBronze", "sourceFile": "sourceFileBronze"}
    ).withColumns({"lastUpload": F.current_timestamp(), "pipelineStage": F.lit("silverTransformation")})


def with_stage(df: DataFrame, stage: str = "goldTransformation") -> DataFrame:
    return df.withColumn("pipelineStage", F.lit(stage))
