"""Streams whose columns and types follow the files.

Bronze keeps every value as the text it came as. What the columns are is a history of
schema versions beside the table: a batch whose files bring a column, or a value that
does not fit its column's type, adds a version with the column, or with the narrowest
type that holds both (int, long, double; date; else string). Types are applied when
bronze is read, so a wider type never rewrites stored files and loses no digits.

Silver reads bronze in the version it was started with and stops before it writes a batch
of a later one; ``run_silver`` starts it again from the same checkpoint, so the batch
is taken whole in the new version. A batch's rows, its rule counts and the gold seasons it
touches are written to places named by the batch: a batch that is repeated after a
failure replaces what it has written and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contestry.functions.names import COMPETITION_ALIASES, TEAM_ALIASES
from contestry.operators.quality import RESULT_RULES, Rule, enforce
from contestry.plans import silver
from contestry.session import materialize
from contestry.sources.files import LINEAGE, header_columns, read_csv, union_by_name, with_file_lineage
from contestry.streaming.ingest import _FILES

#: from narrow to wide; a date and a number only meet in a string
NUMBERS = ("int", "bigint", "double")
_VERSION = "_schema_version"
_HISTORY = "version int, position int, name string, type string"

Types = dict[str, str | None]


# ---- types -------------------------------------------------------------------------------


def wider(a: str | None, b: str | None) -> str | None:
    """The narrowest type that holds values of both; None is a column without values so far."""
    if a is None or b is None or a == b:
        return a or b
    if a in NUMBERS and b in NUMBERS:
        return NUMBERS[max(NUMBERS.index(a), NUMBERS.index(b))]
    return "string"


#: what every text that has a type looks like; a cast throws inside for any other text, which is slow
_LOOKS = {
    "int": r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$",
    "bigint": r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$",
    "double": r"^[\x00-\x20]*[+-]?(?i:[0-9]*\.?[0-9]*(?:e[+-]?[0-9]+)?[df]?"
    r"|0x[0-9a-f]*\.?[0-9a-f]*p[+-]?[0-9]+[df]?|inf|infinity|nan)[\x00-\x20]*$",
    "date": r"^\s*\d{4}-\d{2}-\d{2}\s*$",
}


def _fits(column: Column, kind: str) -> Column:
    return F.when(column.rlike(_LOOKS[kind]), column.try_cast(kind).isNotNull()).otherwise(False)


def value_types(df: DataFrame) -> Types:
    """The narrowest type of every text column, by all its values; one pass, one row for each column.

    The values are dealt as rows of (column, value), so the checks are written out once and not for
    every column: code of that length would not be compiled.
    """
    kinds = (*NUMBERS, "date")
    cells = df.select(F.posexplode(F.array(*(F.col(f"`{c}`") for c in df.columns))).alias("_i", "_value"))
    value = F.col("_value")
    misfits = (F.count_if(~F.coalesce(_fits(value, k), F.lit(False))).alias(k) for k in kinds)
    seen = {r["_i"]: r for r in cells.filter("_value IS NOT NULL").groupBy("_i").agg(*misfits).collect()}
    return {
        c: next((k for k in kinds if seen[i][k] == 0), "string") if i in seen else None
        for i, c in enumerate(df.columns)
    }


# ---- the history of schemas --------------------------------------------------------------


def schema_history(spark: SparkSession, target: str) -> DataFrame:
    """(version, position, name, type): every version with all its columns."""
    return spark.read.schema(_HISTORY).parquet(f"{target}/_schemas/*")


def schema_at(spark: SparkSession, target: str, version: int | None = None) -> tuple[int, Types]:
    """A version's columns and types, the last one's by default; (0, {}) if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_schemas")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return 0, {}
    rows = schema_history(spark, target).collect()  # a row for each column and version
    last = max((r.version for r in rows if version is None or r.version <= version), default=0)
    own = sorted((r for r in rows if r.version == last), key=lambda r: r.position)
    return last, {r.name: r.type for r in own}


def _evolve(spark: SparkSession, target: str, seen: Types) -> int:
    """Add a version if the seen columns and types ask for one; the version that holds them."""
    version, types = schema_at(spark, target)
    merged = types | {c: wider(types.get(c), kind) for c, kind in seen.items()}
    if version and merged == types:
        return version
    rows = [(version + 1, i, c, kind) for i, (c, kind) in enumerate(merged.items())]
    spark.createDataFrame(rows, _HISTORY).coalesce(1).write.mode("overwrite").parquet(f"{target}/_schemas/{version + 1}")
    return version + 1


# ---- bronze ------------------------------------------------------------------------------


def store_drops(
    spark: SparkSession, landing: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Append new CSV files to a raw table of texts, each by its own header, and keep its schema history."""

    def store(batch: DataFrame, number: int) -> None:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for row in batch.collect():  # at most files_per_batch names
            by_header.setdefault(tuple(header_columns(spark, row.path)), []).append(row.path)
        parts = []
        for header, paths in by_header.items():
            texts = T.StructType([T.StructField(c, T.StringType()) for c in header])
            parts.append(with_file_lineage(read_csv(spark, paths, texts, glob="*")))
        if parts:
            rows = materialize(union_by_name(parts), "drops")
            version = _evolve(spark, target, value_types(rows.drop(*LINEAGE.fieldNames())))
            rows.withColumn(_VERSION, F.lit(version)).write.mode("overwrite").parquet(f"{target}/rows/batch={number}")

    names = (
        spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")
    )
    return names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _raw_schema(types: Types) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in types]
    return T.StructType([*texts, *LINEAGE.fields, T.StructField(_VERSION, T.IntegerType())])


def typed(raw: DataFrame, types: Types) -> DataFrame:
    """Texts as the types of a schema version."""
    return raw.withColumns({c: F.col(f"`{c}`").try_cast(kind) for c, kind in types.items() if kind and kind != "string"})


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """The raw table in its last schema version."""
    _, types = schema_at(spark, target)
    return typed(spark.read.schema(_raw_schema(types)).parquet(f"{target}/rows/*"), types).drop(_VERSION)


# ---- silver, rules and gold --------------------------------------------------------------


class SchemaChanged(Exception):
    """A batch holds rows of a later schema version than the stream was started with."""


def season_records(results: DataFrame) -> DataFrame:
    """Season, competition and team with contests, wins, draws, losses and points."""

    def side(me: str, other: str, won: str, lost: str) -> Column:
        return F.struct(
            F.col(f"{me}Team").alias("Team"), F.col(won).alias("won"), F.col("DrawFlag").alias("drawn"),
            F.col(lost).alias("lost"), F.col(f"{me}Score").alias("scored"), F.col(f"{other}Score").alias("conceded"),
        )

    sides = F.array(side("Home", "Away", "HomeWinFlag", "AwayWinFlag"), side("Away", "Home", "AwayWinFlag", "HomeWinFlag"))
    rows = results.select("Season", "Competition", F.explode(sides).alias("s")).select("Season", "Competition", "s.*")
    return rows.groupBy("Season", "Competition", "Team").agg(
        F.count("*").alias("played"), *(F.sum(c).alias(c) for c in ("won", "drawn", "lost", "scored", "conceded"))
    )


def _silver_batch(
    raw: DataFrame, types: Types, rules: Sequence[Rule], teams: silver.Aliases, competitions: silver.Aliases
) -> tuple[DataFrame, Observation]:
    """The contests of a batch that pass the drop rules, and their rule counts."""
    named = {"MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "HomeScore", "AwayScore", "Date", "Competition"}
    missing = {c: F.lit(None).cast("string") for c in sorted(named) if c not in types}
    extra = [c for c in types if c not in named]
    texts = raw.withColumns(missing) if missing else raw
    read = typed(texts, {c: types[c] for c in extra})
    scored = silver.scored(read, teams, competitions, extra)
    seen = Observation()
    counts = [F.count_if(~r.holds).alias(r.name) for r in rules]
    return enforce(scored.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), rules), seen


def start_silver(
    spark: SparkSession,
    target: str,
    rules: Sequence[Rule] = RESULT_RULES,
    teams: silver.Aliases = TEAM_ALIASES,
    competitions: silver.Aliases = COMPETITION_ALIASES,
    version: int | None = None,
) -> StreamingQuery:
    """Bronze to silver, rule counts and gold seasons, in one schema version (the last by default)."""
    version, types = schema_at(spark, f"{target}/bronze", version)
    rows = spark.readStream.schema(_raw_schema(types)).parquet(f"{target}/bronze/rows/*")

    def store(batch: DataFrame, number: int) -> None:
        latest = batch.agg(F.max(_VERSION).alias("v")).first()["v"]
        if latest is None:
            return
        if latest > version:
            raise SchemaChanged(f"batch {number} has schema version {latest}, the stream {version}")
        results, seen = _silver_batch(batch.drop(_VERSION), types, rules, teams, competitions)
        results.write.mode("overwrite").parquet(f"{target}/silver/version={version}/batch={number}")
        counts = seen.get
        told = [(number, r.name, "drop" if r.drop else "warn", counts["rows"] - counts[r.name], counts[r.name]) for r in rules]
        history = spark.createDataFrame(told, "batch long, rule string, action string, passed long, failed long")
        history.coalesce(1).write.mode("overwrite").parquet(f"{target}/rules/batch={number}")
        _refresh_gold(spark, target, f"{target}/silver/version={version}/batch={number}")

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{target}/_checkpoints/silver")
        .trigger(availableNow=True)
        .start()
    )


def _refresh_gold(spark: SparkSession, target: str, batch: str) -> None:
    """Recompute the seasons that a silver batch holds, from all of silver, and replace just these."""
    seasons = materialize(spark.read.parquet(batch).select("Season").distinct(), "touched-seasons")
    results = read_silver(spark, target).join(seasons, "Season", "left_semi")
    records = season_records(results).repartition("Season")
    (
        records.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("Season")
        .parquet(f"{target}/gold/season_records")
    )


def run_silver(spark: SparkSession, target: str, version: int | None = None, **options) -> int:
    """Take all new bronze rows; starts again for each schema change. The number of starts."""
    starts = 0
    while True:
        starts += 1
        try:
            start_silver(spark, target, version=version, **options).awaitTermination()
            return starts
        except StreamingQueryException as stopped:
            if "SchemaChanged" not in str(stopped):
                raise
            version = None


def read_silver(spark: SparkSession, target: str) -> DataFrame:
    """Silver of all schema versions in the columns and types of the last one."""
    last, types = schema_at(spark, f"{target}/bronze")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/silver")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = []
    for version in range(1, last + 1):
        path = f"{target}/silver/version={version}"
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(path)):
            part = spark.read.parquet(f"{path}/*")
            parts.append(part.withColumns({c: F.col(f"`{c}`").cast(k) for c, k in types.items() if k and _is_extra(c, part)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _is_extra(column: str, part: DataFrame) -> bool:
    """Whether a silver column came along from the files, after those silver makes itself."""
    own = part.columns.index("_silver_ingest_timestamp")
    return column in part.columns[own + 1 :]


def read_rule_history(spark: SparkSession, target: str) -> DataFrame:
    """(batch, rule, action, passed, failed) of every silver batch, once each."""
    return spark.read.parquet(f"{target}/rules/*")


def run_ingest(spark: SparkSession, landing: str, target: str, **options) -> int:
    """One incremental run from CSV files to gold seasons; the number of silver starts."""
    store_drops(spark, landing, f"{target}/bronze", f"{target}/_checkpoints/bronze").awaitTermination()
    return run_silver(spark, target, **options) if schema_at(spark, f"{target}/bronze")[0] else 0


# ---- dedupe ------------------------------------------------------------------------------


def deduplicated_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key; a key is forgotten ``delay`` after its last event time.

    State is one key for each row of the last ``delay``. Take an ingest time as event time:
    rows older than the watermark are dropped, which an ingest time never is.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
