"""Dense numbering (1, 2, 3, ...) of a whole table in a given order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contestry.session import materialize

# monotonically_increasing_id(): partition number above, row number in the lower 33 bits
_ROW_BITS = 33


def numbered(
    df: DataFrame, name: str, order: Sequence[str | Column], unique: bool = False
) -> DataFrame:
    """Add ``name`` = row number over the whole table, without a one-task window.

    The table is range-partitioned on the order, sorted inside the partitions and
    written once; a row's number is its place in its partition plus the rows of
    all earlier partitions. Only one row per partition is broadcast.

    ``unique=True`` says that the order columns are a key. If they are not, ties
    are broken by a hash of the whole row, then by its columns, so the same rows
    get the same numbers in every run. Rows that are equal in all columns are
    counted before the shuffle and dealt out again by their copy number, so even a
    large group of them spreads over many partitions.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    columns = df.columns
    if not unique:
        copies = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
        df = copies.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
        order = [*order, F.xxhash64(*columns), *columns, F.col("_copy")]

    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .select(*columns, "_slot"),
        name,
    )
    part = F.shiftright("_slot", _ROW_BITS)
    place = F.col("_slot") - F.shiftleft(part, _ROW_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    offsets = materialize(offsets, f"{name}-offsets")
    return placed.join(F.broadcast(offsets), part == F.col("_part")).select(
        *columns, (F.col("_offset") + place + 1).alias(name)
    )


def dimension(names: DataFrame, id_name: str) -> DataFrame:
    """Distinct rows of a one-column table with a surrogate id in name order."""
    return numbered(names.distinct(), id_name, names.columns, unique=True)
