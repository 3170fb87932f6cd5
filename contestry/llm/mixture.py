"""Mixing sources to target weights by whole copies and one hash-seeded draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contestry.llm.columns import only, spaced_word_count, whole_text
from contestry.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
SEEDS = 64


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, _draw) of every row; size is the number of words.

    ``_draw`` is a hash of id and text that seeds the row's draws.
    """
    rows = only(docs, doc_id="doc_id", source="source", _text="text")
    return rows.select("doc_id", "source", *_size_and_draw("doc_id", "_text"))


def _size_and_draw(doc_id: str, text: str) -> tuple[Column, Column]:
    return (
        spaced_word_count(whole_text(text)).alias("size"),
        F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text))).alias("_draw"),
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size, target) with one row per source.

    Sources in code point order, null last, take the weights in turn and share
    the words of all sources by weight. A source stops at ``most`` times its own
    words, and what it leaves over is shared again by weight among the others.
    Filled in the order of words per weight, a source is full exactly if the
    level that the not yet filled ones would get lies above it; so one pass over
    the sorted sources finds the final level. The windows run over one row per
    source, after all documents were summed.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    by_fill = Window.orderBy("_fill", F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    left = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    filled = (
        sums.withColumn("_weight", weight)
        .withColumn("_cap", F.col("source_size") * most)
        .withColumn("_fill", F.col("_cap") / F.col("_weight"))
        .withColumn("_words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_caps_before", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weight_left", left("_weight"))
        .withColumn("_level", (F.col("_words") - F.col("_caps_before")) / F.col("_weight_left"))
        .withColumn("_full", F.col("_fill") < F.col("_level"))
    )
    # the level of the first source that isn't full; from there on levels fall
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    return filled.withColumn("_final", level).select(
        "source",
        "source_size",
        F.when(F.col("_full") | F.col("_final").isNull(), F.col("_cap").cast("double"))
        .otherwise(F.least(F.col("_cap").cast("double"), F.col("_weight") * F.col("_final")))
        .alias("target"),
    )


def _copies(rate: Column, draw: Column, seed: Column) -> Column:
    """floor(rate), and one more with probability equal to the fraction."""
    unit = F.pmod(F.xxhash64(draw, seed), F.lit(1 << 52)) / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return whole + F.when(unit < rate - whole, F.lit(1)).otherwise(F.lit(0))


def plan_mix(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seeds: int = SEEDS,
) -> DataFrame:
    """(source, source_size, target, _rate, _seed) with one row per source.

    The draws' seed is chosen by source: of ``seeds`` seeds, the one whose copies
    come nearest to the target. All of them are summed in one aggregate.
    """
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    targets = materialize(
        source_targets(sizes, weights, most).withColumn("_rate", F.coalesce(rate, F.lit(0.0))),
        "mix-targets",
    )
    taken = [
        F.sum(F.col("size") * _copies(F.col("_rate"), F.col("_draw"), F.lit(s))).alias(f"_taken{s}")
        for s in range(seeds)
    ]
    keyed = targets.withColumnRenamed("source", "_source")
    summed = (
        sizes.join(keyed, sizes.source.eqNullSafe(F.col("_source")))
        .groupBy("_source", "source_size", "target", "_rate")
        .agg(*taken)
    )
    nearest = F.array_min(
        F.array(
            *(F.struct(F.abs(F.col(f"_taken{s}") - F.col("target")), F.lit(s).alias("s")) for s in range(seeds))
        )
    )
    return materialize(
        summed.select(
            F.col("_source").alias("source"), "source_size", "target", "_rate", nearest["s"].alias("_seed")
        ),
        "mix-plan",
    )


def with_copies(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Add source_size, target and copies to rows with source and ``_draw``."""
    keyed = plan.withColumnRenamed("source", "_source")
    return (
        sizes.join(keyed, sizes.source.eqNullSafe(F.col("_source")), "left")
        .withColumn("copies", _copies(F.col("_rate"), F.col("_draw"), F.col("_seed")))
        .drop("_source", "_rate", "_seed")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row.

    Null or empty texts have size 0 and take 0. A null source is a source of its
    own, the last. Rows that repeat an id and a text share their draw. An empty
    table gives no rows.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    mixed = with_copies(sizes, plan_mix(sizes))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST_COPIES,
    seeds: int = SEEDS,
) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns.

    The two passes over ``docs`` agree on every draw, as it depends on id and
    text only; see ``mix_report`` for nulls and repeated rows.
    """
    sizes = materialize(sized(docs), "mix-sizes")
    plan = plan_mix(sizes, weights, most, seeds)
    rows = docs.select(
        F.struct("*").alias("_doc"),
        F.col("source").alias("source"),
        _size_and_draw("doc_id", "text")[1],
    )
    copied = with_copies(rows, plan).filter("copies > 0")
    return copied.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_doc.*")
