"""Small fixed relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# League rounds 1-30, then the play-off rounds (spelt as in the source).
LEAGUE_ROUNDS = 30
PLAYOFF_ROUNDS = (
    ("QF", "Quater Final", 98, "PlayOff"),
    ("SF", "Semi Final", 99, "PlayOff"),
    ("F", "Final", 100, "Final"),
)

# Starting rating per competition.
BASELINES = {"premiership": 1500.0, "championship": 900.0, "urc": 1300.0, "pro-14": 1800.0}


def literal(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A few rows given in the program.

    From Arrow data Spark makes a local relation, whose size it knows, so that
    joins broadcast it; rows in a Python list would have an unknown size and make
    the other side shuffle on a key with few values.
    """
    names = [field.split()[0] for field in schema.split(",")]
    return spark.createDataFrame(pa.table([list(c) for c in zip(*rows)], names=names), schema)


def dim_rounds(spark: SparkSession) -> DataFrame:
    """33 round codes in playing order with a dense id."""
    rounds = [(str(n), f"Round {n}", n, "League") for n in range(1, LEAGUE_ROUNDS + 1)]
    rounds += PLAYOFF_ROUNDS
    rows = [(*row, i) for i, row in enumerate(sorted(rounds, key=lambda r: r[2]), start=1)]
    return literal(
        spark, "RoundCode string, RoundName string, RoundOrder int, RoundType string, RoundId long", rows
    )


def baselines(spark: SparkSession, ratings: Mapping[str, float] = BASELINES) -> DataFrame:
    rows = [(name, float(rating)) for name, rating in ratings.items()]
    return literal(spark, "Competition string, StartingElo double", rows)
