"""Feature tables for training and for the next round."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators.keys import numbered

FEATURES = ("HomeTeamElo", "AwayTeamElo", "EloDiff", "IsNeutral")
LABEL = "HomeWinFlag"


def last_rounds(facts: DataFrame) -> DataFrame:
    """Latest played round per season and competition."""
    return facts.groupBy("SeasonId", "CompetitionId").agg(
        F.max("RoundOrder").alias("LastCompletedRound")
    )


def next_round(upcoming: DataFrame, last: DataFrame, follow: str = "next") -> DataFrame:
    """Upcoming contests of the round after the last played one.

    ``follow="next"`` takes round number + 1. ``follow="available"`` takes the
    smallest later round that is scheduled, so play-offs follow the league.
    """
    ahead = upcoming.join(last, ["SeasonId", "CompetitionId"])
    if follow == "next":
        return ahead.filter(F.col("RoundOrder") == F.col("LastCompletedRound") + 1)
    ahead = ahead.filter(F.col("RoundOrder") > F.col("LastCompletedRound"))
    first = ahead.groupBy("SeasonId", "CompetitionId").agg(F.min("RoundOrder").alias("RoundOrder"))
    return ahead.join(first, ["SeasonId", "CompetitionId", "RoundOrder"], "left_semi")


def with_difference(df: DataFrame, digits: int | None = None) -> DataFrame:
    gap = F.col("HomeTeamElo") - F.col("AwayTeamElo")
    return df.withColumn("EloDiff", gap if digits is None else F.round(gap, digits))


def next_round_features(
    upcoming: DataFrame,
    last: DataFrame,
    latest: DataFrame,
    follow: str = "next",
    diff_digits: int | None = None,
) -> DataFrame:
    """Features of the next round; teams without a rating keep null."""
    games = next_round(upcoming, last, follow)
    for side in ("Home", "Away"):
        elo = latest.select(
            F.col("TeamId").alias(f"{side}TeamId"), F.col("EloAfter").alias(f"{side}TeamElo")
        )
        games = games.join(elo, f"{side}TeamId", "left")
    # fixed values: the names of the feature table's columns
    return with_difference(games, diff_digits).select(
        "HomeTeamId", "AwayTeamId", "HomeTeamElo", "AwayTeamElo", "EloDiff", "SeasonId",
        "RoundName", "RoundOrder", "Date", "CompetitionId", "IsNeutral",
    )


def training_frame(
    rated: DataFrame, digits: int | None = 2, diff_digits: int | None = 0
) -> DataFrame:
    """Pre-match ratings, difference, neutral flag and label per played contest.

    ``rated`` has one row per contest with both sides' ratings and the contest's own
    columns, so this is a projection. A contest lacking a rating drops out.
    """
    elo = {f"{s}TeamElo": F.col(f"{s}EloBefore") for s in ("Home", "Away")}
    if digits is not None:
        elo = {name: F.round(c, digits) for name, c in elo.items()}
    return (
        with_difference(rated.withColumns(elo), diff_digits)
        .select("MatchSequence", *FEATURES, LABEL)
        .na.drop()
    )


def ordered_split(
    frame: DataFrame, test_share: float = 0.2, order: str = "MatchSequence"
) -> tuple[DataFrame, DataFrame]:
    """First part for training, last part for testing, in sequence, no shuffling of rows."""
    ranked = numbered(frame, "Position", [order], unique=True)
    total = ranked.count()
    train_rows = total - math.ceil(total * test_share)
    return (
        ranked.filter(F.col("Position") <= train_rows),
        ranked.filter(F.col("Position") > train_rows),
    )
