"""Bronze to silver: played and upcoming contests. Works on batches and streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.functions.names import (
    COMPETITION_ALIASES,
    TEAM_ALIASES,
    normalise_competition_names,
    normalise_team_names,
)
from contestry.functions.scoring import is_neutral, parse_date, result_columns
from contestry.operators.quality import RESULT_RULES, enforce

Aliases = Mapping[str, str] | DataFrame


def _cleaned(bronze: DataFrame, teams: Aliases, competitions: Aliases) -> DataFrame:
    df = normalise_team_names(bronze, teams)
    df = normalise_competition_names(df, competitions)
    return df.withColumns(
        {
            "MatchId": F.col("MatchId").try_cast("long"),
            "Season": F.col("Season").cast("string"),
            "Round": F.col("Round").cast("string"),
            "Date": parse_date(F.col("Date")),
            "IsNeutral": is_neutral(),
            "_silver_ingest_timestamp": F.current_timestamp(),
        }
    )


def scored(
    bronze: DataFrame,
    teams: Aliases = TEAM_ALIASES,
    competitions: Aliases = COMPETITION_ALIASES,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Typed and enriched contests before the drop rules, with ``extra`` columns as they are."""
    scores = {c: F.col(c).try_cast("int") for c in ("HomeScore", "AwayScore")}
    df = _cleaned(bronze, teams, competitions).withColumns(scores).withColumns(result_columns())
    return df.select(
        "MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "HomeScore", "AwayScore",
        "Result", "Date", "Competition", "HomePointsDifference", "AwayPointsDifference",
        "TotalMatchPoints", "HomeWinFlag", "AwayWinFlag", "DrawFlag", "IsNeutral",
        F.col("source_file").alias("bronze_file"), "_silver_ingest_timestamp", *(f"`{c}`" for c in extra),
    )


def match_results(
    bronze: DataFrame, teams: Aliases = TEAM_ALIASES, competitions: Aliases = COMPETITION_ALIASES
) -> DataFrame:
    """Silver table of played contests: cleaned, enriched, drop rules applied."""
    return enforce(scored(bronze, teams, competitions), RESULT_RULES)


def upcoming_matches(
    bronze: DataFrame,
    as_of: dt.date,
    teams: Aliases = TEAM_ALIASES,
    competitions: Aliases = COMPETITION_ALIASES,
) -> DataFrame:
    """Silver table of contests dated ``as_of`` or later (its rules only warn)."""
    return (
        _cleaned(bronze, teams, competitions)
        .filter(F.col("Date") >= F.lit(as_of))
        .select(
            "MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "Date", "Competition",
            "IsNeutral", "source_file", "_silver_ingest_timestamp",
        )
    )
