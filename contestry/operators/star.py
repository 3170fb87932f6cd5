"""Star schema: dimensions, match facts, the wide fact, the match sequence.

No join here carries a broadcast hint: dimensions are stored tables, so Spark
knows their size, broadcasts them while they are small and otherwise shuffles,
splitting skewed keys (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators.keys import dimension, numbered


def both_sides(df: DataFrame, home: str, away: str, name: str, *carry: str) -> DataFrame:
    """One row per contest and side, from a single scan (UNION ALL of the two sides)."""
    return df.select(F.explode(F.array(home, away)).alias(name), *carry)


def dim_teams(silver: DataFrame) -> DataFrame:
    return dimension(both_sides(silver, "HomeTeam", "AwayTeam", "TeamName"), "TeamId")


def dim_competitions(silver: DataFrame) -> DataFrame:
    return dimension(silver.select("Competition"), "CompetitionId")


def dim_seasons(silver: DataFrame) -> DataFrame:
    return dimension(silver.select("Season"), "SeasonId")


def dim_results(silver: DataFrame) -> DataFrame:
    return dimension(silver.select("Result"), "ResultId")


def dim_played_rounds(silver: DataFrame) -> DataFrame:
    """Round codes that occur, numbered in string order."""
    return dimension(silver.select("Round"), "RoundId")


def _with_dimensions(
    silver: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame, rounds: DataFrame
) -> DataFrame:
    """Ids for names; rows with an unknown team, competition or season drop out."""
    home = teams.select(F.col("TeamName").alias("HomeTeam"), F.col("TeamId").alias("HomeTeamId"))
    away = teams.select(F.col("TeamName").alias("AwayTeam"), F.col("TeamId").alias("AwayTeamId"))
    return (
        silver.join(home, "HomeTeam")
        .join(away, "AwayTeam")
        .join(competitions, "Competition")
        .join(seasons, "Season")
        .join(rounds, silver["Round"] == rounds["RoundCode"], "left")
    )


# Order in which match keys are given; MatchId settles contests that agree in the rest.
MATCH_ORDER = ("Date", "CompetitionId", "HomeTeamId", "AwayTeamId", "MatchId")

_FACT_KEYS = (
    "HomeTeamId", "AwayTeamId", "SeasonId", "RoundId", "RoundCode", "RoundOrder", "RoundName",
    "RoundType", "Date",
)
_FACT_MEASURES = (
    "HomeScore", "AwayScore", "Result", "HomePointsDifference", "AwayPointsDifference",
    "TotalMatchPoints", "HomeWinFlag", "AwayWinFlag", "DrawFlag",
)


def _facts(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    keyed = numbered(joined.select("MatchId", *columns), "MatchKey", MATCH_ORDER)
    return keyed.select("MatchKey", *columns)


def fact_matches(
    silver: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame, rounds: DataFrame
) -> DataFrame:
    """One row per played contest with dimension ids and a dense MatchKey."""
    joined = _with_dimensions(silver, teams, competitions, seasons, rounds)
    return _facts(
        joined,
        [*_FACT_KEYS, "CompetitionId", *_FACT_MEASURES, "IsNeutral", "_silver_ingest_timestamp"],
    )


def fact_upcoming(
    silver: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame, rounds: DataFrame
) -> DataFrame:
    """One row per future contest with dimension ids and a dense MatchKey."""
    joined = _with_dimensions(silver, teams, competitions, seasons, rounds)
    return _facts(
        joined, [*_FACT_KEYS, "IsNeutral", "CompetitionId", "_silver_ingest_timestamp"]
    )


def unmatched(
    silver: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame
) -> DataFrame:
    """Contests per dimension that the inner joins of the fact would drop; one scan."""
    lookups = {
        "home_team": ("HomeTeam", teams, "TeamName"),
        "away_team": ("AwayTeam", teams, "TeamName"),
        "competition": ("Competition", competitions, "Competition"),
        "season": ("Season", seasons, "Season"),
    }
    rows = silver.select("HomeTeam", "AwayTeam", "Competition", "Season")
    for label, (column, dim, key) in lookups.items():
        known = dim.select(F.col(key).alias(column), F.lit(True).alias(f"_{label}"))
        rows = rows.join(known, column, "left")
    counts = rows.agg(*(F.count_if(F.col(f"_{n}").isNull()).alias(n) for n in lookups))
    return counts.unpivot([], list(lookups), "dimension", "rows")


# Order in which contests are rated, and the order by season and round code as text.
SEQUENCE_ORDER = ("SeasonId", "Date", "RoundOrder", "MatchKey")
ROUND_TEXT_ORDER = ("SeasonId", "RoundCode", "MatchKey")


def match_sequence(facts: DataFrame, order: Sequence[str] = SEQUENCE_ORDER) -> DataFrame:
    """A dense MatchSequence in the given order, which must end in a unique column."""
    columns = (
        "MatchKey", "HomeTeamId", "AwayTeamId", "SeasonId", "CompetitionId", "RoundOrder",
        "RoundCode", "Date", "Result", "IsNeutral", "HomeWinFlag",
    )
    return numbered(facts.select(*columns), "MatchSequence", order, unique=True)


def wide_fact(
    facts: DataFrame,
    ratings: DataFrame,
    teams: DataFrame,
    seasons: DataFrame,
    rounds: DataFrame,
    results: DataFrame,
) -> DataFrame:
    """Every contest with all its dimension rows and both sides' ratings, left-joined,
    with its stage and load time.

    ``ratings`` has one row per MatchKey (``rating.rate`` or ``rating.flat_start``).
    """
    home = teams.select(F.col("TeamId").alias("HomeTeamId"), F.col("TeamName").alias("HomeTeam"))
    away = teams.select(F.col("TeamId").alias("AwayTeamId"), F.col("TeamName").alias("AwayTeam"))
    elo = ratings.select(
        "MatchKey", "HomeEloBefore", "HomeEloAfter", "HomeEloChange",
        "AwayEloBefore", "AwayEloAfter", "AwayEloChange",
    )
    return (
        facts.select(
            "MatchKey", "HomeTeamId", "AwayTeamId", "SeasonId", "RoundId", "HomeScore",
            "AwayScore", "Result", "HomePointsDifference", "AwayPointsDifference",
        )
        .join(elo, "MatchKey", "left")
        .join(results, "Result", "left")
        .join(seasons, "SeasonId", "left")
        .join(home, "HomeTeamId", "left")
        .join(away, "AwayTeamId", "left")
        .join(rounds.select("RoundId", "RoundName"), "RoundId", "left")
        .withColumns(
            {
                "MatchPointsDifference": F.col("HomePointsDifference"),
                "lastUpload": F.current_timestamp(),
                "pipelineStage": F.lit("goldTransformation"),
            }
        )
    )
