"""Standings and count reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.functions.scoring import AWAY_WIN, DRAW, HOME_WIN
from contestry.operators.quality import CONTEST_KEY
from contestry.operators.star import both_sides


def result_counts(facts: DataFrame, seasons: DataFrame) -> DataFrame:
    """Home wins, away wins and draws per season."""
    counts = facts.groupBy("SeasonId").agg(
        F.count_if(F.col("Result") == HOME_WIN).alias("Home_Wins"),
        F.count_if(F.col("Result") == AWAY_WIN).alias("Away_Wins"),
        F.count_if(F.col("Result") == DRAW).alias("Draws"),
    )
    return (
        counts.join(seasons, "SeasonId")
        .select("Season", "Home_Wins", "Away_Wins", "Draws")
        .orderBy("Season")
    )


def team_view(facts: DataFrame, *carry: str) -> DataFrame:
    """One row per contest and team with its outcome.

    This replaces the join "team id IN (home, away)", which has no hash key and
    would run as a nested loop, by an explode of the two sides.
    """

    def side(team: str, win: str, loss: str) -> Column:
        return F.struct(
            F.col(team).alias("TeamId"),
            (F.col("Result") == win).alias("Won"),
            (F.col("Result") == loss).alias("Lost"),
            (F.col("Result") == DRAW).alias("Drew"),
        )

    sides = F.array(side("HomeTeamId", HOME_WIN, AWAY_WIN), side("AwayTeamId", AWAY_WIN, HOME_WIN))
    return facts.select(*carry, F.explode(sides).alias("_s")).select(*carry, "_s.*")


def _record(facts: DataFrame, teams: DataFrame, by: Sequence[str]) -> DataFrame:
    counts = team_view(facts, *by).groupBy("TeamId", *by).agg(
        F.count_if("Won").alias("Wins"),
        F.count_if("Lost").alias("Loses"),
        F.count_if("Drew").alias("Draws"),
    )
    return counts.join(teams, "TeamId")


def team_record(facts: DataFrame, teams: DataFrame) -> DataFrame:
    """Wins, losses and draws per team, most wins first."""
    return (
        _record(facts, teams, [])
        .select("TeamName", "Wins", "Loses", "Draws")
        .orderBy(F.desc("Wins"), "TeamName")
    )


def team_season_record(facts: DataFrame, teams: DataFrame, seasons: DataFrame) -> DataFrame:
    """Wins, losses and draws per team and season."""
    return (
        _record(facts, teams, ["SeasonId"])
        .join(seasons, "SeasonId")
        .select(F.col("TeamName").alias("Team"), "Season", "Wins", "Loses", "Draws")
        .orderBy("Season", F.desc("Team"))
    )


def season_totals(counts: DataFrame) -> DataFrame:
    """Dashboard roll-up of ``result_counts``."""
    return counts.groupBy("Season").agg(
        *(F.sum(c).alias(c) for c in ("Home_Wins", "Away_Wins", "Draws"))
    )


def wins_by_team(records: DataFrame, teams: Sequence[str] | None = None) -> DataFrame:
    """Dashboard roll-up of ``team_season_record``, optionally for chosen teams."""
    if teams is not None:
        records = records.filter(F.col("Team").isin(list(teams)))
    return records.groupBy("Team", "Season").agg(F.sum("Wins").alias("Wins"))


def counts_by(df: DataFrame, *columns: str, name: str = "matches") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def competition_counts(facts: DataFrame, competitions: DataFrame) -> DataFrame:
    return (
        counts_by(facts, "CompetitionId")
        .join(competitions, "CompetitionId")
        .select("Competition", "matches")
    )


def round_counts(facts: DataFrame) -> DataFrame:
    return counts_by(facts, "RoundCode", "RoundOrder").orderBy("RoundOrder")


def season_first_dates(facts: DataFrame) -> DataFrame:
    """Three minima per season and competition, each on its own."""
    return (
        facts.groupBy("SeasonId", "CompetitionId")
        .agg(
            F.min("Date").alias("first_date"),
            F.min("RoundOrder").alias("first_round_order"),
            F.min("RoundCode").alias("first_round_code"),
        )
        .orderBy("SeasonId", "CompetitionId")
    )


def first_date(silver: DataFrame) -> DataFrame:
    return silver.agg(F.min("Date").alias("first_date"))


def multi_competition_teams(facts: DataFrame) -> DataFrame:
    """Teams seen in more than one competition.

    Rows are counted per (team, competition) first, so the distinct count only
    sees one row per pair.
    """
    pairs = counts_by(both_sides(facts, "HomeTeamId", "AwayTeamId", "TeamId", "CompetitionId"), "TeamId", "CompetitionId")
    return (
        pairs.groupBy("TeamId")
        .agg(F.count("CompetitionId").alias("comps"), F.sum("matches").alias("matches"))
        .filter(F.col("comps") > 1)
        .orderBy(F.desc("comps"), F.desc("matches"), "TeamId")
    )


def outer_match_join(
    left: DataFrame, right: DataFrame, suffix: str = "_1", key: Sequence[str] = CONTEST_KEY
) -> DataFrame:
    """Full outer join of two contest tables on a key; the right side's columns get a suffix.

    The key should tell contests apart; ids restart in every file and don't. Rows
    that lack part of the key match nothing but would all meet in one task, so
    their content serves as a second key that spreads them.
    """

    def spread(df: DataFrame) -> DataFrame:
        lacking = reduce(or_, (F.col(c).isNull() for c in key))
        return df.withColumn("_spread", F.when(lacking, F.xxhash64(*df.columns)).otherwise(0))

    left, right = spread(left), spread(right)
    right = right.withColumnsRenamed({c: c + suffix for c in right.columns})
    on = [F.col(c) == F.col(c + suffix) for c in (*key, "_spread")]
    return left.join(right, on, "full").drop("_spread", "_spread" + suffix)


def outer_join_by_id(left: DataFrame, right: DataFrame, suffix: str = "_1") -> DataFrame:
    """The same on MatchId alone, for tables of one file each: of an id that stands n
    times on either side it makes n * n rows."""
    return outer_match_join(left, right, suffix, ("MatchId",))


def drop_suffixed(df: DataFrame, suffix: str = "_1") -> DataFrame:
    return df.drop(*(c for c in df.columns if c.endswith(suffix)))


def home_away_games(contests: DataFrame) -> DataFrame:
    """Home and away games of the teams that have both.

    Written as the full outer join and null filter that users know; Spark itself
    turns the pair into an inner join.
    """
    home = contests.groupBy("HomeTeam").agg(F.count("HomeTeam").alias("home_games"))
    away = contests.groupBy("AwayTeam").agg(F.count("AwayTeam").alias("away_games"))
    return (
        home.join(away, F.col("HomeTeam") == F.col("AwayTeam"), "full")
        .na.drop(subset=["HomeTeam", "AwayTeam"])
        .orderBy(F.desc("HomeTeam"))
    )


def base_rating_list(
    base: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame
) -> DataFrame:
    """Start ratings with names."""
    return (
        base.join(teams, "TeamId")
        .join(competitions, "CompetitionId")
        .join(seasons, "SeasonId")
        .select("TeamName", "Competition", "Season", "Elo")
    )


def named_season_ratings(
    ratings: DataFrame, teams: DataFrame, competitions: DataFrame, seasons: DataFrame
) -> DataFrame:
    """``rating.season_ratings`` with names."""
    return (
        ratings.join(teams, "TeamId")
        .join(competitions, "CompetitionId")
        .join(seasons, "SeasonId")
        .select("TeamName", "Competition", "Season", "StartingElo", "EndingElo")
        .orderBy("TeamName", "Season")
    )


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows of a total order (top-n; no full sort)."""
    return df.orderBy(*order).limit(n)
