"""Data-quality rules, profiles and reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named SQL condition; ``drop`` rules remove the rows that fail them.

    An unknown (null) outcome counts as a failure.
    """

    name: str
    condition: str
    drop: bool = False

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def not_null(name: str, column: str, drop: bool = False) -> Rule:
    return Rule(name, f"{column} IS NOT NULL", drop)


RESULT_RULES = (
    not_null("valid_match_id", "MatchId"),
    not_null("valid_home_team", "HomeTeam", drop=True),
    not_null("valid_away_team", "AwayTeam", drop=True),
    not_null("valid_season", "Season", drop=True),
    not_null("valid_round", "Round", drop=True),
    not_null("valid_home_team_score", "HomeScore", drop=True),
    not_null("valid_away_team_score", "AwayScore", drop=True),
    Rule("valid_scores", "HomeScore >= 0 AND AwayScore >= 0"),
    Rule("different_teams", "HomeTeam != AwayTeam", drop=True),
    not_null("valid_date", "Date"),
)


def upcoming_rules(as_of: dt.date) -> tuple[Rule, ...]:
    return (
        not_null("valid_match_id", "MatchId"),
        not_null("valid_home_team", "HomeTeam"),
        not_null("valid_away_team", "AwayTeam"),
        Rule("different_teams", "HomeTeam != AwayTeam"),
        not_null("valid_date", "Date"),
        Rule("upcoming_match", f"Date >= DATE'{as_of.isoformat()}'"),
    )


def dimension_rules(name_column: str, id_column: str) -> tuple[Rule, ...]:
    return (not_null(f"valid_{name_column}", name_column), not_null(f"valid_{id_column}", id_column))


OLDEST_SEASON_RULES = (not_null("valid_season", "Season"), not_null("valid_competition", "Competition"))


def season_date_rule(first_month: int = 8) -> Rule:
    """Optional rule: the date of a "15/16" contest lies in that season."""
    start = f"make_date(2000 + try_cast(substring(Season, 1, 2) AS INT), {first_month}, 1)"
    return Rule("date_in_season", f"Date >= {start} AND Date < add_months({start}, 12)")


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that pass every drop rule; warn rules remove nothing."""
    for rule in rules:
        if rule.drop:
            df = df.filter(rule.holds)
    return df


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str) -> DataFrame:
    """Count failures while the data flows past (batch ``Observation`` or stream progress)."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(~rule.holds).alias(rule.name) for rule in rules),
    )


def _long(df: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """Turn a one-row frame into one row per column."""
    return df.unpivot([], list(names), key, value)


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its action, passed and failed rows; one pass over the data."""
    checks = [F.count_if(~rule.holds).alias(rule.name) for rule in rules]
    failures = df.agg(F.count(F.lit(1)).alias("_rows"), *checks)
    actions = F.create_map(
        *(F.lit(v) for rule in rules for v in (rule.name, "drop" if rule.drop else "warn"))
    )
    return failures.unpivot("_rows", [r.name for r in rules], "rule", "failed").select(
        "rule",
        actions[F.col("rule")].alias("action"),
        (F.col("_rows") - F.col("failed")).alias("passed"),
        "failed",
    )


def condition_report(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row per named condition with the number of rows it holds for; one pass."""
    counts = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))
    return _long(counts, list(conditions), "check", "rows")


def breaches(df: DataFrame, conditions: Mapping[str, Column], key: str) -> DataFrame:
    """One row per row and condition that holds for it."""
    hits = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in conditions.items())))
    return df.select(key, F.explode(hits).alias("check"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column; one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns))
    return _long(counts, [f"`{c}`" for c in columns], "column", "nulls")


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies; copies are counted before the shuffle."""
    groups = df.groupBy(*(f"`{c}`" for c in keys or df.columns)).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def deduplicate(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Exact-row dedupe, or one row per key (the smallest in column order)."""
    if keys is None:
        return df.distinct()
    rest = [c for c in df.columns if c not in set(keys)]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*(c if c in set(keys) else F.col(f"_row.{c}") for c in df.columns))


# A contest is the same one if these agree; ids restart in every file.
CONTEST_KEY = ("Competition", "Season", "Date", "HomeTeam", "AwayTeam")


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)


def rows_per_source(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as (column, value), from one scan."""
    pairs = F.explode(
        F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns))
    )
    return df.select(pairs.alias("_p")).select("_p.*").distinct()


# ---- checks over contest statistics ----------------------------------------------------

SIDES = ("Home", "Away")


def _either(condition) -> Column:
    return condition("Home") | condition("Away")


def negative_scores() -> Column:
    return _either(lambda s: F.col(f"{s}Score") < 0)


def more_conversions_than_tries() -> Column:
    return _either(lambda s: F.col(f"{s}Tries") < F.col(f"{s}Conversions"))


def more_post_contact_than_metres() -> Column:
    return _either(lambda s: F.col(f"{s}MetresGained") < F.col(f"{s}PostContactMetres"))


def score_not_explained(drop_goals: bool = False) -> Column:
    """Score differs from 5 per try, 2 per conversion and 3 per penalty (or drop goal)."""

    def wrong(side: str) -> Column:
        points = (
            F.col(f"{side}Tries") * 5
            + F.col(f"{side}Conversions") * 2
            + F.col(f"{side}PenaltyGoals") * 3
        )
        if drop_goals:
            points = points + F.col(f"{side}DropGoals") * 3
        return F.col(f"{side}Score") != points

    return _either(wrong)


def not_whole(columns: Sequence[str], eps: float = 1e-6) -> Column:
    """The shares do not add up to 1; ``eps=0`` compares exactly."""
    total = sum((F.col(f"`{c}`") for c in columns[1:]), F.col(f"`{columns[0]}`"))
    return F.abs(total - 1) > eps


# Groups of share columns that add up to 1.
SHARE_GROUPS = {
    "territory": ("HomeTerritory", "AwayTerritory"),
    "possession": ("HomePossession", "AwayPossession"),
    "home_ruck_speed": ("Home0-3sRuckSpeed", "Home3-6sRuckSpeed", "Home6s+RuckSpeed"),
    "away_ruck_speed": ("Away0-3sRuckSpeed", "Away3-6sRuckSpeed", "Away6s+RuckSpeed"),
    "territory_zones": (
        "TerritoryHomeTry-Line-22m",
        "TerritoryHome22m-50m",
        "TerritoryAway22m-50m",
        "TerritoryAwayTry-Line-22m",
    ),
    "home_possession_zones": (
        "HomePossessionsTryLine-22m",
        "HomePossession22m-50m",
        "HomePossessionOpp50m-22m",
        "HomePossessionOpp22m-TryLine",
    ),
    "away_possession_zones": (
        "AwayPossessionsTryLine-22m",
        "AwayPossession22m-50m",
        "AwayPossessionOpp50m-22m",
        "AwayPossessionOpp22m-TryLine",
    ),
    "last10_possession": ("HomePossessionLast10", "AwayPossessionLast10"),
}


def domain_checks(drop_goals: bool = False) -> dict[str, Column]:
    return {
        "negative_scores": negative_scores(),
        "more_conversions_than_tries": more_conversions_than_tries(),
        "more_post_contact_than_metres": more_post_contact_than_metres(),
        "score_not_explained": score_not_explained(drop_goals),
    }


def share_checks(eps: float = 1e-6) -> dict[str, Column]:
    return {name: not_whole(columns, eps) for name, columns in SHARE_GROUPS.items()}
