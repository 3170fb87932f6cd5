"""Silver to gold: the star, rating and feature tables of one refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.operators import quality, rating, star
from contestry.plans import features
from contestry.session import materialize
from contestry.sources import literals
from contestry.sources.tables import save_table

# Names of the stored tables and the properties that hold them.
TABLES = {
    "dim_teams": "teams",
    "dim_rounds": "rounds",
    "dim_competitions": "competitions",
    "dim_seasons": "seasons",
    "fact_match_results": "facts",
    "upcoming_matches_fact": "upcoming",
    "oldest_season_per_comp": "oldest",
    "baseline_elo": "baseline",
    "match_sequence": "sequence",
    "starting_team_comps": "starting",
    "team_base_elo": "base",
    "fact_elo": "ratings",
    "latest_elo": "latest",
    "last_played_round": "last_rounds",
    "match_features": "next_features",
}
# Filters by season read one folder, filters by team few row groups of it.
PARTITIONS = {"fact_elo": "SeasonId"}
SORTED = {"fact_elo": ("SeasonId", "TeamId")}


class Gold:
    """All gold tables over the two silver tables.

    A table is built when it is first read and then stored in the shared folder
    for the tables that need it, so one refresh computes each of them once.
    Dimensions come from played contests; ids hold for one refresh.
    """

    def __init__(
        self,
        silver: DataFrame,
        upcoming: DataFrame,
        baselines: Mapping[str, float] = literals.BASELINES,
        default_start: float | None = None,
        digits: int | None = 2,
        slice_rows: int | None = None,
        follow: str = "next",
    ):
        self.spark = silver.sparkSession
        self._silver, self._upcoming = silver, upcoming
        self._baselines = baselines
        self._rating_options = {"default_start": default_start, "slice_rows": slice_rows}
        self._digits = digits
        self._follow = follow

    @cached_property
    def silver(self) -> DataFrame:
        return materialize(self._silver, "silver")

    @cached_property
    def upcoming_silver(self) -> DataFrame:
        return materialize(self._upcoming, "upcoming-silver")

    # ---- star schema ----

    @cached_property
    def teams(self) -> DataFrame:
        return materialize(star.dim_teams(self.silver), "teams")

    @cached_property
    def competitions(self) -> DataFrame:
        return materialize(star.dim_competitions(self.silver), "competitions")

    @cached_property
    def seasons(self) -> DataFrame:
        return materialize(star.dim_seasons(self.silver), "seasons")

    @cached_property
    def rounds(self) -> DataFrame:
        return literals.dim_rounds(self.spark)

    @cached_property
    def facts(self) -> DataFrame:
        return star.fact_matches(self.silver, self.teams, self.competitions, self.seasons, self.rounds)

    @cached_property
    def upcoming(self) -> DataFrame:
        return star.fact_upcoming(
            self.upcoming_silver, self.teams, self.competitions, self.seasons, self.rounds
        )

    # ---- ratings ----

    @cached_property
    def sequence(self) -> DataFrame:
        return star.match_sequence(self.facts)

    @cached_property
    def starting(self) -> DataFrame:
        return rating.starting_competitions(self.facts)

    @cached_property
    def oldest(self) -> DataFrame:
        return rating.oldest_seasons(self.silver)

    @cached_property
    def baseline(self) -> DataFrame:
        return rating.baseline_ratings(literals.baselines(self.spark, self._baselines), self.oldest)

    @cached_property
    def base(self) -> DataFrame:
        base = rating.team_base_ratings(self.starting, self.competitions, self.baseline)
        return materialize(base, "base")

    @cached_property
    def rated(self) -> DataFrame:
        """One row per contest with both sides' ratings, stored."""
        return materialize(rating.rate(self.sequence, self.base, **self._rating_options), "rated-contests")

    @cached_property
    def ratings(self) -> DataFrame:
        """One row per contest and team: a projection of the stored contests."""
        return rating.fact_ratings(self.rated, self._digits)

    # ---- features ----

    @cached_property
    def latest(self) -> DataFrame:
        return materialize(rating.latest_ratings(self.ratings), "latest")

    @cached_property
    def last_rounds(self) -> DataFrame:
        return materialize(features.last_rounds(self.facts), "last-rounds")

    @cached_property
    def next_features(self) -> DataFrame:
        return features.next_round_features(self.upcoming, self.last_rounds, self.latest, self._follow)

    @cached_property
    def training(self) -> DataFrame:
        return features.training_frame(self.rated, self._digits)

    # ---- rules ----

    def expectations(self, as_of: dt.date) -> DataFrame:
        """Warn rules over the gold tables: passed and failed rows by table and rule."""
        rules = {
            "dim_teams": (self.teams, quality.dimension_rules("TeamName", "TeamId")),
            "dim_competitions": (self.competitions, quality.dimension_rules("Competition", "CompetitionId")),
            "dim_seasons": (self.seasons, quality.dimension_rules("Season", "SeasonId")),
            "oldest_season_per_comp": (self.oldest, quality.OLDEST_SEASON_RULES),
            "upcoming": (self.upcoming_silver, quality.upcoming_rules(as_of)),
        }
        reports = [quality.rule_report(t, r).withColumn("table", F.lit(name)) for name, (t, r) in rules.items()]
        return reduce(DataFrame.unionByName, reports)

    def refresh(self, schema: str) -> dict[str, DataFrame]:
        """Full refresh of all gold tables in a catalog schema."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
        stored = {}
        for name, part in TABLES.items():
            df = getattr(self, part)
            if name in SORTED:
                df = df.sortWithinPartitions(*SORTED[name])
            gold = {"quality": "gold"}
            stored[name] = save_table(df, f"{schema}.{name}", properties=gold, partition_by=PARTITIONS.get(name))
        return stored
