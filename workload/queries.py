"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestry.functions import names, scoring
from contestry.operators import quality, rating, reports, star
from contestry.operators.continued import RatingStore
from contestry.operators.keys import numbered
from contestry.plans import features, model, silver
from contestry.plans.gold import Gold
from contestry.session import delete_folder, materialize, new_folder
from contestry.sources import files, landing, schemas, tables
from contestry.streaming import catalog, evolving, ingest
from workload import feeds
from workload.feeds import AS_OF

DEFAULT_START = 1500.0


@dataclass(frozen=True)
class Pipeline:
    """Silver and gold of one data folder; every stored table is built once, when first read."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def bronze(self) -> DataFrame:
        return feeds.bronze(self.spark, self.sf_dir)

    @cached_property
    def aliases(self) -> DataFrame:
        return feeds.team_aliases(self.spark, self.sf_dir)

    @cached_property
    def scored(self) -> DataFrame:
        return silver.scored(self.bronze, self.aliases)

    @cached_property
    def results(self) -> DataFrame:
        return silver.match_results(self.bronze, self.aliases)

    @cached_property
    def upcoming(self) -> DataFrame:
        return silver.upcoming_matches(self.bronze, AS_OF, self.aliases)

    @cached_property
    def gold(self) -> Gold:
        """Gold tables over stored bronze, which both silver tables read."""
        bronze = materialize(self.bronze, "bronze")
        return Gold(
            silver.match_results(bronze, self.aliases),
            silver.upcoming_matches(bronze, AS_OF, self.aliases),
            default_start=DEFAULT_START,
        )

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return features.ordered_split(self.gold.training)

    @cached_property
    def evolved(self) -> str:
        """Folder of two ingest runs; the files of the second bring a column, a wider type and a date.

        Silver takes the second run in the schema of the first, so it stops and starts again.
        """
        feed = feeds.raw_feed(self.spark, self.sf_dir).withColumn("Crowd", F.col("HomeScore") * 100)
        drops, target = new_folder(self.spark, "landing"), new_folder(self.spark, "evolved")
        _write_csv(feed.filter("MatchId % 2 = 0"), f"{drops}/first")
        evolving.run_ingest(self.spark, f"{drops}/*", target, teams=self.aliases)
        late = feed.filter("MatchId % 2 = 1").withColumns(
            {
                "Crowd": F.col("Crowd") + 0.5,
                "Announced": F.date_add(F.lit("2000-01-01").cast("date"), (F.col("MatchId") % 365).cast("int")),
            }
        )
        _write_csv(late.select("Announced", *reversed(feed.columns)), f"{drops}/second")
        checkpoint = f"{target}/_checkpoints/bronze"
        evolving.store_drops(self.spark, f"{drops}/*", f"{target}/bronze", checkpoint).awaitTermination()
        evolving.run_silver(self.spark, target, version=1, teams=self.aliases)
        return target

    @cached_property
    def customers(self) -> DataFrame:
        games = feeds.customer_feed(self.spark, self.sf_dir)
        return numbered(games, "MatchSequence", ["Date", "MatchKey"], unique=True)


_pipelines: dict[tuple[str, str], Pipeline] = {}


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline of this session and folder; queries share its stored tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _pipelines:
        _pipelines[key] = Pipeline(spark, sf_dir)
    return _pipelines[key]


def forget() -> None:
    """Drop the shared tables' handles, so that the next query builds its own."""
    _pipelines.clear()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Pipeline], DataFrame]) -> Callable[[Pipeline], DataFrame]:
    """Register a function of the pipeline under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(pipeline(spark, sf_dir))
    return build


def without_times(df: DataFrame) -> DataFrame:
    """Leave out columns that differ from run to run."""
    return df.drop("_silver_ingest_timestamp", "_ingest_date", "ingestTimestamp", "lastUpload")


# ---- ingest and cleaning -----------------------------------------------------------------


@query
def ingest_metadata(p: Pipeline) -> DataFrame:
    tagged = files.with_source_tag(feeds.raw_feed(p.spark, p.sf_dir), "orders")
    return files.to_silver_lineage(tagged).select("MatchId", "sourceFileBronze", "pipelineStage")


@query
def normalise_names(p: Pipeline) -> DataFrame:
    return names.normalise_team_names(feeds.club_feed(p.spark, p.sf_dir))


@query
def normalise_competition(p: Pipeline) -> DataFrame:
    return names.normalise_competition_names(p.bronze).select("MatchId", "Competition")


@query
def parse_dates(p: Pipeline) -> DataFrame:
    return p.bronze.select("MatchId", scoring.parse_date(F.col("Date")).alias("Date"))


@query
def result_flags(p: Pipeline) -> DataFrame:
    columns = {**scoring.result_columns(), "IsNeutral": scoring.is_neutral()}
    return p.bronze.select("MatchId", *(c.alias(n) for n, c in columns.items()))


@query
def silver_results(p: Pipeline) -> DataFrame:
    return without_times(p.results)


@query
def upcoming_silver(p: Pipeline) -> DataFrame:
    return without_times(p.upcoming)


@query
def capped_metric(p: Pipeline) -> DataFrame:
    stats = feeds.statistics(p.spark, p.sf_dir)
    caps = {
        f"{s}PostContactMetres": scoring.capped(f"{s}PostContactMetres", f"{s}MetresGained")
        for s in ("Home", "Away")
    }
    return stats.select("MatchId", *(c.alias(n) for n, c in caps.items()))


# ---- quality -----------------------------------------------------------------------------


@query
def expectation_report(p: Pipeline) -> DataFrame:
    results = quality.rule_report(p.scored, quality.RESULT_RULES)
    upcoming = quality.rule_report(p.upcoming, quality.upcoming_rules(AS_OF))
    return results.withColumn("table", F.lit("results")).unionByName(
        upcoming.withColumn("table", F.lit("upcoming"))
    )


@query
def null_profile(p: Pipeline) -> DataFrame:
    return quality.null_profile(feeds.raw_feed(p.spark, p.sf_dir))


@query
def file_lineage(p: Pipeline) -> DataFrame:
    """Rows by the folder their file lies in, with one folder for each season."""
    path = new_folder(p.spark, "seasons-csv")
    feed = feeds.raw_feed(p.spark, p.sf_dir).select("MatchId", F.coalesce("Season", F.lit("unknown")).alias("Season"))
    feed.write.options(header=True).partitionBy("Season").csv(path)
    schema = T.StructType([f for f in schemas.RESULTS.fields if f.name == "MatchId"])
    stored = files.with_file_lineage(files.read_csv(p.spark, path, schema))
    folder = F.regexp_extract("source_file", "Season=([^/]+)/[^/]+[.]csv$", 1)
    return quality.rows_per_source(stored.withColumn("source_file", folder))


@query
def gold_expectations(p: Pipeline) -> DataFrame:
    return p.gold.expectations(AS_OF)


@query
def source_row_counts(p: Pipeline) -> DataFrame:
    return quality.rows_per_source(p.bronze)


@query
def duplicate_report(p: Pipeline) -> DataFrame:
    return quality.duplicate_report(feeds.raw_feed(p.spark, p.sf_dir))


@query
def dedupe_exact(p: Pipeline) -> DataFrame:
    return quality.deduplicate(feeds.raw_feed(p.spark, p.sf_dir))


@query
def dedupe_by_key(p: Pipeline) -> DataFrame:
    # the smallest row in column order stays: MatchId, Round, scores
    rows = without_times(p.gold.silver).drop("bronze_file")
    return quality.deduplicate(rows, quality.CONTEST_KEY)


@query
def domain_checks(p: Pipeline) -> DataFrame:
    return quality.condition_report(feeds.statistics(p.spark, p.sf_dir), quality.domain_checks())


@query
def domain_breaches(p: Pipeline) -> DataFrame:
    return quality.breaches(feeds.statistics(p.spark, p.sf_dir), quality.domain_checks(), "MatchId")


@query
def share_checks(p: Pipeline) -> DataFrame:
    return quality.condition_report(feeds.statistics(p.spark, p.sf_dir), quality.share_checks())


@query
def share_breaches(p: Pipeline) -> DataFrame:
    return quality.breaches(feeds.statistics(p.spark, p.sf_dir), quality.share_checks(), "MatchId")


@query
def negative_score_rows(p: Pipeline) -> DataFrame:
    rows = without_times(p.results).drop("bronze_file")
    return rows.filter(quality.negative_scores())


@query
def complete_rows(p: Pipeline) -> DataFrame:
    return quality.drop_nulls(feeds.raw_feed(p.spark, p.sf_dir))


@query
def distinct_values(p: Pipeline) -> DataFrame:
    columns = ("Result", "Season", "Round", "HomeTeam", "AwayTeam", "Competition")
    return quality.distinct_values(p.results, columns)


@query
def distinct_teams(p: Pipeline) -> DataFrame:
    home = p.gold.silver.select(F.col("HomeTeam").alias("Team"))
    away = p.gold.silver.select(F.col("AwayTeam").alias("Team"))
    return home.union(away).distinct().orderBy("Team")


# ---- star schema -------------------------------------------------------------------------


@query
def dim_teams(p: Pipeline) -> DataFrame:
    return star.dim_teams(p.results)


@query
def dim_competitions(p: Pipeline) -> DataFrame:
    return star.dim_competitions(p.results)


@query
def dim_seasons(p: Pipeline) -> DataFrame:
    return star.dim_seasons(p.results)


@query
def dim_results(p: Pipeline) -> DataFrame:
    return star.dim_results(p.results)


@query
def dim_played_rounds(p: Pipeline) -> DataFrame:
    return star.dim_played_rounds(p.results)


@query
def dim_rounds(p: Pipeline) -> DataFrame:
    played = reports.counts_by(p.gold.facts, "RoundCode")
    return p.gold.rounds.join(played, "RoundCode", "left")


@query
def fact_matches(p: Pipeline) -> DataFrame:
    return without_times(p.gold.facts)


@query
def fact_upcoming(p: Pipeline) -> DataFrame:
    return without_times(p.gold.upcoming)


@query
def unmatched_upcoming(p: Pipeline) -> DataFrame:
    s = p.gold
    return star.unmatched(s.upcoming_silver, s.teams, s.competitions, s.seasons)


@query
def wide_fact(p: Pipeline) -> DataFrame:
    s = p.gold
    ratings = rating.flat_start(s.sequence)
    results = star.dim_results(s.silver)
    return without_times(star.wide_fact(s.facts, ratings, s.teams, s.seasons, s.rounds, results))


@query
def outer_match_join(p: Pipeline) -> DataFrame:
    joined = reports.outer_match_join(
        p.results.select("MatchId", "HomeScore", *quality.CONTEST_KEY),
        p.upcoming.select("MatchId", "Round", *quality.CONTEST_KEY),
    )
    return joined.select("MatchId", "HomeTeam", "HomeScore", "MatchId_1", "HomeTeam_1", "Round_1")


@query
def outer_match_join_left(p: Pipeline) -> DataFrame:
    return reports.drop_suffixed(outer_match_join(p))


@query
def outer_join_by_id(p: Pipeline) -> DataFrame:
    return reports.outer_join_by_id(
        p.results.select("MatchId", "HomeTeam", "HomeScore"),
        p.upcoming.select("MatchId", "HomeTeam", "Round"),
    )


@query
def home_away_games(p: Pipeline) -> DataFrame:
    return reports.home_away_games(p.gold.silver)


@query
def union_by_name(p: Pipeline) -> DataFrame:
    played = p.results.select("MatchId", "HomeTeam", "HomeScore", "AwayScore")
    ahead = p.upcoming.select("MatchId", "HomeTeam", "source_file")
    return files.union_by_name([played, ahead])


@query
def match_sequence(p: Pipeline) -> DataFrame:
    return p.gold.sequence


# ---- ratings -----------------------------------------------------------------------------


@query
def oldest_season(p: Pipeline) -> DataFrame:
    return p.gold.oldest


@query
def baseline_ratings(p: Pipeline) -> DataFrame:
    return p.gold.baseline


@query
def starting_competition(p: Pipeline) -> DataFrame:
    return p.gold.starting


@query
def team_base_rating(p: Pipeline) -> DataFrame:
    return p.gold.base


@query
def teams_without_base(p: Pipeline) -> DataFrame:
    return rating.teams_without_base(p.gold.starting, p.gold.base)


@query
def base_rating_list(p: Pipeline) -> DataFrame:
    s = p.gold
    return reports.base_rating_list(p.gold.base, s.teams, s.competitions, s.seasons)


@query
def expected_score(p: Pipeline) -> DataFrame:
    games = rating.with_start_ratings(p.gold.sequence, p.gold.base, DEFAULT_START)
    chance = scoring.expected_score("HomeStartingElo", "AwayStartingElo")
    return games.select(
        "MatchKey", "HomeStartingElo", "AwayStartingElo", F.round(chance, 6).alias("expected")
    )


@query
def fact_rating(p: Pipeline) -> DataFrame:
    return p.gold.ratings


@query
def rating_unrounded_k(p: Pipeline) -> DataFrame:
    rated = rating.elo(p.gold.sequence, p.gold.base, k=20.0, default_start=DEFAULT_START)
    return rating.rounded(rated, ("EloBefore", "EloAfter", "EloChange"), 6)


@query
def rating_flat_start_wide(p: Pipeline) -> DataFrame:
    return rating.flat_start(p.gold.sequence)


@query
def rating_by_round_text(p: Pipeline) -> DataFrame:
    sequence = star.match_sequence(p.gold.facts, star.ROUND_TEXT_ORDER)
    return rating.flat_start(sequence).select("MatchKey", "MatchSequence", "HomeEloAfter", "AwayEloAfter")


_WIDE = ("HomeEloBefore", "HomeEloAfter", "AwayEloBefore", "AwayEloAfter")


def _customer_ratings(p: Pipeline, **options) -> DataFrame:
    rated = rating.rate(p.customers, default_start=DEFAULT_START, **options)
    return rating.rounded(rated, _WIDE, 6).select(
        "MatchSequence", "HomeTeamId", "AwayTeamId", *_WIDE
    )


@query
def rating_many_teams(p: Pipeline) -> DataFrame:
    # slices as short as on a large table, where the least size of a slice doesn't count
    teams = feeds.table(p.spark, p.sf_dir, "customer").count()
    return _customer_ratings(p, slice_rows=max(teams // rating.TEAMS_PER_CONTEST, 1))


@query
def rating_sliced(p: Pipeline) -> DataFrame:
    # the same in slices of a fixed size: the result doesn't depend on it
    return _customer_ratings(p, slice_rows=2000)


@query
def rating_waves(p: Pipeline) -> DataFrame:
    # the same by column expressions, all contests of a wave at once
    return _customer_ratings(p, by="waves")


@query
def rating_continued(p: Pipeline) -> DataFrame:
    """Four runs of one store: a first part, more without one late contest, all of it, and again.

    Run names the run that has rated a contest as it is stored now.
    """
    games = p.customers.select("MatchSequence", "HomeTeamId", "AwayTeamId", "Result")
    n = games.count()
    early, late = n * 2 // 5, n * 7 // 10
    missing = games.filter(F.col("MatchSequence") != late).withColumn(
        "MatchSequence", F.col("MatchSequence") - (F.col("MatchSequence") > late).cast("int")
    )
    store = RatingStore(p.spark, new_folder(p.spark, "rating-store"), DEFAULT_START, slice_rows=5000)
    runs = [store.run(games.filter(F.col("MatchSequence") <= early)), store.run(missing), store.run(games), store.run(games)]
    # the late contest lies after the first mark, so the third run starts again there
    number = F.lit(0)
    for i, done in enumerate(runs, 1):
        number = F.when(F.col("MatchSequence") > done.restarted_at, i).otherwise(number) if done.rated else number
    rated = rating.rounded(store.rated(), _WIDE, 6)
    return rated.select("MatchSequence", "HomeTeamId", "AwayTeamId", *_WIDE, number.alias("Run"))


@query
def rating_history(p: Pipeline) -> DataFrame:
    return rating.rating_history(p.gold.ratings, block_rows=1000)


@query
def rating_history_lists(p: Pipeline) -> DataFrame:
    lists = rating.rating_history_lists(rating.rating_history(p.gold.ratings), list_rows=100)
    text = F.transform("History", lambda x: F.format_string("%.2f", x))
    return lists.select("TeamId", "List", F.array_join(text, ",").alias("History"))


@query
def season_start_end_rating(p: Pipeline) -> DataFrame:
    s = p.gold
    seasons = rating.season_ratings(p.gold.ratings)
    return reports.named_season_ratings(seasons, s.teams, s.competitions, s.seasons)


@query
def first_season_ratings(p: Pipeline) -> DataFrame:
    return rating.season_ratings(p.gold.ratings, season_id=1)


@query
def latest_rating(p: Pipeline) -> DataFrame:
    return p.gold.latest


@query
def rating_snapshot(p: Pipeline) -> DataFrame:
    return rating.rating_snapshot(p.gold.ratings)


@query
def rating_progression(p: Pipeline) -> DataFrame:
    return rating.rating_progression(p.gold.ratings, team_id=4)


@query
def zero_sum_check(p: Pipeline) -> DataFrame:
    # + 0 turns a negative zero into zero
    return rating.zero_sum_totals(p.gold.ratings).withColumn(
        "TotalEloChange", F.col("TotalEloChange") + 0.0
    )


@query
def zero_sum_breaks(p: Pipeline) -> DataFrame:
    return rating.zero_sum_breaks(p.gold.ratings).agg(F.count("*").alias("breaks"))


@query
def continuity_check(p: Pipeline) -> DataFrame:
    gaps = rating.continuity_gaps(p.gold.ratings, block_rows=1000)
    return gaps.select(
        "TeamId", "MatchSequence", "EloAfter", "NextEloBefore", F.round("Break", 6).alias("Break")
    )


# ---- reports -----------------------------------------------------------------------------


@query
def result_counts_by_season(p: Pipeline) -> DataFrame:
    return reports.result_counts(p.gold.facts, p.gold.seasons)


@query
def season_totals(p: Pipeline) -> DataFrame:
    return reports.season_totals(reports.result_counts(p.gold.facts, p.gold.seasons))


@query
def team_record(p: Pipeline) -> DataFrame:
    return reports.team_record(p.gold.facts, p.gold.teams)


@query
def team_season_record(p: Pipeline) -> DataFrame:
    return reports.team_season_record(p.gold.facts, p.gold.teams, p.gold.seasons)


@query
def wins_by_team(p: Pipeline) -> DataFrame:
    return reports.wins_by_team(team_season_record(p))


@query
def wins_of_chosen_teams(p: Pipeline) -> DataFrame:
    # the team filter is the feature
    return reports.wins_by_team(team_season_record(p), ["nation_3", "nation_7", "nation_11"])


@query
def round_counts(p: Pipeline) -> DataFrame:
    return reports.round_counts(p.gold.facts)


@query
def home_team_counts(p: Pipeline) -> DataFrame:
    return reports.counts_by(p.results, "HomeTeam")


@query
def competition_counts(p: Pipeline) -> DataFrame:
    return reports.competition_counts(p.gold.facts, p.gold.competitions)


@query
def season_first_dates(p: Pipeline) -> DataFrame:
    return reports.season_first_dates(p.gold.facts)


@query
def first_date(p: Pipeline) -> DataFrame:
    return reports.first_date(p.results)


@query
def multi_competition_teams(p: Pipeline) -> DataFrame:
    return reports.multi_competition_teams(p.gold.facts)


@query
def first_rows(p: Pipeline) -> DataFrame:
    return reports.first_rows(p.gold.sequence, 10, "MatchSequence").select(
        "MatchSequence", "MatchKey", "HomeTeamId", "AwayTeamId"
    )


# ---- features and model ------------------------------------------------------------------


@query
def last_round(p: Pipeline) -> DataFrame:
    return p.gold.last_rounds


@query
def next_round(p: Pipeline) -> DataFrame:
    ahead = features.next_round(p.gold.upcoming, p.gold.last_rounds)
    return without_times(ahead)


@query
def next_round_available(p: Pipeline) -> DataFrame:
    ahead = features.next_round(p.gold.upcoming, p.gold.last_rounds, follow="available")
    return without_times(ahead)


@query
def next_round_features(p: Pipeline) -> DataFrame:
    return rating.rounded(p.gold.next_features, ("EloDiff",), 6)


@query
def upcoming_rounds(p: Pipeline) -> DataFrame:
    return p.gold.upcoming.select("SeasonId", "CompetitionId", "RoundOrder").distinct()


@query
def training_frame(p: Pipeline) -> DataFrame:
    return p.gold.training


@query
def ordered_split(p: Pipeline) -> DataFrame:
    train, test = p.split
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select("part", "MatchSequence", "Position")


@query
def scaled_features(p: Pipeline) -> DataFrame:
    train, test = p.split
    scaled = model.fit_scaling(train).apply(train.unionByName(test))
    return rating.rounded(scaled, features.FEATURES, 4).select("MatchSequence", *features.FEATURES)


@query
def rating_rule_report(p: Pipeline) -> DataFrame:
    """The report over a rule that needs no fit: the side with the higher rating wins at home."""
    rule = p.split[1].withColumn("prediction", (F.col("EloDiff") > 0).cast("int"))
    report = model.classification_report(rule)
    return rating.rounded(report, ("precision", "recall", "f1"), 6)


@query
def home_win_model_metrics(p: Pipeline) -> DataFrame:
    train, test = p.split
    report = model.classification_report(model.fit_home_win(train).predict(test))
    return rating.rounded(report, ("precision", "recall", "f1"), 6)


@query
def next_round_probabilities(p: Pipeline) -> DataFrame:
    chances = model.next_round_probabilities(model.fit_home_win(p.split[0]), p.gold.next_features)
    return rating.rounded(chances, ("EloDiff",), 6)


# ---- files, tables, streams --------------------------------------------------------------


def _write_csv(df: DataFrame, path: str, mode: str = "error") -> str:
    # blanks around names are part of the data
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, **blanks).csv(path)
    return path


@query
def csv_batch_ingest(p: Pipeline) -> DataFrame:
    path = _write_csv(feeds.raw_feed(p.spark, p.sf_dir), new_folder(p.spark, "results-csv"))
    return files.read_csv(p.spark, path, schemas.RESULTS)


@query
def csv_schema_inference(p: Pipeline) -> DataFrame:
    path = _write_csv(
        feeds.raw_feed(p.spark, p.sf_dir).select("MatchId", "Season", "HomeScore", "AwayScore"),
        new_folder(p.spark, "inferred-csv"),
    )
    return files.read_csv(p.spark, path, files.infer_csv_schema(p.spark, path))


@query
def csv_statistics_ingest(p: Pipeline) -> DataFrame:
    """Filled values and total of each of the 93 columns; texts have their length as total."""
    path = _write_csv(feeds.statistics(p.spark, p.sf_dir), new_folder(p.spark, "statistics-csv"))
    stats = files.read_csv(p.spark, path, schemas.STATISTICS)
    texts = [f.name for f in schemas.STATISTICS.fields if isinstance(f.dataType, T.StringType)]
    value = lambda c: F.length(f"`{c}`") if c in texts else F.col(f"`{c}`")
    sums = [F.struct(F.count(f"`{c}`").alias("n"), F.sum(value(c)).cast("double").alias("t")) for c in stats.columns]
    row = stats.agg(*(s.alias(f"c{i}") for i, s in enumerate(sums)))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("v")) for i, c in enumerate(stats.columns)))
    return row.select(F.explode(pairs).alias("p")).select(
        "p.column", F.col("p.v.n").alias("filled"), F.round("p.v.t", 3).alias("total")
    )


@query
def csv_schema_evolution(p: Pipeline) -> DataFrame:
    raw = feeds.raw_feed(p.spark, p.sf_dir).select(
        "MatchId", "HomeTeam", "HomeScore", "AwayScore", "Season", "Date"
    )
    early = raw.filter("Season < '1998' OR Season IS NULL").drop("Season", "Date")
    late = raw.filter("Season >= '1998'").select("MatchId", "Date", "HomeTeam", "HomeScore", "AwayScore")
    paths = [_write_csv(df, new_folder(p.spark, "drop-csv")) for df in (early, late)]
    return files.read_csv_drops(p.spark, paths, schemas.RESULTS_CORE)


@dataclass(frozen=True)
class Streamed:
    bronze: DataFrame
    results: DataFrame
    upcoming: DataFrame


def _streamed(p: Pipeline) -> Streamed:
    landing = _write_csv(feeds.raw_feed(p.spark, p.sf_dir), new_folder(p.spark, "landing"))
    target = new_folder(p.spark, "streamed")
    return Streamed(
        *ingest.run_ingest(p.spark, landing, target, schemas.RESULTS, AS_OF, p.aliases)
    )


@query
def stream_bronze(p: Pipeline) -> DataFrame:
    return without_times(_streamed(p).bronze).drop("source_file")


@query
def stream_bronze_to_silver(p: Pipeline) -> DataFrame:
    return without_times(_streamed(p).results).drop("bronze_file")


@query
def stream_upcoming(p: Pipeline) -> DataFrame:
    return without_times(_streamed(p).upcoming).drop("source_file")


@query
def gold_after_stream(p: Pipeline) -> DataFrame:
    tables_ = _streamed(p)
    s = Gold(tables_.results, tables_.upcoming)
    return reports.team_record(s.facts, s.teams)


def _table_name(label: str) -> str:
    import uuid

    return f"{label}_{uuid.uuid4().hex}"


def _dropped(p: Pipeline, result: DataFrame, *names: str) -> DataFrame:
    """The result, stored, without the tables it was made from."""
    result = materialize(result, "from-tables")
    for name in names:
        p.spark.sql(f"DROP TABLE {name}")
    return result


@query
def stream_schema_evolution(p: Pipeline) -> DataFrame:
    """One landing folder, two runs: the second drop has a column more and another order."""
    feed = feeds.raw_feed(p.spark, p.sf_dir)
    landing, target = new_folder(p.spark, "landing"), new_folder(p.spark, "streamed")

    def run() -> None:
        checkpoint = f"{target}/_checkpoint"
        ingest.store_drops(p.spark, f"{landing}/*", f"{target}/bronze", checkpoint, schemas.RESULTS).awaitTermination()

    early = feed.filter("MatchId % 2 = 0").select("MatchId", "HomeTeam", "AwayTeam", "HomeScore", "AwayScore")
    _write_csv(early, f"{landing}/first")
    run()
    late = feed.filter("MatchId % 2 = 1").withColumn("Referee", F.concat(F.lit("ref-"), F.col("MatchId") % 7))
    _write_csv(late.select("AwayScore", "Referee", "AwayTeam", "HomeTeam", "MatchId", "HomeScore"), f"{landing}/second")
    run()
    stored = ingest.read_drops(p.spark, f"{target}/bronze", schemas.RESULTS)
    return stored.select("MatchId", "HomeTeam", "AwayTeam", "HomeScore", "AwayScore", "Date", "Referee")


@query
def stream_inferred_types(p: Pipeline) -> DataFrame:
    """Bronze in its last schema: Crowd has become a double, Announced has come as a date."""
    stored = evolving.read_bronze(p.spark, f"{p.evolved}/bronze")
    kinds = dict(stored.dtypes)
    return stored.select(
        F.col("MatchId").cast("long").alias("MatchId"), "HomeTeam", "Crowd", "Announced",
        F.lit(kinds["Crowd"]).alias("crowd_type"), F.lit(kinds["Announced"]).alias("announced_type"),
    )


@query
def stream_schema_history(p: Pipeline) -> DataFrame:
    """The versions of the columns that have changed."""
    history = evolving.schema_history(p.spark, f"{p.evolved}/bronze")
    return history.filter("name IN ('Crowd', 'Announced')").select("version", "name", "type")


@query
def stream_evolved_silver(p: Pipeline) -> DataFrame:
    stored = evolving.read_silver(p.spark, p.evolved)
    return stored.select("MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "Result", "Crowd", "Announced")


@query
def stream_gold_seasons(p: Pipeline) -> DataFrame:
    """Refreshed by season inside the stream, by two batches."""
    stored = p.spark.read.parquet(f"{p.evolved}/gold/season_records")
    return stored.withColumn("Season", F.col("Season").cast("string"))


@query
def stream_rule_history(p: Pipeline) -> DataFrame:
    """Rows that have passed and failed each rule, over all batches of the stream."""
    history = evolving.read_rule_history(p.spark, p.evolved)
    return history.groupBy("rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query
def stream_dedupe(p: Pipeline) -> DataFrame:
    """Two drops of the same contests, by the time they come: each contest once."""
    folder, target = new_folder(p.spark, "landing"), new_folder(p.spark, "deduplicated")
    schema = T.StructType([f for f in schemas.RESULTS.fields if f.name in quality.CONTEST_KEY])
    for drop in ("first", "second"):
        _write_csv(feeds.raw_feed(p.spark, p.sf_dir).select(*schema.fieldNames()), f"{folder}/{drop}")
        rows = files.with_source_tag(ingest.read_csv_stream(p.spark, f"{folder}/*", schema), drop)
        once = evolving.deduplicated_stream(rows, quality.CONTEST_KEY, "ingestTimestamp", "30 days")
        ingest.append_stream(once, f"{target}/rows", f"{target}/_checkpoint").awaitTermination()
    return p.spark.read.schema(schema).parquet(f"{target}/rows")


@query
def append_merged(p: Pipeline) -> DataFrame:
    """A table that gains a column by an append, which lacks one of its columns."""
    name = _table_name("merged")
    tables.save_table(p.results.select("MatchId", "Season", "Result"), name)
    stored = tables.append_merged(p.upcoming.select("Round", "MatchId", "Season"), name)
    return _dropped(p, stored, name)


@query
def rewritten_landing(p: Pipeline) -> DataFrame:
    """Files rewritten under their old names are read as they are now."""
    path = new_folder(p.spark, "rewritten-csv")
    feed = feeds.raw_feed(p.spark, p.sf_dir).select("MatchId", "HomeTeam", "HomeScore")
    schema = T.StructType([f for f in schemas.RESULTS.fields if f.name in feed.columns])
    _write_csv(feed, path)
    before = files.read_csv(p.spark, path, schema).count()
    _write_csv(feed.filter("HomeScore > 30"), path, "overwrite")
    return files.read_csv(p.spark, path, schema).withColumn("before", F.lit(before).cast("long"))


@query
def landing_refreshed(p: Pipeline) -> DataFrame:
    """A landing folder after one drop is rewritten, one deleted and one added: only these are read again."""
    folder, target = new_folder(p.spark, "landing"), new_folder(p.spark, "landed")
    feed = feeds.raw_feed(p.spark, p.sf_dir).select("MatchId", "HomeTeam", "HomeScore")
    schema = T.StructType([f for f in schemas.RESULTS.fields if f.name in feed.columns])
    drops = [feed.filter(F.col("MatchId") % 4 == k) for k in range(4)]
    for k in range(3):
        _write_csv(drops[k], f"{folder}/{k}")
    landing.refresh_landing(p.spark, folder, target, schema, "part-*")
    _write_csv(drops[1].withColumn("HomeScore", -F.col("HomeScore")), f"{folder}/1", "overwrite")
    delete_folder(p.spark, f"{folder}/2")
    _write_csv(drops[3], f"{folder}/3")
    files_now = landing.refresh_landing(p.spark, folder, target, schema, "part-*")
    stored = landing.read_landing(p.spark, target, schema)
    return stored.join(files_now.select("source_file", "change"), "source_file").select(*feed.columns, "change")


@query
def stream_catalog(p: Pipeline) -> DataFrame:
    """Two runs from files over a bronze to a silver table of the catalog, with days merged in between."""
    folder, checkpoint = new_folder(p.spark, "landing"), new_folder(p.spark, "catalog-checkpoints")
    names_ = tuple(_table_name(label) for label in ("bronze", "results", "upcoming"))
    merged = _table_name("merged")
    feed = feeds.raw_feed(p.spark, p.sf_dir)
    for k, drop in enumerate(("first", "second")):
        _write_csv(feed.filter(F.col("MatchId") % 2 == k), f"{folder}/{drop}")
        catalog.run_ingest(p.spark, f"{folder}/*", schemas.RESULTS, names_, checkpoint, AS_OF, p.aliases)
        catalog.merge_days(p.spark, names_[1], merged, catalog.SILVER_DAY)
    results = catalog.read_days(p.spark, names_[1], merged, catalog.SILVER_DAY)
    return _dropped(p, without_times(results).drop("bronze_file", catalog.SILVER_DAY), *names_, merged)


@query
def overwrite_with_new_schema(p: Pipeline) -> DataFrame:
    name = _table_name("overwritten")
    tables.save_table(p.results.select("MatchId", "Season"), name)
    replaced = p.results.select(F.col("Season").alias("Year"), "Result", F.col("HomeScore").cast("string").alias("MatchId"))
    tables.save_table(replaced, name)
    return _dropped(p, tables.read_table(p.spark, name), name)


@query
def ctas_roundtrip(p: Pipeline) -> DataFrame:
    silver_name, counts_name = _table_name("silver"), _table_name("counts")
    tables.save_table(
        p.results, silver_name, comment="played contests", properties={"quality": "silver"}
    )
    tables.create_table_as(
        p.spark,
        counts_name,
        f"SELECT Season, Result, count(*) AS matches FROM {silver_name} GROUP BY Season, Result",
    )
    return _dropped(p, tables.read_table(p.spark, counts_name), silver_name, counts_name)


@query
def append_roundtrip(p: Pipeline) -> DataFrame:
    name = _table_name("appended")
    tables.save_table(p.results.select("MatchId", "Season"), name)
    stored = tables.append_table(p.upcoming.select("MatchId", "Season"), name)
    return _dropped(p, reports.counts_by(stored, "Season", name="rows"), name)
