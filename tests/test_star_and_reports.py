import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from contestry.operators import quality, rating, reports, star
from contestry.plans import features, silver
from contestry.plans.gold import Gold

COLUMNS = "MatchId string, HomeTeam string, AwayTeam string, Season string, Round string, HomeScore string, AwayScore string, Date string, Competition string, source_file string"
AS_OF = dt.date(2016, 3, 1)


def raw_rows():
    rng = random.Random(11)
    teams = ["Bath Rugby", "saracens", "SARRIES ", "Wasps Rugby", "Sale Sharks", "chiefs", "leicester tigers"]
    out = []
    for i in range(400):
        home, away = rng.choice(teams), rng.choice(teams)
        day = dt.date(2015, 9, 1) + dt.timedelta(days=rng.randrange(270))
        played = day < AS_OF
        out.append((
            str(i % 390), home, away, rng.choice(["15/16", "15/16", "14/15", None]),
            rng.choice(["1", "2", "3", "SF", "F", "ZZ"]),
            str(rng.randrange(-1, 9)) if played else None, str(rng.randrange(9)) if played else None,
            day.strftime("%d/%m/%Y"), rng.choice(["Gallagher Premiership", "Championship"]), "f",
        ))
    out.append(("x1", "bath", "sale", "15/16", "1", "12", "bad", "01/10/2015", "Championship", "f"))
    return out


@pytest.fixture(scope="module")
def bronze(spark):
    return spark.createDataFrame(raw_rows(), COLUMNS)


@pytest.fixture(scope="module")
def gold(spark, bronze):
    return Gold(
        silver.match_results(bronze), silver.upcoming_matches(bronze, AS_OF), default_start=1400.0
    )


def test_silver_schema_and_rules(bronze):
    out = silver.match_results(bronze)
    assert out.columns == [
        "MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "HomeScore", "AwayScore", "Result", "Date",
        "Competition", "HomePointsDifference", "AwayPointsDifference", "TotalMatchPoints", "HomeWinFlag",
        "AwayWinFlag", "DrawFlag", "IsNeutral", "bronze_file", "_silver_ingest_timestamp",
    ]
    assert out.filter("Season IS NULL OR HomeScore IS NULL OR HomeTeam = AwayTeam").count() == 0
    # a score that is no number is unknown, not an error
    assert silver.scored(bronze).filter("MatchId IS NULL AND AwayScore IS NULL").count() == 1
    assert out.filter("HomeScore < 0").count() > 0  # negative scores only warn
    ahead = silver.upcoming_matches(bronze, AS_OF)
    assert ahead.filter(F.col("Date") < F.lit(AS_OF)).count() == 0
    assert ahead.columns[-2:] == ["source_file", "_silver_ingest_timestamp"]


def test_facts(gold):
    facts = gold.facts
    assert facts.columns == [
        "MatchKey", "HomeTeamId", "AwayTeamId", "SeasonId", "RoundId", "RoundCode", "RoundOrder", "RoundName",
        "RoundType", "Date", "CompetitionId", "HomeScore", "AwayScore", "Result", "HomePointsDifference",
        "AwayPointsDifference", "TotalMatchPoints", "HomeWinFlag", "AwayWinFlag", "DrawFlag", "IsNeutral",
        "_silver_ingest_timestamp",
    ]
    n = gold.silver.count()
    assert sorted(r[0] for r in facts.select("MatchKey").collect()) == list(range(1, n + 1))
    assert facts.filter("RoundId IS NULL").count() == gold.silver.filter("Round = 'ZZ'").count() > 0
    ordered = Window.orderBy("Date", "CompetitionId", "HomeTeamId", "AwayTeamId")
    ranks = facts.withColumn("r", F.rank().over(ordered)).withColumn("d", F.max("MatchKey").over(
        Window.partitionBy("Date", "CompetitionId", "HomeTeamId", "AwayTeamId")))
    assert ranks.filter("MatchKey < r OR MatchKey > d").count() == 0


def test_sequence_equals_the_global_window(gold):
    window = Window.orderBy("SeasonId", "Date", "RoundOrder", "MatchKey")
    expected = gold.facts.withColumn("s", F.row_number().over(window).cast("long"))
    assert rows(gold.sequence, "MatchKey", "MatchSequence") == rows(expected, "MatchKey", "s")


def test_unmatched_counts_what_the_fact_drops(spark, gold):
    ahead = gold.upcoming_silver.withColumn("HomeTeam", F.when(F.col("MatchId") < 50, "newcomer").otherwise(F.col("HomeTeam")))
    report = dict(rows(star.unmatched(ahead, gold.teams, gold.competitions, gold.seasons)))
    assert report["home_team"] == ahead.filter("HomeTeam = 'newcomer'").count() > 0
    assert report["season"] == ahead.filter("Season IS NULL").count()
    facts = star.fact_upcoming(ahead, gold.teams, gold.competitions, gold.seasons, gold.rounds)
    assert facts.count() == ahead.filter("HomeTeam != 'newcomer' AND Season IS NOT NULL").count()


def test_team_record_equals_the_in_join(spark, gold):
    gold.facts.createOrReplaceTempView("m")
    gold.teams.createOrReplaceTempView("t")
    expected = spark.sql("""
        SELECT TeamName,
          count_if((Result = 'HomeWin' AND HomeTeamId = TeamId) OR (Result = 'AwayWin' AND AwayTeamId = TeamId)),
          count_if((Result = 'HomeWin' AND AwayTeamId = TeamId) OR (Result = 'AwayWin' AND HomeTeamId = TeamId)),
          count_if(Result = 'Draw')
        FROM m JOIN t ON TeamId IN (HomeTeamId, AwayTeamId) GROUP BY TeamName""")
    record = reports.team_record(gold.facts, gold.teams)
    assert rows(record) == rows(expected)
    assert "NestedLoop" not in record._jdf.queryExecution().executedPlan().toString()
    seasons = reports.team_season_record(gold.facts, gold.teams, gold.seasons)
    chosen = reports.wins_by_team(seasons, ["bath", "sale"])
    assert {r["Team"] for r in chosen.collect()} == {"bath", "sale"}
    assert rows(reports.wins_by_team(seasons).groupBy("Team").agg(F.sum("Wins"))) == rows(record, "TeamName", "Wins")


def test_outer_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "MatchId int, HomeTeam string")
    b = spark.createDataFrame([(2, "y"), (3, "z")], "MatchId int, HomeTeam string")
    joined = reports.outer_join_by_id(a, b)
    assert rows(joined) == [(1, "x", None, None), (2, "y", 2, "y"), (None, None, 3, "z")]
    assert rows(reports.drop_suffixed(joined)) == [(1, "x"), (2, "y"), (None, None)]
    nameless = spark.createDataFrame([(None, "n")], "MatchId int, HomeTeam string")
    both = reports.outer_join_by_id(a.union(nameless), b.union(nameless))
    assert rows(both) == rows(joined.union(spark.createDataFrame(
        [(None, "n", None, None), (None, None, None, "n")], joined.schema)))
    games = spark.createDataFrame([("x", "y"), ("x", "z"), ("y", "x")], "HomeTeam string, AwayTeam string")
    assert rows(reports.home_away_games(games)) == [("x", 2, "x", 1), ("y", 1, "y", 1)]


def test_outer_join_of_ids_that_restart_per_file(spark):
    """Ten ids, each in 20 files a side: by contest key the result has a row for each contest."""
    day = dt.date(2015, 9, 1)
    schema = "MatchId int, Competition string, Season string, Date date, HomeTeam string, AwayTeam string"
    side = lambda files: spark.createDataFrame(
        [(i, f"league {f}", "15/16", day, f"t{i}", f"t{i + 1}") for f in files for i in range(10)], schema
    )
    both = reports.outer_match_join(side(range(20)), side(range(10, 30)))
    assert both.count() == 300
    assert both.filter("HomeTeam = HomeTeam_1 AND Competition = Competition_1").count() == 100
    assert reports.outer_join_by_id(side(range(3)), side(range(3))).count() == 90
    assert reports.outer_match_join(side([0]), side([0]), key=("MatchId",)).count() == 10


def test_wide_fact_has_every_contest_once(gold):
    results, elo = star.dim_results(gold.silver), rating.flat_start(gold.sequence)
    wide = star.wide_fact(gold.facts, elo, gold.teams, gold.seasons, gold.rounds, results)
    assert wide.count() == wide.select("MatchKey").distinct().count() == gold.facts.count()
    assert wide.filter("HomeEloBefore IS NULL OR ResultId IS NULL OR HomeTeam IS NULL").count() == 0


def test_next_round(spark):
    upcoming = spark.createDataFrame(
        [(1, 1, 23), (1, 1, 98), (1, 1, 99), (2, 1, 4), (2, 1, None)], "SeasonId int, CompetitionId int, RoundOrder int"
    )
    last = spark.createDataFrame([(1, 1, 30), (2, 1, 3)], "SeasonId int, CompetitionId int, LastCompletedRound int")
    assert rows(features.next_round(upcoming, last), "SeasonId", "RoundOrder") == [(2, 4)]
    available = features.next_round(upcoming, last, follow="available")
    assert rows(available, "SeasonId", "RoundOrder") == [(1, 98), (2, 4)]


def test_training_frame_equals_two_joins(gold):
    elo = gold.ratings.select("MatchKey", "TeamId", "EloBefore")
    home = elo.selectExpr("MatchKey", "TeamId AS HomeTeamId", "EloBefore AS HomeTeamElo")
    away = elo.selectExpr("MatchKey", "TeamId AS AwayTeamId", "EloBefore AS AwayTeamElo")
    expected = (
        gold.facts.join(home, ["MatchKey", "HomeTeamId"])
        .join(away, ["MatchKey", "AwayTeamId"])
        .withColumn("EloDiff", F.round(F.col("HomeTeamElo") - F.col("AwayTeamElo")))
        .select(*features.FEATURES, features.LABEL)
    )
    frame = features.training_frame(gold.rated)
    assert rows(frame, *features.FEATURES, features.LABEL) == rows(expected)
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    one_side = gold.rated.withColumn("HomeEloBefore", F.when(F.col("HomeTeamId") != 1, F.col("HomeEloBefore")))
    assert features.training_frame(one_side).count() == gold.facts.filter("HomeTeamId != 1").count()


def test_next_features(gold):
    out = gold.next_features
    assert out.columns == [
        "HomeTeamId", "AwayTeamId", "HomeTeamElo", "AwayTeamElo", "EloDiff", "SeasonId", "RoundName",
        "RoundOrder", "Date", "CompetitionId", "IsNeutral",
    ]


@pytest.mark.parametrize("n, train", [(1, 0), (4, 3), (5, 4), (10, 8), (11, 8)])
def test_ordered_split(spark, n, train):
    frame = spark.range(n).select((F.col("id") * 3).alias("MatchSequence")).repartition(3)
    first, second = features.ordered_split(frame)
    assert [r[0] for r in first.select("MatchSequence").orderBy("MatchSequence").collect()] == [3 * i for i in range(train)]
    assert second.count() == n - train


def test_refresh_stores_every_table(spark, gold):
    stored = gold.refresh("refreshed")
    assert len(stored) == 15
    for name, df in stored.items():
        assert spark.table(f"refreshed.{name}").columns == df.columns
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES refreshed.fact_elo").collect()}
    assert properties["quality"] == "gold"
    assert rows(stored["latest_elo"]) == rows(gold.latest)
    one = stored["fact_elo"].filter("SeasonId = 1")
    assert one.count() == gold.ratings.filter("SeasonId = 1").count()
    assert "PartitionFilters: [isnotnull(SeasonId" in one._jdf.queryExecution().executedPlan().toString()
    gold.refresh("refreshed")  # a second refresh replaces the first


def test_rules_over_the_tables(gold):
    for rule_set, table in (
        (quality.dimension_rules("TeamName", "TeamId"), gold.teams),
        (quality.dimension_rules("Competition", "CompetitionId"), gold.competitions),
        (quality.OLDEST_SEASON_RULES, gold.oldest),
        (quality.upcoming_rules(AS_OF), gold.upcoming_silver.filter("HomeTeam != AwayTeam")),
    ):
        assert rows(quality.rule_report(table, rule_set).filter("failed > 0")) == []
