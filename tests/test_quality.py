import datetime as dt

from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from contestry.operators import quality
from contestry.operators.quality import Rule

SCORES = "MatchId int, HomeScore int, AwayScore int"


def sample(spark):
    return spark.createDataFrame([(1, 5, 3), (2, None, 3), (3, -1, 0), (None, 1, 1)], SCORES)


RULES = (
    Rule("id", "MatchId IS NOT NULL"),
    Rule("home", "HomeScore IS NOT NULL", drop=True),
    Rule("positive", "HomeScore >= 0 AND AwayScore >= 0"),
)


def test_unknown_outcome_is_a_failure(spark):
    report = rows(quality.rule_report(sample(spark), RULES), "rule", "action", "passed", "failed")
    assert report == [("home", "drop", 3, 1), ("id", "warn", 3, 1), ("positive", "warn", 2, 2)]


def test_only_drop_rules_remove_rows(spark):
    assert [r[0] for r in quality.enforce(sample(spark), RULES).collect()] == [1, 3, None]


def test_observed_rules(spark):
    seen = Observation("rules")
    df = sample(spark)
    checks = [F.count_if(~rule.holds).alias(rule.name) for rule in RULES]
    df.observe(seen, *checks).write.format("noop").mode("overwrite").save()
    assert seen.get == {"id": 1, "home": 1, "positive": 2}
    assert quality.observe_rules(df, RULES, "name").count() == 4


def test_profiles(spark):
    df = sample(spark)
    assert rows(quality.null_profile(df)) == [("AwayScore", 0), ("HomeScore", 1), ("MatchId", 1)]
    twice = df.union(df.filter("MatchId = 1"))
    assert quality.duplicate_report(twice).first().asDict() == {"rows": 5, "distinct_rows": 4, "duplicates": 1}
    empty = df.filter("false")
    assert quality.duplicate_report(empty).first().asDict() == {"rows": 0, "distinct_rows": 0, "duplicates": 0}
    assert quality.deduplicate(twice).count() == 4


def test_null_profile_of_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1.0)], "`Home6s+RuckSpeed` double, `HomeScrumWins%` double")
    assert rows(quality.null_profile(df)) == [("Home6s+RuckSpeed", 1), ("HomeScrumWins%", 0)]


def test_dedupe_by_key_keeps_the_smallest_row(spark):
    df = spark.createDataFrame([(2, "a", 1), (1, "a", 9), (3, None, 1), (4, None, 1)], "id int, k string, v int")
    assert rows(quality.deduplicate(df, ["k"])) == [(1, "a", 9), (3, None, 1)]


def test_drop_nulls_and_counts_per_source(spark):
    df = sample(spark).withColumn("source_file", F.when(F.col("MatchId") == 1, "a").otherwise("b"))
    assert quality.drop_nulls(df).count() == 2
    assert quality.drop_nulls(df, ["HomeScore"]).count() == 3
    assert rows(quality.rows_per_source(df)) == [("a", 1), ("b", 3)]


STATS = (
    "MatchId int, HomeScore int, AwayScore int, HomeTries int, AwayTries int, HomeConversions int, "
    "AwayConversions int, HomePenaltyGoals int, AwayPenaltyGoals int, HomeDropGoals int, AwayDropGoals int, "
    "HomeMetresGained int, AwayMetresGained int, HomePostContactMetres int, AwayPostContactMetres int"
)


def test_domain_checks(spark):
    df = spark.createDataFrame(
        [
            (1, 10, 3, 1, 0, 1, 0, 1, 1, 0, 0, 100, 90, 50, 40),
            (2, 13, 3, 1, 0, 1, 0, 1, 1, 1, 0, 100, 90, 50, 95),
            (3, -5, 2, 0, 0, 0, 1, 0, 0, 0, 0, 10, None, 5, 5),
        ],
        STATS,
    )
    assert rows(quality.breaches(df, quality.domain_checks(), "MatchId")) == [
        (2, "more_post_contact_than_metres"),
        (2, "score_not_explained"),
        (3, "more_conversions_than_tries"),
        (3, "negative_scores"),
        (3, "score_not_explained"),
    ]
    with_drop_goals = quality.condition_report(df, quality.domain_checks(drop_goals=True))
    assert dict(rows(with_drop_goals))["score_not_explained"] == 1


def test_shares_allow_for_float_noise(spark):
    df = spark.createDataFrame([(0.7, 0.2, 0.1), (0.3, 0.3, 0.3), (None, 0.5, 0.5)], "a double, b double, c double")
    loose = df.filter(quality.not_whole(["a", "b", "c"])).count()
    exact = df.filter(quality.not_whole(["a", "b", "c"], eps=0)).count()
    assert (loose, exact) == (1, 2)  # 0.7 + 0.2 + 0.1 is not exactly 1


def test_season_date_rule(spark):
    df = spark.createDataFrame(
        [("15/16", dt.date(2015, 10, 25)), ("15/16", dt.date(2025, 10, 25)), ("15/16", dt.date(2016, 5, 28))],
        "Season string, Date date",
    )
    assert quality.rule_report(df, [quality.season_date_rule()]).first()["failed"] == 1


def test_distinct_values(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2)], "a string, b int")
    assert rows(quality.distinct_values(df, ["a", "b"])) == [("a", "x"), ("b", "1"), ("b", "2")]
