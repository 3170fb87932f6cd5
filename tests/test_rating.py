import datetime as dt
import math
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from contestry.operators import components, rating

SCHEMA = (
    "MatchKey long, MatchSequence long, CompetitionId long, SeasonId long, RoundOrder int, Date date, "
    "HomeTeamId long, AwayTeamId long, Result string"
)
WIDE = ("MatchSequence", "HomeEloBefore", "HomeEloAfter", "AwayEloBefore", "AwayEloAfter")


def schedule(seed, matches, teams, hot=0.0, pools=1):
    """Random contests; a share of them involves team 0."""
    rng = random.Random(seed)
    games = []
    for i in range(1, matches + 1):
        pool = rng.randrange(pools)
        home, away = rng.sample(range(pool * teams, (pool + 1) * teams), 2)
        if rng.random() < hot:
            home, away = 0, rng.randrange(1, teams)
        result = rng.choice(["HomeWin", "AwayWin", "Draw"])
        day = dt.date(2015, 1, 1) + dt.timedelta(days=i // 5)
        games.append((i * 10, i, 1 + pool, 1 + i * 3 // (matches + 1), rng.choice([None, 1, 2, 3]), day, home, away, result))
    return games


def loop(games, start, k=35.0):
    """Plain sequential ratings."""
    elo, out = dict(start), []
    for g in sorted(games, key=lambda g: g[1]):
        home, away = g[6], g[7]
        h, a = elo[home], elo[away]
        score = {"HomeWin": 1.0, "AwayWin": 0.0}.get(g[8], 0.5)
        gain = k * (score - 1 / (1 + 10 ** ((a - h) / 400)))
        elo[home], elo[away] = h + gain, a - gain
        out.append((g[1], h, h + gain, a, a - gain))
    return out


def frame(spark, games):
    return spark.createDataFrame(games, SCHEMA).repartition(5)


def start_table(spark, start):
    return spark.createDataFrame(list(start.items()), "TeamId long, Elo double")


def test_one_pass_equals_the_loop(spark, partitions):
    games = schedule(1, 600, 6, pools=5)
    start = {t: 1000.0 + 20 * t for t in range(30)}
    rated = rating.rate(frame(spark, games), start_table(spark, start))
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)


@pytest.mark.parametrize("slice_rows", [40, 150, 299])
def test_slices_equal_the_loop(spark, slice_rows):
    games = schedule(2, 300, 20, hot=0.35)
    start = {t: 1500.0 for t in range(20)}
    rated = rating.rate(frame(spark, games), default_start=1500.0, slice_rows=slice_rows)
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)


def test_large_and_small_groups_together(spark):
    games = schedule(3, 200, 5) + [
        (g[0] + 5000, g[1] + 500, *g[2:6], g[6] + 100, g[7] + 100, g[8]) for g in schedule(4, 30, 4)
    ]
    start = {t: 1200.0 for t in (*range(5), *range(100, 104))}
    rated = rating.rate(frame(spark, games), default_start=1200.0, slice_rows=100)
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)


def test_a_hub_team_does_not_gather_the_contests(spark):
    """Team 0 plays a third of all contests, so all teams are one connected group."""
    games = schedule(11, 2400, 400, hot=0.33)
    start = {t: 1500.0 for t in range(400)}
    rated = rating.rate(frame(spark, games), default_start=1500.0, slice_rows=100)
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)
    sliced = rating._sliced(frame(spark, games).withColumn("_actual", F.lit(1.0)), start_table(spark, start), 100)
    sliced = sliced.filter("sequence IS NOT NULL")
    groups = [r["count"] for r in sliced.groupBy("_slice", "component").count().collect()]
    assert len(groups) > 500 and max(groups) < 0.03 * len(games)


def test_nothing_to_rate(spark):
    assert rating.rate(spark.createDataFrame([], SCHEMA), default_start=1500.0).isEmpty()


def test_tiny_arrow_batches_keep_the_state(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, 7)
    try:
        games = schedule(5, 100, 4)
        rated = rating.rate(frame(spark, games), default_start=1500.0)
        assert rows(rated, *WIDE) == sorted(loop(games, {t: 1500.0 for t in range(4)}), key=repr)
    finally:
        spark.conf.set(key, before)


def test_k_and_missing_starts(spark):
    games = schedule(6, 60, 5)
    base = start_table(spark, {0: 1800.0})
    start = {0: 1800.0, **{t: 1500.0 for t in range(1, 5)}}
    rated = rating.elo(frame(spark, games), base, k=20.0, default_start=1500.0)
    wide = loop(games, start, k=20.0)
    assert rated.columns == ["MatchKey", "MatchSequence", "TeamId", "OpponentId", "EloBefore", "EloAfter", "EloChange"]
    assert rows(rated, "MatchSequence", "EloBefore", "EloAfter") == sorted(
        [w[:3] for w in wide] + [(w[0], *w[3:]) for w in wide], key=repr
    )
    unknown = rating.rate(frame(spark, games[:1]), base.filter("false")).first()
    assert math.isnan(unknown["HomeEloAfter"])


def test_fact_ratings_are_rounded_and_sum_to_zero(spark):
    games = schedule(7, 120, 6)
    facts = rating.fact_ratings(rating.rate(frame(spark, games), default_start=1500.0))
    wide = loop(games, {t: 1500.0 for t in range(6)})
    assert facts.count() == 240
    assert rows(facts, "MatchSequence", "EloAfter") == sorted(
        [(w[0], round(w[2], 2)) for w in wide] + [(w[0], round(w[4], 2)) for w in wide], key=repr
    )
    assert rating.zero_sum_breaks(facts).count() == 0
    assert rating.continuity_breaks(facts, block_rows=10).count() == 0
    broken = facts.withColumn("EloAfter", F.when(F.col("MatchSequence") == 50, 0.0).otherwise(F.col("EloAfter")))
    assert rating.continuity_breaks(broken, block_rows=10).count() == 2
    lost = facts.withColumn("EloChange", F.when(F.col("MatchSequence") == 50, 1.0).otherwise(F.col("EloChange")))
    assert rows(rating.zero_sum_breaks(lost)) == [(500, 2.0)]


def test_flat_start(spark):
    games = schedule(8, 40, 4)
    out = rating.flat_start(frame(spark, games))
    wide = loop(games, {t: 1500.0 for t in range(4)})
    assert rows(out, *WIDE) == sorted([(w[0], *(round(v, 1) for v in w[1:])) for w in wide], key=repr)
    assert {"MatchKey", "HomeEloChange", "AwayEloChange", "Result"} <= set(out.columns)


@pytest.fixture(scope="module")
def facts(spark):
    rated = rating.rate(frame(spark, schedule(9, 400, 8, hot=0.4)), default_start=1500.0)
    return rating.fact_ratings(rated).cache()


@pytest.mark.parametrize("block_rows", [1, 17, 10_000])
def test_next_ratings_equal_the_team_window(facts, block_rows):
    window = Window.partitionBy("TeamId").orderBy("MatchSequence")
    expected = facts.withColumn("NextEloBefore", F.lead("EloBefore").over(window))
    columns = ("TeamId", "MatchSequence", "NextEloBefore")
    assert rows(rating.next_ratings(facts, block_rows), *columns) == rows(expected, *columns)


@pytest.mark.parametrize("block_rows", [1, 17, 10_000])
def test_history_equals_the_team_window(facts, block_rows):
    window = Window.partitionBy("TeamId").orderBy("MatchSequence")
    expected = facts.withColumn("Entry", F.row_number().over(window))
    history = rating.rating_history(facts, block_rows)
    assert rows(history, "TeamId", "Entry", "EloAfter") == rows(expected, "TeamId", "Entry", "EloAfter")
    lists = rating.rating_history_lists(history, list_rows=30).collect()
    assert max(len(r["History"]) for r in lists) == 30
    team0 = [x for r in sorted(lists, key=lambda r: r["List"]) if r["TeamId"] == 0 for x in r["History"]]
    assert team0 == [r["EloAfter"] for r in rating.rating_progression(facts, 0).collect()]


def test_season_ratings_equal_first_and_last_value(facts):
    window = (
        Window.partitionBy("TeamId", "CompetitionId", "SeasonId")
        .orderBy("RoundOrder", "MatchSequence")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    expected = facts.select(
        "TeamId", "CompetitionId", "SeasonId",
        F.first("EloBefore").over(window).alias("s"), F.last("EloAfter").over(window).alias("e"),
    ).distinct()
    assert rows(rating.season_ratings(facts)) == rows(expected)
    assert rating.season_ratings(facts, 1).select("SeasonId").distinct().count() == 1


def test_latest_equals_last_row_per_team(facts):
    window = Window.partitionBy("TeamId").orderBy(F.desc("MatchSequence"))
    expected = facts.withColumn("n", F.row_number().over(window)).filter("n = 1").select("TeamId", "EloAfter")
    assert rows(rating.latest_ratings(facts)) == rows(expected)
    snapshot = [r["CurrentElo"] for r in rating.rating_snapshot(facts).collect()]
    assert snapshot == sorted(snapshot, reverse=True) and len(snapshot) == 8


def test_start_ratings(spark):
    facts = spark.createDataFrame(
        [
            (1, 10, 20, 1, 1, dt.date(2015, 9, 1)),
            (2, 30, 10, 2, 1, dt.date(2015, 9, 2)),
            (3, 20, 30, 2, 1, dt.date(2015, 9, 1)),
            (4, 40, 10, 3, 2, None),
        ],
        "MatchKey long, HomeTeamId long, AwayTeamId long, CompetitionId long, SeasonId long, Date date",
    )
    starting = rating.starting_competitions(facts)
    # a missing date sorts first; equal dates go by match key
    assert rows(starting, "TeamId", "CompetitionId") == [(10, 3), (20, 1), (30, 2), (40, 3)]
    competitions = spark.createDataFrame([("premiership", 1), ("urc", 2), ("cup", 3)], "Competition string, CompetitionId long")
    silver = spark.createDataFrame([("premiership", "16/17"), ("premiership", "15/16"), ("urc", "15/16")], "Competition string, Season string")
    listed = spark.createDataFrame([("premiership", 1500.0), ("urc", 1300.0), ("pro-14", 1800.0)], "Competition string, StartingElo double")
    baseline = rating.baseline_ratings(listed, rating.oldest_seasons(silver))
    assert rows(baseline) == [("premiership", 1500.0, "15/16"), ("urc", 1300.0, "15/16")]
    base = rating.team_base_ratings(starting, competitions, baseline)
    assert rows(base, "TeamId", "Elo") == [(20, 1500.0), (30, 1300.0)]
    assert rows(rating.teams_without_base(starting, base), "TeamId") == [(10,), (40,)]


def test_short_slices_of_many_teams_are_rated_several_at_once(spark, monkeypatch):
    """The stages don't grow with the number of short slices; a slice is never cut."""
    stages, real = [], rating._sliced
    monkeypatch.setattr(rating, "_sliced", lambda games, state, rows: stages.append(rows) or real(games, state, rows))
    games = schedule(21, 400, 300)
    start = {t: 1500.0 for t in range(300)}
    rated = rating.rate(frame(spark, games), start_table(spark, start), default_start=1500.0, slice_rows=3)
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)
    teams = len({t for g in games for t in g[6:8]})
    assert stages == [teams // 3 // 3 * 3] and stages[0] > 80


def test_team_ids_of_any_size_and_type(spark):
    games = schedule(22, 80, 12)
    start = dict.fromkeys(range(12), 1500.0)
    expected = sorted(loop(games, start), key=repr)
    df = frame(spark, games)
    for team in (lambda c: F.col(c) - 7, lambda c: F.col(c) * F.lit(2**59), lambda c: F.concat(F.lit("t"), F.col(c))):
        other = df.withColumns({c: team(c) for c in ("HomeTeamId", "AwayTeamId")})
        rated = rating.rate(other, default_start=1500.0, slice_rows=30)
        assert rows(rated, *WIDE) == expected
        assert dict(rated.dtypes)["HomeTeamId"] == dict(other.dtypes)["HomeTeamId"]


def test_groups_of_slices_are_found_without_rounds_of_joins(spark, monkeypatch):
    """A slice is bounded, so one task labels it; no round of labels is stored."""

    def stored(*_, **__):
        raise AssertionError("a round of labels was stored")

    monkeypatch.setattr(components, "materialize", stored)
    games = schedule(23, 120, 30)
    start = dict.fromkeys(range(30), 1500.0)
    rated = rating.rate(frame(spark, games), default_start=1500.0, slice_rows=10)
    assert rows(rated, *WIDE) == sorted(loop(games, start), key=repr)


def test_contests_without_a_home_team_or_a_number_drop_out(spark):
    games = schedule(24, 40, 6)
    df = frame(spark, games)
    lost = df.limit(1).withColumns({c: F.lit(None).cast("long") for c in ("HomeTeamId", "AwayTeamId")})
    numberless = df.limit(1).withColumn("MatchSequence", F.lit(None).cast(dict(df.dtypes)["MatchSequence"]))
    rated = rating.rate(df.union(lost.withColumn("MatchSequence", F.lit(41))).union(numberless), default_start=1500.0)
    assert rows(rated, *WIDE) == sorted(loop(games, dict.fromkeys(range(6), 1500.0)), key=repr)
