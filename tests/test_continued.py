"""Ratings that continue, and ratings by waves, against the plain loop."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_rating import WIDE, frame, loop, schedule, start_table

from contestry.operators import rating
from contestry.operators.continued import RatingStore, Run


def numbered(games):
    """The same contests with dense sequence numbers."""
    return [(g[0], i, *g[2:]) for i, g in enumerate(sorted(games, key=lambda g: g[1]), 1)]


def store(spark, tmp_path, **options):
    return RatingStore(spark, str(tmp_path / "store"), default_start=1500.0, **options)


def test_two_runs_equal_one(spark, tmp_path):
    games = schedule(11, 300, 12, hot=0.3)
    start = dict.fromkeys(range(12), 1500.0)
    kept = store(spark, tmp_path, slice_rows=70)
    assert kept.rated() is None and kept.state() is None
    assert kept.run(frame(spark, games[:180])) == Run(0, 180, 180)
    assert rows(kept.rated(), *WIDE) == sorted(loop(games[:180], start), key=repr)
    assert kept.run(frame(spark, games)) == Run(180, 300, 120)
    assert rows(kept.rated(), *WIDE) == sorted(loop(games, start), key=repr)
    assert kept.run(frame(spark, games)) == Run(300, 300, 0)
    assert kept.state().count() == 12


def test_a_late_contest_restarts_from_the_state_before_it(spark, tmp_path):
    games = schedule(12, 240, 10)
    start = dict.fromkeys(range(10), 1500.0)
    kept = store(spark, tmp_path)
    late = games[150]
    without = numbered(games[:150] + games[151:])
    kept.run(frame(spark, without[:100]))
    kept.run(frame(spark, without[:200]))
    kept.run(frame(spark, without))
    assert [p.mark for p in kept.parts()] == [100, 200, 239]
    assert late[1] == 151 and kept.run(frame(spark, games)) == Run(100, 240, 140)
    assert rows(kept.rated(), *WIDE) == sorted(loop(games, start), key=repr)
    assert [p.mark for p in kept.parts()] == [100, 240]


def test_a_corrected_result_and_a_contest_that_goes(spark, tmp_path):
    games = schedule(13, 120, 8)
    start = dict.fromkeys(range(8), 1500.0)
    kept = store(spark, tmp_path)
    kept.run(frame(spark, games[:60]))
    kept.run(frame(spark, games))
    corrected = games[:80] + [(*games[80][:8], "Draw" if games[80][8] != "Draw" else "HomeWin")] + games[81:]
    assert kept.run(frame(spark, corrected)) == Run(60, 120, 60)
    assert rows(kept.rated(), *WIDE) == sorted(loop(corrected, start), key=repr)
    fewer = corrected[:90]
    assert kept.run(frame(spark, fewer)) == Run(60, 90, 30)
    assert rows(kept.rated(), *WIDE) == sorted(loop(fewer, start), key=repr)
    assert kept.run(frame(spark, fewer[:60])) == Run(60, 60, 0)
    assert kept.rated().count() == 60


def test_new_teams_and_changed_start_ratings(spark, tmp_path):
    games = schedule(14, 60, 5) + [(g[0] + 5000, g[1] + 60, *g[2:6], g[6] + 5, g[7] + 5, g[8]) for g in schedule(15, 40, 5)]
    start = {t: 1000.0 + 10 * t for t in range(10)}
    kept = store(spark, tmp_path)
    kept.run(frame(spark, games[:60]), start_table(spark, start))
    assert kept.run(frame(spark, games), start_table(spark, start)) == Run(60, 100, 40)
    assert rows(kept.rated(), *WIDE) == sorted(loop(games, start), key=repr)
    # a team of the second run starts elsewhere: the first run's part stays
    start[9] = 1400.0
    assert kept.run(frame(spark, games), start_table(spark, start)).restarted_at == 60
    assert rows(kept.rated(), *WIDE) == sorted(loop(games, start), key=repr)
    start[0] = 1400.0
    assert kept.run(frame(spark, games), start_table(spark, start)).restarted_at == 0
    assert rows(kept.rated(), *WIDE) == sorted(loop(games, start), key=repr)


def test_another_k_rates_all_anew(spark, tmp_path):
    games = schedule(16, 50, 5)
    start = dict.fromkeys(range(5), 1500.0)
    store(spark, tmp_path).run(frame(spark, games))
    other = store(spark, tmp_path, k=20.0)
    assert other.run(frame(spark, games)) == Run(0, 50, 50)
    assert rows(other.rated(), *WIDE) == sorted(loop(games, start, k=20.0), key=repr)


def test_a_run_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    games = schedule(17, 80, 6)
    kept = store(spark, tmp_path)
    kept.run(frame(spark, games[:50]))

    def broken(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(rating, "rate_from", broken)
        with pytest.raises(RuntimeError):
            kept.run(frame(spark, games))
    assert kept.rated().count() == 50
    assert kept.run(frame(spark, games)) == Run(50, 80, 30)


def test_an_empty_sequence(spark, tmp_path):
    kept = store(spark, tmp_path)
    assert kept.run(frame(spark, schedule(1, 3, 4)).limit(0)) == Run(0, 0, 0)


def close(df, expected):
    found = rows(df, *WIDE)
    assert len(found) == len(expected)
    for a, b in zip(found, sorted(expected, key=repr)):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=1e-9)


@pytest.mark.parametrize("slice_rows", [30, 500])
def test_waves_equal_the_loop(spark, slice_rows):
    games = schedule(18, 200, 60, hot=0.1)
    start = {t: 1300.0 + t for t in range(60)}
    df = frame(spark, games).withColumn("h", F.lit("own")).withColumn("_kept", F.lit(1))
    rated = rating.rate(df, start_table(spark, start), slice_rows=slice_rows, by="waves")
    close(rated, loop(games, start))
    assert set(df.columns) < set(rated.columns)


def test_waves_without_python_rows(spark):
    games = frame(spark, schedule(19, 60, 30))
    state = rating.start_state(games, None, 1500.0)
    linked = rating._linked(games.withColumn("_actual", F.lit(1.0)), 60).drop("_slice")
    plan = rating._rate_waves(linked, state, 35.0, 400.0)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan


def test_missing_starts_spread_in_waves_too(spark):
    games = schedule(20, 30, 10)
    a = rows(rating.rate(frame(spark, games), start_table(spark, {t: 1500.0 for t in range(5)})), *WIDE)
    b = rows(rating.rate(frame(spark, games), start_table(spark, {t: 1500.0 for t in range(5)}), by="waves"), *WIDE)
    assert [[x != x for x in r] for r in a] == [[x != x for x in r] for r in b]


def test_a_team_against_itself_is_refused(spark):
    games = [(10, 1, 1, 1, 1, None, 3, 3, "Draw"), (20, 2, 1, 1, 1, None, 1, 2, "Draw")]
    with pytest.raises(ValueError, match="itself"):
        rating.rate(frame(spark, games), default_start=1500.0, by="waves")


def test_rated_contests_are_left_out_of_later_waves(spark, monkeypatch):
    """Two teams meet over and over, so most contests of the other teams are rated long before."""
    pairs = [(20 + 2 * i, 21 + 2 * i) for i in range(90)]
    teams = [(0, 1)] * 30 + pairs
    games = [(i * 10, i, 1, 1, 1, None, home, away, "Draw") for i, (home, away) in enumerate(teams, 1)]
    sizes, real = [], rating._wave
    monkeypatch.setattr(rating, "_wave", lambda rows, n, *a: sizes.append(rows.count()) or real(rows, n, *a))
    rated = rating.rate(frame(spark, games), start_table(spark, dict.fromkeys(range(200), 1500.0)), by="waves")
    close(rated, loop(games, dict.fromkeys(range(200), 1500.0)))
    assert len(sizes) >= 30 and max(sizes[12:]) < 40 < len(games) <= sizes[0]
