"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from contestry.sources.schemas import STATISTICS

# Fixed values, written out here so that a wrong one in the library shows.
_DAY = "DATE '2001-03-15'"
RESULT_RULES = (
    ('valid_match_id', 'warn', 'MatchId IS NOT NULL'),
    ('valid_home_team', 'drop', 'HomeTeam IS NOT NULL'),
    ('valid_away_team', 'drop', 'AwayTeam IS NOT NULL'),
    ('valid_season', 'drop', 'Season IS NOT NULL'),
    ('valid_round', 'drop', 'Round IS NOT NULL'),
    ('valid_home_team_score', 'drop', 'HomeScore IS NOT NULL'),
    ('valid_away_team_score', 'drop', 'AwayScore IS NOT NULL'),
    ('valid_scores', 'warn', 'HomeScore >= 0 AND AwayScore >= 0'),
    ('different_teams', 'drop', 'HomeTeam != AwayTeam'),
    ('valid_date', 'warn', 'Date IS NOT NULL'),
)
UPCOMING_RULES = (
    ('valid_match_id', 'warn', 'MatchId IS NOT NULL'),
    ('valid_home_team', 'warn', 'HomeTeam IS NOT NULL'),
    ('valid_away_team', 'warn', 'AwayTeam IS NOT NULL'),
    ('different_teams', 'warn', 'HomeTeam != AwayTeam'),
    ('valid_date', 'warn', 'Date IS NOT NULL'),
    ('upcoming_match', 'warn', "Date >= DATE'2001-03-15'"),
)
SHARE_GROUPS = {
    'territory': ('HomeTerritory', 'AwayTerritory'),
    'possession': ('HomePossession', 'AwayPossession'),
    'home_ruck_speed': ('Home0-3sRuckSpeed', 'Home3-6sRuckSpeed', 'Home6s+RuckSpeed'),
    'away_ruck_speed': ('Away0-3sRuckSpeed', 'Away3-6sRuckSpeed', 'Away6s+RuckSpeed'),
    'territory_zones': ('TerritoryHomeTry-Line-22m', 'TerritoryHome22m-50m', 'TerritoryAway22m-50m', 'TerritoryAwayTry-Line-22m'),
    'home_possession_zones': ('HomePossessionsTryLine-22m', 'HomePossession22m-50m', 'HomePossessionOpp50m-22m', 'HomePossessionOpp22m-TryLine'),
    'away_possession_zones': ('AwayPossessionsTryLine-22m', 'AwayPossession22m-50m', 'AwayPossessionOpp50m-22m', 'AwayPossessionOpp22m-TryLine'),
    'last10_possession': ('HomePossessionLast10', 'AwayPossessionLast10'),
}
BASELINES = {
    'premiership': 1500.0,
    'championship': 900.0,
    'urc': 1300.0,
    'pro-14': 1800.0,
}
LEAGUE_ROUNDS = 30
PLAYOFF_ROUNDS = (("QF", "Quater Final", 98, "PlayOff"), ("SF", "Semi Final", 99, "PlayOff"), ("F", "Final", 100, "Final"))
TEAM_ALIASES = {
    'bath rugby': 'bath',
    'bath rugby club': 'bath',
    'bristol bears': 'bristol',
    'bristol rugby club': 'bristol',
    'bears': 'bristol',
    'chiefs': 'exeter-chiefs',
    'exeter-cheifs': 'exeter-chiefs',
    'gloucester rugby': 'gloucester',
    'gloucester rugby club': 'gloucester',
    'cherries': 'gloucester',
    'harlequins rugby': 'harlequins',
    'harlequins rugby club': 'harlequins',
    'leicester tigers': 'leicester',
    'leicester tigers rugby club': 'leicester',
    'leicester': 'leicester',
    'london irish': 'london-irish',
    'london irish rugby club': 'london-irish',
    'northampton saints': 'northampton',
    'northampton saints rugby club': 'northampton',
    'northampton': 'northampton',
    'saints': 'northampton',
    'sale sharks': 'sale',
    'sale rugby club': 'sale',
    'wasps rugby': 'wasps',
    'wasps rugby club': 'wasps',
    'saracens rugby': 'saracens',
    'saracens rugby club': 'saracens',
    'sarries': 'saracens',
    'worcester warriors': 'worcester',
    'worcester rugby club': 'worcester',
    'worcester': 'worcester',
    'newcastle falcons': 'newcastle',
    'newcastle rugby club': 'newcastle',
    'falcons': 'newcastle',
    'newcastle red bulls': 'newcastle',
    'newcastle red bulls rugby club': 'newcastle',
}

# Building blocks in order of dependence: name -> SELECT (or a recursive body).
_BLOCKS: dict[str, str] = {}


def _spelt(name: str) -> str:
    return f"""CASE o_orderpriority WHEN '1-URGENT' THEN {name} WHEN '2-HIGH' THEN '  ' || {name} || ' '
      WHEN '3-MEDIUM' THEN {name} || ' rugby' WHEN '4-NOT SPECIFIED' THEN lower({name}) || ' rugby club'
      ELSE lower({name}) END"""


_BLOCKS["line_totals"] = """
SELECT l_orderkey, count(*) AS n_lines, max(l_linenumber) AS top_line, sum(l_suppkey) AS supp,
  sum(l_quantity) FILTER (WHERE l_linenumber % 2 = 1) AS odd_qty,
  sum(l_quantity) FILTER (WHERE l_linenumber % 2 = 0) AS even_qty
FROM lineitem GROUP BY l_orderkey"""

_BLOCKS["feed"] = f"""
SELECT o_orderkey AS MatchId,
  {_spelt("h.n_name")} AS HomeTeam,
  CASE WHEN coalesce(n_lines, 0) < 10 THEN {_spelt("a.n_name")} END AS AwayTeam,
  CASE WHEN coalesce(n_lines, 0) <> 9 THEN CAST(year(o_orderdate) AS VARCHAR) END AS Season,
  CASE WHEN n_lines = 8 THEN 'X'
    WHEN month(o_orderdate) = 4 AND h.n_regionkey = 3 AND c_mktsegment <> 'MACHINERY' THEN '5'
    WHEN month(o_orderdate) = 10 THEN 'QF' WHEN month(o_orderdate) = 11 THEN 'SF'
    WHEN month(o_orderdate) = 12 THEN 'F' ELSE CAST(month(o_orderdate) AS VARCHAR) END AS Round,
  CASE WHEN CAST(o_orderdate AS DATE) < {_DAY}
    THEN (CASE WHEN o_totalprice < 10000 THEN -1 ELSE 1 END) * (CAST(odd_qty AS INTEGER) % 60) END AS HomeScore,
  CASE WHEN CAST(o_orderdate AS DATE) < {_DAY} THEN CAST(even_qty AS INTEGER) % 60 END AS AwayScore,
  CASE WHEN n_lines = 7 AND o_orderstatus = 'P' THEN NULL
    WHEN day(o_orderdate) = 31 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN isodow(o_orderdate) IN (1, 7) THEN strftime(o_orderdate, '%d-%m-%Y')
    WHEN isodow(o_orderdate) = 2 THEN strftime(o_orderdate, '%m-%d-%Y')
    WHEN isodow(o_orderdate) = 4 THEN strftime(o_orderdate, '%m/%d/%Y')
    ELSE strftime(o_orderdate, '%d/%m/%Y') END AS "Date",
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'RBS 6 Nations'
    WHEN h.n_regionkey = 0 THEN CASE WHEN year(o_orderdate) >= 1998 THEN 'Gallagher Premiership' ELSE 'Aviva Premiership' END
    WHEN h.n_regionkey = 1 THEN ' Championship' WHEN h.n_regionkey = 2 THEN 'URC' WHEN h.n_regionkey = 3 THEN 'Pro-14 '
    ELSE 'RBS 6 Nations' END AS Competition
FROM orders
LEFT JOIN line_totals ON o_orderkey = l_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation h ON h.n_nationkey = c_nationkey
LEFT JOIN nation a ON a.n_nationkey = (c_nationkey + 5 * (CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 + supp % 4 END)) % 25
CROSS JOIN (SELECT unnest([1, 2]) AS copy_no) c
WHERE copy_no = 1 OR n_lines > top_line"""


def _folded(team: str) -> str:
    return f"regexp_replace(trim(lower({team})), '^(nation_[0-9]+) rugby( club)?$', '\\1')"


_BLOCKS["cleaned"] = f"""
SELECT MatchId, {_folded("HomeTeam")} AS HomeTeam, {_folded("AwayTeam")} AS AwayTeam, Season, Round, HomeScore, AwayScore,
  CASE trim(lower(Competition)) WHEN 'gallagher premiership' THEN 'premiership' WHEN 'aviva premiership' THEN 'premiership'
    WHEN 'rbs 6 nations' THEN 'six nations' ELSE trim(lower(Competition)) END AS Competition,
  CAST(coalesce(try_strptime("Date", '%d-%m-%Y'), try_strptime("Date", '%m-%d-%Y'),
    try_strptime("Date", '%d/%m/%Y'), try_strptime("Date", '%m/%d/%Y')) AS DATE) AS "Date",
  CASE WHEN Round = 'F' THEN 1 ELSE 0 END AS IsNeutral,
  'season-' || coalesce(Season, 'unknown') AS source_file
FROM feed"""

_BLOCKS["scored"] = """
SELECT MatchId, HomeTeam, AwayTeam, Season, Round, HomeScore, AwayScore,
  CASE WHEN HomeScore > AwayScore THEN 'HomeWin' WHEN HomeScore < AwayScore THEN 'AwayWin' ELSE 'Draw' END AS Result,
  "Date", Competition, HomeScore - AwayScore AS HomePointsDifference, AwayScore - HomeScore AS AwayPointsDifference,
  HomeScore + AwayScore AS TotalMatchPoints,
  CASE WHEN HomeScore > AwayScore THEN 1 ELSE 0 END AS HomeWinFlag,
  CASE WHEN HomeScore < AwayScore THEN 1 ELSE 0 END AS AwayWinFlag,
  CASE WHEN HomeScore > AwayScore OR HomeScore < AwayScore THEN 0 ELSE 1 END AS DrawFlag,
  IsNeutral, source_file AS bronze_file
FROM cleaned"""

_BLOCKS["silver"] = """
SELECT * FROM scored
WHERE HomeTeam IS NOT NULL AND AwayTeam IS NOT NULL AND Season IS NOT NULL AND Round IS NOT NULL
  AND HomeScore IS NOT NULL AND AwayScore IS NOT NULL AND HomeTeam <> AwayTeam"""

_BLOCKS["upcoming"] = f"""
SELECT MatchId, HomeTeam, AwayTeam, Season, Round, "Date", Competition, IsNeutral, source_file
FROM cleaned WHERE "Date" >= {_DAY}"""


def _dim(name: str, id_name: str, source: str) -> str:
    return f"SELECT {name}, row_number() OVER (ORDER BY {name}) AS {id_name} FROM ({source})"


_BLOCKS["teams"] = _dim(
    "TeamName", "TeamId", "SELECT HomeTeam AS TeamName FROM silver UNION SELECT AwayTeam FROM silver"
)
_BLOCKS["competitions"] = _dim("Competition", "CompetitionId", "SELECT DISTINCT Competition FROM silver")
_BLOCKS["seasons"] = _dim("Season", "SeasonId", "SELECT DISTINCT Season FROM silver")
_BLOCKS["results"] = _dim("Result", "ResultId", "SELECT DISTINCT Result FROM silver")
_BLOCKS["played_rounds"] = _dim("Round", "RoundId", "SELECT DISTINCT Round FROM silver")

_ROUND_ROWS = [(str(n), f"Round {n}", n, "League") for n in range(1, LEAGUE_ROUNDS + 1)] + list(PLAYOFF_ROUNDS)
_BLOCKS["rounds"] = (
    "SELECT *, row_number() OVER (ORDER BY RoundOrder) AS RoundId FROM (VALUES "
    + ", ".join(f"('{c}', '{n}', {o}, '{t}')" for c, n, o, t in _ROUND_ROWS)
    + ") r(RoundCode, RoundName, RoundOrder, RoundType)"
)

_KEYED = """
SELECT row_number() OVER (ORDER BY "Date" NULLS FIRST, CompetitionId, h.TeamId, a.TeamId, MatchId) AS MatchKey,
  h.TeamId AS HomeTeamId, a.TeamId AS AwayTeamId, SeasonId, RoundId, RoundCode, RoundOrder, RoundName, RoundType,
  "Date", CompetitionId, IsNeutral {measures}
FROM {source} s
JOIN teams h ON s.HomeTeam = h.TeamName
JOIN teams a ON s.AwayTeam = a.TeamName
JOIN competitions c ON s.Competition = c.Competition
JOIN seasons y ON s.Season = y.Season
LEFT JOIN rounds r ON s.Round = r.RoundCode"""
_BLOCKS["facts"] = _KEYED.format(
    source="silver",
    measures=""", HomeScore, AwayScore, Result, HomePointsDifference, AwayPointsDifference, TotalMatchPoints,
  HomeWinFlag, AwayWinFlag, DrawFlag""",
)
_BLOCKS["upfacts"] = _KEYED.format(source="upcoming", measures="")
_BLOCKS["sequence"] = """
SELECT MatchKey, HomeTeamId, AwayTeamId, SeasonId, CompetitionId, RoundOrder, RoundCode, "Date", Result, IsNeutral, HomeWinFlag,
  row_number() OVER (ORDER BY SeasonId, "Date" NULLS FIRST, RoundOrder NULLS FIRST, MatchKey) AS MatchSequence
FROM facts"""
_BLOCKS["team_rows"] = """
SELECT HomeTeamId AS TeamId, * FROM facts UNION ALL SELECT AwayTeamId AS TeamId, * FROM facts"""
_BLOCKS["starting"] = """
SELECT TeamId, CompetitionId, SeasonId, "Date" FROM team_rows
QUALIFY row_number() OVER (PARTITION BY TeamId ORDER BY "Date" NULLS FIRST, MatchKey) = 1"""
_BLOCKS["oldest"] = "SELECT Competition, min(Season) AS Season FROM silver GROUP BY Competition"
_BLOCKS["baseline"] = (
    "SELECT Competition, StartingElo, Season FROM (VALUES "
    + ", ".join(f"('{c}', {r}::DOUBLE)" for c, r in BASELINES.items())
    + ") b(Competition, StartingElo) JOIN oldest USING (Competition)"
)
_BLOCKS["base"] = """
SELECT TeamId, CompetitionId, SeasonId, StartingElo AS Elo
FROM starting JOIN competitions USING (CompetitionId) JOIN (SELECT Competition, StartingElo FROM baseline) USING (Competition)"""
_BLOCKS["started"] = """
SELECT TeamId, coalesce(Elo, 1500::DOUBLE) AS Elo FROM teams LEFT JOIN (SELECT TeamId, Elo FROM base) USING (TeamId)"""


def _recursion(name: str, k: float, games: str, start: str) -> None:
    """Ratings as a recursion over rounds of contests that can be rated at once.

    ``games`` lists (MatchSequence, HomeTeamId, AwayTeamId, actual), ``start`` lists
    (TeamId, Elo). A contest is ready when both its teams have played all their
    earlier ones; every step rates the ready contests and lists all teams' new
    ratings. {name}_wide then looks up each contest's four ratings.
    """
    _BLOCKS[f"{name}_turns"] = f"""
SELECT MatchSequence, team, row_number() OVER (PARTITION BY team ORDER BY MatchSequence) AS turn
FROM (SELECT MatchSequence, unnest([HomeTeamId, AwayTeamId]) AS team FROM {games})"""
    _BLOCKS[f"{name}_slots"] = f"""
SELECT g.*, h.turn AS home_turn, a.turn AS away_turn FROM {games} g
JOIN {name}_turns h ON h.MatchSequence = g.MatchSequence AND h.team = HomeTeamId
JOIN {name}_turns a ON a.MatchSequence = g.MatchSequence AND a.team = AwayTeamId"""
    _BLOCKS[f"{name}_rounds(team, played, rating)"] = f"""
SELECT TeamId, 0::BIGINT, Elo FROM {start}
UNION ALL
(WITH ready AS MATERIALIZED (
  SELECT HomeTeamId, AwayTeamId,
    {k}::DOUBLE * (actual - 1::DOUBLE / (1::DOUBLE + pow(10::DOUBLE, (a.rating - h.rating) / 400::DOUBLE))) AS gain
  FROM {name}_slots
  JOIN {name}_rounds h ON h.team = HomeTeamId AND h.played = home_turn - 1
  JOIN {name}_rounds a ON a.team = AwayTeamId AND a.played = away_turn - 1),
moves AS (SELECT HomeTeamId AS team, gain FROM ready UNION ALL SELECT AwayTeamId, -gain FROM ready)
SELECT r.team, CASE WHEN m.gain IS NULL THEN played ELSE played + 1 END,
  CASE WHEN m.gain IS NULL THEN rating ELSE rating + m.gain END
FROM {name}_rounds r LEFT JOIN moves m ON m.team = r.team
WHERE EXISTS (SELECT 1 FROM ready))"""
    _BLOCKS[f"{name}_states"] = f"SELECT DISTINCT team, played, rating FROM {name}_rounds"
    _BLOCKS[f"{name}_wide"] = f"""
SELECT g.MatchSequence, HomeTeamId, AwayTeamId, h0.rating AS HomeEloBefore, h1.rating AS HomeEloAfter,
  a0.rating AS AwayEloBefore, a1.rating AS AwayEloAfter,
  h1.rating - h0.rating AS HomeEloChange, a1.rating - a0.rating AS AwayEloChange
FROM {name}_slots g
JOIN {name}_states h0 ON h0.team = HomeTeamId AND h0.played = home_turn - 1
JOIN {name}_states h1 ON h1.team = HomeTeamId AND h1.played = home_turn
JOIN {name}_states a0 ON a0.team = AwayTeamId AND a0.played = away_turn - 1
JOIN {name}_states a1 ON a1.team = AwayTeamId AND a1.played = away_turn"""


def _both_teams(name: str) -> str:
    """Two rows per contest from ``{name}_wide``."""
    sides = (("Home", "Away"), ("Away", "Home"))
    return " UNION ALL ".join(
        f"""SELECT q.MatchKey, q.MatchSequence, q.CompetitionId, q.SeasonId, q.RoundOrder, q."Date",
  q.{me}TeamId AS TeamId, q.{other}TeamId AS OpponentId, {me}EloBefore AS EloBefore, {me}EloAfter AS EloAfter,
  {me}EloChange AS EloChange FROM sequence q JOIN {name}_wide USING (MatchSequence)"""
        for me, other in sides
    )


_BLOCKS["games"] = """
SELECT MatchSequence, HomeTeamId, AwayTeamId,
  CASE Result WHEN 'HomeWin' THEN 1::DOUBLE WHEN 'AwayWin' THEN 0::DOUBLE ELSE 0.5::DOUBLE END AS actual
FROM sequence"""
_BLOCKS["flat"] = "SELECT TeamId, 1500::DOUBLE AS Elo FROM teams"
_recursion("elo", 35, "games", "started")
_recursion("elo20", 20, "games", "started")
_recursion("eloflat", 35, "games", "flat")
_BLOCKS["text_sequence"] = """
SELECT MatchKey, row_number() OVER (ORDER BY SeasonId, RoundCode NULLS FIRST, MatchKey) AS MatchSequence FROM facts"""
_BLOCKS["text_games"] = """
SELECT t.MatchSequence, HomeTeamId, AwayTeamId, actual
FROM text_sequence t JOIN sequence q USING (MatchKey) JOIN (SELECT MatchSequence, actual FROM games) g ON g.MatchSequence = q.MatchSequence"""
_recursion("elotext", 35, "text_games", "flat")
for _name in ("elo", "elo20"):
    _BLOCKS[f"{_name}_long"] = _both_teams(_name)

_BLOCKS["ratings"] = """
SELECT MatchKey, MatchSequence, CompetitionId, SeasonId, RoundOrder, "Date", TeamId, OpponentId,
  round(EloBefore, 2) AS EloBefore, round(EloAfter, 2) AS EloAfter, round(EloChange, 2) AS EloChange FROM elo_long"""
_BLOCKS["latest"] = """
SELECT TeamId, EloAfter FROM ratings QUALIFY row_number() OVER (PARTITION BY TeamId ORDER BY MatchSequence DESC) = 1"""
_BLOCKS["last_rounds"] = """
SELECT SeasonId, CompetitionId, max(RoundOrder) AS LastCompletedRound FROM facts GROUP BY ALL"""
_BLOCKS["next_games"] = """
SELECT u.*, LastCompletedRound FROM upfacts u JOIN last_rounds USING (SeasonId, CompetitionId)
WHERE RoundOrder = LastCompletedRound + 1"""
_BLOCKS["training"] = """
SELECT h.MatchSequence, h.EloBefore AS HomeTeamElo, a.EloBefore AS AwayTeamElo, round(h.EloBefore - a.EloBefore) AS EloDiff,
  IsNeutral, HomeWinFlag
FROM facts f JOIN ratings h ON h.MatchKey = f.MatchKey AND h.TeamId = f.HomeTeamId
JOIN ratings a ON a.MatchKey = f.MatchKey AND a.TeamId = f.AwayTeamId"""
_BLOCKS["ranked"] = """
SELECT *, row_number() OVER (ORDER BY MatchSequence) AS Position, count(*) OVER () AS total FROM training"""
_BLOCKS["record"] = """
SELECT TeamId, SeasonId,
  CASE WHEN (Result = 'HomeWin' AND TeamId = HomeTeamId) OR (Result = 'AwayWin' AND TeamId = AwayTeamId) THEN 1 ELSE 0 END AS won,
  CASE WHEN (Result = 'HomeWin' AND TeamId = AwayTeamId) OR (Result = 'AwayWin' AND TeamId = HomeTeamId) THEN 1 ELSE 0 END AS lost,
  CASE WHEN Result = 'Draw' THEN 1 ELSE 0 END AS drew
FROM team_rows"""

# ---- statistics --------------------------------------------------------------------------

_ZONES = (
    "l_returnflag = 'A'",
    "l_returnflag = 'N'",
    "l_returnflag = 'R' AND l_linestatus = 'F'",
    "l_returnflag = 'R' AND l_linestatus = 'O'",
)


def _sum_if(condition: str, name: str) -> str:
    return f"sum(CASE WHEN {condition} THEN l_quantity ELSE 0 END) AS {name}"


_SUMS = [
    "sum(l_quantity) AS qty",
    _sum_if("l_linenumber % 2 = 1", "odd"),
    _sum_if("l_linenumber % 2 = 0", "even"),
    _sum_if("l_linestatus = 'O'", "open_qty"),
]
for _i, _zone in enumerate(_ZONES, start=1):
    _SUMS += [
        _sum_if(_zone, f"zone{_i}"),
        _sum_if(f"l_linenumber % 2 = 1 AND {_zone}", f"odd_zone{_i}"),
        _sum_if(f"l_linenumber % 2 = 0 AND {_zone}", f"even_zone{_i}"),
    ]
_BLOCKS["stat_lines"] = (
    "SELECT l_orderkey, count(*) AS n_lines, " + ", ".join(_SUMS) + " FROM lineitem GROUP BY l_orderkey"
)


def _side_stats(side: str, half: str) -> list[str]:
    score = f"CAST({half} AS INTEGER) % 60"
    rest = f"(CAST({half} AS INTEGER) % 60) % 5"
    zone1, zone2 = f"{half}_zone1 / nullif({half}, 0)", f"{half}_zone2 / nullif({half}, 0)"
    return [
        f"{score} AS {side}Score",
        f"({score}) // 5 AS {side}Tries",
        f"CASE {rest} WHEN 2 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS {side}Conversions",
        f"CASE {rest} WHEN 3 THEN 1 ELSE 0 END AS {side}PenaltyGoals",
        f"CAST({half} AS INTEGER) AS {side}MetresGained",
        f"CAST({half}_zone1 * 2 AS INTEGER) AS {side}PostContactMetres",
        f'{zone1} AS "{side}0-3sRuckSpeed"',
        f'{zone2} + excess AS "{side}3-6sRuckSpeed"',
        f'1 - {zone1} - {zone2} AS "{side}6s+RuckSpeed"',
    ]


def _zone_stats(names: tuple[str, ...], prefix: str, whole: str) -> list[str]:
    shares = [f"{prefix}zone{i} / nullif({whole}, 0)" for i in range(1, 5)]
    shares[0] += " + excess"
    return [f'{share} AS "{name}"' for share, name in zip(shares, names)]


_STATS = [
    "o_orderkey AS MatchId",
    "open_qty / nullif(qty, 0) + excess AS HomeTerritory",
    "1 - open_qty / nullif(qty, 0) AS AwayTerritory",
    "odd / nullif(qty, 0) AS HomePossession",
    "even / nullif(qty, 0) + excess AS AwayPossession",
    "zone1 / nullif(qty, 0) AS HomePossessionLast10",
    "1 - zone1 / nullif(qty, 0) - excess AS AwayPossessionLast10",
    *_side_stats("Home", "odd"),
    *_side_stats("Away", "even"),
    *_zone_stats(SHARE_GROUPS["territory_zones"], "", "qty"),
    *_zone_stats(SHARE_GROUPS["home_possession_zones"], "odd_", "odd"),
    *_zone_stats(SHARE_GROUPS["away_possession_zones"], "even_", "even"),
]
_BLOCKS["stats"] = (
    "SELECT " + ", ".join(_STATS) + " FROM (SELECT *, CASE WHEN o_orderstatus = 'P' AND n_lines = 6 THEN 0.1::DOUBLE"
    " ELSE 0::DOUBLE END AS excess FROM orders LEFT JOIN stat_lines ON o_orderkey = l_orderkey) s"
)

def _stat_values() -> list[str]:
    """The 93 statistics columns in order; what no check reads is made from the line count."""
    known = {name.strip('"'): value for value, name in (part.rsplit(" AS ", 1) for part in _STATS)}
    known |= {
        "HomeTeam": "'nation-' || c_nationkey",
        "AwayTeam": "'segment-' || lower(c_mktsegment)",
        "Season": "CAST(year(o_orderdate) AS VARCHAR)",
        "Round": "CAST(month(o_orderdate) AS VARCHAR)",
        "HomeDropGoals": "0",
        "AwayDropGoals": "0",
    }
    values = []
    for i, field in enumerate(STATISTICS.fields):
        whole = field.dataType.simpleString() == "int"
        made = f"n_lines + {i}" if whole else f"n_lines / (n_lines + {i})::DOUBLE"
        values.append(known.get(field.name, made))
    return values


_BLOCKS["all_stats"] = (
    "SELECT " + ", ".join(f"{v} AS c{i}" for i, v in enumerate(_stat_values())) + " FROM (SELECT *,"
    " CASE WHEN o_orderstatus = 'P' AND n_lines = 6 THEN 0.1::DOUBLE ELSE 0::DOUBLE END AS excess"
    " FROM orders LEFT JOIN stat_lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey) s"
)


def _statistics_totals() -> str:
    parts = []
    for i, field in enumerate(STATISTICS.fields):
        value = f"length(c{i})" if field.dataType.simpleString() == "string" else f"c{i}"
        parts.append(
            f"""SELECT '{field.name}' AS "column", count(c{i}) AS filled, round(sum({value})::DOUBLE, 3) AS total FROM all_stats"""
        )
    return " UNION ALL ".join(parts)


_SCORE = "{s}Score <> {s}Tries * 5 + {s}Conversions * 2 + {s}PenaltyGoals * 3"
_DOMAIN = {
    "negative_scores": "HomeScore < 0 OR AwayScore < 0",
    "more_conversions_than_tries": "HomeTries < HomeConversions OR AwayTries < AwayConversions",
    "more_post_contact_than_metres": "HomeMetresGained < HomePostContactMetres OR AwayMetresGained < AwayPostContactMetres",
    "score_not_explained": f"{_SCORE.format(s='Home')} OR {_SCORE.format(s='Away')}",
}
_SHARES = {
    name: "abs(" + " + ".join(f'"{c}"' for c in columns) + " - 1) > 1e-6"
    for name, columns in SHARE_GROUPS.items()
}


def _count_checks(checks: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "check", count(*) FILTER (WHERE {c}) AS rows FROM {source}"""
        for n, c in checks.items()
    )


def _breach_rows(checks: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT MatchId, '{n}' AS "check" FROM {source} WHERE {c}""" for n, c in checks.items()
    )


def _rules(rules, source: str, label: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS "table", '{name}' AS rule, '{action}' AS action,
        count(*) FILTER (WHERE {condition}) AS passed,
        count(*) - count(*) FILTER (WHERE {condition}) AS failed FROM {source}"""
        for name, action, condition in rules
    )


def _filled(*columns: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((f"valid_{c}", "warn", f"{c} IS NOT NULL") for c in columns)


_GOLD_RULES = {
    "dim_teams": ("teams", _filled("TeamName", "TeamId")),
    "dim_competitions": ("competitions", _filled("Competition", "CompetitionId")),
    "dim_seasons": ("seasons", _filled("Season", "SeasonId")),
    "oldest_season_per_comp": (
        "oldest",
        (("valid_season", "warn", "Season IS NOT NULL"), ("valid_competition", "warn", "Competition IS NOT NULL")),
    ),
    "upcoming": ("upcoming", UPCOMING_RULES),
}


# ---- contests of customers ---------------------------------------------------------------

_BLOCKS["customer_games"] = """
SELECT *, row_number() OVER (ORDER BY "Date", MatchKey) AS MatchSequence FROM (
  SELECT o_orderkey AS MatchKey, o_custkey % n AS HomeTeamId, (o_custkey + 1 + (o_orderkey * 7919) % (n - 1)) % n AS AwayTeamId,
    CASE o_orderstatus WHEN 'F' THEN 1::DOUBLE WHEN 'O' THEN 0::DOUBLE ELSE 0.5::DOUBLE END AS actual,
    CAST(o_orderdate AS DATE) AS "Date"
  FROM orders CROSS JOIN (SELECT count(*) AS n FROM customer))"""
_BLOCKS["customer_start"] = """
SELECT DISTINCT unnest([HomeTeamId, AwayTeamId]) AS TeamId, 1500::DOUBLE AS Elo FROM customer_games"""
_recursion("customer", 35, "customer_games", "customer_start")
_CUSTOMER_RATINGS = """
SELECT MatchSequence, HomeTeamId, AwayTeamId, round(HomeEloBefore, 6) AS HomeEloBefore, round(HomeEloAfter, 6) AS HomeEloAfter,
  round(AwayEloBefore, 6) AS AwayEloBefore, round(AwayEloAfter, 6) AS AwayEloAfter FROM customer_wide"""

# ---- the queries -------------------------------------------------------------------------

_CLUB_KEYS = "[" + ", ".join(f"'{a}'" for a in TEAM_ALIASES) + "]"
_CLUB_NAMES = "[" + ", ".join(f"'{n}'" for n in TEAM_ALIASES.values()) + "]"
_N_CLUBS = len(TEAM_ALIASES)

_SILVER_COLUMNS = """MatchId, HomeTeam, AwayTeam, Season, Round, HomeScore, AwayScore, Result, "Date", Competition,
  HomePointsDifference, AwayPointsDifference, TotalMatchPoints, HomeWinFlag, AwayWinFlag, DrawFlag, IsNeutral"""
_CONTEST_KEY = 'Competition, Season, "Date", HomeTeam, AwayTeam'
_SAME_CONTEST = " AND ".join(f'l."{c}" = r."{c}"' for c in ("Competition", "Season", "Date", "HomeTeam", "AwayTeam"))
_FEED_COLUMNS = ("MatchId", "HomeTeam", "AwayTeam", "Season", "Round", "HomeScore", "AwayScore", "Date", "Competition")

_FLAT_COLUMNS = ", ".join(
    f"round({s}Elo{p}, 1) AS {s}Elo{p}" for s in ("Home", "Away") for p in ("Before", "After", "Change")
)

_QUERIES: dict[str, str] = {
    "ingest_metadata": """SELECT MatchId, 'orders' AS sourceFileBronze, 'silverTransformation' AS pipelineStage FROM feed""",
    "normalise_names": f"""SELECT o_orderkey AS MatchId, {_CLUB_NAMES}[o_custkey % {_N_CLUBS} + 1] AS HomeTeam,
        {_CLUB_NAMES}[o_orderkey % {_N_CLUBS} + 1] AS AwayTeam FROM orders""",
    "normalise_competition": "SELECT MatchId, Competition FROM cleaned",
    "parse_dates": """SELECT c.MatchId, c."Date" FROM cleaned c""",
    "result_flags": """SELECT MatchId, Result, HomePointsDifference, AwayPointsDifference, TotalMatchPoints,
        HomeWinFlag, AwayWinFlag, DrawFlag, IsNeutral FROM scored""",
    "silver_results": f"SELECT {_SILVER_COLUMNS}, bronze_file FROM silver",
    "upcoming_silver": "SELECT * FROM upcoming",
    "capped_metric": """SELECT MatchId,
        CASE WHEN HomePostContactMetres > HomeMetresGained THEN HomeMetresGained ELSE HomePostContactMetres END AS HomePostContactMetres,
        CASE WHEN AwayPostContactMetres > AwayMetresGained THEN AwayMetresGained ELSE AwayPostContactMetres END AS AwayPostContactMetres
        FROM stats""",
    "expectation_report": _rules(RESULT_RULES, "scored", "results")
    + " UNION ALL "
    + _rules(UPCOMING_RULES, "upcoming", "upcoming"),
    "gold_expectations": " UNION ALL ".join(_rules(r, t, label) for label, (t, r) in _GOLD_RULES.items()),
    "file_lineage": "SELECT coalesce(Season, 'unknown') AS source_file, count(*) AS rows FROM feed GROUP BY ALL",
    "null_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE "{c}" IS NULL) AS nulls FROM feed""" for c in _FEED_COLUMNS
    ),
    "source_row_counts": "SELECT source_file, count(*) AS rows FROM cleaned GROUP BY ALL",
    "duplicate_report": """SELECT sum(n)::BIGINT AS rows, count(*) AS distinct_rows, sum(n - 1)::BIGINT AS duplicates
        FROM (SELECT count(*) AS n FROM feed GROUP BY ALL, MatchId, HomeTeam, AwayTeam, Season, Round, HomeScore, AwayScore, "Date", Competition)""".replace(
        "GROUP BY ALL, ", "GROUP BY "
    ),
    "dedupe_exact": "SELECT DISTINCT * FROM feed",
    "dedupe_by_key": f"""SELECT {_SILVER_COLUMNS} FROM silver QUALIFY row_number() OVER (
        PARTITION BY {_CONTEST_KEY} ORDER BY MatchId, Round, HomeScore, AwayScore) = 1""",
    "domain_checks": _count_checks(_DOMAIN, "stats"),
    "domain_breaches": _breach_rows(_DOMAIN, "stats"),
    "share_checks": _count_checks(_SHARES, "stats"),
    "share_breaches": _breach_rows(_SHARES, "stats"),
    "negative_score_rows": f"SELECT {_SILVER_COLUMNS} FROM silver WHERE HomeScore < 0 OR AwayScore < 0",
    "complete_rows": f"""SELECT * FROM feed WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in _FEED_COLUMNS)}""",
    "distinct_values": " UNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS "column", {c} AS value FROM silver"""
        for c in ("Result", "Season", "Round", "HomeTeam", "AwayTeam", "Competition")
    ),
    "distinct_teams": "SELECT HomeTeam AS Team FROM silver UNION SELECT AwayTeam FROM silver ORDER BY Team",
    "dim_teams": "SELECT * FROM teams",
    "dim_competitions": "SELECT * FROM competitions",
    "dim_seasons": "SELECT * FROM seasons",
    "dim_results": "SELECT * FROM results",
    "dim_played_rounds": "SELECT * FROM played_rounds",
    "dim_rounds": """SELECT r.*, matches FROM rounds r
        LEFT JOIN (SELECT RoundCode, count(*) AS matches FROM facts GROUP BY ALL) USING (RoundCode)""",
    "fact_matches": "SELECT * FROM facts",
    "fact_upcoming": "SELECT * FROM upfacts",
    "unmatched_upcoming": """
        SELECT 'home_team' AS dimension, count(*) AS rows FROM upcoming WHERE HomeTeam NOT IN (SELECT TeamName FROM teams) OR HomeTeam IS NULL
        UNION ALL SELECT 'away_team', count(*) FROM upcoming WHERE AwayTeam NOT IN (SELECT TeamName FROM teams) OR AwayTeam IS NULL
        UNION ALL SELECT 'competition', count(*) FROM upcoming WHERE Competition NOT IN (SELECT Competition FROM competitions)
        UNION ALL SELECT 'season', count(*) FROM upcoming WHERE Season NOT IN (SELECT Season FROM seasons) OR Season IS NULL""",
    "wide_fact": f"""SELECT f.MatchKey, HomeTeamId, AwayTeamId, f.SeasonId, f.RoundId, HomeScore, AwayScore, f.Result,
        HomePointsDifference, AwayPointsDifference, HomePointsDifference AS MatchPointsDifference, ResultId, Season,
        h.TeamName AS HomeTeam, a.TeamName AS AwayTeam, r.RoundName, 'goldTransformation' AS pipelineStage, {_FLAT_COLUMNS}
        FROM facts f LEFT JOIN (SELECT MatchKey, w.* EXCLUDE (HomeTeamId, AwayTeamId) FROM sequence JOIN eloflat_wide w USING (MatchSequence)) e ON e.MatchKey = f.MatchKey
        LEFT JOIN results USING (Result) LEFT JOIN seasons y ON y.SeasonId = f.SeasonId
        LEFT JOIN teams h ON h.TeamId = HomeTeamId LEFT JOIN teams a ON a.TeamId = AwayTeamId
        LEFT JOIN rounds r ON r.RoundId = f.RoundId""",
    "outer_match_join": f"""SELECT l.MatchId, l.HomeTeam, l.HomeScore, r.MatchId AS MatchId_1, r.HomeTeam AS HomeTeam_1, r.Round AS Round_1
        FROM silver l FULL JOIN upcoming r ON {_SAME_CONTEST}""",
    "outer_match_join_left": f"""SELECT l.MatchId, l.HomeTeam, l.HomeScore FROM silver l FULL JOIN upcoming r ON {_SAME_CONTEST}""",
    "outer_join_by_id": """SELECT l.MatchId, l.HomeTeam, l.HomeScore, r.MatchId AS MatchId_1, r.HomeTeam AS HomeTeam_1, r.Round AS Round_1
        FROM silver l FULL JOIN upcoming r ON l.MatchId = r.MatchId""",
    "home_away_games": """SELECT HomeTeam, home_games, AwayTeam, away_games
        FROM (SELECT HomeTeam, count(*) AS home_games FROM silver GROUP BY ALL)
        JOIN (SELECT AwayTeam, count(*) AS away_games FROM silver GROUP BY ALL) ON HomeTeam = AwayTeam ORDER BY HomeTeam DESC""",
    "union_by_name": """SELECT MatchId, HomeTeam, HomeScore, AwayScore, NULL AS source_file FROM silver
        UNION ALL SELECT MatchId, HomeTeam, NULL, NULL, source_file FROM upcoming""",
    "match_sequence": "SELECT * FROM sequence",
    "oldest_season": "SELECT * FROM oldest",
    "baseline_ratings": "SELECT * FROM baseline",
    "starting_competition": "SELECT * FROM starting",
    "team_base_rating": "SELECT * FROM base",
    "teams_without_base": "SELECT * FROM starting WHERE TeamId NOT IN (SELECT TeamId FROM base)",
    "base_rating_list": """SELECT TeamName, Competition, Season, Elo FROM base JOIN teams USING (TeamId)
        JOIN competitions USING (CompetitionId) JOIN seasons USING (SeasonId)""",
    "expected_score": """SELECT MatchKey, h.Elo AS HomeStartingElo, a.Elo AS AwayStartingElo,
        round(1::DOUBLE / (1::DOUBLE + pow(10::DOUBLE, (a.Elo - h.Elo) / 400::DOUBLE)), 6) AS expected
        FROM sequence JOIN started h ON h.TeamId = HomeTeamId JOIN started a ON a.TeamId = AwayTeamId""",
    "fact_rating": "SELECT * FROM ratings",
    "rating_unrounded_k": """SELECT MatchKey, MatchSequence, TeamId, OpponentId, round(EloBefore, 6) AS EloBefore,
        round(EloAfter, 6) AS EloAfter, round(EloChange, 6) AS EloChange FROM elo20_long""",
    "rating_flat_start_wide": f"""SELECT q.*, {_FLAT_COLUMNS} FROM sequence q JOIN eloflat_wide USING (MatchSequence)""",
    "rating_by_round_text": """SELECT MatchKey, MatchSequence, round(HomeEloAfter, 1) AS HomeEloAfter, round(AwayEloAfter, 1) AS AwayEloAfter
        FROM text_sequence JOIN elotext_wide USING (MatchSequence)""",
    "stream_inferred_types": """SELECT MatchId, HomeTeam, HomeScore * 100 + CASE WHEN MatchId % 2 = 1 THEN 0.5::DOUBLE ELSE 0 END AS Crowd,
        CASE WHEN MatchId % 2 = 1 THEN DATE '2000-01-01' + CAST(MatchId % 365 AS INTEGER) END AS Announced,
        'double' AS crowd_type, 'date' AS announced_type FROM feed""",
    "stream_schema_history": """SELECT * FROM (VALUES (1, 'Crowd', 'int'), (2, 'Crowd', 'double'), (2, 'Announced', 'date')) t(version, name, type)""",
    "stream_evolved_silver": """SELECT MatchId, HomeTeam, AwayTeam, Season, Round, Result,
        HomeScore * 100 + CASE WHEN MatchId % 2 = 1 THEN 0.5::DOUBLE ELSE 0 END AS Crowd,
        CASE WHEN MatchId % 2 = 1 THEN DATE '2000-01-01' + CAST(MatchId % 365 AS INTEGER) END AS Announced FROM silver""",
    "stream_gold_seasons": """SELECT Season, Competition, Team, count(*) AS played, sum(won)::BIGINT AS won, sum(drawn)::BIGINT AS drawn, sum(lost)::BIGINT AS lost,
        sum(scored)::BIGINT AS scored, sum(conceded)::BIGINT AS conceded FROM (
          SELECT Season, Competition, HomeTeam AS Team, HomeWinFlag AS won, DrawFlag AS drawn, AwayWinFlag AS lost,
            HomeScore AS scored, AwayScore AS conceded FROM silver
          UNION ALL SELECT Season, Competition, AwayTeam, AwayWinFlag, DrawFlag, HomeWinFlag, AwayScore, HomeScore FROM silver)
        GROUP BY Season, Competition, Team""",
    "stream_rule_history": f'SELECT "rule", action, passed, failed FROM ({_rules(RESULT_RULES, "scored", "results")})',
    "stream_dedupe": f"SELECT DISTINCT {_CONTEST_KEY} FROM feed",
    "append_merged": "SELECT MatchId, Season, Result, NULL AS Round FROM silver UNION ALL SELECT MatchId, Season, NULL, Round FROM upcoming",
    "rating_waves": _CUSTOMER_RATINGS,
    "rating_continued": f"""SELECT r.*, CASE WHEN MatchSequence > n * 2 // 5 THEN 3 ELSE 1 END AS Run
        FROM ({_CUSTOMER_RATINGS}) r CROSS JOIN (SELECT count(*) AS n FROM orders)""",
    "rating_many_teams": _CUSTOMER_RATINGS,
    "rating_sliced": _CUSTOMER_RATINGS,
    "rating_history": """SELECT TeamId, row_number() OVER (PARTITION BY TeamId ORDER BY MatchSequence) AS Entry, MatchSequence, EloAfter
        FROM ratings""",
    "rating_history_lists": """SELECT TeamId, (Entry - 1) // 100 AS List,
        array_to_string(list(printf('%.2f', EloAfter) ORDER BY Entry), ',') AS History
        FROM (SELECT TeamId, row_number() OVER (PARTITION BY TeamId ORDER BY MatchSequence) AS Entry, EloAfter FROM ratings)
        GROUP BY ALL""",
    "season_start_end_rating": """SELECT DISTINCT TeamName, Competition, Season,
        first_value(EloBefore) OVER w AS StartingElo, last_value(EloAfter) OVER w AS EndingElo
        FROM ratings JOIN teams USING (TeamId) JOIN competitions USING (CompetitionId) JOIN seasons USING (SeasonId)
        WINDOW w AS (PARTITION BY TeamId, CompetitionId, SeasonId ORDER BY RoundOrder NULLS FIRST, MatchSequence
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "first_season_ratings": """SELECT DISTINCT TeamId, CompetitionId, SeasonId,
        first_value(EloBefore) OVER w AS StartingElo, last_value(EloAfter) OVER w AS EndingElo
        FROM ratings WHERE SeasonId = 1
        WINDOW w AS (PARTITION BY TeamId, CompetitionId, SeasonId ORDER BY RoundOrder NULLS FIRST, MatchSequence
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "latest_rating": "SELECT * FROM latest",
    "rating_snapshot": "SELECT TeamId, round(EloAfter, 2) AS CurrentElo FROM latest ORDER BY CurrentElo DESC, TeamId",
    "rating_progression": "SELECT MatchSequence, EloAfter FROM ratings WHERE TeamId = 4 ORDER BY MatchSequence",
    "zero_sum_check": "SELECT MatchKey, round(sum(EloChange), 6) + 0 AS TotalEloChange FROM ratings GROUP BY MatchKey",
    "zero_sum_breaks": """SELECT count(*) AS breaks FROM (SELECT round(sum(EloChange), 6) AS t FROM ratings GROUP BY MatchKey)
        WHERE abs(t) > 0.0001""",
    "continuity_check": """SELECT TeamId, MatchSequence, EloAfter, lead(EloBefore) OVER w AS NextEloBefore,
        round(abs(EloAfter - lead(EloBefore) OVER w), 6) AS "Break" FROM ratings WINDOW w AS (PARTITION BY TeamId ORDER BY MatchSequence)""",
    "result_counts_by_season": """SELECT Season, count(*) FILTER (WHERE Result = 'HomeWin') AS Home_Wins,
        count(*) FILTER (WHERE Result = 'AwayWin') AS Away_Wins, count(*) FILTER (WHERE Result = 'Draw') AS Draws
        FROM facts JOIN seasons USING (SeasonId) GROUP BY Season ORDER BY Season""",
    "season_totals": """SELECT Season, sum(CASE WHEN Result = 'HomeWin' THEN 1 ELSE 0 END)::BIGINT AS Home_Wins,
        sum(CASE WHEN Result = 'AwayWin' THEN 1 ELSE 0 END)::BIGINT AS Away_Wins,
        sum(CASE WHEN Result = 'Draw' THEN 1 ELSE 0 END)::BIGINT AS Draws FROM silver GROUP BY Season""",
    "team_record": """SELECT TeamName, sum(won)::BIGINT AS Wins, sum(lost)::BIGINT AS Loses, sum(drew)::BIGINT AS Draws
        FROM record JOIN teams USING (TeamId) GROUP BY TeamName ORDER BY Wins DESC, TeamName""",
    "team_season_record": """SELECT TeamName AS Team, Season, sum(won)::BIGINT AS Wins, sum(lost)::BIGINT AS Loses, sum(drew)::BIGINT AS Draws
        FROM record JOIN teams USING (TeamId) JOIN seasons USING (SeasonId) GROUP BY ALL ORDER BY Season, Team DESC""",
    "wins_by_team": """SELECT TeamName AS Team, Season, sum(won)::BIGINT AS Wins FROM record JOIN teams USING (TeamId)
        JOIN seasons USING (SeasonId) GROUP BY ALL""",
    "wins_of_chosen_teams": """SELECT TeamName AS Team, Season, sum(won)::BIGINT AS Wins FROM record JOIN teams USING (TeamId)
        JOIN seasons USING (SeasonId) WHERE TeamName IN ('nation_3', 'nation_7', 'nation_11') GROUP BY ALL""",
    "round_counts": "SELECT RoundCode, RoundOrder, count(*) AS matches FROM facts GROUP BY ALL ORDER BY RoundOrder NULLS FIRST",
    "home_team_counts": "SELECT HomeTeam, count(*) AS matches FROM silver GROUP BY ALL",
    "competition_counts": "SELECT Competition, count(*) AS matches FROM facts JOIN competitions USING (CompetitionId) GROUP BY ALL",
    "season_first_dates": """SELECT SeasonId, CompetitionId, min("Date") AS first_date, min(RoundOrder) AS first_round_order,
        min(RoundCode) AS first_round_code FROM facts GROUP BY ALL""",
    "first_date": """SELECT min("Date") AS first_date FROM silver""",
    "multi_competition_teams": """SELECT TeamId, count(DISTINCT CompetitionId) AS comps, count(*) AS matches FROM team_rows
        GROUP BY TeamId HAVING count(DISTINCT CompetitionId) > 1""",
    "last_round": "SELECT * FROM last_rounds",
    "next_round": "SELECT * FROM next_games",
    "next_round_available": """SELECT u.*, LastCompletedRound FROM upfacts u JOIN last_rounds USING (SeasonId, CompetitionId)
        WHERE RoundOrder > LastCompletedRound
        QUALIFY RoundOrder = min(RoundOrder) OVER (PARTITION BY u.SeasonId, u.CompetitionId)""",
    "next_round_features": """SELECT HomeTeamId, AwayTeamId, h.EloAfter AS HomeTeamElo, a.EloAfter AS AwayTeamElo,
        round(h.EloAfter - a.EloAfter, 6) AS EloDiff, SeasonId, RoundName, RoundOrder, "Date", CompetitionId, IsNeutral
        FROM next_games LEFT JOIN latest h ON h.TeamId = HomeTeamId LEFT JOIN latest a ON a.TeamId = AwayTeamId""",
    "upcoming_rounds": "SELECT DISTINCT SeasonId, CompetitionId, RoundOrder FROM upfacts",
    "training_frame": "SELECT * FROM training",
    "ordered_split": """SELECT CASE WHEN Position <= total - ceil(total / 5) THEN 'train' ELSE 'test' END AS part, MatchSequence, Position
        FROM ranked""",
    "scaled_features": " SELECT MatchSequence, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM fit)) / (SELECT stddev_pop({c}) FROM fit), 4) AS {c}"
        for c in ("HomeTeamElo", "AwayTeamElo", "EloDiff", "IsNeutral")
    )
    + " FROM ranked",
    "first_rows": "SELECT MatchSequence, MatchKey, HomeTeamId, AwayTeamId FROM sequence ORDER BY MatchSequence LIMIT 10",
    "csv_batch_ingest": "SELECT * FROM feed",
    "csv_schema_inference": """SELECT MatchId, Season::INTEGER AS Season, HomeScore, AwayScore FROM feed""",
    "csv_statistics_ingest": _statistics_totals(),
    "csv_schema_evolution": """SELECT MatchId, HomeTeam, HomeScore, AwayScore, CASE WHEN Season >= '1998' THEN "Date" END AS "Date"
        FROM feed""",
    "stream_bronze": "SELECT * FROM feed",
    "stream_schema_evolution": """SELECT MatchId, HomeTeam, AwayTeam, HomeScore, AwayScore, NULL AS "Date",
        CASE WHEN MatchId % 2 = 1 THEN 'ref-' || (MatchId % 7) END AS Referee FROM feed""",
    "rewritten_landing": """SELECT MatchId, HomeTeam, HomeScore, (SELECT count(*) FROM feed) AS before FROM feed WHERE HomeScore > 30""",
    "landing_refreshed": """SELECT MatchId, HomeTeam, CASE WHEN MatchId % 4 = 1 THEN -HomeScore ELSE HomeScore END AS HomeScore,
        CASE WHEN MatchId % 4 = 0 THEN 'same' ELSE 'new' END AS change FROM feed WHERE MatchId % 4 <> 2""",
    "stream_catalog": f"SELECT {_SILVER_COLUMNS} FROM silver",
    "overwrite_with_new_schema": """SELECT Season AS Year, Result, HomeScore::VARCHAR AS MatchId FROM silver""",
    "stream_bronze_to_silver": f"SELECT {_SILVER_COLUMNS} FROM silver",
    "stream_upcoming": """SELECT MatchId, HomeTeam, AwayTeam, Season, Round, "Date", Competition, IsNeutral FROM upcoming""",
    "gold_after_stream": """SELECT TeamName, sum(won)::BIGINT AS Wins, sum(lost)::BIGINT AS Loses, sum(drew)::BIGINT AS Draws
        FROM record JOIN teams USING (TeamId) GROUP BY TeamName""",
    "ctas_roundtrip": """SELECT Season, Result, count(*) AS matches FROM silver GROUP BY ALL""",
    "append_roundtrip": """SELECT Season, count(*) AS rows FROM (SELECT Season FROM silver UNION ALL SELECT Season FROM upcoming) GROUP BY ALL""",
}

_BLOCKS["fit"] = "SELECT * FROM ranked WHERE Position <= total - ceil(total / 5)"


# ---- the model ---------------------------------------------------------------------------

_FEATURES = ("HomeTeamElo", "AwayTeamElo", "EloDiff", "IsNeutral")
_BLOCKS["scale"] = (
    "SELECT count(*) AS n, "
    + ", ".join(f"avg({c}) AS mean_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS std_{c}" for c in _FEATURES)
    + " FROM fit"
)
_BLOCKS["scaled_fit"] = (
    "SELECT n, HomeWinFlag::DOUBLE AS y, "
    + ", ".join(f"({c} - mean_{c}) / std_{c} AS x{i}" for i, c in enumerate(_FEATURES))
    + " FROM fit CROSS JOIN scale"
)
_W = [f"w{i}" for i in range(len(_FEATURES))]
_P = "1::DOUBLE / (1::DOUBLE + exp(-(b + " + " + ".join(f"{w} * x{i}" for i, w in enumerate(_W)) + ")))"
# gradient steps on the mean loss with an L2 penalty of 1 / n on the weights; a step of 1 is below the
# curvature of four scaled features, and 800 of them leave nothing to improve in the digits shown
_BLOCKS[f"steps(step, b, {', '.join(_W)})"] = f"""
SELECT 0, 0::DOUBLE, {", ".join("0::DOUBLE" for _ in _W)}
UNION ALL
SELECT step + 1, b - avg({_P} - y), {", ".join(f"{w} - avg(({_P} - y) * x{i}) - {w} / max(n)" for i, w in enumerate(_W))}
FROM steps CROSS JOIN scaled_fit WHERE step < 800 GROUP BY step, b, {", ".join(_W)}"""
_BLOCKS["weights"] = "SELECT * FROM steps WHERE step = 800"
_SCALED = ", ".join(f"({c} - mean_{c}) / std_{c} AS x{i}" for i, c in enumerate(_FEATURES))
_BLOCKS["model_predicted"] = f"""
SELECT label, CASE WHEN {_P} > 0.5 THEN 1 ELSE 0 END AS prediction
FROM (SELECT HomeWinFlag AS label, {_SCALED} FROM ranked CROSS JOIN scale WHERE Position > total - ceil(total / 5)) CROSS JOIN weights"""
_BLOCKS["rule_predicted"] = """
SELECT HomeWinFlag AS label, CASE WHEN EloDiff > 0 THEN 1 ELSE 0 END AS prediction
FROM ranked WHERE Position > total - ceil(total / 5)"""


def _report(predicted: str) -> str:
    return f"""SELECT class::VARCHAR AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
    FROM (WITH classes AS (SELECT label AS class FROM {predicted} UNION SELECT prediction FROM {predicted}),
    scores AS (SELECT class, coalesce(hits / nullif(guessed, 0), 0) AS precision, coalesce(hits / nullif(support, 0), 0) AS recall,
        2 * hits / (support + guessed) AS f1, support, hits
      FROM (SELECT class, count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE prediction = class) AS guessed,
        (count(*) FILTER (WHERE label = class AND prediction = class))::DOUBLE AS hits FROM classes CROSS JOIN {predicted} GROUP BY class))
    SELECT class::VARCHAR AS class, precision, recall, f1, support::BIGINT AS support FROM scores
    UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support)::BIGINT FROM scores
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM scores
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support)::BIGINT FROM scores)"""


_QUERIES |= {
    "rating_rule_report": _report("rule_predicted"),
    "home_win_model_metrics": _report("model_predicted"),
    "next_round_probabilities": f"""SELECT * EXCLUDE (HomeWinProb), round(HomeWinProb, 2) AS HomeWinProb, round(1 - HomeWinProb, 2) AS AwayWinProb
        FROM (SELECT f.* EXCLUDE (x0, x1, x2, x3), {_P} AS HomeWinProb FROM (SELECT g.*, {_SCALED} FROM ({_QUERIES["next_round_features"]}) g
          CROSS JOIN scale WHERE HomeTeamElo IS NOT NULL AND AwayTeamElo IS NOT NULL) f CROSS JOIN weights)""",
}


def _needed(sql: str) -> set[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[A-Za-z_0-9]+", todo.pop()))
        for block, body in _BLOCKS.items():
            if block not in found and block.split("(")[0] in words:
                found.add(block)
                todo.append(body)
    return found


def oracle_sql() -> dict[str, str]:
    """Each query as one statement: the blocks it needs, then its SELECT."""
    statements = {}
    for name, query in _QUERIES.items():
        needed = _needed(query)
        parts = [f"{block} AS MATERIALIZED ({body})" if "(" not in block else f"{block} AS ({body})" for block, body in _BLOCKS.items() if block in needed]
        statements[name] = ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + query
    return statements
