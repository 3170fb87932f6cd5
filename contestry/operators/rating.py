"""Sequential Elo ratings, exact, on Spark.

Every rating depends on the previous contest of both teams. The sequence is cut into
slices of about a third as many contests as there are teams; then the
contests of a slice fall into many small groups of teams that don't meet in it,
however connected the teams are as a whole. A slice is bounded, so one task finds its groups;
the group of its next slice that each team goes on to comes from a window by team. A group is rated
by one pass over its contests and sends its teams' ratings on to these groups.

A job rates several slices, each a shuffle stage: ratings travel from group to group
inside the job, and only those for later jobs are stored. So no task holds more contests
than a slice (those of its own groups, when it rates), ratings that
don't change aren't touched, and a failure repeats part of one job. With few teams
the chain of contests is sequential whatever the plan; a slice then holds
``LEAST_ROWS`` contests, which one task rates in a second or two.

A slice can also be rated by waves (``by="waves"``): the contests whose teams have both
played all their earlier ones are rated at once, by column expressions, and send their
teams' ratings to the contests that come next. That needs no Python worker and no
groups, but a shuffle for each wave, so it suits many teams.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contestry.functions.scoring import actual_score, expected_score
from contestry.operators.components import local_roots
from contestry.operators.star import both_sides
from contestry.session import materialize, new_folder

# The largest gain per contest, and the gap that means ten-fold odds.
K_FACTOR = 35.0
SCALE = 400.0

# Teams per contest of a slice, and the least contests of one; only a stated size makes it larger.
TEAMS_PER_CONTEST = 3
LEAST_ROWS = 1_000_000
# Contests that are worth a task of their own, and those of one stored file.
TASK_ROWS = 25_000
FILE_ROWS = 250_000
# Slices of one job, and the contests that a job of several slices holds at most.
JOB_SLICES = 8
JOB_ROWS = 1 << 20
# Tasks that slices are dealt to when their groups are looked for.
MOST_TASKS = 1000
# Waves of one job; what they have rated is left out of the next.
WAVES = 4

_ELO_COLUMNS = ("HomeEloBefore", "HomeEloAfter", "AwayEloBefore", "AwayEloAfter")


# ---- start ratings -----------------------------------------------------------------------


def oldest_seasons(silver: DataFrame) -> DataFrame:
    """First season per competition (in string order)."""
    return silver.groupBy("Competition").agg(F.min("Season").alias("Season"))


def baseline_ratings(baselines: DataFrame, oldest: DataFrame) -> DataFrame:
    """Start rating of the listed competitions that occur, with their first season."""
    return baselines.join(oldest, "Competition").select("Competition", "StartingElo", "Season")


def starting_competitions(facts: DataFrame) -> DataFrame:
    """Competition, season and date of each team's first contest.

    The first row is the smallest (Date, MatchKey), an aggregate that is combined
    before the shuffle, so a team with very many contests is no hot spot.
    """
    rows = both_sides(facts, "HomeTeamId", "AwayTeamId", "TeamId", "Date", "MatchKey", "CompetitionId", "SeasonId")
    first = rows.groupBy("TeamId").agg(
        F.min(F.struct("Date", "MatchKey", "CompetitionId", "SeasonId")).alias("first")
    )
    return first.select("TeamId", "first.CompetitionId", "first.SeasonId", "first.Date")


def team_base_ratings(
    starting: DataFrame, competitions: DataFrame, baseline: DataFrame
) -> DataFrame:
    """Start rating per team; teams whose first competition has no baseline drop out."""
    return (
        starting.join(competitions, "CompetitionId")
        .join(baseline.drop("Season"), "Competition")
        .select("TeamId", "CompetitionId", "SeasonId", F.col("StartingElo").alias("Elo"))
    )


def teams_without_base(starting: DataFrame, base: DataFrame) -> DataFrame:
    """Teams that have no start rating (a warning when no default is given)."""
    return starting.join(base.select("TeamId"), "TeamId", "left_anti")


def with_start_ratings(
    sequence: DataFrame, base: DataFrame, default_start: float | None = None
) -> DataFrame:
    """Attach both teams' start ratings; ``default_start`` fills missing ones."""
    for side in ("Home", "Away"):
        start = base.select(
            F.col("TeamId").alias(f"{side}TeamId"), F.col("Elo").alias(f"{side}StartingElo")
        )
        sequence = sequence.join(start, f"{side}TeamId", "left")
        if default_start is not None:
            sequence = sequence.fillna(default_start, f"{side}StartingElo")
    return sequence


# ---- the rating pass ---------------------------------------------------------------------

# What travels through a job. A contest has a sequence number. A row without one is about
# a team (home): the group it goes on to after this slice, or the rating it comes with (h_before).
_TRAVEL = (
    "slice", "component", "sequence", "home", "away", "actual", "next_slice", "next_component",
    "h_before", "h_after", "a_before", "a_after",
)


def _group_pass(number: int, k: float, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function over travelling rows, dealt by (slice, component).

    It rates the contests of one slice, in sequence, and sends the ratings of its groups on.
    Within a slice a team has one group, so a task's groups share a table of ratings.
    Rows of other slices pass as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = []
        for batch in batches:
            here = pc.equal(batch.column("slice"), number)
            if here.true_count:
                own.append(batch.filter(here))
            if here.true_count < len(batch):
                yield batch.filter(pc.invert(here))
        if not own:
            return
        rows = pa.Table.from_batches(own)
        messages = rows.filter(pc.is_null(rows["sequence"]))
        starts = messages.filter(pc.is_valid(messages["h_before"]))
        rating = dict(zip(_values(starts["home"]), _values(starts["h_before"])))
        contests = rows.filter(pc.is_valid(rows["sequence"])).sort_by("sequence").select(_TRAVEL[:8])
        for part in contests.to_batches(max_chunksize=_CHUNK):
            elo = []
            for home, away, actual in zip(*(_values(part.column(c)) for c in ("home", "away", "actual"))):
                h, a = rating[home], rating[away]
                gain = k * (actual - 1 / (1 + 10 ** ((a - h) / scale)))
                rating[home] = h_after = h + gain
                rating[away] = a_after = rating[away] - gain
                elo.append((h, h_after, a, a_after))
            values = [pa.array(c, pa.float64()) for c in zip(*elo)]
            yield pa.RecordBatch.from_arrays([*part.columns, *values], schema=rows.schema)
        onward = messages.filter(pc.is_valid(messages["next_slice"])).combine_chunks()
        if len(onward):
            nothing = [pa.nulls(len(onward), f.type) for f in rows.schema]
            sent = [onward["next_slice"], onward["next_component"], nothing[2], onward["home"], *nothing[4:8]]
            sent.append(pa.array([rating.get(t) for t in _values(onward["home"])], pa.float64()))
            yield from pa.Table.from_arrays([*sent, *nothing[9:]], schema=rows.schema).to_batches(max_chunksize=_CHUNK)

    return run


# Contests that are Python values at once.
_CHUNK = 1 << 16


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """As Python values; numbers go over numpy, which is much faster."""
    if column.null_count or not (pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_pylist()
    return column.to_numpy().tolist()


def _slice_groups(rows: pa.Table) -> pa.Table:
    """The contests of one slice with their group, named by its smallest team, and a row
    without a contest for each team of the slice."""
    slice_, sequence, home, away, actual = (rows[c].combine_chunks() for c in _CUT)
    teams = pa.concat_arrays([home, away]).unique().drop_null()
    teams = teams.take(pc.sort_indices(teams))
    a, b = pc.index_in(home, teams), pc.index_in(away, teams)
    met = pc.and_(a.is_valid(), b.is_valid())
    roots = pa.array(local_roots(len(teams), *(x.filter(met).to_numpy() for x in (a, b))))
    known = a.is_valid()
    contests = [slice_, teams.take(roots.take(a)), sequence, home, away, actual]
    n = len(teams)
    members = [slice_[:1].take(pa.nulls(n, pa.int64()).fill_null(0)), teams.take(roots), pa.nulls(n, sequence.type), teams]
    members += [pa.nulls(n, away.type), pa.nulls(n, actual.type)]
    return pa.table({c: pa.concat_arrays([x.filter(known), y]) for c, x, y in zip(_TRAVEL, contests, members)})


_CUT = ("slice", "MatchSequence", "HomeTeamId", "AwayTeamId", "_actual")


def _sliced(games: DataFrame, state: DataFrame, rows: int) -> DataFrame:
    """Travelling rows stored by slice: the contests with their group, and for each team and slice
    the group of its next one, the first of them with its start rating.

    A slice is bounded (``LEAST_ROWS``, or what is stated), so one task finds its groups.
    """
    spark = games.sparkSession
    team = games.select(F.coalesce("HomeTeamId", "AwayTeamId")).schema[0].dataType
    number = F.col("MatchSequence").cast("bigint")
    cut = games.filter("MatchSequence IS NOT NULL").select(
        F.floor((number - 1) / rows).alias("slice"), number.alias("MatchSequence"),
        *(F.col(c).cast(team).alias(c) for c in _CUT[2:4]), "_actual",
    )
    first, last = cut.agg(F.min("slice"), F.max("slice")).first()
    tasks = min((last or 0) - (first or 0) + 1, MOST_TASKS)
    kinds = T.StructType([T.StructField(c, cut.schema[f].dataType) for c, f in zip(_TRAVEL, (_CUT[0], _CUT[2], *_CUT[1:]))])
    grouped = materialize(cut.repartition(tasks, "slice").groupBy("slice").applyInArrow(_slice_groups, kinds), "groups")
    nothing = lambda kind: F.lit(None).cast(kind)
    contests = grouped.filter("sequence IS NOT NULL").select(
        *_TRAVEL[:6], nothing("bigint").alias("next_slice"), nothing(team).alias("next_component"),
        *(nothing("double").alias(c) for c in _TRAVEL[8:]),
    )
    order = Window.partitionBy("home").orderBy("slice")  # a row for each slice in which the team plays
    known = F.coalesce("Elo", F.lit(float("nan")))
    onward = grouped.filter("sequence IS NULL").withColumn("_next", F.lead(F.struct("slice", "component")).over(order))
    routes = (
        onward.withColumn("_first", F.row_number().over(order) == 1)
        .join(state.select(F.col("TeamId").alias("home"), "Elo"), "home")
        .select(
            *_TRAVEL[:6], F.col("_next.slice").alias("next_slice"), F.col("_next.component").alias("next_component"),
            F.when(F.col("_first"), known).alias("h_before"), *(nothing("double").alias(c) for c in _TRAVEL[9:]),
        )
    )
    part = F.pmod(F.xxhash64("component"), F.lit(-(-rows // FILE_ROWS)))
    both = contests.unionByName(routes).withColumn("_slice", F.col("slice"))
    return materialize(both.repartition("slice", part), "slices", partition_by="_slice")


def _rate_groups(sequence: DataFrame, state: DataFrame, rows: int, k: float, scale: float) -> DataFrame:
    spark = sequence.sparkSession
    travelling = _sliced(sequence.withColumn("_actual", actual_score()), state, rows)
    folder = new_folder(spark, "rated")
    schema = travelling.drop("_slice").schema
    slices = sorted(r["_slice"] for r in travelling.select("_slice").distinct().collect())  # one row per slice
    together = max(1, min(JOB_SLICES, JOB_ROWS // rows))
    # a stated number keeps adaptive execution from putting all groups of a long slice in one task
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows * together // TASK_ROWS))
    jobs = sorted({n // together for n in slices})
    written: set[int] = set()
    for job in jobs:
        # only the folder of the messages to this job is listed
        table = spark.read.schema(schema).parquet(f"{folder}/_to={job}") if job in written else None
        for number in (n for n in slices if n // together == job):
            own = travelling.filter(F.col("_slice") == number).drop("_slice")
            table = own if table is None else table.unionByName(own)
            table = table.repartition(tasks, "slice", "component").mapInArrow(_group_pass(number, k, scale), schema)
        to = F.when(F.col("sequence").isNotNull(), -1).otherwise(F.floor(F.col("slice") / together)).cast("int")
        table.filter("sequence IS NOT NULL OR next_slice IS NULL").withColumn("_to", to).write.mode("append").partitionBy("_to").parquet(folder)
        written = _jobs_sent_to(spark, folder)
    if not slices:
        return sequence.select("*", *(F.lit(None).cast("double").alias(c) for c in _ELO_COLUMNS)).limit(0)
    stored = spark.read.schema(schema).parquet(f"{folder}/_to=-1")
    elo = stored.select(F.col("sequence").alias("MatchSequence"), *(F.col(a).alias(b) for a, b in zip(_TRAVEL[8:], _ELO_COLUMNS)))
    return sequence.join(elo, "MatchSequence").select(*sequence.columns, *_ELO_COLUMNS)


def _jobs_sent_to(spark, folder: str) -> set[int]:
    """The jobs that messages are stored for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return {int(n.removeprefix("_to=")) for n in names if n.startswith("_to=")}


def _linked(games: DataFrame, rows: int) -> DataFrame:
    """Contests stored by slice, each with the next contest of either team in its slice, and
    whether it is a team's first one there."""
    cut = games.withColumn("_slice", F.floor((F.col("MatchSequence") - 1) / rows))
    side = lambda s: F.struct(F.col(f"{s}TeamId").alias("team"), F.lit(s).alias("side"))
    sides = cut.select("_slice", "MatchSequence", F.explode(F.array(side("Home"), side("Away"))).alias("_s"))
    own = Window.partitionBy("_slice", "_s.team").orderBy("MatchSequence")
    following = sides.select(
        "_slice",
        "MatchSequence",
        F.col("_s.side").alias("side"),
        F.lead(F.struct("MatchSequence", "_s.side")).over(own).alias("next"),
        (F.row_number().over(own) == 1).alias("first"),
    )
    of = lambda c, s: F.max(F.when(F.col("side") == s, F.col(c))).alias(f"_{s}_{c}")
    links = following.groupBy("_slice", "MatchSequence").agg(*(of(c, s) for c in ("next", "first") for s in ("Home", "Away")))
    linked = cut.join(links, ["_slice", "MatchSequence"])
    return materialize(
        linked.select(*games.columns, *links.columns[2:], "_slice").repartitionByRange("MatchSequence"),
        "linked-slices",
        partition_by="_slice",
    )


_WAVE = ("MatchSequence", "actual", "home_next", "away_next", "h", "a", "wave")


def _gain(k: float, scale: float):
    return k * (F.col("actual") - expected_score("h", "a", scale))


def _wave(rows: DataFrame, number: int, k: float, scale: float) -> DataFrame:
    """One wave: contests that have got both ratings are rated and send them on.

    A contest is a row of its own plus the messages to it, which hold one rating each.
    """
    merged = rows.groupBy("MatchSequence").agg(*(F.max(c).alias(c) for c in _WAVE[1:]))
    ready = F.col("wave").isNull() & F.col("h").isNotNull() & F.col("a").isNotNull()
    own = F.struct(*_WAVE[:-1], F.coalesce("wave", F.when(ready, F.lit(number))).alias("wave"))
    kinds = dict(rows.dtypes)

    def message(after: str, value):
        to = lambda side: F.when(F.col(f"{after}.side") == side, value)
        empty = {c: F.lit(None).cast(kinds[c]) for c in _WAVE}
        full = empty | {"MatchSequence": F.col(f"{after}.MatchSequence"), "h": to("Home"), "a": to("Away")}
        return F.when(ready & F.col(after).isNotNull(), F.struct(*(v.alias(c) for c, v in full.items())))

    gain = _gain(k, scale)
    sent = [message("home_next", F.col("h") + gain), message("away_next", F.col("a") - gain)]
    return merged.select(F.inline(F.array_compact(F.array(own, *sent))))


def _rate_slices(sequence: DataFrame, state: DataFrame, rows: int, k: float, scale: float) -> DataFrame:
    """Rate slice after slice by waves."""
    spark = sequence.sparkSession
    games = _linked(sequence.withColumn("_actual", actual_score()), rows)
    folder = new_folder(spark, "rated")
    schema = T.StructType(sequence.schema.fields + [T.StructField(c, T.DoubleType()) for c in _ELO_COLUMNS])
    slices = sorted(r["_slice"] for r in games.select("_slice").distinct().collect())  # one row per slice
    for number in slices:
        part = games.filter(F.col("_slice") == number).drop("_slice")
        path = f"{folder}/slice={number}"
        _rate_waves(part, state, k, scale).write.parquet(path)
        if number != slices[-1]:
            state = materialize(state_after(state, spark.read.schema(schema).parquet(path)), "state")
    if not slices:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())


def _rate_waves(games: DataFrame, state: DataFrame, k: float, scale: float) -> DataFrame:
    """Rate linked contests from a table of (TeamId, Elo), wave by wave."""
    links = {f"_{s}_{c}" for s in ("Home", "Away") for c in ("next", "first")}
    kept = [c for c in games.columns if c not in links and c != "_actual"]
    part = games.select(*kept)
    games = games.select("MatchSequence", "HomeTeamId", "AwayTeamId", "_actual", *links)
    for s, c in (("Home", "h"), ("Away", "a")):
        # a missing start rating is not a number, as in the pass over groups
        known = F.coalesce("Elo", F.lit(float("nan"))).alias(f"_{c}")
        start = state.select(F.col("TeamId").alias(f"{s}TeamId"), known)
        games = games.join(start, f"{s}TeamId").withColumn(c, F.when(F.col(f"_{s}_first"), F.col(f"_{c}"))).drop(f"_{c}")
    table = games.select(
        "MatchSequence", F.col("_actual").alias("actual"), F.col("_Home_next").alias("home_next"),
        F.col("_Away_next").alias("away_next"), "h", "a", F.lit(None).cast("int").alias("wave"),
    )
    spark, folder = games.sparkSession, new_folder(games.sparkSession, "waves")
    schema = table.schema
    stored = T.StructType([*schema, T.StructField("_waves", T.IntegerType()), T.StructField("_rated", T.BooleanType())])
    done, left = 0, None
    while left != 0:
        for _ in range(WAVES):
            done += 1
            table = _wave(table, done, k, scale)
        seen = Observation()
        open_ = F.count_if(F.col("wave").isNull() & F.col("actual").isNotNull())
        marked = table.observe(seen, open_.alias("open")).withColumn("_rated", F.col("wave").isNotNull())
        marked.write.partitionBy("_rated").parquet(f"{folder}/_waves={done}")
        before, left = left, seen.get["open"]
        if before is not None and left == before and left:
            raise ValueError("a contest of a team with itself can't be rated by waves")
        if left:
            # a rated contest gets no more messages, so only the open ones and messages to them go on
            table = spark.read.schema(schema).parquet(f"{folder}/_waves={done}/_rated=false")
    after = _gain(k, scale)
    elo = spark.read.schema(stored).parquet(folder).filter("_rated").select(
        "MatchSequence", F.col("h").alias("HomeEloBefore"), (F.col("h") + after).alias("HomeEloAfter"),
        F.col("a").alias("AwayEloBefore"), (F.col("a") - after).alias("AwayEloAfter"),
    )
    return part.join(elo, "MatchSequence").select(*kept, *_ELO_COLUMNS)


def start_state(sequence: DataFrame, base: DataFrame | None, default_start: float | None) -> DataFrame:
    """(TeamId, Elo) of every team of the sequence before its first contest."""
    teams = both_sides(sequence, "HomeTeamId", "AwayTeamId", "TeamId").distinct()
    return with_start(teams, base, default_start)


def with_start(teams: DataFrame, base: DataFrame | None, default_start: float | None) -> DataFrame:
    """Add the start rating of each team (TeamId) as Elo."""
    if base is None:
        return teams.withColumn("Elo", F.lit(default_start).cast("double"))
    state = teams.join(base.select("TeamId", F.col("Elo").cast("double")), "TeamId", "left")
    return state if default_start is None else state.fillna(default_start, "Elo")


def state_after(state: DataFrame, rated: DataFrame) -> DataFrame:
    """The state after the contests of ``rated``; only teams that took part change."""
    latest = latest_ratings(_long(rated, ("MatchSequence",)))
    return state.join(latest, "TeamId", "left").select("TeamId", F.coalesce("EloAfter", "Elo").alias("Elo"))


def _stage_rows(slice_rows: int | None, teams: int) -> int:
    """Contests that one stage rates. Slices of a stated size are rated several at once, as whole
    slices, while together they hold no more contests than fall into small groups; so the
    stages grow with the contests per team, not with all contests."""
    small = max(min(teams // TEAMS_PER_CONTEST, LEAST_ROWS), 1)
    if slice_rows is None:
        return max(small, LEAST_ROWS)
    return slice_rows * max(small // slice_rows, 1)


def rate_from(
    sequence: DataFrame,
    state: DataFrame,
    *,
    k: float = K_FACTOR,
    scale: float = SCALE,
    slice_rows: int | None = None,
    by: str = "groups",
) -> tuple[DataFrame, DataFrame]:
    """Rate contests from a stored state (TeamId, Elo): the rated contests and the state after them.

    ``sequence`` may begin anywhere, as long as the state is that before its first contest.
    """
    rows = _stage_rows(slice_rows, state.count())
    rated = {"groups": _rate_groups, "waves": _rate_slices}[by](sequence, state, rows, k, scale)
    return rated, state_after(state, rated)


def with_changes(rated: DataFrame) -> DataFrame:
    """Add what either side has won or lost."""
    return rated.withColumns(
        {f"{s}EloChange": F.col(f"{s}EloAfter") - F.col(f"{s}EloBefore") for s in ("Home", "Away")}
    )


def rate(
    sequence: DataFrame,
    base: DataFrame | None = None,
    *,
    k: float = K_FACTOR,
    scale: float = SCALE,
    default_start: float | None = None,
    slice_rows: int | None = None,
    by: str = "groups",
) -> DataFrame:
    """Rate all contests in sequence; one row per contest, not rounded.

    ``sequence`` needs MatchSequence (unique, from 1), HomeTeamId, AwayTeamId and
    Result; other columns pass through. ``base`` holds (TeamId, Elo); teams without
    a start rating get ``default_start``, or NaN, which then spreads, if that is None
    too. ``slice_rows`` sets the contests of a slice, ``by`` how one is rated; the
    ratings depend on neither.
    """
    state = materialize(start_state(sequence, base, default_start), "state")
    rated, _ = rate_from(sequence, state, k=k, scale=scale, slice_rows=slice_rows, by=by)
    return with_changes(rated)


# ---- shapes of the result ----------------------------------------------------------------


def _long(rated: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Two rows per contest, one per team, from a single scan."""

    def side(me: str, other: str):
        return F.struct(
            F.col(f"{me}TeamId").alias("TeamId"),
            F.col(f"{other}TeamId").alias("OpponentId"),
            F.col(f"{me}EloBefore").alias("EloBefore"),
            F.col(f"{me}EloAfter").alias("EloAfter"),
            (F.col(f"{me}EloAfter") - F.col(f"{me}EloBefore")).alias("EloChange"),
        )

    sides = F.explode(F.array(side("Home", "Away"), side("Away", "Home")))
    return rated.select(*carry, sides.alias("_side")).select(*carry, "_side.*")


def rounded(df: DataFrame, columns: tuple[str, ...], digits: int | None) -> DataFrame:
    if digits is None:
        return df
    return df.withColumns({c: F.round(c, digits) for c in columns})


def fact_ratings(rated: DataFrame, digits: int | None = 2) -> DataFrame:
    """Rating table from rated contests: one row per contest and team, before / after / change."""
    carry = ("MatchKey", "MatchSequence", "CompetitionId", "SeasonId", "RoundOrder", "Date")
    return rounded(_long(rated, carry), ("EloBefore", "EloAfter", "EloChange"), digits)


def elo(sequence: DataFrame, base: DataFrame, k: float = K_FACTOR, default_start: float | None = None) -> DataFrame:
    """Unrounded ratings with a chosen K: seven columns, two rows per contest."""
    return _long(rate(sequence, base, k=k, default_start=default_start), ("MatchKey", "MatchSequence"))


def flat_start(sequence: DataFrame, start: float = 1500.0, digits: int | None = 1, k: float = K_FACTOR) -> DataFrame:
    """Every team starts alike; one row per contest with both sides' ratings."""
    rated = rate(sequence, k=k, default_start=start)
    columns = tuple(f"{s}Elo{part}" for s in ("Home", "Away") for part in ("Before", "After", "Change"))
    return rounded(rated, columns, digits)


# ---- reading ratings ---------------------------------------------------------------------


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """Each team's rating after its last contest; combined before the shuffle."""
    return ratings.groupBy("TeamId").agg(F.max_by("EloAfter", "MatchSequence").alias("EloAfter"))


def rating_snapshot(ratings: DataFrame, digits: int = 2) -> DataFrame:
    """Current ratings, best first."""
    return (
        latest_ratings(ratings)
        .select("TeamId", F.round("EloAfter", digits).alias("CurrentElo"))
        .orderBy(F.desc("CurrentElo"), "TeamId")
    )


def rating_progression(ratings: DataFrame, team_id: int) -> DataFrame:
    """One team's ratings in sequence."""
    return (
        ratings.filter(F.col("TeamId") == team_id)
        .select("MatchSequence", "EloAfter")
        .orderBy("MatchSequence")
    )


def season_ratings(ratings: DataFrame, season_id: int | None = None) -> DataFrame:
    """First and last rating per team, competition and season, in round order.

    Smallest and largest (RoundOrder, MatchSequence): contests without a known
    round come first, as nulls do in a window order.
    """
    if season_id is not None:
        ratings = ratings.filter(F.col("SeasonId") == season_id)
    order = F.struct("RoundOrder", "MatchSequence")
    return ratings.groupBy("TeamId", "CompetitionId", "SeasonId").agg(
        F.min_by("EloBefore", order).alias("StartingElo"),
        F.max_by("EloAfter", order).alias("EndingElo"),
    )


def zero_sum_totals(ratings: DataFrame) -> DataFrame:
    """Rating points won and lost per contest; should be 0."""
    return ratings.groupBy("MatchKey").agg(F.round(F.sum("EloChange"), 6).alias("TotalEloChange"))


def zero_sum_breaks(ratings: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    return zero_sum_totals(ratings).filter(F.abs("TotalEloChange") > tolerance)


def _blocks(ratings: DataFrame, block_rows: int) -> DataFrame:
    """Cut every team's timeline at multiples of ``block_rows`` sequence numbers.

    A team has at most one contest per sequence number, so a (team, block) window
    never holds more than ``block_rows`` rows, whichever team is hot.
    """
    return ratings.withColumn("_block", F.floor(F.col("MatchSequence") / block_rows))


def next_ratings(ratings: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Add NextEloBefore, the team's rating before its following contest.

    ``lead`` runs inside the blocks; the last row of a block takes the first row of
    the team's next block, from a table of one row per team and block.
    """
    cut = _blocks(ratings, block_rows)
    heads = cut.groupBy("TeamId", "_block").agg(F.min_by("EloBefore", "MatchSequence").alias("_head"))
    following = F.lead("_head").over(Window.partitionBy("TeamId").orderBy("_block"))
    heads = heads.select("TeamId", "_block", following.alias("_following"))
    inside = F.lead("EloBefore").over(Window.partitionBy("TeamId", "_block").orderBy("MatchSequence"))
    return (
        cut.withColumn("_inside", inside)
        .join(heads, ["TeamId", "_block"])
        .withColumn("NextEloBefore", F.coalesce("_inside", "_following"))
        .drop("_inside", "_following", "_block")
    )


def continuity_gaps(ratings: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Difference between a rating and the same team's next starting point."""
    gap = F.abs(F.col("EloAfter") - F.col("NextEloBefore"))
    return next_ratings(ratings, block_rows).withColumn("Break", gap)


def continuity_breaks(ratings: DataFrame, tolerance: float = 1e-4, block_rows: int = 1_000_000) -> DataFrame:
    return continuity_gaps(ratings, block_rows).filter(F.col("Break") > tolerance)


def rating_history(ratings: DataFrame, block_rows: int = 1_000_000) -> DataFrame:
    """Each team's ratings as numbered entries 1, 2, 3, ... of its history."""
    cut = _blocks(ratings, block_rows)
    counts = cut.groupBy("TeamId", "_block").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("TeamId").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "TeamId", "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("TeamId", "_block").orderBy("MatchSequence"))
    return (
        cut.withColumn("_place", place)
        .join(offsets, ["TeamId", "_block"])
        .select("TeamId", (F.col("_offset") + F.col("_place")).alias("Entry"), "MatchSequence", "EloAfter")
    )


def rating_history_lists(history: DataFrame, list_rows: int = 10_000) -> DataFrame:
    """History as arrays of at most ``list_rows`` entries each (List = 0, 1, 2, ...)."""
    entries = history.withColumn("List", F.floor((F.col("Entry") - 1) / list_rows))
    return entries.groupBy("TeamId", "List").agg(
        F.sort_array(F.collect_list(F.struct("Entry", "EloAfter")))["EloAfter"].alias("History")
    )
