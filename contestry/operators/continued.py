"""Ratings that continue where the last run stopped.

A store keeps, for each run, the rated contests it has added, the teams' ratings after
them (the state at the run's mark, its last sequence number) and two fingerprints: of
all contests up to the mark, and of the start ratings of the teams that had played by
then. A new run takes the last mark whose fingerprints still hold for the sequence as
it is now, and rates only what comes after it. A contest that turns up late, goes
or changes before a mark changes the fingerprint of this mark and of all later ones, so the
run starts again from the state before it; what was rated beyond that state is dropped.

Fingerprints are sums over rows, taken for all marks in one pass with map-side sums.
A run writes its data first and the list of its parts last, as a new version of a small
table; a run that fails leaves the version before it in force.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestry.operators import rating
from contestry.operators.star import both_sides
from contestry.session import materialize

_PARTS = (
    "mark long, contests decimal(38,0), starts decimal(38,0), first long, rated string, state string"
)


@dataclass(frozen=True)
class Run:
    """What a run did: the mark it went on from (0: from the start), its own mark, and contests it rated."""

    restarted_at: int
    mark: int
    rated: int


def _sum_of_hashes(when: Column, *columns: str) -> Column:
    return F.coalesce(F.sum(F.when(when, F.xxhash64(*columns).cast("decimal(20,0)"))), F.lit(0)).cast("decimal(38,0)")


class RatingStore:
    """Rated contests and states in a folder that all executors reach.

    ``options`` (``k``, ``scale``, ``slice_rows``, ``by``) go to ``rating.rate_from``; those
    that change ratings are part of the fingerprint.
    """

    def __init__(self, spark: SparkSession, path: str, default_start: float | None = None, **options):
        self.spark, self.path = spark, path.rstrip("/")
        self._default_start, self._options = default_start, options

    # ---- versions ----

    def _versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        names = [f.getPath() for f in files.listStatus(folder)]
        done = [p for p in names if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()) for p in done)

    def parts(self) -> list:
        """The valid parts, in order of their marks; one row for each run that still counts."""
        versions = self._versions()
        if not versions:
            return []
        stored = self.spark.read.schema(_PARTS).parquet(f"{self.path}/versions/{versions[-1]}")
        return stored.orderBy("mark").collect()

    # ---- reading ----

    def rated(self) -> DataFrame | None:
        """All rated contests with both sides' ratings and changes, or None before the first run."""
        parts = self.parts()
        if not parts:
            return None
        return rating.with_changes(self.spark.read.parquet(*(p.rated for p in parts)))

    def state(self) -> DataFrame | None:
        """(TeamId, Elo) after the last contest, or None before the first run."""
        parts = self.parts()
        return self.spark.read.parquet(parts[-1].state) if parts else None

    # ---- a run ----

    def _fingerprints(self, sequence: DataFrame, starts: DataFrame, marks: list[int]) -> dict[int, tuple]:
        """(contests, starts) for each mark; ``starts`` has each team's first contest, too."""
        options = {k: v for k, v in self._options.items() if k in ("k", "scale")}
        salt = F.lit(repr(sorted(options.items())))
        games = sequence.withColumn("_salt", salt)
        columns = ["_salt", *sorted(sequence.columns)]
        contests = games.agg(*(_sum_of_hashes(F.col("MatchSequence") <= m, *columns).alias(str(m)) for m in marks))
        known = starts.filter("TeamId IS NOT NULL")
        teams = known.agg(*(_sum_of_hashes(F.col("_first") <= m, "TeamId", "Elo").alias(str(m)) for m in marks))
        a, b = contests.first(), teams.first()
        return {m: (a[str(m)], b[str(m)]) for m in marks}

    def run(self, sequence: DataFrame, base: DataFrame | None = None) -> Run:
        """Bring the store up to ``sequence``, which holds all contests, numbered from 1.

        Every column of ``sequence`` counts as part of a contest, so leave out those that
        differ from run to run. An unchanged sequence rates nothing.
        """
        teams = both_sides(sequence, "HomeTeamId", "AwayTeamId", "TeamId", "MatchSequence").groupBy("TeamId")
        first = teams.agg(F.min("MatchSequence").alias("_first"))
        starts = materialize(rating.with_start(first, base, self._default_start), "starts")
        end = sequence.agg(F.max("MatchSequence").alias("end")).first()["end"] or 0
        parts = self.parts()
        found = self._fingerprints(sequence, starts, sorted({*(p.mark for p in parts), end}))
        valid = [p for p in parts if p.mark <= end and found[p.mark] == (p.contests, p.starts)]
        # a part goes on from the one before it, so the first broken mark ends the list
        kept = [p for p, q in zip(parts, valid) if p == q]
        mark = kept[-1].mark if kept else 0
        if mark == end and len(kept) == len(parts):
            return Run(mark, end, 0)
        ahead = sequence.filter(F.col("MatchSequence") > mark)
        state = starts.select("TeamId", "Elo")
        if kept:
            known = self.spark.read.parquet(kept[-1].state).withColumnRenamed("Elo", "_elo")
            state = materialize(
                state.join(known, "TeamId", "left").select("TeamId", F.coalesce("_elo", "Elo").alias("Elo")), "state"
            )
        new = []
        if end > mark:
            rated, _ = rating.rate_from(ahead, state, **self._options)
            folder = f"{self.path}/to-{end}-{uuid.uuid4().hex}"
            rated.write.parquet(f"{folder}/rated")
            # from the stored contests, so that they are put together once
            stored = self.spark.read.schema(rated.schema).parquet(f"{folder}/rated")
            rating.state_after(state, stored).write.parquet(f"{folder}/state")
            new = [(end, *found[end], mark + 1, f"{folder}/rated", f"{folder}/state")]
        version = (self._versions() or [0])[-1] + 1
        listed = self.spark.createDataFrame([*map(tuple, kept), *new], _PARTS)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/{version}")
        return Run(mark, end, end - mark)

