"""Repair of conversations by a lightest derivation.

A conversation is legal if the initials of its roles spell ``(s?(ua)+)?``. Its rows are
kept (free), get another role (2), are deleted (3), or rows of empty text are put in
(2); blank rows and repeats must go, and a truncated row that stays costs 1. The repair
is the lightest derivation of a weighted deduction system, found by Knuth's agenda:

* axioms: ``row(i, r)``, row i stays or becomes role r, or goes; ``new(r)``, an inserted row;
* ``prefix(i, q), row(i, r) -> prefix(i + 1, q·r)`` and ``prefix(i, q), new(r) -> prefix(i, q·r)``;
* ``prefix(n, q) -> goal`` for the accepting q.

A weight is (cost, audit), the audit being the initials of the edits so far; costs add up and
audits are appended. Items leave the agenda by weight, each once, and the derivation
ends when the goal leaves it. That is right as the functions are superior (no result is
lighter than what it is made of) and monotone: two audits of one item with equal cost
are never the beginning of each other, as what one has more would be insertions, which cost.

Rows are sorted by conversation and turn in Spark and stream through the tasks as one
letter each. A conversation of more than ``CHUNK`` rows is derived chunk by chunk, for every
state it can be in where a chunk begins; the chunks' spans are joined by the same
superior functions as they come. So a task holds one chunk of rows and the audit. The
repaired rows come from a second pass that reads each audit before its rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from contestry.llm.columns import only
from contestry.session import materialize

CHUNK = 256
#: derivations that a Python worker remembers, of chunks of equal letters
REMEMBERED = 1 << 14
SPACED = "[^\\x20\\x09-\\x0D]"

#: state after the role's initial, by state: 0 nothing yet, s, u, a
_NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
_STATES, _ACCEPTING = "0sua", "0a"
_ROLES = {"u": "user", "a": "assistant"}

Weight = tuple[int, str]


def _row_axioms(letter: str) -> Iterator[tuple[str, int, str]]:
    """(edit, cost, initial of the role it gives, or none) of a row.

    ``x`` must go; s, u and a are the initial of a role, o any other one; a capital is a truncated row.
    """
    yield "D", 3, ""
    if letter != "x":
        own, extra = letter.lower(), int(letter.isupper())
        if own != "o":
            yield "K", extra, own
        for role in _ROLES:
            if role != own:
                yield "R", 2 + extra, role


@lru_cache(REMEMBERED)
def lightest(letters: str, start: str, whole: bool) -> dict[str, Weight]:
    """The lightest weight of every state after the rows, or of the goal alone (``whole``)."""
    n = len(letters)
    agenda: list[tuple[int, str, int, str, str]] = [(0, "", 0, "prefix", start)]
    agenda += [(2, "I", -1, "new", role) for role in _ROLES]
    agenda += [(cost, edit, i, "row", role) for i, x in enumerate(letters) for edit, cost, role in _row_axioms(x)]
    heapq.heapify(agenda)
    prefixes: list[dict[str, Weight]] = [{} for _ in range(n + 1)]
    rows: list[list[tuple[int, str, str]]] = [[] for _ in range(n)]
    new: list[str] = []

    def derive(i: int, state: str, weight: Weight, step: int, cost: int, edit: str, role: str) -> None:
        after = _NEXT.get((state, role)) if role else state
        if after and after not in prefixes[i + step]:
            heapq.heappush(agenda, (weight[0] + cost, weight[1] + edit, i + step, "prefix", after))

    while agenda:
        cost, audit, i, kind, x = heapq.heappop(agenda)
        if kind == "goal":
            return {"goal": (cost, audit)}
        if kind == "row":
            rows[i].append((cost, audit, x))
            for state, weight in prefixes[i].items():
                derive(i, state, weight, 1, cost, audit, x)
        elif kind == "new":
            new.append(x)
            for j, known in enumerate(prefixes):
                for state, weight in list(known.items()):
                    derive(j, state, weight, 0, cost, audit, x)
        elif x not in prefixes[i]:
            weight = prefixes[i][x] = (cost, audit)
            for row_cost, edit, role in rows[i] if i < n else ():
                derive(i, x, weight, 1, row_cost, edit, role)
            for role in new:
                derive(i, x, weight, 0, 2, "I", role)
            if whole and i == n and x in _ACCEPTING:
                heapq.heappush(agenda, (cost, audit, n, "goal", ""))
            if not whole and i == n and len(prefixes[n]) == (4 if start == "0" else 3 if start == "s" else 2):
                break
    return prefixes[n]


class _Chain:
    """An audit as its last piece and the chain before it."""

    __slots__ = ("before", "piece")

    def __init__(self, before: _Chain | None, piece: str):
        self.before, self.piece = before, piece

    def text(self, until: _Chain | None = None) -> str:
        pieces, at = [], self
        while at is not until:
            pieces.append(at.piece)
            at = at.before
        return "".join(reversed(pieces))


def _lighter(a: tuple[int, _Chain], b: tuple[int, _Chain]) -> bool:
    """Whether a weighs less than b; both chains have as many pieces, and those they share aren't read."""
    if a[0] != b[0]:
        return a[0] < b[0]
    x, y = a[1], b[1]
    while x is not y:
        x, y = x.before, y.before
    return a[1].text(x) < b[1].text(x)


class _Derivation:
    """The lightest derivation of one conversation, whose rows come one by one."""

    def __init__(self, chunk: int):
        self.chunk = chunk
        self.letters: list[str] = []
        self.spans: dict[str, tuple[int, _Chain | None]] = {"0": (0, None)}

    def add(self, letter: str) -> None:
        if len(self.letters) == self.chunk:
            self._close()
        self.letters.append(letter)

    def _close(self) -> None:
        joined: dict[str, tuple[int, _Chain]] = {}
        letters = "".join(self.letters)
        for state, (cost, chain) in self.spans.items():
            for after, (more, piece) in lightest(letters, state, False).items():
                both = (cost + more, _Chain(chain, piece))
                if after not in joined or _lighter(both, joined[after]):
                    joined[after] = both
        self.spans, self.letters = joined, []

    def goal(self) -> Weight:
        if self.spans == {"0": (0, None)}:
            return lightest("".join(self.letters), "0", True)["goal"]
        self._close()
        ends = [self.spans[q] for q in _ACCEPTING if q in self.spans]
        best = ends[0]
        for other in ends[1:]:
            best = other if _lighter(other, best) else best
        return best[0], best[1].text()


def _first_of(text: str) -> Column:
    return F.substring(text, 1, 1)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows as a careless export leaves them, by a checksum of ``conv_id:turn``: dropped, emptied,
    without full stops, doubled, or said by the user. Nulls count as one blank."""
    rows = only(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return (
        rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"))
        .filter("fate <> 0")
        .select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("n"))
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number ``n``, and what is wrong with the first of them.

    A row repeats an earlier one if its conversation has its role and text at a smaller
    turn (nulls first); the smallest turn is an aggregate, so a row that is repeated very
    often is no hot spot.
    """
    equal = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = equal.groupBy("conv_id", "role", "text").agg(F.min(place).alias("_first")).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text"), F.col("_first.turn").alias("_turn")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (
        F.when(~F.col("text").rlike(SPACED), "blank")
        .when(~F.col("turn").eqNullSafe(F.col("_turn")), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
        .otherwise("")
    )
    return equal.join(first, same).select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Each conversation's rows in order in one task, which reads them one after another."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def audits(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``turns`` has conv_id, turn, role, text and n, how often a row stands there. Rows go by
    turn, nulls first, then by role and text. A role without characters, as any that
    begins neither with s, u nor a, can't be kept.
    """
    judged = _in_order(_judged(turns), "turn", "role", "text")
    letters = judged.select("conv_id", "turn", _first_of("role").alias("initial"), "n", "fault")
    kind = to_arrow_type(letters.schema["conv_id"].dataType)
    schema = pa.schema([("conv_id", kind), *((c, pa.int64()) for c in (*_COUNTS, "cost")), ("audit", pa.string())])

    def derived(rows):
        for conv, own in groupby(rows, key=lambda r: (r[0],)):
            derivation, count = _Derivation(chunk), dict.fromkeys(("blank", "duplicate", "truncated", ""), 0)
            illegal, distinct, least, most, before = 0, 0, None, None, None
            for _, turn, initial, n, fault in own:
                letter = "x" if fault in ("blank", "duplicate") else initial if initial and initial in "sua" else "o"
                derivation.add(letter.upper() if fault == "truncated" else letter)
                count[fault] += 1
                if before is not None and before + initial not in ("su", "ua", "au"):
                    illegal += 1
                for _ in range(n - 1):
                    derivation.add("x")
                count["blank" if fault == "blank" else "duplicate"] += n - 1
                illegal += n - 1  # equal initials side by side
                before = initial
                if turn is not None and turn != most:
                    least, most, distinct = turn if least is None else least, turn, distinct + 1
            gaps = 0 if least is None else most - least + 1 - distinct
            yield (*conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, *derivation.goal())

    types = f"conv_id {dict(letters.dtypes)['conv_id']}, " + "".join(f"{c} bigint, " for c in (*_COUNTS, "cost")) + "audit string"
    return letters.mapInArrow(lambda batches: _batches(derived(_rows(batches)), schema), types)


def _applied(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired rows; each conversation's audit comes before its rows."""
    for conv, own in groupby(rows, key=lambda r: (r[0],)):
        edits, at, state = next(own)[4], 0, "0"

        def said(role: str) -> tuple:
            return (*conv, _ROLES[role], "")

        def inserted():
            nonlocal at, state
            while at < len(edits) and edits[at] == "I":
                at, state = at + 1, "a" if state == "u" else "u"
                yield said(state)

        for _, role, text, n, _, _ in own:
            for _ in range(n):
                yield from inserted()
                edit, at = edits[at], at + 1
                if edit == "K":
                    state = role[:1]
                    yield (*conv, role, text)
                elif edit == "R":
                    state = "a" if state == "u" else "u"
                    yield (*conv, _ROLES[state], text)
        yield from inserted()


def _with_rows(found: DataFrame, turns: DataFrame) -> DataFrame:
    """Each audit and after it the rows it is about, in order."""
    equal = turns.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    nothing = F.lit(None)
    heads = found.select("conv_id", nothing.cast("string").alias("role"), nothing.cast("string").alias("text"), F.lit(0).cast("long").alias("n"), "audit", F.lit(0).alias("kind"), nothing.cast(dict(turns.dtypes)["turn"]).alias("turn"))
    rows = equal.select("conv_id", "role", "text", "n", nothing.cast("string").alias("audit"), F.lit(1).alias("kind"), "turn")
    both = _in_order(heads.unionByName(rows), "kind", "turn", "role", "text")
    return both.select("conv_id", "role", "text", "n", "audit", "kind")


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the rows of the repaired conversations, places from 0.

    Conversations from which all rows go have none. ``turns`` as for ``audits``.
    """
    both = _with_rows(audits(turns), turns)
    schema = pa.schema([("conv_id", to_arrow_type(both.schema["conv_id"].dataType)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def placed(rows):
        for _, own in groupby(_applied(rows), key=lambda r: (r[0],)):
            for place, (conv, role, text) in enumerate(own):
                yield conv, place, role, text

    types = f"conv_id {dict(both.dtypes)['conv_id']}, place bigint, role string, text string"
    return both.mapInArrow(lambda batches: _batches(placed(_rows(batches)), schema), types)


def _digests(found: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the repaired ``role:text``, joined by newlines."""
    both = _with_rows(found, turns)
    schema = pa.schema([("conv_id", to_arrow_type(both.schema["conv_id"].dataType)), ("repaired_sha256", pa.string())])

    def hashed(rows):
        for (conv,), own in groupby(_applied(rows), key=lambda r: (r[0],)):
            digest, gap = hashlib.sha256(), ""
            for _, role, text in own:
                digest.update(f"{gap}{role}:{text}".encode())
                gap = "\n"
            yield conv, digest.hexdigest()

    types = f"conv_id {dict(both.dtypes)['conv_id']}, repaired_sha256 string"
    return both.mapInArrow(lambda batches: _batches(hashed(_rows(batches)), schema), types)


def repair_report(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row for every conv_id of the table, the null one included, after its rows were
    damaged: faults, cost and audit of the repair, and a hash of what it gives.

    Conversations that lose all rows, to the damage or to the repair, hash the empty text.
    """
    turns = materialize(damaged(conversations), "damaged-turns")
    found = materialize(audits(turns, chunk), "audits")
    digests = _digests(found, turns).withColumnRenamed("conv_id", "_hashed")
    known = found.withColumnRenamed("conv_id", "_conv")
    every = only(conversations, conv_id="conv_id").distinct()
    rows = every.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("_hashed")), "left"
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.select(
        "conv_id",
        *map(zero, (*_COUNTS, "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


REPAIR_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(k) + 1), lambda i: ord(substr(k, i, 1))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
    4294967295) % 20 AS fate FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hashed WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM damaged
), sighted AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed
), judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN last = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM sighted
), counted AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), inserts(state, via, cost, piece) AS (
  VALUES ('0', '0', 0, ''), ('0', 'u', 2, 'I'), ('0', 'a', 4, 'II'), ('s', 's', 0, ''), ('s', 'u', 2, 'I'), ('s', 'a', 4, 'II'),
    ('u', 'u', 0, ''), ('u', 'a', 2, 'I'), ('a', 'a', 0, ''), ('a', 'u', 2, 'I')
), steps(via, said, state) AS (
  VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), edits AS (
  SELECT conv_id, i, via, via AS state, 3 AS cost, 'D' AS edit FROM judged CROSS JOIN (SELECT DISTINCT via FROM inserts)
  UNION ALL
  SELECT conv_id, i, via, state, CASE WHEN said = initial THEN 0 ELSE 2 END + (fault = 'truncated')::INTEGER,
    CASE WHEN said = initial THEN 'K' ELSE 'R' END
  FROM judged JOIN steps ON fault NOT IN ('blank', 'duplicate') AND (said = initial OR said <> 's')
), best(conv_id, i, state, cost, audit) AS (
  SELECT conv_id, 0::BIGINT, '0', 0, '' FROM counted
  UNION ALL
  SELECT conv_id, i, state, cost, audit FROM (
    SELECT b.conv_id, e.i, e.state, b.cost + s.cost + e.cost AS cost, b.audit || s.piece || e.edit AS audit,
      row_number() OVER (PARTITION BY b.conv_id, e.state ORDER BY b.cost + s.cost + e.cost, b.audit || s.piece || e.edit) AS place
    FROM best b JOIN inserts s ON s.state = b.state
    JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.via = s.via)
  WHERE place = 1
), goals AS (
  SELECT conv_id, cost, audit FROM (
    SELECT b.conv_id, b.cost + s.cost AS cost, b.audit || s.piece AS audit,
      row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + s.cost, b.audit || s.piece) AS place
    FROM best b JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i
    JOIN inserts s ON s.state = b.state AND s.via IN ('0', 'a'))
  WHERE place = 1
), letters AS (
  SELECT conv_id, p, substr(audit, p, 1) AS edit FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM goals)
), numbered AS (
  SELECT *, sum((edit <> 'I')::INTEGER) OVER (PARTITION BY conv_id ORDER BY p) AS i,
    sum((edit <> 'D')::INTEGER) OVER (PARTITION BY conv_id ORDER BY p) AS place FROM letters
), written AS (
  SELECT l.conv_id, l.p, l.place, l.edit, j.role, CASE WHEN l.edit = 'I' THEN '' ELSE j.text END AS text,
    first_value(CASE WHEN l.edit = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id ORDER BY l.p) AS led
  FROM numbered l LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.i = l.i WHERE l.edit <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p) AS said
  FROM written GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN goals g ON g.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""
