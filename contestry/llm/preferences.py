"""Preference formatting: one prompt and two masked completions for each pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.llm.columns import only
from contestry.operators.keys import numbered
from contestry.session import materialize

TRAINED_ROLE = "assistant"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): the turns of each conversation in order.

    Turns that share a number go by role and text; a row that repeats a turn
    exactly counts once. A null role or text is empty, a null number comes first.
    Rows without a conversation are left out. A conversation is one output row in
    any case, so gathering its turns takes no more than the result does.
    """
    rows = only(turns, key=key, turn="turn", role="role", text="text").filter("key IS NOT NULL")
    empty = F.lit("")
    one = F.struct("turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    return rows.groupBy("key").agg(F.array_sort(F.collect_set(one)).alias("turns"))


def _said(turn: Column) -> Column:
    """What a turn says, without its number."""
    return F.struct(turn["role"], turn["text"])


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _mask(turns: Column) -> Column:
    """(start, end) in characters of what is trained on: what the trained role says,
    with the mark that ends it."""
    at = F.aggregate(
        turns,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(_rendered(t))).alias("at"),
            F.when(
                t["role"] == TRAINED_ROLE,
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct(
                            (s["at"] + F.length(t["role"]) + 5).cast("long").alias("start"),
                            (s["at"] + F.length(_rendered(t)) - 1).cast("long").alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
    )
    return at["spans"]


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns two conversations share from the start."""
    shorter = F.least(F.size(chosen), F.size(rejected))
    alike = F.zip_with(
        F.slice(chosen, F.lit(1), shorter),
        F.slice(rejected, F.lit(1), shorter),
        lambda a, b: _said(a) == _said(b),
    )
    return F.coalesce(F.nullif(F.array_position(alike, False), F.lit(0)) - 1, shorter.cast("long"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask).

    ``pairs`` has pair_id and the turns of the chosen and the rejected conversation
    (see ``conversations``). The longest common prefix of turns is rendered once,
    as the prompt; what follows it is the completions, each with the character
    spans to train on. A pair of equal conversations has two empty completions. Where
    ``rejected`` is null, the whole of ``chosen`` is the prompt and the completions and masks are null.
    """
    n_common = F.coalesce(common_turns(F.col("chosen"), F.col("rejected")), F.size("chosen").cast("long"))
    paired = F.col("rejected").isNotNull()
    counted = pairs.select("pair_id", "chosen", "rejected", n_common.alias("n_common"))
    rest = lambda c: F.slice(F.col(c), F.col("n_common").cast("int") + 1, F.greatest(F.size(c), F.lit(1)))
    prefix = F.slice(F.col("chosen"), F.lit(1), F.col("n_common").cast("int"))
    cut = counted.select(
        "pair_id", "n_common", prefix.alias("prefix"), F.when(paired, rest("chosen")).alias("c"), rest("rejected").alias("r")
    )
    return cut.select(
        "pair_id",
        "n_common",
        _text(F.col("prefix")).alias("prompt"),
        _text(F.col("c")).alias("chosen"),
        _text(F.col("r")).alias("rejected"),
        _mask(F.col("c")).alias("chosen_mask"),
        _mask(F.col("r")).alias("rejected_mask"),
    )


def branched(turns: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected): each conversation beside a branch that goes on otherwise.

    The conversations with a reply are numbered 0, 1, 2, ... by id, whatever their ids
    are. Number i branches at its own reply i modulo its replies: the branch has what
    comes before, then what the next number (0 after the last) has from its reply of
    the same place, or its last one, to its end. As that may begin like the original, where the two
    part is left to ``common_turns``. Nothing is cut: turns after the last reply are in both
    sides. Without a reply there is no branch, ``rejected`` is null.
    """
    places = F.filter(
        F.transform("turns", lambda t, i: F.when(t["role"] == TRAINED_ROLE, i)), lambda i: i.isNotNull()
    )
    whole = materialize(conversations(turns).select("key", "turns", places.alias("replies")), "conversations")
    placed = numbered(whole.filter(F.size("replies") > 0).select("key"), "number", ["key"], unique=True)
    placed = materialize(placed.withColumn("number", F.col("number") - 1), "replied")
    replied = placed.count()
    if not replied:
        return whole.select(F.col("key").alias("pair_id"), F.col("turns").alias("chosen"), F.lit(None).cast(_TURNS).alias("rejected"))
    own = whole.join(placed, "key", "left")
    others = whole.join(placed, "key").select(
        F.pmod(F.col("number") - 1, F.lit(replied)).alias("number"),
        F.col("turns").alias("other"),
        F.col("replies").alias("other_replies"),
    )
    at = F.pmod("number", F.size("replies")).cast("int")
    other_at = F.least(at, F.size("other_replies") - 1)
    branch = F.concat(
        F.slice("turns", F.lit(1), F.get("replies", at)),
        F.slice("other", F.get("other_replies", other_at) + 1, F.size("other")),
    )
    return own.join(others, "number", "left").select(
        F.col("key").alias("pair_id"), F.col("turns").alias("chosen"), branch.alias("rejected")
    )


def preference_report(turns: DataFrame) -> DataFrame:
    """The pairs of ``branched``, with the masks as text (start-end, comma-joined)."""
    pairs = format_pairs(branched(turns))
    spans = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ","
    )
    return pairs.select(
        F.col("pair_id").alias("conv_id"),
        "n_common",
        "prompt",
        "chosen",
        "rejected",
        spans("chosen_mask").alias("chosen_mask"),
        spans("rejected_mask").alias("rejected_mask"),
    )


#: the same in SQL for a table without null numbers
PREFERENCE_SQL = r"""
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS place
  FROM (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL)
), replies AS (
  SELECT conv_id, place, row_number() OVER (PARTITION BY conv_id ORDER BY place) - 1 AS reply,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns WHERE role = 'assistant'
), numbers AS (
  SELECT conv_id, n, row_number() OVER (ORDER BY conv_id) - 1 AS number, count(*) OVER () AS replied
  FROM (SELECT DISTINCT conv_id, n FROM replies)
), branches AS (
  SELECT a.conv_id, own.place AS own_place, b.conv_id AS other, theirs.place AS other_place
  FROM numbers a JOIN numbers b ON b.number = (a.number + 1) % a.replied
  JOIN replies own ON own.conv_id = a.conv_id AND own.reply = a.number % a.n
  JOIN replies theirs ON theirs.conv_id = b.conv_id AND theirs.reply = least(a.number % a.n, b.n - 1)
), rejected AS (
  SELECT b.conv_id, t.place, t.role, t.text FROM branches b JOIN turns t ON t.conv_id = b.conv_id AND t.place < b.own_place
  UNION ALL
  SELECT b.conv_id, b.own_place + t.place - b.other_place, t.role, t.text
  FROM branches b JOIN turns t ON t.conv_id = b.other AND t.place >= b.other_place
), sizes AS (
  SELECT t.conv_id, count(*) AS n, (SELECT count(*) FROM rejected r WHERE r.conv_id = t.conv_id) AS m FROM turns t GROUP BY t.conv_id
), differ AS (
  SELECT s.conv_id, s.m > 0 AS paired, CASE WHEN s.m = 0 THEN s.n ELSE coalesce(
    (SELECT min(c.place) FROM turns c JOIN rejected r ON r.conv_id = c.conv_id AND r.place = c.place
      WHERE c.conv_id = s.conv_id AND (c.role <> r.role OR c.text <> r.text)), least(s.n, s.m)) END AS n_common
  FROM sizes s
), sides AS (
  SELECT 'c' AS side, conv_id, place, role, text FROM turns
  UNION ALL
  SELECT 'r', conv_id, place, role, text FROM rejected
), shown AS (
  SELECT s.*, d.n_common, '<|' || s.role || '|>' || chr(10) || s.text || '<|end|>' || chr(10) AS shown,
    sum(CASE WHEN s.place >= d.n_common THEN length(s.role) + length(s.text) + 13 END)
      OVER (PARTITION BY s.side, s.conv_id ORDER BY s.place) AS upto
  FROM sides s JOIN differ d ON d.conv_id = s.conv_id
), texts AS (
  SELECT conv_id, side, coalesce(string_agg(CASE WHEN place < n_common THEN shown END, '' ORDER BY place), '') AS prompt,
    coalesce(string_agg(CASE WHEN place >= n_common THEN shown END, '' ORDER BY place), '') AS rest,
    coalesce(string_agg(CASE WHEN place >= n_common AND role = 'assistant'
      THEN (upto - length(text) - 8)::BIGINT::VARCHAR || '-' || (upto - 1)::BIGINT::VARCHAR END, ',' ORDER BY place), '') AS mask
  FROM shown GROUP BY conv_id, side
)
SELECT d.conv_id, d.n_common, c.prompt, CASE WHEN d.paired THEN c.rest END AS chosen, r.rest AS rejected,
  CASE WHEN d.paired THEN c.mask END AS chosen_mask, r.mask AS rejected_mask
FROM differ d JOIN texts c ON c.conv_id = d.conv_id AND c.side = 'c'
LEFT JOIN texts r ON r.conv_id = d.conv_id AND r.side = 'r'
"""
