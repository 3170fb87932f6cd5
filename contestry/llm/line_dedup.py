"""Removal of lines that repeat across documents.

Lines are normalised (ASCII white space stripped at both ends, A-Z in lower case) and
hashed; the documents of each hash are counted; lines whose hash more than
``max_docs`` documents hold go, except in the document with the smallest id; the
others are put together again by position.

A document counts once for a line: its repeats are dropped before the explode, so
the counts are sums combined before the shuffle, and a line of a third of all
documents is one row for each task. The join that brings the counts back has
shuffles on both sides, so adaptive execution splits such a line there. A hash is 128
bits, of two seeds. No document is held beyond its own row.

Null and empty texts are one empty line. A null id counts as the largest. Rows that
share an id are documents of their own in the counts, and all of them keep a line
of which this id is the smallest. Columns other than ``doc_id`` and ``text`` pass as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.llm.columns import lower_ascii, only, whole_text
from contestry.session import materialize

#: keys of fewer characters stay wherever they are
LEAST_CHARS = 10
#: a key in more documents loses its lines
MAX_DOCS = 1
_WHITE = " \t\n\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    return F.split(whole_text(text), "\n", -1)


def keys_of(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(lines_of(lower_ascii(whole_text(text))), lambda line: F.btrim(line, F.lit(_WHITE)))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def line_counts(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, n_docs, first_doc) of every key that is long enough."""
    rows = only(docs, doc_id="doc_id", text="text")
    own = F.array_distinct(F.filter(keys_of(F.col("text")), lambda k: F.char_length(k) >= least_chars))
    held = rows.select("doc_id", F.explode(own).alias("key")).select("doc_id", *_hashes("key"))
    return held.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


def repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, max_docs: int = MAX_DOCS) -> DataFrame:
    """(doc_id, text_hash, pos) of every line that goes; positions count from 0."""
    shared = materialize(line_counts(docs, least_chars).filter(F.col("n_docs") > max_docs).drop("n_docs"), "shared-lines")
    # hashed before the explode, or each line would hash the whole text again
    rows = only(docs, doc_id="doc_id", text="text").withColumn("text_hash", F.xxhash64("text"))
    lines = rows.select("doc_id", "text_hash", F.posexplode(keys_of(F.col("text"))).alias("pos", "key"))
    long = lines.filter(F.char_length("key") >= least_chars).select("doc_id", "text_hash", "pos", *_hashes("key"))
    return (
        long.join(shared, ["h1", "h2"])
        .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .select("doc_id", "text_hash", "pos")
    )


def _kept(lines: Column, gone: Column) -> Column:
    """The lines at other positions, in order, in time linear in the text: the outer
    ``transform`` splits it once, and each line that stays is looked up by its place."""

    def left(own: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(1), F.size(own)), F.transform(gone, lambda p: p + 1))
        return F.concat_ws("\n", F.transform(places, lambda p: F.element_at(own, p)))

    return F.element_at(F.transform(F.array(lines), left), 1)


def drop_repeated_lines(
    docs: DataFrame, least_chars: int = LEAST_CHARS, max_docs: int = MAX_DOCS, n_lines: str = "n_lines", n_dropped: str = "n_dropped"
) -> DataFrame:
    """All rows with the lines that stay as ``text``, the number of lines before and of those that went."""
    gone = (
        repeated_lines(docs, least_chars, max_docs)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("pos").alias("_lines_gone"))
        .select(F.col("doc_id").alias("_lines_id"), F.col("text_hash").alias("_lines_text"), "_lines_gone")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_lines_id")) & (F.xxhash64("text") == F.col("_lines_text"))
    lines = lines_of(F.col("text"))
    nothing = F.col("_lines_gone").isNull()
    found = docs.join(gone, same, "left").withColumns(
        {
            n_lines: F.size(lines).cast("long"),
            n_dropped: F.when(nothing, 0).otherwise(F.size("_lines_gone")).cast("long"),
            "_lines_kept": F.when(nothing, whole_text("text")).otherwise(_kept(lines, F.col("_lines_gone"))),
        }
    )
    return found.withColumn("text", F.col("_lines_kept")).drop("_lines_kept", "_lines_id", "_lines_text", "_lines_gone")


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""
    kept = drop_repeated_lines(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


LINE_SQL = r"""
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, pos, lines[pos] AS line,
    translate(trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM texts)
), shared AS (
  SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT l.*, coalesce(l.doc_id <> s.first_doc, false) AS gone FROM lines l LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
