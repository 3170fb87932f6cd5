"""Ranked lexical search with geometrically blocked posting lists.

Two passes. The first reads every whole text and stores, for each document, the counts of
the terms that any query holds, and the sums that the weights need: documents, terms,
documents of each term. The second searches shards of documents. In a shard each
term's posting list is clustered by the similarity of its documents' impact vectors into
blocks; a block stores the coordinatewise maximum of its documents' impacts. The sum of
a summary over a query's terms bounds the score of every document of the block, so a
block is skipped only if this exact bound fails, that is, lies below a score that
``k`` documents are known to reach. Documents of the other blocks are scored in full. All
numbers are 64-bit integers, so bounds and scores are exact.

A shard needs no other one: a term of a third of all documents has a list in each, and
tasks hand on ``k`` documents of each query at most. The first known score comes from
a search of a part of the documents (one in ``FIRST_PART``); it is only a bound, what is
returned is exact.

Queries are taken in passes of ``PASS_TERMS`` terms, the only thing that is sent to all
tasks (8 bytes a term), and inside a shard in groups of ``GROUP_TERMS`` terms, so that
a group's matrix of impacts has ``CELLS`` cells at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contestry.llm import text as tx
from contestry.llm.columns import only
from contestry.session import materialize

K = 50
#: terms of the queries that one pass serves, and that one group inside a shard serves
PASS_TERMS = 1 << 20
GROUP_TERMS = 512
#: documents of a shard times terms of a group
CELLS = 1 << 21
#: documents of a block on average; dimensions in which documents are compared for clustering
BLOCK = 64
SKETCH = 32
#: one in so many documents gives the first bounds
FIRST_PART = 32


def _terms(column: pa.Array) -> Iterator[list[tuple[int, np.ndarray, np.ndarray]]]:
    """For each run of rows: (all terms, distinct term hashes, their counts) of every row."""
    data, offsets = tx.utf8(column)
    for a, b in tx.runs(offsets):
        cuts = offsets[a : b + 1] - offsets[a]
        starts, _, hashes = tx.words(tx.lower(data[offsets[a] : offsets[b]]), cuts, tx.PLAIN)
        ends = np.searchsorted(starts, cuts)
        rows = []
        for i in range(b - a):
            own, counts = np.unique(hashes[ends[i] : ends[i + 1]], return_counts=True)
            rows.append((int(ends[i + 1] - ends[i]), own, counts))
        yield rows


def _queries(items: DataFrame, id_column: str) -> DataFrame:
    """(query, item_id, terms): distinct term hashes of every item that has terms, numbered from 0."""
    rows = only(items, item_id=id_column, text="text")
    kind = dict(rows.dtypes)["item_id"]

    def hashed(batches):
        for batch in batches:
            terms = [own.view(np.int64) for run in _terms(batch.column("text")) for _, own, _ in run]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"]
            )

    found = rows.mapInArrow(hashed, f"item_id {kind}, terms array<bigint>").filter("size(terms) > 0")
    return materialize(found.withColumn("query", F.monotonically_increasing_id()), "queries")


def _passes(queries: DataFrame) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(query numbers, terms of each) of so many queries that they hold ``PASS_TERMS`` terms, or one."""

    def ready():
        order = np.argsort(numbers)
        return np.array(numbers)[order], [terms[i] for i in order]

    numbers, terms, held = [], [], 0
    for row in queries.select("query", "terms").toLocalIterator():
        own = np.array(row.terms, np.int64).view(np.uint64)
        if numbers and held + len(own) > PASS_TERMS:
            yield ready()
            numbers, terms, held = [], [], 0
        numbers.append(row.query)
        terms.append(own)
        held += len(own)
    if numbers:
        yield ready()


def _postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, counts) of every document: all its terms with repeats, and the
    numbers and counts of those in the vocabulary."""
    rows = only(docs, doc_id="doc_id", text="text")
    kind = dict(rows.dtypes)["doc_id"]

    def describe(batches):
        for batch in batches:
            n, sizes, terms, counts = [], [0], [], []
            for run in _terms(batch.column("text")):
                for size, own, times in run:
                    at = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
                    known = vocabulary[at] == own
                    n.append(size)
                    sizes.append(int(known.sum()))
                    terms.append(at[known])
                    counts.append(times[known])
            offsets = pa.array(np.cumsum(sizes), pa.int32())
            flat = [pa.array(np.concatenate(x) if x else [], kind) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), *(pa.ListArray.from_arrays(offsets, x) for x in flat)],
                names=["doc_id", "n", "terms", "counts"],
            )

    return rows.mapInArrow(describe, f"doc_id {kind}, n bigint, terms array<int>, counts array<bigint>")


def _weights(postings: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents that have terms, all their terms, and the weight of each term of the vocabulary."""
    sums = postings.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, df = sums.docs, np.zeros(n_terms, np.int64)
    counts = postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df"))
    for row in counts.collect():  # at most PASS_TERMS rows, or the terms of one query
        df[row.t] = row.df
    return n_docs, sums.terms or 0, np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def _groups(queries: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray]]:
    """(places, terms) of so many queries that they hold ``GROUP_TERMS`` different terms, or one."""
    places, held = [], np.empty(0, np.int64)
    for i, own in enumerate(queries):
        both = np.union1d(held, own)
        if places and len(both) > GROUP_TERMS:
            yield places, held
            places, both = [], own
        places.append(i)
        held = both
    if places:
        yield places, held


def _blocked(impacts: np.ndarray, sketch: np.ndarray, term: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """One term's posting list: (documents in the order of blocks, block starts and end, summaries)."""
    docs = np.flatnonzero(impacts[:, term])
    if not len(docs):
        return None
    pivots = docs[::block]
    nearest = (sketch[docs] @ sketch[pivots].T).argmax(1)
    order = np.argsort(nearest, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(nearest[order]) > 0)))
    docs = docs[order]
    return docs, np.append(starts, len(docs)), np.maximum.reduceat(impacts[docs], starts)


def _search_group(impacts: np.ndarray, queries: list[np.ndarray], known: np.ndarray, k: int, block: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (columns of the matrix): the rows that can be among its best k, and their scores."""
    n_docs, n_terms = impacts.shape
    signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (n_terms, SKETCH))
    sketch = impacts.astype(np.float32) @ signs
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1)
    lists = [_blocked(impacts, sketch, t, block) for t in range(n_terms)]
    greatest = impacts.max(0)
    for q, terms in enumerate(queries):
        fresh = np.ones(n_docs, bool)
        rows, scores, bound = [], [], max(int(known[q]), 1)
        for t in terms[np.argsort(-greatest[terms], kind="stable")]:
            if lists[t] is None:
                continue
            docs, ends, summaries = lists[t]
            live = summaries[:, terms].sum(1) >= bound
            if not live.any():
                continue
            own = docs[np.repeat(live, np.diff(ends))]
            own = own[fresh[own]]
            fresh[own] = False
            found = impacts[np.ix_(own, terms)].sum(1)
            good = found >= bound
            rows.append(own[good])
            scores.append(found[good])
            if sum(map(len, scores)) >= k:
                all_scores = np.concatenate(scores)
                bound = max(bound, int(np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]))
        if rows:
            rows, scores = np.concatenate(rows), np.concatenate(scores)
            good = scores >= bound
            yield q, rows[good], scores[good]


def _searched(postings: DataFrame, queries: list[np.ndarray], numbers: np.ndarray, stats, known: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score) of the documents that can be among the best k of each query."""
    n_docs, n_terms, weights = stats
    cells, block = CELLS, BLOCK
    groups = [(np.array(places), held, [np.searchsorted(held, queries[i]) for i in places]) for places, held in _groups(queries)]
    kind = dict(postings.dtypes)["doc_id"]
    names = ["query", "doc_id", "score"]

    def search(batches):
        for batch in batches:
            for places, held, own in groups:
                rows = max(1, cells // len(held))
                for a in range(0, len(batch), rows):
                    shard = batch.slice(a, rows)
                    lists = shard.column("terms")
                    row = np.repeat(np.arange(len(shard)), np.diff(lists.offsets.to_numpy()))
                    term, tf = lists.flatten().to_numpy(), shard.column("counts").flatten().to_numpy()
                    at = np.minimum(np.searchsorted(held, term), len(held) - 1)
                    in_group = held[at] == term
                    row, at, tf = row[in_group], at[in_group], tf[in_group]
                    m = 50 + (50 * shard.column("n").to_numpy() * n_docs) // n_terms
                    impacts = np.zeros((len(shard), len(held)), np.int64)
                    impacts[row, at] = weights[held[at]] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))
                    for q, found, scores in _search_group(impacts, own, known[places], k, block):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), numbers[places[q]])), shard.column("doc_id").take(pa.array(found)), pa.array(scores)], names=names
                        )

    held = postings.filter("size(terms) > 0")
    return held.mapInArrow(search, f"query bigint, doc_id {kind}, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k of each query, ranked; tasks hand on k rows of each query at most."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_column: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item with a score above 0.

    Null and empty texts, and texts without terms, neither find nor are found. Rows of
    ``items`` that repeat an id are queries of their own, rows of ``docs`` that repeat
    one are documents of their own. A null doc_id is the last among equal scores.
    """
    queries = _queries(items, id_column)
    ranked = []
    for numbers, hashed in _passes(queries):
        vocabulary = np.unique(np.concatenate(hashed))
        terms = [np.searchsorted(vocabulary, own) for own in hashed]
        postings = materialize(_postings(docs, vocabulary), "postings")
        stats = _weights(postings, len(vocabulary))
        known = np.zeros(len(numbers), np.int64)
        part = postings.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_PART)) == 0)
        first = _best(_searched(part, terms, numbers, stats, known, k), k).filter(F.col("rank") == k)
        for row in first.select("query", "score").collect():  # one row for each query of the pass
            known[np.searchsorted(numbers, row.query)] = row.score
        ranked.append(materialize(_best(_searched(postings, terms, numbers, stats, known, k), k), "ranked"))
    if not ranked:
        kind = dict(only(docs, doc_id="doc_id").dtypes)["doc_id"]
        nothing = F.lit(None)
        return queries.select("item_id", nothing.cast("int").alias("rank"), nothing.cast(kind).alias("doc_id"), nothing.cast("long").alias("score")).limit(0)
    found = reduce(DataFrame.unionByName, ranked)
    return found.join(queries.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH_SQL = rf"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM documents
), lengths AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS (
  SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths
), asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({_LOW}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS term FROM benchmark)
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings CROSS JOIN totals GROUP BY term, n_docs
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals
  GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""
