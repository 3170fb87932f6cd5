"""Near duplicates by a chosen-path set similarity join.

Documents are sets of word shingles. Independent trees branch them by minwise
tokens: at a node the documents with the same least token under the node's hash
go to the same child. Small nodes are compared exhaustively on full sets; large
ones branch again, every other time by two tokens, each by a hash of its own. A
pair of similarity s meets in a tree's first node with probability s, so all trees
miss it with (1 - s) ** TREES: below 1e-13 at 0.8. ``miss_bound`` gives the same for
pairs that only meet in deeper nodes: below 1e-6 at every depth.

Nothing lists all pairs of a group. A node gives a spanning forest of its links,
and nodes whose documents are known to be connected are not compared at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.llm import text as tx
from contestry.llm.columns import only, whole_text
from contestry.operators.components import component_labels
from contestry.session import materialize, new_folder, scope

WORDS = 4
PERCENT = 80
TREES = 20
#: trees whose nodes are compared first; what they link needs no comparison in the others
FIRST_TREES = 2
#: minwise hashes: one for the root of each tree, the rest for deeper nodes
HASHES = 64
#: documents and shingles that one block holds; a task compares two blocks at once
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: a node branches if it is larger; what is left at the last depth is compared by blocks
LARGEST = (256, 512, 2048, 16384, 131072)
#: sets of a leaf whose sketches one task compares, each with all of like size; 64 bytes a set
SKETCHED = 16384
#: by how many independent tokens a node of each depth branches
BRANCHES = (1, 2, 1, 2, 1)

_SEEDS = tx.mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS, _MASKS = _SEEDS[:HASHES] | np.uint64(1), _SEEDS[HASHES:]


def miss_bound(depth: int, similarity: float = PERCENT / 100) -> float:
    """How probable it is that a pair which only meets at this depth meets in no tree."""
    missed = 0.0
    for branches in reversed(BRANCHES[: depth - 1]):
        missed = (1 - similarity * (1 - missed)) ** branches
    return (1 - similarity * (1 - missed)) ** TREES


def shingle_sets(column: pa.Array, k: int) -> Iterator[list[np.ndarray]]:
    """For each run of rows, the sorted distinct shingle hashes of every row."""
    data, offsets = tx.utf8(column)
    for a, b in tx.runs(offsets):
        cuts = offsets[a : b + 1] - offsets[a]
        part = tx.lower(data[offsets[a] : offsets[b]])
        starts, _, hashes = tx.words(part, cuts, tx.SPACED)
        row = tx.rows_of(starts, cuts)
        ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=b - a))))
        shingles = tx.windows(hashes, k)
        sets = []
        for i in range(b - a):
            n = ends[i + 1] - ends[i]
            own = shingles[ends[i] : ends[i + 1] - k + 1] if n >= k else tx.windows(hashes[ends[i] : ends[i + 1]], n)
            sets.append(np.unique(own) if n else own[:0])
        yield sets


def profiles(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """(row, doc_id, text_hash, n, set_id, mins, sketch) of every row.

    ``set_id`` is a 128-bit hash of the whole set, null if it is empty; ``mins``
    are its least hashes and ``sketch`` their lowest bytes.
    """
    rows = only(docs, doc_id="doc_id", text="text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text"
    )

    def describe(batches):
        for batch in batches:
            n, set_id, mins, sketch = [], [], [], []
            for sets in shingle_sets(batch.column("text"), k):
                sizes = np.array([len(s) for s in sets])
                n.append(sizes)
                set_id += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                some = sizes > 0
                least = np.zeros((len(sets), HASHES), np.uint32)
                if some.any():
                    joined = np.concatenate(sets)
                    at = (np.cumsum(sizes) - sizes)[some]
                    for j in range(HASHES):
                        least[some, j] = _least(joined, at, _MASKS[j], _FACTORS[j])
                mins.append(least.view(np.int32))
                sketch += [r.tobytes() for r in least.astype(np.uint8)]
            sizes = np.concatenate(n) if n else np.empty(0, np.int64)
            flat = np.concatenate(mins).ravel() if mins else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * HASHES, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("text_hash")]
                + [pa.array(sizes, pa.int64()), pa.array(set_id, pa.binary()), lists, pa.array(sketch, pa.binary())],
                names=["row", "doc_id", "text_hash", "n", "set_id", "mins", "sketch"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        describe,
        f"row bigint, doc_id {kind}, text_hash bigint, n bigint, set_id binary, mins array<int>, sketch binary",
    )


def _least(joined: np.ndarray, at: np.ndarray, mask: np.uint64, factor: np.uint64) -> np.ndarray:
    """The least hash of each set, of sets that begin at the given places."""
    return np.minimum.reduceat((((joined ^ mask) * factor) >> np.uint64(32)).astype(np.uint32), at)


def _of_sets(rows: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows, told by doc_id and text_hash, of the wanted sets, with ``v``.

    The join is a shuffle at any size, as wanted sets grow with the documents: broadcast while they
    are few, they would make the disk it takes jump from nothing to the size of the rows.
    """
    keys = sets.join(wanted, "v", "left_semi").select("v", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = rows.doc_id.eqNullSafe(F.col("_id")) & (rows.text_hash == F.col("_hash"))
    return rows.join(keys.hint("shuffle_hash"), same)


def _hashed(docs: DataFrame) -> DataFrame:
    return only(docs, doc_id="doc_id", text="text").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _texts(docs: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(v, text) of the wanted sets."""
    return _of_sets(_hashed(docs), sets, wanted).select("v", "text")


def _tokens(docs: DataFrame, sets: DataFrame, wanted: DataFrame, depth: int, n: int, k: int) -> DataFrame:
    """(v, tokens): n minwise tokens of each wanted set, by hashes that only this depth uses.

    They are made of all texts, where these are read, and then joined, as they are shorter than texts.
    """
    seeds = tx.mixed(tx.mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) + (np.uint64(depth) << np.uint64(32))))
    factors, masks = seeds[:n] | np.uint64(1), seeds[n:]
    rows = _hashed(docs)

    def describe(batches):
        for batch in batches:
            begin = 0
            for sets in shingle_sets(batch.column("text"), k):
                sizes = np.array([len(s) for s in sets])
                own = batch.slice(begin, len(sets)).select(["doc_id", "text_hash"]).filter(pa.array(sizes > 0))
                begin += len(sets)
                if not len(own):
                    continue
                joined, at = np.concatenate(sets), (np.cumsum(sizes) - sizes)[sizes > 0]
                least = np.stack([_least(joined, at, m, f) for m, f in zip(masks, factors)], 1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(own) + 1) * n, pa.int32()), pa.array(least.ravel().view(np.int32), pa.int32())
                )
                yield own.append_column("tokens", lists)

    made = rows.mapInArrow(describe, f"doc_id {dict(rows.dtypes)['doc_id']}, text_hash bigint, tokens array<int>")
    # rows that repeat id and text are one set
    return _of_sets(made, sets, wanted).select("v", "tokens").dropDuplicates(["v"])


def _nodes(sets: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(tree, node, v, large): the leaves of all trees that hold two sets at least;
    large ones have too many for their sketches to be compared in one task.

    A node branches by hashes that belong to its depth, its tree and the branches
    taken so far, so no two steps share one. The larger a node, the deeper
    its leaves: a pair parts with probability 1 - s at each step, while documents
    that only share some passage part almost surely. The tokens of the second depth
    are among ``mins``; those of deeper ones are made for the sets that get there.
    """
    root = F.posexplode(F.slice("mins", 1, TREES)).alias("tree", "token")
    rows = sets.select("v", root).select("tree", F.lit(0).alias("path"), F.xxhash64("tree", "token").alias("node"), "v")
    leaves, paths = [], 1
    for depth, largest in enumerate((*LARGEST, None)):
        # stored, so that adaptive execution can split the rows of a large node in the join
        sizes = materialize(rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "node-sizes")
        sized = materialize(rows.join(sizes, "node"), f"depth{depth}")
        leaf = sized.filter(F.col("size") <= largest) if largest else sized
        leaves.append(leaf.select("tree", "node", "v", (F.col("size") > SKETCHED).alias("large")))
        if not largest:
            break
        inner = sized.filter(F.col("size") > largest)
        if inner.isEmpty():
            break
        branches = BRANCHES[depth]
        paths *= branches
        if depth == 0:
            tokens = sets.select("v", F.slice("mins", TREES + 1, TREES * paths).alias("tokens"))
        else:
            wanted = inner.select("v").distinct()
            tokens = materialize(_tokens(docs, sets, wanted, depth, TREES * paths, k), f"tokens{depth}")
        path = F.explode(F.sequence(F.col("path") * branches, F.col("path") * branches + branches - 1)).alias("path")
        token = F.element_at("tokens", F.col("tree") * paths + F.col("path") + 1)
        rows = (
            inner.select("tree", "node", "v", path)
            .join(tokens, "v")
            .select("tree", "path", F.xxhash64("node", "path", token).alias("node"), "v")
        )
    return reduce(DataFrame.unionByName, leaves)


def _by_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches of rows sorted by key, cut so that no key goes over an end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys == keys[-1])[0])
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(key)[0] != batch.column(key)[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _promising(nodes: DataFrame, sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The nodes, with ``component``, without the sets that resemble none of another
    component there. Without labels every set is its own component.

    Sizes have to allow the similarity, and 34 of 64 minwise hashes to agree;
    at 0.8 fewer agree with a probability of 3e-7, for all trees together, as they share the hashes.
    Sets are sorted by size, so that each meets only those of like size. Only sketches
    are compared, so documents that share a passage and little else cost no full sets.
    """
    if labels is None:
        known = nodes.withColumn("component", F.col("v"))
    else:
        known = nodes.join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
    rows = known.filter("NOT large").join(sets.select("v", "n", "sketch"), "v")

    def compare(batches):
        for table in _by_group(batches, "node"):
            node, n, component = (_numpy(table, c) for c in ("node", "n", "component"))
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
            keep = np.zeros(len(node), bool)
            i, step = np.arange(len(node)), 1
            while True:
                i = i[: np.searchsorted(i, len(node) - step)]
                # what is too large at this distance is so at every greater one
                i = i[(node[i] == node[i + step]) & (100 * n[i] >= PERCENT * n[i + step])]
                if not len(i):
                    break
                apart = i[component[i] != component[i + step]]
                for part in np.array_split(apart, len(apart) // 100_000 + 1):
                    same = (sketch[part] == sketch[part + step]).sum(1) >= 34
                    keep[part[same]] = keep[part[same] + step] = True
                step += 1
            yield from table.select(["node", "v", "n", "component"]).filter(pa.array(keep)).to_batches()

    kept = (
        rows.repartition("node")
        .sortWithinPartitions("node", "n")
        .mapInArrow(compare, "node bigint, v bigint, n bigint, component bigint")
    )
    return kept.unionByName(known.filter("large").join(sets.select("v", "n"), "v").select("node", "v", "n", "component"))


def _dealt(nodes: DataFrame, first: bool) -> DataFrame:
    """(part, v, component): what is compared together, for nodes of several components.

    A node of up to two blocks is one part. In a larger one the documents of its largest
    component are not compared among themselves: blocks of the others meet each
    other and blocks of that component. At first, before any links are known, a large node is
    dealt into blocks that share one document, which is linear in its size.
    """
    blocks_of = lambda c, n: F.greatest(F.ceil(c / BLOCK), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    place = lambda n: F.pmod(F.xxhash64("v"), n).cast("int")
    if first:
        stats = nodes.groupBy("node").agg(
            F.min("v").alias("pivot"), blocks_of(F.count("*"), F.sum("n")).alias("blocks")
        )
        rows = nodes.join(materialize(stats, "pivots"), "node")
        blocks = F.col("blocks")
        every = F.sequence(F.lit(0), blocks - 1)
        places = (
            F.when(blocks <= 2, F.array(F.lit(0))).when(F.col("v") == F.col("pivot"), every).otherwise(F.array(place(blocks)))
        )
        return rows.select("node", "v", "component", F.explode(places).alias("place")).select(
            F.xxhash64("node", "place").alias("part"), "v", "component"
        )
    counts = nodes.groupBy("node", "component").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    stats = counts.groupBy("node").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"), F.count("*").alias("components"),
        F.max(F.struct("c", "n", "component")).alias("top"),
    )
    stats = stats.filter("components > 1").select(
        "node",
        F.col("top.component").alias("top"),
        (blocks_of(F.col("c"), F.col("n")) <= 2).alias("small"),
        blocks_of(F.col("c") - F.col("top.c"), F.col("n") - F.col("top.n")).alias("others"),
        blocks_of(F.col("top.c"), F.col("top.n")).alias("tops"),
    )
    rows = nodes.join(materialize(stats, "nodes-open"), "node")
    others, tops = F.col("others"), F.col("tops")
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    zero = F.lit(0)
    in_top = F.transform(F.sequence(zero, others - 1), lambda i: pair(i, others + place(tops)))
    with_others = F.transform(
        F.sequence(zero, others - 1), lambda j: pair(F.least(place(others), j), F.greatest(place(others), j))
    )
    with_top = F.transform(F.sequence(zero, tops - 1), lambda j: pair(place(others), others + j))
    pairs = (
        F.when(F.col("small"), F.array(pair(zero, zero)))
        .when(F.col("component") == F.col("top"), in_top)
        .otherwise(F.concat(with_others, with_top))
    )
    return rows.select("node", "v", "component", F.explode(pairs).alias("p")).select(
        F.xxhash64("node", "p.i", "p.j").alias("part"), "v", "component"
    )


def _links(parts: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links in each part, confirmed on full sets.

    Texts grow with the documents, so they are not broadcast while they are few either.
    """

    def compare(batches):
        for table in _by_group(batches, "part"):
            part, v, component = (_numpy(table, c) for c in ("part", "v", "component"))
            sets = [s for run in shingle_sets(table.column("text").combine_chunks(), k) for s in run]
            ends = np.flatnonzero(np.concatenate((part[1:] != part[:-1], [True]))) + 1
            found = [
                link
                for a, b in zip(np.concatenate(([0], ends[:-1])), ends)
                if b - a > 1
                for link in _forest(v[a:b], component[a:b], sets[a:b], percent)
            ]
            both = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return (
        parts.join(texts.hint("merge"), "v")
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _forest(v: np.ndarray, component: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join components; each set outside the largest one is held against all others at once."""
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.cumsum(sizes) - sizes
    group = np.unique(component, return_inverse=True)[1]
    outside = np.flatnonzero(group != np.bincount(group).argmax())
    held = np.zeros(ids.max() + 1, bool)
    for i in outside.tolist():
        if (group == group[0]).all():
            return
        own = ids[at[i] : at[i] + sizes[i]]
        held[own] = True
        shared = np.add.reduceat(held[ids], at)
        held[own] = False
        close = (100 + percent) * shared >= percent * (sizes + sizes[i])
        for j in np.flatnonzero(close & (group != group[i])).tolist():
            if group[j] != group[i]:
                group[group == group[j]] = group[i]
                yield int(v[i]), int(v[j])


def _stored(near: DataFrame, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` returns, stored; the tables it has stored on its way are deleted."""
    spark = near.sparkSession
    path = new_folder(spark, label)
    with scope(spark):
        df = build()
        schema = df.schema
        df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def classes(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(row, doc_id, text_hash, n_shingles, component, component_id) of every row.

    ``component`` names the class within this result, ``component_id`` is its
    smallest doc_id. Null and empty texts, and texts without words, have no
    shingles and are classes of their own. Equal sets are one class at once; only
    one text of each takes part in the join. Rows that repeat an id are rows of
    their own in the join; a null id is the smallest only in a class of nulls.
    """
    described = materialize(profiles(docs, k), "profiles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    distinct = materialize(
        described.filter("n > 0").groupBy("set_id").agg(first).select(
            "set_id", F.col("first.row").alias("v"), F.col("first.doc_id").alias("first_id")
        ),
        "distinct-sets",
    )
    sets = materialize(
        described.join(distinct.select(F.col("v").alias("row")), "row", "left_semi").select(
            F.col("row").alias("v"), "doc_id", "text_hash", "n", "mins", "sketch"
        ),
        "sets",
    )
    nodes = _stored(sets, "nodes", lambda: _nodes(sets, docs, k))
    links, labels = None, None
    for first in (True, False):

        def compare(trees=nodes.filter(F.col("tree") < FIRST_TREES) if first else nodes, known=labels):
            near = materialize(_promising(trees, sets, known), "promising")
            texts = materialize(_texts(docs, sets, near.select("v").distinct()), "texts")
            return _links(_dealt(near, first), texts, k, percent)

        found = _stored(sets, "links", compare)
        links = found if links is None else links.unionByName(found)
        labels = _stored(sets, "labels", lambda: component_labels(links, "a", "b").select(F.col("node").alias("v"), "component"))
    labelled = distinct.join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_set = materialize(
        materialize(labelled, "labelled").join(materialize(smallest, "smallest"), "component").select(
            "set_id", "component", "component_id"
        ),
        "set-classes",
    )
    return described.join(of_set, "set_id", "left").select(
        "row",
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "row").alias("component"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; see ``classes``."""
    return classes(docs).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns.

    Rows that repeat both id and text are merged to one.
    """
    found = materialize(classes(docs, k, percent), "near-classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    kept = materialize(found.groupBy("component").agg(first.alias("first")), "near-kept")
    rows = found.join(kept, found.row == F.col("first.row"), "left_semi")
    keys = materialize(rows.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "near-keys")
    same = docs.doc_id.eqNullSafe(F.col("_id")) & (F.xxhash64(docs.text) == F.col("_hash"))
    repeated = found.groupBy("doc_id", "text_hash").count().filter("count > 1")
    kept_docs = docs.join(keys, same, "left_semi")
    if repeated.isEmpty():
        return kept_docs
    return kept_docs.withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_hash"]).drop("_hash")
