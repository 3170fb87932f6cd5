"""Exact dedup by deterministic block naming.

A text is cut into blocks of fixed size. Equal blocks get one integer name, by
sorting; then adjacent names are paired and the pairs named likewise, level by
level, until a document has one name. Documents are equal exactly if they end on
the same level with the same name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contestry.llm.columns import lower_ascii, only, whole_text
from contestry.session import materialize

BLOCK_CHARS = 4096


def document_names(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(_row, doc_id, text_sha256, level, name) of every row of documents.

    Null counts as the empty text, which has one empty block.
    """
    rows = only(docs, doc_id="doc_id", text="text").withColumn("text", lower_ascii(whole_text("text")))
    seed = 0
    while True:
        blocks = _blocks(F.col("text"), block_chars)
        hashed = F.transform(blocks, lambda b: F.xxhash64(F.lit(seed), b))
        if _told_apart(rows.select(F.explode(blocks).alias("block")), seed):
            break
        seed += 1
    stored = materialize(
        rows.select(
            F.monotonically_increasing_id().alias("_row"),
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            hashed.alias("hashes"),
        ),
        "named-docs",
    )
    done = []
    current = stored.select("_row", F.size("hashes").alias("n"), F.posexplode("hashes").alias("place", "hash"))
    keys, level = ["hash"], 0
    longest = stored.agg(F.max(F.size("hashes")).alias("n")).first().n or 1
    while True:
        named = materialize(_named(current, keys), f"level{level}")
        done.append(named.filter("n = 1").select("_row", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        current, keys = _pairs(named), ["left_name", "right_name"]
        level, longest = level + 1, (longest + 1) // 2
    names = reduce(DataFrame.unionByName, done)
    return materialize(stored.drop("hashes").join(names, "_row"), "document-names")


def _named(current: DataFrame, keys: list[str]) -> DataFrame:
    """(_row, n, place, name): sorted distinct keys get rising integers as names."""
    names = materialize(
        current.select(keys)
        .distinct()
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("name", F.monotonically_increasing_id()),
        "names",
    )
    return current.join(names, keys).select("_row", "n", "place", "name")


def _pairs(named: DataFrame) -> DataFrame:
    """Names at places 0 and 1, 2 and 3, ... side by side; -1 stands beside the
    last of an odd number. Documents of one name are done and left out."""
    pair, even = F.floor(F.col("place") / 2), F.col("place") % 2 == 0
    return (
        named.filter("n > 1")
        .groupBy("_row", F.ceil(F.col("n") / 2).alias("n"), pair.alias("place"))
        .agg(
            F.max(F.when(even, F.col("name"))).alias("left_name"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right_name"),
        )
    )


def _blocks(text: Column, size: int) -> Column:
    """Blocks of ``size`` characters, the last one shorter; one at least. They are cut
    in one pass, so a text takes time in proportion to its length."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) > 0, cut).otherwise(F.array(F.lit("")))


def _told_apart(blocks: DataFrame, seed: int) -> bool:
    """Whether different blocks have different hashes under this seed: the least
    and the greatest block of each hash are compared, so equal blocks merge
    before the shuffle and no group is gathered."""
    h = F.xxhash64(F.lit(seed), "block").alias("h")
    ends = blocks.groupBy(h).agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
    return ends.filter("lo <> hi").isEmpty()


def duplicate_classes(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal if they are identical after lower-casing A-Z. Of equal texts
    the row with the largest doc_id stays; a null id is less than any. If rows
    repeat that id too, one of them stays. Null texts equal empty ones. An empty
    table gives no rows.
    """
    names = document_names(docs, block_chars)
    classes = materialize(
        names.groupBy("level", "name").agg(
            F.max(F.struct("doc_id", "_row")).alias("keep"), F.count("*").alias("group_size")
        ),
        "classes",
    )
    return names.join(classes, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("keep._row")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that stay, with all their columns; one of each class.

    Rows that stay are found again by id and text hash. Rows that share both
    (repeats of one document) are merged to one of them.
    """
    classes = materialize(duplicate_classes(docs, block_chars), "duplicate-classes")
    id_and_hash = [F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")]
    kept = classes.filter("kept").select(id_and_hash)
    repeated = materialize(
        classes.filter("group_size > 1").groupBy(id_and_hash).count().filter("count > 1").drop("count"),
        "repeated-ids",
    )
    sha = F.sha2(lower_ascii(whole_text("text")), 256)
    same = docs.doc_id.eqNullSafe(F.col("_id")) & (sha == F.col("_sha"))
    if repeated.isEmpty():
        return docs.join(kept, same, "left_semi")
    again = kept.join(repeated, kept._id.eqNullSafe(repeated._id) & (kept._sha == repeated._sha), "left_semi")
    alone = docs.join(kept, same, "left_semi").join(again, same, "left_anti")
    merged = docs.join(again, same, "left_semi").withColumn("_sha", sha).dropDuplicates(["doc_id", "_sha"])
    return alone.unionByName(merged.drop("_sha"))
