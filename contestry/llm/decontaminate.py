"""Benchmark decontamination by a broadcast set of test n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contestry.llm import text as tx
from contestry.llm.columns import only

WINDOW = 10
#: the benchmark is broadcast in blocks of about so many bytes of text; the arrays of a block
#: take up to ``MULTIPLE`` times its text, where words have four letters or more, and 4 MB for
#: each of ten lengths
BLOCK_BYTES = 16 << 20
MULTIPLE = 12
#: hashes whose meaning a worker keeps at once
REMEMBERED = 10_000
_BITS = 22

_SPAN = "array<struct<first:bigint,last:bigint>>"


class _Windows:
    """The windows of some test items as arrays: by length, sorted hashes and the words where
    they start. What a hash stands for is looked up, and compared, in the items' own text."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        texts = [text.encode() for _, text in items]
        self.items = [item for item, _ in items]
        cuts = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
        self.data = tx.lower(np.frombuffer(b"".join(texts), np.uint8))
        starts, ends, hashes = tx.words(self.data, cuts, tx.PLAIN)
        row = tx.rows_of(starts, cuts)
        size = np.minimum(window, np.bincount(row, minlength=len(items)))
        self.starts, self.ends, self.row = starts.astype(np.int32), ends.astype(np.int32), row.astype(np.int32)
        self.hashes, self.at, self.maybe = {}, {}, {}
        for k in np.unique(size[size > 0]).tolist():
            at = np.arange(max(len(row) - k + 1, 0))
            at = at[(row[at] == row[at + k - 1]) & (size[row[at]] == k)]
            h = tx.windows(hashes, k)[at]
            order = np.argsort(h, kind="stable")
            self.hashes[k], self.at[k] = h[order], at[order].astype(np.int32)
            bits = min(_BITS, len(h).bit_length() + 5)
            self.maybe[k] = np.zeros(1 << bits, bool)
            self.maybe[k][self._slot(k, h)] = True
        #: what was hit lately, by length and hash
        self.found: dict[tuple[int, int], dict[bytes, set[str]]] = {}

    def _slot(self, k: int, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - (len(self.maybe[k]).bit_length() - 1))

    def nbytes(self) -> int:
        """Bytes of all arrays, which is what a worker holds."""
        arrays = [self.data, self.starts, self.ends, self.row]
        return sum(a.nbytes for a in (*arrays, *self.hashes.values(), *self.at.values(), *self.maybe.values()))

    def _meant(self, k: int, h: int) -> dict[bytes, set[str]]:
        """The texts of the windows with a hash, and the items that hold them."""
        if (k, h) not in self.found:
            if len(self.found) >= REMEMBERED:
                self.found.clear()
            first, end = (np.searchsorted(self.hashes[k], np.uint64(h), side) for side in ("left", "right"))
            meant: dict[bytes, set[str]] = defaultdict(set)
            for i in self.at[k][first:end].tolist():
                meant[_joined(self.data, self.starts, self.ends, i, k)].add(self.items[self.row[i]])
            self.found[k, h] = dict(meant)
        return self.found[k, h]

    def scan(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int, set[str]]]]]:
        """Words of each row, and by row (first word, last word, items) of each
        verified hit. Words are counted within the row."""
        data = tx.lower(data)
        starts, ends, hashes = tx.words(data, cuts, tx.PLAIN)
        row = tx.rows_of(starts, cuts)
        n_rows = len(cuts) - 1
        n_words = np.bincount(row, minlength=n_rows)
        first = np.concatenate(([0], np.cumsum(n_words)[:-1])) if n_rows else np.empty(0, np.int64)
        hits: list[list[tuple[int, int, set[str]]]] = [[] for _ in range(n_rows)]
        for k, known in self.hashes.items():
            h = tx.windows(hashes, k)
            at = np.flatnonzero(self.maybe[k][self._slot(k, h)])
            at = at[row[at] == row[at + k - 1]]
            slot = np.minimum(np.searchsorted(known, h[at]), len(known) - 1)
            at = at[known[slot] == h[at]]
            for i in at.tolist():
                items = self._meant(k, int(h[i])).get(_joined(data, starts, ends, i, k))
                if items:
                    r = int(row[i])
                    hits[r].append((i - int(first[r]), i - int(first[r]) + k - 1, items))
        return n_words, hits


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, i: int, k: int) -> bytes:
    return b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + k], ends[i : i + k]))


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Sorted spans, with those that touch or overlap made one."""
    out: list[dict[str, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], b)
        else:
            out.append({"first": a, "last": b})
    return out


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[_Windows]:
    """The benchmark's windows, block by block; each block is small enough to broadcast."""
    items = only(benchmark, item="item_id", text="text").filter("text IS NOT NULL").select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).distinct().collect()
        yield _Windows([(r.item, r.text) for r in block], window)


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, text, n_words, spans, items of every row of documents.

    ``spans`` are the runs of words (first, last, counted from 0) inside any
    occurrence of ``window`` consecutive words of a test item, or of a whole item
    that has fewer words; ``items`` are the ids of the items they come from. Null
    and empty texts have no words and no hits. Items without words hit nothing,
    items that share an id are one, a null id counts as the empty string. A
    benchmark larger than a block is scanned for block by block, without a shuffle.
    """
    return _scanned(only(docs, doc_id="doc_id", text="text"), benchmark, window, block_bytes)


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int) -> DataFrame:
    """``docs`` with n_words, spans and items, which grow block by block."""
    rows = docs.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPAN).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for block in _blocks(benchmark, window, block_bytes):
        known = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches, known=known):
            for batch in batches:
                data, offsets = tx.utf8(batch.column("text"))
                old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                counts, spans, items = [], [], []
                for a, b in tx.runs(offsets):
                    cuts = offsets[a : b + 1] - offsets[a]
                    n_words, hits = known.value.scan(data[offsets[a] : offsets[b]], cuts)
                    counts.append(n_words)
                    for r, found in zip(range(a, b), hits):
                        old = [(s["first"], s["last"]) for s in old_spans[r]]
                        spans.append(_merged(old + [f[:2] for f in found]) if found else old_spans[r])
                        items.append(sorted(set(old_items[r]).union(*(f[2] for f in found))))
                n_words = np.concatenate(counts) if counts else []
                for name, values in (("n_words", n_words), ("spans", spans), ("items", items)):
                    field = batch.schema.field(name)
                    batch = batch.set_column(batch.schema.names.index(name), field, pa.array(values, field.type))
                yield batch

        rows = rows.mapInArrow(scan, rows.schema)
    return rows


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without a hit, with all their columns; see ``find_hits``."""
    at = docs.columns.index("text")
    clean = docs
    for block in _blocks(benchmark, window, block_bytes):
        known = docs.sparkSession.sparkContext.broadcast(block)

        def pick(batches, known=known):
            for batch in batches:
                data, offsets = tx.utf8(batch.column(at))
                hit = np.zeros(len(batch), bool)
                for a, b in tx.runs(offsets):
                    hits = known.value.scan(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[1]
                    hit[a:b] = [bool(found) for found in hits]
                yield batch.filter(pa.array(~hit))

        clean = clean.mapInArrow(pick, docs.schema)
    return clean


def cut_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All documents, with the words of hits, and what stands between them, cut out of the text."""
    names, at = docs.columns, docs.columns.index("text")
    whole = docs.select("doc_id", "text", F.struct("*").alias("_doc"))
    found = _scanned(whole, benchmark, window, block_bytes)

    def cut(batches):
        for batch in batches:
            rows = batch.column("_doc").flatten()
            texts, spans = batch.column("text").to_pylist(), batch.column("spans").to_pylist()
            kept = [_without(t, s) if s else t for t, s in zip(texts, spans)]
            rows[at] = pa.array(kept, rows[at].type)
            yield pa.RecordBatch.from_arrays(rows, names=names)

    return found.mapInArrow(cut, docs.schema)


def _without(text: str, spans: list[dict[str, int]]) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = tx.words(tx.lower(data), np.array([0, len(data)]), tx.PLAIN)
    keep = np.ones(len(data), bool)
    for s in spans:
        keep[starts[s["first"]] : ends[s["last"]]] = False
    return data[keep].tobytes().decode()


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return find_hits(docs, benchmark).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
