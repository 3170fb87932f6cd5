"""Quality classifier: perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of order ``ORDER`` over the bytes
of the texts as they are, one for each language. Its counts come from all
trusted text and are kept, and joined order by order, as tables sharded by
language and n-gram. It grows with the corpus, so it is never gathered: the different n-grams
of a chunk of documents go to the shards of the model that have their probabilities, and
these come back to the chunk's texts (``scores_by_join``).

A model of text folded to 32 symbols is small enough to be broadcast at low orders
(``scores_by_table``); no registered query uses it.

A mean over n bytes varies as one over the root of n. So a document is judged by how far its
bits lie from the median of its language, times that root: its deviation. The thresholds
are quantiles of the deviations of the language's trusted documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contestry.llm import text as tx
from contestry.llm.columns import only, whole_text
from contestry.session import materialize

ORDER = 5
#: symbols of folded text
SYMBOLS = 32
#: small tables of counts can ask for no discount, which leaves nothing for what is unseen
LEAST_DISCOUNT = 0.1
#: quantiles of the trusted documents' deviations
LOW, HIGH = 0.005, 0.995
#: numbers that a task holds before it sums them, and different n-grams before it sends them
WAITING, HELD = 1 << 21, 1 << 22
#: bytes of text, and of each row beside it, that make a chunk of documents
CHUNK_BYTES, ROW_BYTES = 32 << 20, 64
#: parts of a model at most; n-grams of so many symbols at least are in one part only
SHARDS, SHARDED = 1024, 3
#: bits of the set of trusted ids by hash that spares other texts the shuffle
SLOTS = 1 << 26
#: models broadcast at once, two for each language, and the cells that one may have
LANGUAGES = 8
CELLS = 1 << 20
#: medians are found to so many parts of a bit, thresholds to so many of a unit of deviation
BINS = 1000


def _fold() -> np.ndarray:
    """a-z, upper case, digit, white space, sentence mark, other sign, non-ASCII byte."""
    table = np.full(256, 30, np.uint8)
    table[97:123] = np.arange(26)
    table[65:91] = 26
    table[48:58] = 27
    table[list(b" \t\n\x0b\x0c\r")] = 28
    table[list(b".,;:!?'\"()-")] = 29
    table[128:] = 31
    return table


_FOLD = _fold()
_START = 28


class Alphabet(NamedTuple):
    """The symbol of each byte, the bits that a symbol takes, and the one before a text."""

    symbols: np.ndarray
    width: int
    start: int


BYTES = Alphabet(np.arange(256, dtype=np.uint8), 8, 32)
FOLDED = Alphabet(_FOLD, 5, _START)


def grams(data: np.ndarray, cuts: np.ndarray, order: int, letters: Alphabet = FOLDED) -> np.ndarray:
    """The code of the n-gram that ends at each byte; texts start after white space."""
    if order * letters.width > 62:
        raise ValueError(f"{order} symbols of {letters.width} bits are more than 62 bits")
    symbols = letters.symbols[data]
    code = symbols.astype(np.int64)
    begins = cuts[:-1][cuts[:-1] < len(data)]
    for j in range(1, order):
        before = np.full(len(data), letters.start, np.uint8)
        before[j:] = symbols[:-j] if j < len(data) else symbols[:0]
        for i in range(j):
            at = begins + i
            before[at[at < len(data)]] = letters.start
        code += before.astype(np.int64) << (letters.width * j)
    return code


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def _half() -> Column:
    """Each document belongs to one of two halves, and the model of its half is trained
    on the other; so nothing is scored by a model that has seen it."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(2))


def _model(half: Column) -> Column:
    return F.concat(half.cast("string"), F.lit(" "), _language())


def gram_counts(trusted: DataFrame, order: int = ORDER, letters: Alphabet = FOLDED) -> DataFrame:
    """(lang, code, c) over all trusted texts, which may be packed; each task sums its own before the shuffle.

    Here and below ``lang`` is the name of a model: the half it serves and a language.
    """
    texts = tx.unpacked_texts if dict(trusted.dtypes)["text"] == "binary" else tx.utf8

    def count(batches):
        sums = _Sums()
        for batch in batches:
            for name, codes in _by_model(batch.column("lang"), *texts(batch.column("text")), order, letters):
                yield from sums.add(name, codes)
        yield from sums.flush()

    rows = trusted.select(_model(1 - _half()).alias("lang"), "text")
    return rows.mapInArrow(count, "lang string, code bigint, c bigint").groupBy("lang", "code").agg(F.sum("c").alias("c"))


def _by_model(
    column: pa.Array, data: np.ndarray, offsets: np.ndarray, order: int, letters: Alphabet
) -> Iterator[tuple[str, np.ndarray]]:
    """The codes of some rows after the others, by the rows' models."""
    names = column.dictionary_encode()
    own, names = names.indices.to_numpy(), names.dictionary.to_pylist()
    for a, b in tx.runs(offsets):
        cuts = offsets[a : b + 1] - offsets[a]
        codes = grams(data[offsets[a] : offsets[b]], cuts, order, letters)
        by_code = np.repeat(own[a:b], np.diff(cuts))
        for i in np.unique(own[a:b]).tolist():
            yield names[i], codes[by_code == i]


class _Sums:
    """Counts of codes by model; codes wait until there are enough to be counted at once,
    and what is held goes out when there is too much of it."""

    def __init__(self) -> None:
        self.sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.waiting: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, name: str, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.waiting.setdefault(name, []).append(codes)
        self.size += len(codes)
        if self.size >= WAITING:
            self.settle()
            if sum(len(codes) for codes, _ in self.sums.values()) >= HELD:
                yield from self.flush()

    def settle(self) -> None:
        """Count what waits."""
        for name, waiting in self.waiting.items():
            code, c = np.unique(np.concatenate(waiting), return_counts=True)
            if name in self.sums:
                code, c = (np.concatenate(x) for x in zip(self.sums[name], (code, c)))
                order = np.argsort(code, kind="stable")
                code, c = code[order], c[order]
                first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))[: len(code)])
                code, c = code[first], np.add.reduceat(c, first) if len(first) else c
            self.sums[name] = code, c
        self.waiting, self.size = {}, 0

    def flush(self) -> Iterator[pa.RecordBatch]:
        self.settle()
        for name in list(self.sums):
            code, c = self.sums.pop(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(code), pa.string()), pa.array(code, pa.int64()), pa.array(c, pa.int64())],
                names=["lang", "code", "c"],
            )


def kneser_ney(counts: DataFrame, order: int = ORDER, letters: Alphabet = FOLDED) -> DataFrame:
    """(lang, order, code, p, back): by order, the probability of each seen n-gram's
    last symbol, and the weight that its context gives to the order below.

    Lower orders count the different symbols before an n-gram. Discounts for counts
    of one, two, three and more come from the counts of counts.
    """
    counted, symbols = {order: counts}, 1 << letters.width
    for k in range(order - 1, 0, -1):
        shorter = F.pmod("code", F.lit(symbols**k)).alias("code")
        counted[k] = materialize(counted[k + 1].groupBy("lang", shorter).agg(F.count("*").alias("c")), f"counts{k}")
    of = lambda condition: F.count(F.when(condition, 1))
    c, d = F.col("c"), [F.col(f"d{i}") for i in range(4)]
    levels: list[DataFrame] = []
    for k in range(1, order + 1):
        table = counted[k].withColumn("context", F.shiftright("code", letters.width))
        n = [F.col(f"n{i}") for i in range(5)]
        y = F.when(n[1] + n[2] > 0, n[1] / (n[1] + 2 * n[2])).otherwise(0.0)
        discounts = table.groupBy("lang").agg(*(of(c == i).alias(f"n{i}") for i in range(1, 5))).select(
            "lang",
            *(
                F.greatest(F.lit(LEAST_DISCOUNT), i - (i + 1) * y * n[i + 1] / F.greatest(n[i], F.lit(1))).alias(f"d{i}")
                for i in (1, 2, 3)
            ),
        )
        contexts = table.groupBy("lang", "context").agg(
            F.sum("c").alias("total"), of(c == 1).alias("ones"), of(c == 2).alias("twos"), of(c > 2).alias("more")
        )
        seen = table.join(contexts, ["lang", "context"]).join(discounts, "lang")
        lower = F.lit(1 / symbols)
        if levels:
            below = levels[-1].select("lang", F.col("code").alias("suffix"), F.col("p").alias("lower"))
            suffix = F.pmod("code", F.lit(symbols ** (k - 1)))
            seen, lower = seen.withColumn("suffix", suffix).join(below, ["lang", "suffix"]), F.col("lower")
        back = (d[1] * F.col("ones") + d[2] * F.col("twos") + d[3] * F.col("more")) / F.col("total")
        own = (c - F.when(c == 1, d[1]).when(c == 2, d[2]).otherwise(d[3])) / F.col("total")
        level = seen.select("lang", F.lit(k).alias("order"), "code", (own + back * lower).alias("p"), back.alias("back"))
        levels.append(materialize(level, f"order{k}"))
    return reduce(DataFrame.unionByName, levels)


def packed(bits: np.ndarray) -> bytes:
    """A model's table for the way over the driver: unseen contexts repeat the lower
    order, so little of it is left."""
    return zlib.compress(bits.astype(np.float32).tobytes())


class _Models:
    """Packed tables by name; a Python worker unpacks those it meets, once."""

    def __init__(self, tables: dict[str, bytes]) -> None:
        self.tables = tables
        self.open: dict[str, np.ndarray] = {}

    def get(self, name: str) -> np.ndarray | None:
        if name not in self.open and name in self.tables:
            self.open[name] = np.frombuffer(zlib.decompress(self.tables[name]), np.float32)
        return self.open.get(name)


def _dense(order: int):
    def fill(rows: pa.Table) -> pa.Table:
        """All log probabilities of one language; its rows are bounded like the table."""
        level, code, p, back = (
            rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("order", "code", "p", "back")
        )
        lower = np.full(SYMBOLS, 1 / SYMBOLS)
        for k in range(1, order + 1):
            seen = level == k
            weight = np.ones(SYMBOLS ** (k - 1))
            weight[code[seen] // SYMBOLS] = back[seen]
            below = np.tile(lower.reshape(-1, SYMBOLS), (SYMBOLS if k > 1 else 1, 1))
            lower = (weight[:, None] * below).ravel()
            lower[code[seen]] = p[seen]
        return pa.table({"lang": rows.column("lang")[:1], "bits": pa.array([packed(-np.log2(lower))], pa.binary())})

    return fill


def fit(trusted: DataFrame, order: int = ORDER, letters: Alphabet = FOLDED) -> DataFrame:
    """The model of all trusted text, as ``kneser_ney`` gives it."""
    counts = materialize(gram_counts(trusted, order, letters), f"counts{order}")
    return kneser_ney(counts, order, letters)


def tables(model: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, bits): for each language of a folded model the bits of each n-gram's last symbol, packed."""
    return materialize(model.groupBy("lang").applyInArrow(_dense(order), "lang string, bits binary"), "models")


def _language_blocks(rows: DataFrame, models: DataFrame) -> list[tuple[DataFrame, _Models]]:
    """Rows with ``_model``, by blocks of models that are small enough to broadcast."""
    n = max(1, -(-models.count() // (2 * LANGUAGES)))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(n))
    return [
        (
            rows if n == 1 else rows.filter(block("_model") == k),
            _Models({r.lang: bytes(r.bits) for r in models.filter(block("lang") == k).collect()}),
        )
        for k in range(n)
    ]


def _mean_bits(batch: pa.RecordBatch, tables: _Models, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text, and bits for each byte; no number without model or text."""
    data, offsets = tx.utf8(batch.column("text"))
    models = batch.column("_model").to_pylist()
    bits = np.full(len(batch), np.nan)
    for a, b in tx.runs(offsets):
        cuts = offsets[a : b + 1] - offsets[a]
        codes = grams(data[offsets[a] : offsets[b]], cuts, order)
        for i, begin, end in zip(range(a, b), cuts[:-1].tolist(), cuts[1:].tolist()):
            table = tables.get(models[i])
            if table is not None and end > begin:
                bits[i] = table[codes[begin:end]].sum(dtype=np.float64) / (end - begin)
    return np.diff(offsets), bits


def score(docs: DataFrame, model: DataFrame, order: int = ORDER, letters: Alphabet = FOLDED) -> DataFrame:
    """(doc_id, lang, n, bits) of every row; bits for each byte, null without model or text."""
    if letters is FOLDED and SYMBOLS**order <= CELLS:
        return scores_by_table(docs, tables(model, order), order)
    return scores_by_join(docs, model, order, letters).drop("key")


def _key() -> Column:
    """Rows with the same one have the same score."""
    return F.xxhash64("doc_id", _language(), whole_text("text"))


def scores_by_join(docs: DataFrame, model: DataFrame, order: int = ORDER, letters: Alphabet = FOLDED) -> DataFrame:
    """(doc_id, lang, key, n, bits) of every row, by joins with the sharded model.

    The different n-grams of a chunk of documents go to their shards; there each gets its
    probability, of the longest seen n-gram that it ends with, times the weights of the
    seen contexts above. The chunk's texts meet what comes back. The documents are read twice and
    have to be the same each time, as stored files are.
    """
    rows = only(docs, doc_id="doc_id", lang="lang", text="text").select(
        "doc_id", _language().alias("lang"), _key().alias("key"), _model(_half()).alias("model"), "text"
    )
    spark = docs.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), SHARDS)

    def ask(batches):
        for chunk, parts in _chunks(batches):
            yield _questions(chunk, parts, n, order, letters)

    def pack(batches):
        for chunk, parts in _chunks(batches):
            kind = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema, options=kind) as out:
                for part in pa.Table.from_batches(parts).combine_chunks().to_batches():
                    out.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([sink.getvalue().to_pybytes()])], names=["chunk", "rows"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        return _answers(asked, known, order, letters)

    def measure(texts: pa.Table, told: pa.Table) -> pa.Table:
        return _measured(texts, told, order, letters)

    asked = rows.mapInArrow(ask, "chunk bigint, shard int, model string, codes binary")
    shards = _by_shard(model, n, letters)
    told = asked.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(
        answer, "chunk bigint, model string, codes binary, bits binary"
    )
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(pack, "chunk bigint, rows binary").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        measure, f"doc_id {kind}, lang string, key bigint, n bigint, bits double"
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """A task's rows in chunks, each with a number that comes from its rows."""
    held: list[pa.RecordBatch] = []
    size = 0

    def number() -> int:
        keys = np.concatenate([h.column("key").to_numpy() for h in held]).view(np.uint64)
        return int(tx.mixed(keys).sum(dtype=np.uint64).astype(np.int64))

    for batch in batches:
        _, offsets = tx.utf8(batch.column("text"))
        for a, b in tx.runs(offsets, CHUNK_BYTES // 8):
            held.append(batch.slice(a, b - a))
            size += int(offsets[b] - offsets[a]) + ROW_BYTES * (b - a)
            if size >= CHUNK_BYTES:
                yield number(), held
                held, size = [], 0
    if held:
        yield number(), held


def _shard(codes: np.ndarray, name: str, n: int, letters: Alphabet) -> np.ndarray:
    """The shard of each code, by the model and the last two symbols of its context; so an n-gram,
    its context and all of its endings of ``SHARDED`` symbols and more are in one."""
    pair = (codes >> letters.width) & ((1 << 2 * letters.width) - 1)
    return (tx.mixed(pair.astype(np.uint64) + np.uint64(zlib.crc32(name.encode()) << 32)) % np.uint64(n)).astype(np.int64)


def _by_shard(model: DataFrame, n: int, letters: Alphabet) -> DataFrame:
    """The model's rows with their shard; n-grams too short to have one go to all."""

    def deal(batches):
        for batch in batches:
            names = batch.column("lang").dictionary_encode()
            own, names = names.indices.to_numpy(), names.dictionary.to_pylist()
            level, code = batch.column("order").to_numpy(), batch.column("code").to_numpy()
            shard = np.zeros(len(batch), np.int64)
            for i, name in enumerate(names):
                shard[own == i] = _shard(code[own == i], name, n, letters)
            long = np.flatnonzero(level >= SHARDED)
            yield batch.take(pa.array(long)).append_column("shard", pa.array(shard[long], pa.int32()))
            short = np.flatnonzero(level < SHARDED)
            each = max(1, (1 << 17) // n)
            for a in range(0, len(short), each):
                some = short[a : a + each]
                every = pa.array(np.tile(np.arange(n), len(some)), pa.int32())
                yield batch.take(pa.array(np.repeat(some, n))).append_column("shard", every)

    return model.mapInArrow(deal, "lang string, order int, code bigint, p double, back double, shard int")


def _questions(chunk: int, parts: list[pa.RecordBatch], n: int, order: int, letters: Alphabet) -> pa.RecordBatch:
    """The different codes of a chunk, by shard and model, in order."""
    found: dict[str, list[np.ndarray]] = {}
    size = 0
    for part in parts:
        for name, codes in _by_model(part.column("model"), *tx.utf8(part.column("text")), order, letters):
            found.setdefault(name, []).append(codes)
            size += len(codes)
            if size >= WAITING:
                found, size = {m: [np.unique(np.concatenate(c))] for m, c in found.items()}, 0
    out: list[tuple] = []
    for name in sorted(found):
        codes = np.unique(np.concatenate(found[name]))
        shard = _shard(codes, name, n, letters)
        by = np.argsort(shard, kind="stable")
        codes, shard = codes[by], shard[by]
        ends = np.flatnonzero(np.concatenate((shard[1:] != shard[:-1], [True]))[: len(shard)]) + 1
        for a, b in zip(np.concatenate(([0], ends[:-1])).astype(int).tolist(), ends.tolist()):
            out.append((chunk, int(shard[a]), name, tx.by_byte(np.diff(codes[a:b], prepend=0))))
    kinds = (("chunk", pa.int64()), ("shard", pa.int32()), ("model", pa.string()), ("codes", pa.binary()))
    columns = list(zip(*out)) if out else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[name for name, _ in kinds])


class _Shard:
    """A shard's part of one model, level by level: n-grams with p, contexts with their weight."""

    def __init__(self, level: np.ndarray, code: np.ndarray, p: np.ndarray, back: np.ndarray, order: int, letters: Alphabet) -> None:
        self.width, self.levels = letters.width, []
        for k in range(1, order + 1):
            own = np.flatnonzero(level == k)
            own = own[np.argsort(code[own])]
            context = code[own] >> self.width
            first = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))[: len(context)])
            self.levels.append((code[own], p[own], context[first], back[own[first]]))

    def bits(self, codes: np.ndarray) -> np.ndarray:
        p = np.full(len(codes), 1 / (1 << self.width))
        for k, (gram, own, context, back) in enumerate(self.levels, 1):
            code = codes & ((1 << self.width * k) - 1)
            p *= _looked_up(code >> self.width, context, back, 1.0)
            seen = _looked_up(code, gram, own, 0.0)
            p = np.where(seen > 0, seen, p)
        return -np.log2(p)


def _looked_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray, other: float) -> np.ndarray:
    if not len(known):
        return np.full(len(keys), other)
    slot = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[slot] == keys, values[slot], other)


def _answers(asked: pa.Table, known: pa.Table, order: int, letters: Alphabet) -> pa.Table:
    """The bits of the codes asked for in a shard; none for languages without a model."""
    lang = known.column("lang").combine_chunks().dictionary_encode()
    own, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
    columns = [known.column(c).to_numpy() for c in ("order", "code", "p", "back")]
    models = {name: _Shard(*(c[own == i] for c in columns), order, letters) for i, name in enumerate(names)}
    keep = [name in models for name in asked.column("model").to_pylist()]
    asked = asked.select(["chunk", "model", "codes"]).filter(pa.array(keep, pa.bool_()))
    bits = []
    for name, codes in zip(asked.column("model").to_pylist(), asked.column("codes").to_pylist()):
        bits.append(tx.by_byte(models[name].bits(np.cumsum(tx.values(codes, np.int64))).astype(np.float32)))
    return asked.append_column("bits", pa.array(bits, pa.binary()))


class _Bits:
    """The bits of a chunk's codes, found by a hash of each code; those that share one by search."""

    def __init__(self, codes: np.ndarray, bits: np.ndarray) -> None:
        by = np.argsort(codes, kind="stable")
        self.codes, self.bits = codes[by], bits[by]
        self.shift = np.uint64(64 - max(10, (8 * len(codes)).bit_length()))
        self.places = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        self.places[self._slots(self.codes)] = np.arange(len(codes))

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, codes: np.ndarray) -> np.ndarray:
        place = self.places[self._slots(codes)]
        other = np.flatnonzero(self.codes[place] != codes)
        place[other] = np.minimum(np.searchsorted(self.codes, codes[other]), len(self.codes) - 1)
        if (self.codes[place[other]] != codes[other]).any():
            raise RuntimeError(_CHANGED)
        return self.bits[place]


def _measured(texts: pa.Table, told: pa.Table, order: int, letters: Alphabet) -> pa.Table:
    """Bytes of each text of a chunk, and bits for each byte; no number without model or text."""
    parts: dict[str, tuple[list, list]] = {}
    for name, codes, bits in zip(*(told.column(c).to_pylist() for c in ("model", "codes", "bits"))):
        parts.setdefault(name, ([], []))[0].append(np.cumsum(tx.values(codes, np.int64)))
        parts[name][1].append(tx.values(bits, np.float32))
    known = {name: _Bits(*(np.concatenate(x) for x in part)) for name, part in parts.items()}
    if known and not len(texts):
        raise RuntimeError(_CHANGED)
    out = [
        pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), batch.column("key"), *_bits(batch, known, order, letters)],
            names=["doc_id", "lang", "key", "n", "bits"],
        )
        for rows in texts.column("rows").to_pylist()
        for batch in pa.ipc.open_stream(rows)
    ]
    return pa.Table.from_batches(out)


_CHANGED = "the documents changed between two readings; read them from stored files"


def _bits(
    batch: pa.RecordBatch, known: dict[str, _Bits], order: int, letters: Alphabet
) -> tuple[pa.Array, pa.Array]:
    """Bytes of each text, and bits for each byte."""
    data, offsets = tx.utf8(batch.column("text"))
    names = batch.column("model").dictionary_encode()
    own, names = names.indices.to_numpy(), names.dictionary.to_pylist()
    total = np.full(len(batch), np.nan)
    for a, b in tx.runs(offsets):
        cuts = offsets[a : b + 1] - offsets[a]
        codes = grams(data[offsets[a] : offsets[b]], cuts, order, letters)
        by_code = np.repeat(own[a:b], np.diff(cuts))
        bits = np.full(len(codes), np.nan)
        for i in np.unique(by_code).tolist():
            if names[i] in known:
                place = by_code == i
                bits[place] = known[names[i]].of(codes[place])
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        if len(some):
            total[a + some] = np.add.reduceat(bits, cuts[some]) / np.diff(cuts)[some]
    return pa.array(np.diff(offsets), pa.int64()), pa.array(total, pa.float64(), from_pandas=True)


def scores_by_table(docs: DataFrame, models: DataFrame, order: int = ORDER) -> DataFrame:
    """``score`` of a folded model by looking up every n-gram in broadcast tables, languages block by block."""
    rows = only(docs, doc_id="doc_id", lang="lang", text="text").select(
        "doc_id", _language().alias("lang"), _model(_half()).alias("_model"), "text"
    )
    kind = dict(rows.dtypes)["doc_id"]
    parts = []
    for own, tables in _language_blocks(rows, models):
        known = docs.sparkSession.sparkContext.broadcast(tables)

        def measure(batches, known=known):
            for batch in batches:
                n, bits = _mean_bits(batch, known.value, order)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("lang"), pa.array(n, pa.int64())]
                    + [pa.array(bits, pa.float64(), from_pandas=True)],
                    names=["doc_id", "lang", "n", "bits"],
                )

        parts.append(own.mapInArrow(measure, f"doc_id {kind}, lang string, n bigint, bits double"))
    return reduce(DataFrame.unionByName, parts)


def _quantiles(rows: DataFrame, value: Column, shares: dict[str, float]) -> DataFrame:
    """(lang, a column for each share): the bin, as a whole number, of the least value that
    so large a share of the language's rows does not exceed.

    Values are counted in bins of one over ``BINS``, of which there are few.
    """
    bins = rows.groupBy("lang", F.floor(value * BINS).alias("bin")).agg(F.count("*").alias("c"))
    by = Window.partitionBy("lang")
    up_to = by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = bins.withColumn("up_to", F.sum("c").over(up_to)).withColumn("all", F.sum("c").over(by))
    of = lambda share: F.min(F.when(F.col("up_to") >= share * F.col("all"), F.col("bin")))
    return ranked.groupBy("lang").agg(*(of(share).alias(name) for name, share in shares.items()))


def thresholds(scores: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """(lang, middle, low, high): the median of the given documents' bits and the quantiles
    of their deviations from it, by language.

    A text of n bytes lies within the thresholds from middle + low / sqrt(n) to
    middle + high / sqrt(n) bits.
    """
    scored = scores.filter("bits IS NOT NULL")
    middle = _quantiles(scored, F.col("bits"), {"bin": 0.5}).select("lang", (F.col("bin") / BINS).alias("middle"))
    middle = materialize(middle, "medians")
    deviation = (F.col("bits") - F.col("middle")) * F.sqrt("n")
    ends = _quantiles(scored.join(middle, "lang"), deviation, {"low": low, "high": high})
    return ends.join(middle, "lang").select(
        "lang", "middle", (F.col("low") / BINS).alias("low"), ((F.col("high") + 1) / BINS).alias("high")
    )


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents labelled as of good quality and not toxic; all of them.

    The join is a shuffle at any size, as labels grow with the documents: broadcast while they
    are few, they would make the disk it takes jump from nothing to the size of the texts.
    """
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").alias("_id"))
    return docs.join(good.hint("shuffle_hash"), docs.doc_id == good._id, "left_semi")


def _bound(end: str) -> Column:
    """A threshold in bits for each byte of a text of ``n`` bytes; null for a text without bytes."""
    return F.col("middle") + F.col(end) / F.sqrt(F.nullif(F.col("n"), F.lit(0)))


def _trusted_texts(columns: DataFrame, labels: DataFrame) -> DataFrame:
    """The trusted rows with their texts packed. Texts whose id is surely not among the
    labels', by a set of bits of bounded size, are left out before the shuffle of ``trusted_rows``."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    slot = lambda: F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS))
    by = good.groupBy(F.bitmap_bucket_number(slot() + 1).alias("bucket"))
    held = np.zeros(SLOTS // 8, np.uint8)
    for r in by.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot() + 1)).alias("bits")).collect():
        bits = np.frombuffer(r.bits, np.uint8)
        held[(r.bucket - 1) * len(bits) : r.bucket * len(bits)] = bits
    kind = dict(columns.dtypes)["doc_id"]
    if kind != dict(labels.dtypes)["doc_id"]:
        held[:] = 255  # unlike types have unlike hashes
    known = columns.sparkSession.sparkContext.broadcast(held)

    def pick(batches):
        for batch in batches:
            at = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((known.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), tx.packed_texts(batch.column("text"))],
                names=["doc_id", "lang", "text"],
            )

    rows = columns.select("doc_id", F.col("lang").cast("string").alias("lang"), "text", slot().alias("slot"))
    return trusted_rows(rows.mapInArrow(pick, f"doc_id {kind}, lang string, text binary"), labels)


def _fitted(docs: DataFrame, labels: DataFrame, order: int, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """(scores, thresholds) of the documents, stored."""
    columns = only(docs, doc_id="doc_id", lang="lang", text="text")
    model = fit(_trusted_texts(columns, labels), order, BYTES)
    scores = materialize(scores_by_join(columns, model, order, BYTES), "scores")
    limits = thresholds(trusted_rows(scores, labels), low, high)
    return scores, materialize(limits, "thresholds")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    low: float = LOW,
    high: float = HIGH,
) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, least, most, kept) of every row.

    Models and thresholds of a language come from its trusted documents, all of them.
    A document is rejected if its perplexity lies outside the thresholds of its language,
    which are wider for short texts. Without
    text, or in a language without trusted text, the perplexity and the thresholds are null and the
    document is kept; a null language is a language of its own. Without labels
    everything is kept. Rows that repeat an id are scored one by one.
    """
    scores, limits = _fitted(docs, labels, order, low, high)
    bits, least, most = F.col("bits"), _bound("low"), _bound("high")
    return scores.join(limits, "lang", "left").select(
        "doc_id",
        "lang",
        F.col("n").alias("n_bytes"),
        F.pow(F.lit(2.0), bits).alias("perplexity"),
        F.pow(F.lit(2.0), least).alias("least"),
        F.pow(F.lit(2.0), most).alias("most"),
        F.coalesce((bits >= least) & (bits <= most), F.lit(True)).alias("kept"),
    )


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, least, most, kept of every row; see ``classify``."""
    return classify(docs, labels)


def drop_low_quality(
    docs: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    low: float = LOW,
    high: float = HIGH,
) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    Rejected rows are told by id and a hash of what they are scored by, so rows that repeat
    an id are judged one by one. The join is a shuffle at any size, see ``trusted_rows``.
    """
    scores, limits = _fitted(docs, labels, order, low, high)
    out = scores.join(limits, "lang").filter((F.col("bits") < _bound("low")) | (F.col("bits") > _bound("high")))
    out = out.select(F.col("doc_id").alias("_out_id"), F.col("key").alias("_out_key"))
    same = (F.col("_own_key") == F.col("_out_key")) & F.col("doc_id").eqNullSafe(F.col("_out_id"))
    return docs.withColumn("_own_key", _key()).join(out.hint("shuffle_hash"), same, "left_anti").drop("_own_key")
