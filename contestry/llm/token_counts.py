"""Token counts by a whole-token shortcut.

Which strings of the vocabulary encode alone as one token is proved once, on the
driver, with the tokenizer itself. A pre-token among them counts 1; only the rest
go through the tokenizer's merges, each different one once.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from contestry.llm import text as tx
from contestry.llm.columns import only, whole_text

LIMIT = 512
#: pre-tokens of byte-level BPE
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: characters of merged pre-tokens that a task remembers; beyond that it starts anew
REMEMBERED = 8_000_000
#: stands for the count of a pre-token with characters on which the two Unicode tables may differ
_UNSURE = -(1 << 60)


def _unassigned() -> str:
    """A class of the characters that Python's own Unicode table leaves unassigned.

    On all others the pattern above and the tokenizer find the same pre-tokens;
    tests/llm holds them against each other.
    """
    free = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    starts = [c for i, c in enumerate(free) if i == 0 or free[i - 1] != c - 1]
    ends = [c for i, c in enumerate(free) if i == len(free) - 1 or free[i + 1] != c + 1]
    return "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in zip(starts, ends)) + "]"


class TokenCounter:
    """Counts what a byte-level BPE tokenizer file gives, added tokens included."""

    def __init__(self, definition: str) -> None:
        self.definition = definition
        rules = json.loads(definition)
        kind = rules["pre_tokenizer"]
        if kind["type"] != "ByteLevel" or kind["add_prefix_space"] or rules["normalizer"]:
            raise ValueError("only byte-level pre-tokens of unchanged text can be counted")
        self.added = sorted((t["content"] for t in rules["added_tokens"]), key=len, reverse=True)
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in rules["added_tokens"]):
            raise ValueError("added tokens that look at their neighbours can't be counted")
        self.whole = self._prove()
        self._open()

    def _open(self) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_str(self.definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pattern = regex.compile(PRE_TOKENS)
        self.unsure = re.compile(_unassigned())
        self.split = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.cost, self.remembered = dict.fromkeys(self.whole, 1), 0

    def _prove(self) -> list[str]:
        """The vocabulary's strings that are one pre-token and encode as one token."""
        tokenizer = Tokenizer.from_str(self.definition)
        pattern = regex.compile(PRE_TOKENS)
        ids = sorted(set(tokenizer.get_vocab().values()))
        texts = [t for t in map(tokenizer.decode, ([i] for i in ids)) if t and "�" not in t]
        encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
        special = set(self.added)
        return [
            t for t, e in zip(texts, encoded) if len(e.ids) == 1 and t not in special and pattern.findall(t) == [t]
        ]

    def __reduce__(self):
        return _opened, (self.definition, self.added, self.whole)

    def counts(self, texts: list[str]) -> list[int]:
        rows = []
        for text in texts:
            parts = self.split.split(text) if self.split else [text]
            rows.append((len(parts) - 1, [p for part in parts if part for p in self.pattern.findall(part)]))
        self._merge(set().union(*(r[1] for r in rows)))
        cost = self.cost.__getitem__
        counts = [n + sum(map(cost, pieces)) for n, pieces in rows]
        return [n if n >= 0 else len(self.tokenizer.encode(t, add_special_tokens=False).ids) for n, t in zip(counts, texts)]

    def _merge(self, pieces: set[str]) -> None:
        if self.remembered > REMEMBERED:
            self.cost, self.remembered = dict.fromkeys(self.whole, 1), 0
        rest = [p for p in pieces if p not in self.cost]
        self.remembered += sum(map(len, rest))
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.cost[p] = len(e.ids) if p.isascii() or not self.unsure.search(p) else _UNSURE


def _opened(definition: str, added: list[str], whole: list[str]) -> TokenCounter:
    """A counter on an executor: what was proved comes with it."""
    counter = object.__new__(TokenCounter)
    counter.definition, counter.added, counter.whole = definition, added, whole
    counter._open()
    return counter


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row, over whole texts.

    Null counts as the empty text, with 0 tokens. Strings of added tokens inside
    a text count as that token, as the library has it. Rows don't meet, so
    repeated ids and an empty table need no care.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        counter = TokenCounter(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(counter)  # the vocabulary bounds its size

    def count(batches):
        for batch in batches:
            column = batch.column("text")
            n_tokens: list[int] = []
            for a, b in tx.runs(tx.utf8(column)[1]):
                n_tokens += shared.value.counts(column[a:b].to_pylist())
            yield batch.drop_columns(["text"]).append_column("n_tokens", pa.array(n_tokens, pa.int64()))

    text = whole_text("text")
    rows = only(docs, doc_id="doc_id", text="text").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    return rows.mapInArrow(count, rows.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).schema)


def token_report(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    return token_counts(docs, tokenizer_path).withColumn("over_limit", F.col("n_tokens") > limit)
