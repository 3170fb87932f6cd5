"""Vectorised words and hashes over the bytes of Arrow text columns.

All byte classes used here treat bytes of 0x80 and above alike, so words of UTF-8
text can be found on bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: rows are worked on in runs of so many bytes, a longer row in parts of it; arrays of
#: eight bytes for each of them stay in a core's cache
RUN_BYTES = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def byte_table(gaps: bytes) -> np.ndarray:
    """True for each byte that belongs to words."""
    table = np.ones(256, dtype=bool)
    table[list(gaps)] = False
    return table


#: words [^\x20\x09-\x0D]+
SPACED = byte_table(b" \t\n\x0b\x0c\r")
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
PLAIN = byte_table(bytes(b for b in range(128) if not (48 <= b < 58 or 97 <= b < 123)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), offsets


def packed(data: bytes) -> bytes:
    """Bytes compressed, after their number, for the way through a shuffle."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.Codec("zstd", 1).decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def by_byte(numbers: np.ndarray) -> bytes:
    """Numbers packed: the first byte of all, then the second one, as most bytes of sorted ones say little."""
    return packed(numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes())


def values(data: bytes | None, kind) -> np.ndarray:
    """What ``by_byte`` has packed."""
    if not data:
        return np.empty(0, kind)
    rows = np.frombuffer(unpacked(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T
    return np.ascontiguousarray(rows).view(kind).ravel()


def packed_texts(column: pa.Array) -> pa.Array:
    """Each text packed; null stays null."""
    return pa.array([None if t is None else packed(t) for t in column.cast(pa.large_binary()).to_pylist()], pa.binary())


def unpacked_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of packed texts, as ``utf8`` gives those of a string column."""
    texts = [unpacked(t) if t else b"" for t in column.to_pylist()]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of runs of rows that hold ``most`` bytes at most, or one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


@cache
def _byte_values() -> np.ndarray:
    return mixed(mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * powers(len(data) + 1)[0][: len(data)], out=total[1:])
    return total


def span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((total[ends] - total[starts]) * powers(len(total))[1][starts])


def words(data: np.ndarray, cuts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words; no word goes over a cut.

    ``cuts`` are the offsets of the rows, from 0 to len(data). Hashing goes part
    by part, so memory beside the words stays small for a very long row.
    """
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    held = table[data]
    joined = held[:-1] & held[1:]
    inner = cuts[(cuts > 0) & (cuts < len(data))]
    joined[inner - 1] = False
    starts = np.flatnonzero(held & ~np.concatenate(([False], joined)))
    ends = np.flatnonzero(held & ~np.concatenate((joined, [False]))) + 1
    hashes = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + 2 * RUN_BYTES)))
        at = starts[a]
        total = rolling(data[at : ends[b - 1]])
        hashes[a:b] = span_hashes(total, starts[a:b] - at, ends[a:b] - at)
        a = b
    return starts, ends, hashes


def rows_of(positions: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The row of each byte position."""
    return np.searchsorted(cuts, positions, side="right") - 1


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes."""
    n = max(len(hashes) - k + 1, 0)
    total = hashes[:n].copy()
    for j in range(1, k):
        total = total * _STEP + hashes[j : n + j]
    return mixed(total)
