"""Helpers for Arrow batches of texts: bounded slices, raw UTF-8 bytes, word and shingle hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that its powers have inverses modulo 2**64


def drop_columns(df: DataFrame, names) -> DataFrame:
    """Without the columns that an operator adds itself (names are case-insensitive, as in Spark)."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def free_names(columns, *names: str) -> list[str]:
    """Names for helper columns that no column has (names are case-insensitive, as in Spark)."""
    low = {c.lower() for c in columns}
    out = []
    for name in names:
        while name in low:
            name = f"_{name}"
        out.append(name)
        low.add(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each stay below ``limit`` bytes, or are a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the bounds of its rows."""
    column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]] if data is not None and len(offs) else np.zeros(0, np.uint8)
    return buf, offs - offs[0] if len(offs) else np.zeros(1, np.int64)


def byte_class(ranges) -> np.ndarray:
    """A table of 256 flags that is true for the bytes in the (first, last) ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a: b + 1] = True
    return out


# Separators of the two kinds of words: white space; ASCII other than letters and digits.
WHITE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
NOT_ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41: 0x5B] += 32


def word_bounds(buf: np.ndarray, offs: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-last byte of every word, and the words' bounds per row."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    inner = ~sep[buf]
    edge = np.zeros(len(buf) + 1, bool)  # a row begins here
    edge[offs] = True
    first = inner & edge[:-1]
    first[1:] |= inner[1:] & ~inner[:-1]
    last = inner & edge[1:]
    last[:-1] |= inner[:-1] & ~inner[1:]
    last[-1] |= inner[-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), base & _MASK, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class RollingHash:
    """64-bit hashes of byte ranges by prefix sums of byte values times powers."""

    CHUNK = 1 << 20

    def __init__(self):
        self.values = _byte_values()
        self.up = powers(self.CHUNK)
        self.down = powers(self.CHUNK, pow(_BASE, -1, 1 << 64))

    def tables(self, n: int):
        """Powers of the base and of its inverse, n of each at least."""
        if n > len(self.up):
            self.up, self.down = powers(n), powers(n, pow(_BASE, -1, 1 << 64))
        return self.up, self.down

    def ranges(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of every buf[start:end]; starts ascending, ranges short or disjoint."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + self.CHUNK, "right")))
            a, b = int(starts[i]), int(ends[j - 1])
            up, down = self.tables(b - a + 1)
            pre = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.values[buf[a:b]] * up[: b - a], out=pre[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((pre[e] - pre[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
            i = j
        return out


def word_hashes(hasher: RollingHash, column: pa.Array, sep: np.ndarray, lower: bool = True):
    """Hashes of all words of a text column and the words' bounds per row."""
    buf, offs = utf8(column)
    if lower:
        buf = LOWER[buf]
    starts, ends, rows = word_bounds(buf, offs, sep)
    return hasher.ranges(buf, starts, ends), rows


def shingles(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles and their bounds per row; a row with
    fewer words, but not none, has one shingle of all its words."""
    size = np.diff(rows)
    count = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    n = len(words)
    total = np.zeros(n, np.uint64)
    factor = powers(k + 1, _BASE * _BASE & _MASK)
    row_end = np.repeat(rows[1:], size)
    at = np.arange(n)
    for j in range(k):  # a word past the end of its row adds nothing
        ok = at + j < row_end
        total[ok] += words[at[ok] + j] * factor[j + 1]
    keep = at - np.repeat(rows[:-1], size) < np.repeat(count, size)
    return mix(total[keep]), bounds


class Forest:
    """Union-find over positions, with many links joined at once."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        x = self.root[x]
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            x = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.find(a), self.find(b)
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            high, low = np.maximum(x, y), np.minimum(x, y)
            root, at = np.unique(high, return_index=True)  # each root gets one smaller parent a round
            self.root[root] = low[at]
