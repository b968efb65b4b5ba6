"""Words and hashes of Arrow text columns, computed on their UTF-8 bytes with numpy.

Texts are handled whole. Work goes in runs of documents of about 2 MB, so memory follows the
longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finisher)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed))


def _lowered() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[65:91] += 32
    return low


LOWER = _lowered()
#: Byte values that belong to words: all but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# The two largest primes below 2^31. A word's polynomials modulo two primes do not vanish
# together by structure, as one modulo 2^64 does for long words that repeat by powers of two.
PRIMES = (2147483647, 2147483629)
_VALUES = [(v % np.uint64(p)).astype(np.uint64) for v, p in zip((seeds(256, 11)[LOWER], seeds(256, 13)[LOWER]), PRIMES)]


class _Powers:
    """Powers of a base modulo a prime and of its inverse, as far as a text has needed."""

    def __init__(self, prime: int):
        self.prime, self.base = prime, int(_BASE % prime)
        self.up, self.down = np.ones(1, np.uint32), np.ones(1, np.uint32)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (self._table(b, size) for b in (self.base, pow(self.base, -1, self.prime)))
        return self.up[:n], self.down[:n]

    def _table(self, base: int, size: int) -> np.ndarray:
        out = np.empty(size, np.uint32)
        out[0], done = 1, 1
        while done < size:
            step = np.uint64(pow(base, done, self.prime))
            out[done : 2 * done] = out[:done].astype(np.uint64) * step % np.uint64(self.prime)
            done *= 2
        return out


powers = [_Powers(p) for p in PRIMES]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 62-bit hash of each span of bytes, ASCII letters lower-cased, the same wherever it lies."""
    parts = []
    for values, table in zip(_VALUES, powers):
        prime = np.uint64(table.prime)
        up, down = table.get(max(len(data), 1))
        terms = values[data]
        terms *= up[: len(data)]
        terms %= prime
        # Below 2^31 each, so the sum of up to 2^32 terms fits.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        parts.append((sums[ends] - sums[starts]) % prime * down[starts] % prime)
    return mixed(parts[0] << np.uint64(31) | parts[1])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets between them; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive documents [a, b) of about `limit` bytes, one at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


class Words:
    """Words of a run of texts: byte spans, 62-bit hashes of their ASCII-lower-cased bytes, and
    the index of each text's first word (`first` has one more entry than there are texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
        self.data, self.kind = data, kind
        n = len(data)
        word = kind[data]
        start, end = word.copy(), word.copy()
        if n:
            start[1:] &= ~word[:-1]
            end[:-1] &= ~word[1:]
            at = offsets[(offsets > 0) & (offsets < n)]  # texts touch each other without a gap
            start[at] = word[at]
            end[at - 1] = word[at - 1]
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    @cached_property
    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def letters(self) -> tuple[np.ndarray, np.ndarray]:
        """The lower-cased bytes of all words, one after the other, and the n + 1 offsets between them."""
        return LOWER[self.data[self.kind[self.data]]], np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)

    def bytes_of(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()


def pieces(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[pa.Array]:
    """Slices of about `limit` bytes, one text at least; nothing is copied."""
    at = np.asarray(pc.fill_null(pc.cumulative_sum(pc.cast(pc.binary_length(column), pa.int64()), skip_nulls=True), 0))
    for a, b in runs(np.concatenate([[0], np.maximum.accumulate(at)]).astype(np.int64), limit):
        yield column.slice(a, b - a)


def word_runs(column: pa.Array, kind: np.ndarray, limit: int = RUN_BYTES) -> Iterator[Words]:
    for piece in pieces(column, limit):
        yield Words(*text_bytes(piece), kind)
