"""Token ids of whole texts, with every distinct chunk encoded once.

A text is cut before ASCII white space that follows a visible character. No token of the
vocabularies used here spans such a place (each user says why), so the ids of a text are those of
its chunks in a row. Equal chunks are found by Arrow's dictionary encoding, which compares bytes;
their ids are kept by their bytes up to a bound. The cost follows the number of distinct chunks.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import SparkSession

#: Bounds of what an encoder keeps from one run of texts to the next.
KEPT_CHUNKS = 1 << 18
KEPT_BYTES = 32 << 20


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a local file of the driver to all executors; the name that `shipped` finds it by."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped(name: str) -> str:
    return SparkFiles.get(name)


def flags(values: Iterable[int]) -> np.ndarray:
    marked = np.zeros(256, bool)
    marked[list(values)] = True
    return marked


SPACES = flags([0x20, *range(0x09, 0x0E)])
BLANK = flags([0x20])
_VISIBLE = flags(range(0x21, 0x7F))
_CONTINUED = flags(range(0x80, 0xC0))
# Lead bytes of characters that are never white space: it has the leads C2, E1, E2 and E3 only.
_LEAD2 = flags(range(0xC3, 0xE0))
_LEAD3 = flags(range(0xE4, 0xF0))
_LEAD4 = flags(range(0xF0, 0xF5))


def cuts(data: np.ndarray, spaces: np.ndarray) -> np.ndarray:
    """Positions of `spaces` bytes behind a visible character, in UTF-8 bytes."""
    at = np.flatnonzero(spaces[data])
    at = at[at > 0]
    last = data[at - 1]
    seen = _VISIBLE[last]
    wide = np.flatnonzero(_CONTINUED[last])
    for back, leads in ((2, _LEAD2), (3, _LEAD3), (4, _LEAD4)):
        near = wide[at[wide] >= back]
        seen[near] |= leads[data[at[near] - back]]
    return at[seen]


def repeated(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions begin[i] .. begin[i] + size[i] - 1 of all i in a row."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - total + size, size)


class Strings:
    """Byte strings by number."""

    def __init__(self, values: Sequence[bytes]):
        self.values = pa.array(values, pa.large_binary())
        self.size = np.array([len(v) for v in values], np.int64)

    def joined(self, numbers: np.ndarray) -> pa.Buffer:
        """The bytes of all strings in a row."""
        return self.values.take(pa.array(numbers)).buffers()[2] or pa.py_buffer(b"")


class Chunks:
    """The distinct chunks of a run of texts, and which of them the texts are made of."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray):
        starts = np.sort(np.concatenate([cuts(data, spaces), offsets[:-1][np.diff(offsets) > 0]]))
        starts = starts[np.append(True, starts[1:] != starts[:-1])[: len(starts)]]
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        buffers = [None, bounds, pa.py_buffer(np.ascontiguousarray(data))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        self.distinct, self.which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        self.first = np.searchsorted(starts, offsets)


class ChunkEncoder:
    """Ids of runs of texts, from `encode`, which gives the ids of each chunk of a list."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[Sequence[int]]]):
        self.encode_chunks = encode
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends, self.kept = array("i"), array("q", [0]), 0

    def numbers(self, chunks: list[bytes]) -> list[int]:
        """Where the ids of each chunk are kept."""
        found = list(map(self.known.get, chunks))
        missing = [c for c, at in zip(chunks, found) if at is None]
        if not missing:
            return found
        for chunk, ids in zip(missing, self.encode_chunks(missing)):
            self.known[chunk] = len(self.ends) - 1
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
            self.kept += len(chunk)
        return list(map(self.known.__getitem__, chunks))

    def encode(self, chunks: Chunks) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the n + 1 offsets of the texts in them."""
        if len(self.known) > KEPT_CHUNKS or self.kept > KEPT_BYTES:
            self.clear()
        at = np.array(self.numbers(chunks.distinct), np.int64)[chunks.which]
        ends = np.array(self.ends)
        begin, size = ends[at], ends[at + 1] - ends[at]
        ids = np.array(self.ids)[repeated(begin, size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[chunks.first]
