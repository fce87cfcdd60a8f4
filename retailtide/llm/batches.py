"""Small helpers for the operators that work on Arrow batches inside tasks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bytes of text that a task looks at together; a longer text stands alone.
SLICE_BYTES = 4 << 20

# Factor of the polynomial word hash, any odd number, and its inverse.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# ASCII letters and digits, and every byte of a longer UTF-8 sequence
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
# all bytes but blank and \t \n \v \f \r
_INK = np.ones(256, dtype=bool)
_INK[[32, *range(9, 14)]] = False


_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def map_batches(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers also look for this package where the driver found it."""
    environment = frame.sparkSession.sparkContext.environment
    known = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if _HOME not in known:
        environment["PYTHONPATH"] = os.pathsep.join([_HOME, *known])
    return frame.mapInArrow(run, schema)


def unused(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` does not have, whatever the case of its own."""
    taken = {column.lower() for column in frame.columns}
    while name in taken:
        name += "_"
    return name


def text_slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins and the last ends."""
    raw = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[raw.offset : raw.offset + len(raw) + 1]
    if not len(ends) or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(raw) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse, for at least ``size`` places."""
    if _POWERS.get("size", 0) < size:
        size = max(size, SLICE_BYTES + (1 << 16))
        with np.errstate(over="ignore"):
            for name, base in (("up", _FACTOR), ("down", _INVERSE)):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                _POWERS[name] = np.multiply.accumulate(table)
        _POWERS["size"] = size
    return _POWERS["up"], _POWERS["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Words:
    """The words of a slice: ``start`` and ``end`` byte, ``doc`` row and 64-bit ``hash`` of each.

    ``ink`` words are runs without ASCII white space; others are runs of letters
    and digits (any non-ASCII character counts as one). ``lower`` folds A-Z.
    ``first`` has the number of words before each document, and of all.
    """

    def __init__(self, column: pa.Array, ink: bool = False, lower: bool = True):
        data, self.offsets = text_bytes(column)
        self.data = _LOWER[data] if lower else data
        inside = (_INK if ink else _WORD)[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        up, down = _powers(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, self.offsets)
        self.doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def word_hashes(text: str, ink: bool = False, lower: bool = True) -> np.ndarray:
    """Hashes of the words of one text, as in :class:`Words`."""
    return Words(pa.array([text], pa.string()), ink, lower).hash


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values[first[i]:first[i + 1]]`` for each i, 0 for none."""
    total = np.zeros(len(values) + 1, dtype=np.float64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
