"""Vectorised byte, word and hash work on Arrow text columns, shared by the operators.

Everything here runs inside Spark tasks on slices of a quarter of a megabyte, so a batch of long texts never multiplies
into gigabytes of intermediate arrays. A null text is an empty text. One text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 1 << 18

#: Bytes that separate words: space and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of letter-or-digit words: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20)
_BYTE_VALUES = [_random.integers(1, 2**64, 256, dtype=np.uint64) for _ in range(2)]
_BASES = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
_INVERSES = [np.uint64(pow(int(b), -1, 2**64)) for b in _BASES]
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: int, inverse: bool, n: int) -> np.ndarray:
    held = _powers.get((kind, inverse))
    if held is None or len(held) < n:
        size = max(n, SLICE_BYTES + 1)
        held = np.full(size, (_INVERSES if inverse else _BASES)[kind], np.uint64)
        held[0] = 1
        held = np.cumprod(held, dtype=np.uint64)
        if size <= 16 * SLICE_BYTES:
            _powers[kind, inverse] = held
    return held[:n]


class PrefixHash:
    """Hashes of any byte ranges of a buffer, equal for equal bytes at any place."""

    def __init__(self, data: np.ndarray, kind: int = 0):
        self.kind = kind
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[kind][data] * _power(kind, False, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.back = _power(kind, True, len(data) + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spread = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(spread + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Slice:
    """Consecutive rows of a batch: their texts as one buffer, text i at bounds[i]:bounds[i + 1]."""

    batch: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name)

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self, places: np.ndarray) -> np.ndarray:
        """The row of each place in the buffer."""
        return np.searchsorted(self.bounds, places, "right") - 1


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.fill_null("").cast(pa.large_binary())
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    return data, bounds


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if not batch.num_rows:
        return
    data, bounds = text_buffer(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        own = bounds[first : last + 1]
        yield Slice(batch.slice(first, last - first), data[own[0] : own[-1]], own - own[0])
        first = last


def map_slices(frame: DataFrame, work: Callable[[Slice], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """Apply ``work`` to the slices of the ``text`` column in every task; rows come out as ``schema`` says."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out

    return frame.mapInArrow(run, schema)


def words(part: Slice, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``letters``, never across texts."""
    inside = letters[part.data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(len(inside) + 1, bool)
    edge[part.bounds] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def per_row(rows: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts, or sums of whole numbers, by row."""
    if weights is None:
        return np.bincount(rows, minlength=count).astype(np.int64)
    return np.rint(np.bincount(rows, weights=weights, minlength=count)).astype(np.int64)


def sequence_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbouring 64-bit values; the last width - 1 places have none."""
    n = max(len(values) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0xC6A4A7935BD1E995) + values[k : k + n]
    return mix(out)


def most_frequent(frame: DataFrame, count: str, limit: int) -> DataFrame:
    """The rows of the highest counts: all that reach a level which at most ``limit`` rows reach.

    Only a histogram of count levels (64 an octave) comes to the driver; nothing is sorted.
    """
    level = F.floor(F.log2(count) * 64)
    sizes = frame.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least = 0, None
    for own in sorted(sizes, key=lambda r: -r.level):
        if taken + own.n > limit:
            break
        taken, least = taken + own.n, own.level
    return frame.where(level >= least) if least is not None else frame.limit(0)


def documents(frame: DataFrame, *columns: str) -> DataFrame:
    """Just the named columns of a documents table, whatever else it carries."""
    return frame.select(*[F.col(f"`{c}`") for c in columns])
