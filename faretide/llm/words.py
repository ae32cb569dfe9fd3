"""Words of UTF-8 text, found and hashed on Arrow's bytes with numpy.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. These never occur inside a
multi-byte character, so texts need not be decoded. Rows are taken in blocks of about
``BLOCK`` bytes (one row at least), which bounds a task's memory by the block or, if that is
longer, by its longest text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

BLOCK = 1 << 19
BATCH_BYTES = 4 << 20
SPARKS_OWN = "67108864b"
MAX_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's last steps)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def constants(count: int, seed: int = 1) -> np.ndarray:
    """``count`` fixed odd 64-bit multipliers."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


BYTES = constants(256, 7)
LOWERED = BYTES.copy()
LOWERED[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]


def _power(kind: str, base: np.uint64, count: int) -> np.ndarray:
    if len(_powers[kind]) < count:
        size = max(count, 2 * BLOCK)
        steps = np.full(size, base)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:count]


@dataclass(slots=True)
class Block:
    """Some rows' texts, end to end: ``offsets`` has where each begins, and the end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and for each row the number of its first word."""
        inside = NOT_SPACE[self.data]
        edges = self.offsets[:-1][self.offsets[:-1] < len(self.data)]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        starts[edges] = inside[edges]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = edges[edges > 0] - 1
        ends[edges] = inside[edges]
        start = np.flatnonzero(starts)
        return start, np.flatnonzero(ends) + 1, np.searchsorted(start, self.offsets)

    def sums(self, table: np.ndarray = BYTES) -> np.ndarray:
        """Prefix sums for :meth:`hashes`; ``table`` gives each byte's number."""
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(table[self.data] * _power("up", _BASE, len(self.data)), out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of each span of bytes, the same wherever the span stands."""
        return mix((sums[end] - sums[start]) * _power("down", _INVERSE, len(sums))[start])


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, for which Arrow batches end at ``BATCH_BYTES``, or where the session says.

    Batches of a fixed number of rows would grow with the texts. The setting stays with the
    session, since Spark reads it when the plan is run.
    """
    conf = docs.sparkSession.conf
    if conf.get(MAX_BYTES) == SPARKS_OWN:
        conf.set(MAX_BYTES, str(BATCH_BYTES))
    return docs


def shared(docs: DataFrame, value: object):
    """A broadcast of ``value`` for :func:`received`, with the code of its classes.

    A plain broadcast names classes by their module, which executors do not have.
    """
    return docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))


def received(broadcast) -> object:
    """What :func:`shared` was given, built once by each task that asks."""
    return pickle.loads(broadcast.value)


def blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[Block]:
    """The column's texts in blocks; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), len(column))
        yield Block(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``width`` words in a row of one text, and their first words' numbers."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for k, factor in enumerate(constants(width, 3)):
        total += hashes[k : k + count] * factor
    left = np.repeat(first[1:], np.diff(first))[:count]
    at = np.flatnonzero(left - np.arange(count) >= width)
    return mix(total[at]), at


def shingles(block: Block, width: int, table: np.ndarray = BYTES):
    """Each row's set of word shingles as sorted hashes: values and where each row's begin.

    A row with fewer words has one shingle, its whole sequence; one without words has none.
    """
    start, end, first = block.spans()
    words = block.hashes(block.sums(table), start, end)
    values, at = windows(words, first, width)
    counts = np.diff(first)
    rows = np.searchsorted(first, at, "right") - 1
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k, factor in enumerate(constants(width, 3)):
            has = counts[short] > k
            whole[has] += words[first[short[has]] + k] * factor
        values = np.concatenate([values, mix(whole + counts[short].astype(np.uint64))])
        rows = np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
    bounds = np.searchsorted(rows, np.arange(block.rows + 1))
    values = values.copy()
    keep = np.ones(len(values), bool)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        values[low:high].sort()
    if len(values):
        keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return values[keep], kept[bounds]


def doc_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column of 64-bit numbers."""
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(values.view(np.int64)))
