"""Runs of words that repeat with a period, found by minimizers at several scales.

A run is a stretch with smallest period q and at least ``max(least, power * q)`` words that no
neighbour extends. Words of a block of rows become numbers (equal numbers, equal words), with a
number of its own between two rows, so that nothing reaches over a row's end.

*Direct scans.* For q up to ``direct``, words q apart are compared over the whole block, and
stretches of matches long enough are runs.

*Scales.* For periods in (P, 2P], P = direct, 2 * direct, ..., every 2P words in a row get a hash,
and each window of P of them marks its minima. Inside a run, the window one period on holds the
same hashes, so its minima stand one period on; and 2P words that cover the smallest period
recur inside the run at multiples of it only. So a minimum and the next equal one in the row stand
exactly one period apart, and that pair seeds the run: a run has a window and its copy inside
because it holds four periods. Pairs whose distance belongs to another scale are left to it. Seeds
are extended by comparing words, not hashes, so no false run comes out; a run would be missed only
if hashes of 64 bits collided inside its text.

Stretches found with a multiple of their smallest period coincide with the run itself, and the
smallest period of each stretch is kept. Work on a row is its length times the number of scales,
squared in that number; nothing is shuffled, and a row's memory is a few arrays of its words.

Defined results: a NULL or empty text, or one of white space, has no words and no run. A NULL id
stays NULL, and its text is not edited. Repeated rows are measured each. Of runs with the same
exponent (ties) the one that starts first is the greatest, then the one with the smaller period.
Very long texts are a block of their own, taken whole. Other columns are not read, whatever their
names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from faretide.llm.words import NOT_SPACE, Block, blocks, bounded, constants, doc_column, mix

LEAST, POWER = 6, 4
#: Periods up to here are found by comparing words so far apart.
DIRECT = 16

COLUMNS = (
    "n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def word_array(block: Block) -> tuple[pa.Array, np.ndarray]:
    """The block's words as one array, and for each row the number of its first word."""
    start, end, first = block.spans()
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    letters = np.ascontiguousarray(block.data[NOT_SPACE[block.data]])
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]
    return pa.Array.from_buffers(pa.large_binary(), len(start), buffers), first


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of True begin and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], equal.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _slide(values: np.ndarray, width: int, keep: Callable) -> np.ndarray:
    """Of every ``width`` (a power of two) values in a row, the one that ``keep`` prefers."""
    step = 1
    while step < width:
        values = keep(values[:-step], values[step:])
        step *= 2
    return values


def _minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least hash of some window of ``width``."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    least = _slide(hashes, width, np.minimum)
    # A position's hash is the greatest of the minima around it only if it is one of them.
    pad = np.zeros(width - 1, np.uint64)
    around = _slide(np.concatenate([pad, least, pad]), width, np.maximum)
    return np.flatnonzero(around == hashes)


def _seeds(hashes: np.ndarray, rows: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of next equal minima of one row, ``scale`` to twice that apart: first and distance."""
    at = _minima(hashes, scale)
    order = np.argsort(hashes[at], kind="stable")
    at = at[order]
    apart = np.diff(at)
    good = (hashes[at[1:]] == hashes[at[:-1]]) & (rows[at[1:]] == rows[at[:-1]])
    good &= (apart > scale) & (apart <= 2 * scale)
    return at[:-1][good], apart[good]


def _reach(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from ``at`` on (or back, with ``step`` -1) equal those a period later."""
    count, chunk = 0, 64
    while True:
        low = at + count if step > 0 else at - count - chunk
        high = low + chunk
        low, high = max(low, 0), min(high, len(words) - period)
        if low >= high:
            return count
        equal = words[low:high] == words[low + period : high + period]
        if not equal.all():
            return count + int(equal.argmin() if step > 0 else equal[::-1].argmin())
        count += high - low
        chunk *= 2


def _extended(words: np.ndarray, at: np.ndarray, apart: np.ndarray):
    """Maximal stretches ``(start, end, period)`` that hold the seeds, each once."""
    order = np.lexsort((at, apart))
    at, apart = at[order], apart[order]
    bounds = np.flatnonzero(np.diff(apart, prepend=-1, append=-1))
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        period, k = int(apart[low]), low
        while k < high:
            seed = int(at[k])
            start = seed - _reach(words, seed, period, -1)
            end = seed + _reach(words, seed, period, 1) + period
            yield start, end, period
            # The next seed that this stretch does not hold.
            k = max(k + 1, low + int(np.searchsorted(at[low:high], end - period)))


def find_runs(
    words: np.ndarray, first: np.ndarray, least: int = LEAST, power: int = POWER, direct: int = DIRECT
) -> np.ndarray:
    """Runs of each row's words: ``(row, start, length, period)``, by row, start and period.

    ``words`` are numbers of all rows' words, end to end, and ``first`` says where each row begins.
    ``power`` is 4 at least, and ``direct`` a power of two.
    """
    if power < 4:
        raise ValueError("minimizers find runs of four periods and more")
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts + 1)
    own = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)
    line = -1 - np.arange(len(rows), dtype=np.int64)  # a number that stands nowhere else
    line[own] = words
    begin = first[:-1] + np.arange(len(counts))
    found = []
    for period in range(1, min(direct, int(counts.max(initial=0)) // power) + 1):
        low, high = _stretches(line[:-period] == line[period:])
        long = high - low + period >= max(least, power * period)
        found.append(np.stack([low[long], high[long] + period, np.full(long.sum(), period)]))
    hashes, width, scale = mix(line.view(np.uint64)), 1, direct
    left, right = constants(2, 21)
    kept = np.arange(len(line))
    while len(hashes) and counts.max(initial=0) > power * scale:
        # Rows too short for a run of this scale are left out.
        stay = counts[rows[kept[: len(hashes)]]] > power * scale
        hashes, kept = hashes[stay], kept[: len(hashes)][stay]
        while width < 2 * scale and len(hashes):
            hashes = mix(hashes[:-width] * left + hashes[width:] * right)
            width *= 2
        at, apart = _seeds(hashes, rows[kept], scale)
        for start, end, period in _extended(line, kept[at], apart):
            if end - start >= max(least, power * period):
                found.append(np.array([[start], [end], [period]]))
        scale *= 2
    if not found:
        return np.zeros((4, 0), np.int64)
    start, end, period = np.concatenate(found, axis=1).astype(np.int64)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    row = rows[start]
    return np.stack([row, start - begin[row], end - start, period])[:, np.lexsort((period, start))]


def repeat_from(words: int, key: int) -> tuple[int, int]:
    """Where the contract's edit of a text of so many words begins, and its period."""
    part = key // 10
    at = part % words
    return at, 1 + (words - at) // (3 + part % 8)


def edited(first: np.ndarray, ids: list) -> np.ndarray:
    """For each word of each row the word that stands there after the edit of chosen rows."""
    out = np.arange(first[-1])
    for row, name in enumerate(ids):
        low, high = int(first[row]), int(first[row + 1])
        key = zlib.crc32(str(name).encode()) if name is not None else 1
        if key % 10 == 0 and high > low:
            at, period = repeat_from(high - low, key)
            out[low + at : high] = low + at + np.arange(high - low - at) % period
    return out


def _greatest(runs: np.ndarray, rows: int) -> np.ndarray:
    """For each row the column of its run of greatest exponent, or -1.

    Two quotients less than 1 whose divisors are below 2**26 differ by more than doubles round.
    """
    row, start, length, period = runs
    order = np.lexsort((period, start, -(length % period / period), -(length // period), row))
    out = np.full(rows, -1)
    row = row[order]
    head = np.ones(len(row), bool)
    head[1:] = row[1:] != row[:-1]
    out[row[head]] = order[head]
    return out


def _digests(column: pa.Array) -> list[str]:
    return [sha256(value.as_buffer()).hexdigest() for value in column]


def describe_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: bool = False,
    least: int = LEAST, power: int = POWER, direct: int = DIRECT, spans: bool = False,
) -> DataFrame:
    """Each row's id, its runs in figures and digests, and what stays when they are collapsed.

    A collapsed text has each run's first period only. ``edit`` repeats part of the rows whose id
    says so, as a test with known runs. ``spans`` adds the runs themselves and the collapsed text.
    """
    texts = bounded(docs).select(docs[id_col], docs[text_col].alias("__text"))
    names = [id_col, *(part.split()[0] for part in COLUMNS.split(", "))]

    def measure_block(block: Block, ids: pa.Array) -> list[pa.Array]:
        words, first = word_array(block)
        if edit:
            words = words.take(pa.array(edited(first, ids.to_pylist())))
        numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        runs = find_runs(numbers, first, least, power, direct)
        row, start, length, period = runs
        bounds = np.searchsorted(row, np.arange(block.rows + 1))
        best = _greatest(runs, block.rows)
        none = best < 0
        pick = lambda values: pa.array(values[best] if len(values) else best, mask=none)
        lines = [f"{s},{n},{q}\n" for _, s, n, q in runs.T.tolist()]
        listed = ["".join(lines[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        dropped = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(dropped, first[row] + start + period, 1)
        np.add.at(dropped, first[row] + start + length, -1)
        stays = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
        kept = pa.LargeListArray.from_arrays(
            np.searchsorted(stays, first), words.take(pa.array(stays))
        )
        collapsed = pc.binary_join(kept, pa.scalar(b" ", pa.large_binary()))
        out = [
            pa.array(np.diff(bounds)), pick(start), pick(length), pick(period),
            pick(1000 * length // np.maximum(period, 1)),
            pa.array([sha256(text.encode()).hexdigest() for text in listed]),
            pa.array(_digests(collapsed)),
        ]
        if spans:
            values = [pa.array(v) for v in (start, length, period)]
            structs = pa.StructArray.from_arrays(values, ["start", "length", "period"])
            out.append(pa.ListArray.from_arrays(bounds.astype(np.int32), structs))
            out.append(collapsed.cast(pa.large_string()).cast(pa.string()))
        return out

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(doc_column(batch, "__text")):
                ids = batch.column(0).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([ids, *measure_block(block, ids)], names)

    kind = texts.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {COLUMNS}"
    if spans:
        names += ["runs", "collapsed"]
        schema += ", runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts.mapInArrow(measure, schema)
