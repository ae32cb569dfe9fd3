"""Quality rules on repetition: characters inside repeated n-grams and lines.

Words and lines of each whole text are hashed on its bytes with numpy. For every n-gram length a
window of words that occurs twice or more in the text marks all its words; the marked words'
characters over all words' characters is the coverage. Work is per row, so nothing is shuffled
and no source or group of copies can be hot.

Defined results: a NULL or empty text, or one of white space, has no words and fails
(``n_words < min_words``). A NULL id stays NULL. Repeated rows are measured each. Other columns
of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faretide.llm.words import Block, blocks, bounded, constants, doc_column, mix, windows

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
#: A byte that begins a character.
LEADING = (np.arange(256) & 0xC0) != 0x80

METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, dup_line_chars double, "
    "top_gram_chars double, repeat_chars double, symbol_share double"
)


@dataclass(frozen=True)
class Rules:
    """Bounds above which a text is rejected; shares are of the words' characters."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: by n-gram length: the characters inside windows that occur twice or more
    repeats: tuple[tuple[int, float], ...] = ((5, 0.35), (7, 0.30), (10, 0.25))
    #: by n-gram length: the characters of the most frequent repeated window
    tops: tuple[tuple[int, float], ...] = ((2, 0.30), (3, 0.28))
    dup_line_chars: float = 0.40
    dup_lines: float = 0.40
    symbols_per_word: float = 0.2


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    bits = max(10, int(len(keys)).bit_length() + 2)
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    again = np.flatnonzero(np.bincount(slots, minlength=1 << bits)[slots] > 1)
    out = np.zeros(len(keys), bool)
    if len(again):
        _, inverse, counts = np.unique(keys[again], return_inverse=True, return_counts=True)
        out[again] = counts[inverse] > 1
    return out


def _within(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys that can only be equal within one row of the block."""
    return mix(keys + constants(1, 11)[0] * (rows.astype(np.uint64) + np.uint64(1)))


def _covered(at: np.ndarray, width: int, words: int) -> np.ndarray:
    """Words inside the windows that begin at ``at``."""
    steps = np.zeros(words + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of each row's values."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _lines(block: Block, sums: np.ndarray, start: np.ndarray, end: np.ndarray, chars: np.ndarray):
    """By row: lines with a word, those equal to an earlier one, and the latter's characters."""
    breaks = np.flatnonzero(block.data == 10)
    begin = np.union1d(block.offsets[:-1], breaks + 1)
    begin = begin[begin < len(block.data)]
    stop = np.minimum(
        np.append(begin[1:], len(block.data)),
        np.append(breaks, len(block.data))[np.searchsorted(breaks, begin)],
    )
    low, high = np.searchsorted(start, begin), np.searchsorted(start, stop)
    full = high > low
    begin, stop, low, high = begin[full], stop[full], low[full], high[full]
    rows = np.searchsorted(block.offsets, begin, "right") - 1
    keys = _within(block.hashes(sums, begin, stop), rows)
    later = np.ones(len(keys), bool)
    later[np.unique(keys, return_index=True)[1]] = False
    size = (chars[high] - chars[low]) * later
    count = lambda weights=None: np.bincount(rows, weights, block.rows)
    return count(), count(later), count(size)


def measure_block(block: Block, rules: Rules) -> dict[str, np.ndarray]:
    """The metrics of a block's rows."""
    start, end, first = block.spans()
    sums = block.sums()
    words, counts = block.hashes(sums, start, end), np.diff(first)
    leading = np.concatenate([[0], np.cumsum(LEADING[block.data])])
    sizes = leading[end] - leading[start]
    chars = np.concatenate([[0], np.cumsum(sizes)])
    symbols = _by_row(SYMBOLS[block.data], block.offsets)
    word_chars = _by_row(sizes, first)
    some = np.maximum(word_chars, 1)
    rows = np.repeat(np.arange(block.rows), counts)
    lines, dup_lines, dup_chars = _lines(block, sums, start, end, chars)

    def grams(width):
        values, at = windows(words, first, width)
        keys = _within(values, rows[at])
        again = _repeated(keys)
        return keys[again], at[again]

    repeat_words = _by_row(_covered(grams(3)[1], 3, len(words)), first)
    repeat, top = np.zeros(block.rows), np.zeros(block.rows)
    bad = np.zeros(block.rows, bool)
    for width, most in rules.repeats:
        share = _by_row(_covered(grams(width)[1], width, len(words)) * sizes, first) / some
        repeat = np.maximum(repeat, share)
        bad |= share > most
    for width, most in rules.tops:
        keys, at = grams(width)
        unique, index, number = np.unique(keys, return_index=True, return_counts=True)
        size = (chars[at[index] + width] - chars[at[index]]) * number
        share = np.zeros(block.rows)
        np.maximum.at(share, rows[at[index]], size)
        share /= some
        top = np.maximum(top, share)
        bad |= share > most
    bad |= dup_chars > rules.dup_line_chars * some
    bad |= dup_lines > rules.dup_lines * np.maximum(lines, 1)
    bad |= symbols > rules.symbols_per_word * counts
    base = (counts < rules.min_words) | (100 * repeat_words > rules.max_repeat_percent * counts)
    return {
        "n_words": counts,
        "word_chars": word_chars,
        "n_symbols": symbols,
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": repeat_words,
        "base_failed": base,
        "kept": ~base & ~bad,
        "n_lines": lines.astype(np.int64),
        "dup_line_chars": dup_chars / some,
        "top_gram_chars": np.minimum(top, 1.0),
        "repeat_chars": repeat,
        "symbol_share": symbols / np.maximum(counts, 1),
    }


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """Each row's id and metrics, with the verdict ``kept``."""
    docs = bounded(docs).select(docs[id_col], docs[text_col].alias("__text"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in blocks(doc_column(batch, "__text")):
                found = measure_block(block, rules)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first, block.rows), *map(pa.array, found.values())],
                    [id_col, *found],
                )

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(measure, f"`{id_col}` {kind}, {METRICS}")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows whose text the rules keep, with all their columns."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [measure_block(b, rules)["kept"] for b in blocks(batch.column(at))]
            if verdicts:
                yield batch.filter(pa.array(np.concatenate(verdicts)))

    return bounded(docs).mapInArrow(keep, docs.schema)
