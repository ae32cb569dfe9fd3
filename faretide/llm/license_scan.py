"""License scans: MinHash bands over overlapping windows of words, then exact containment.

Words of each whole text (lower-cased A-Z, without punctuation at their ends) are hashed; shingles
are ``WIDTH`` words in a row. For each length of template there are windows of twice its shingles
that begin every length, so every stretch of a template's length lies whole in a window. A window
gets a MinHash signature of ``BANDS`` values, each a band of one row: a window that holds all n
shingles of a template among at most 2n has Jaccard similarity 1/2 or more, so it misses all bands
with probability ``2 ** -BANDS``, and one that holds 80 % of them with at most about
``0.62 ** BANDS``. Windows that share a band with a template are candidates. A candidate matches
if it holds at least ``least`` of the template's shingles, compared exactly.

Templates are few and their bands are looked up where texts are read: nothing is shuffled and no
window leaves its task unless it matches. Their number is checked.

A match's span begins and ends with shingles of the template and holds none more often than it does.

Defined results: NULL and empty texts match nothing and give no row. Overlapping matches of one
template are one row, the one with the best containment (then the shortest, then the first); ones
that follow each other are a row each. Repeated rows are scanned each. Other columns
are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from faretide.llm.words import LOWERED, NOT_SPACE, Block, blocks, bounded, constants, windows

WIDTH = 2
BANDS = 24
LEAST = 0.8
MAX_TEMPLATES = 10_000

#: Notices that say under which license a text is, by the license's SPDX name.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "all-rights-reserved": ["All rights reserved."],
}

EDGE = ~NOT_SPACE
EDGE = EDGE | np.isin(np.arange(256), [ord(c) for c in ".,;:!?\"'()[]{}<>*#"])


def _words(block: Block):
    """Hashes of words without punctuation at their ends, their spans, and rows' first words."""
    start, end, first = block.spans()
    inner = ~EDGE[block.data]
    at = np.flatnonzero(inner)
    if not len(at):
        return np.zeros(0, np.uint64), start[:0], end[:0], np.zeros(block.rows + 1, np.int64)
    low = at[np.minimum(np.searchsorted(at, start), len(at) - 1)]
    high = at[np.maximum(np.searchsorted(at, end) - 1, 0)] + 1
    full = (low < end) & (low >= start)
    kept = np.concatenate([[0], np.cumsum(full)])
    start, end, low, high = start[full], end[full], low[full], high[full]
    return block.hashes(block.sums(LOWERED), low, high), start, end, kept[first]


class Templates:
    """Templates by length, with their shingles and the bands that lead to them."""

    def __init__(self, texts: dict[str, list[str]], bands: int = BANDS):
        self.bands = bands
        self.names: list[str] = []
        self.sets: list[np.ndarray] = []
        self.often: list[np.ndarray] = []
        self.by_size: dict[int, list[int]] = {}
        for name, notices in texts.items():
            for notice in notices:
                for block in blocks(pa.array([notice])):
                    words, _, _, first = _words(block)
                    values, often = np.unique(windows(words, first, WIDTH)[0], return_counts=True)
                    if len(values):
                        self.by_size.setdefault(len(values), []).append(len(self.names))
                        self.names.append(name)
                        self.sets.append(values)
                        self.often.append(often)
        if len(self.names) > MAX_TEMPLATES:
            raise ValueError(f"more than {MAX_TEMPLATES} templates")
        self.factors = constants(bands, 29)
        own = [values[:, None] * self.factors for values in self.sets]
        self.signatures = [(x ^ (x >> np.uint64(29))).min(0) for x in own]

    def scan(self, block: Block, least: float):
        """Matches: row, template, containment, first and last word."""
        words, _, _, first = _words(block)
        shingles, at = windows(words, first, WIDTH)
        if not len(shingles):
            return []
        rows = np.searchsorted(first, at, "right") - 1
        found: dict[tuple[int, int], set[tuple[float, int, int]]] = {}
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        lengths = np.diff(np.append(starts, len(rows)))
        cut = {}
        for size in self.by_size:
            # Windows are two neighbouring steps of ``size`` shingles, the last maybe shorter.
            steps = -(-lengths // size)
            offset = np.concatenate([[0], np.cumsum(steps)])
            begin = np.repeat(starts, steps) + size * (
                np.arange(offset[-1]) - np.repeat(offset[:-1], steps)
            )
            alone = np.zeros(len(begin), bool)
            alone[offset[1:] - 1] = True
            cut[size] = begin, alone
        candidates: dict[int, set[tuple[int, int]]] = {size: set() for size in self.by_size}
        for band, factor in enumerate(self.factors):
            hashed = shingles * factor
            hashed ^= hashed >> np.uint64(29)
            for size, members in self.by_size.items():
                begin, alone = cut[size]
                low = np.minimum.reduceat(hashed, begin)
                pair = low.copy()
                pair[:-1] = np.where(alone[:-1], low[:-1], np.minimum(low[:-1], low[1:]))
                for member in members:
                    hit = np.flatnonzero(pair == self.signatures[member][band])
                    candidates[size].update((int(w), member) for w in hit)
        for size, pairs in candidates.items():
            begin = cut[size][0]
            for window, member in pairs:
                low = int(begin[window])
                row = int(rows[low])
                end = min(low + 2 * size, int(np.searchsorted(rows, row, "right")))
                inside = np.flatnonzero(np.isin(shingles[low:end], self.sets[member]))
                share = len(np.unique(shingles[low:end][inside])) / len(self.sets[member])
                if share >= least:
                    places = at[low + inside] - first[row]
                    spans = self._spans(member, shingles[low:end][inside], places, least)
                    found.setdefault((row, member), set()).update(spans)
        return [(*key, *span) for key in sorted(found) for span in _apart(found[key])]

    def _spans(self, member: int, values: np.ndarray, places: np.ndarray, least: float):
        """Stretches of shingles of a template that hold enough of it: share, first and last word.

        A stretch is moved on where a shingle would stand in it more often than in the template, so
        one notice does not reach into the next.
        """
        often = self.often[member].tolist()
        which = np.searchsorted(self.sets[member], values).tolist()
        words = places.tolist()
        held, distinct, low, out = [0] * len(often), 0, 0, []
        for high, k in enumerate(which):
            held[k] += 1
            distinct += held[k] == 1
            while held[k] > often[k]:
                held[which[low]] -= 1
                low += 1
            if distinct / len(often) >= least:
                out.append((distinct / len(often), words[low], words[high] + WIDTH - 1))
        return out


def _apart(spans: set[tuple[float, int, int]]) -> list[tuple[float, int, int]]:
    """Spans that do not overlap, the best first chosen, in the order of words."""
    chosen: list[tuple[int, int, float]] = []
    for share, low, high in sorted(spans, key=lambda x: (-x[0], x[2] - x[1], x[1])):
        k = bisect_right(chosen, (high, high, 2.0))
        if not k or chosen[k - 1][1] < low:
            chosen.insert(k, (low, high, share))
    return [(share, low, high) for low, high, share in chosen]


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = LEAST,
) -> DataFrame:
    """``(id_col, license, containment, first_word, last_word)``: a row a match."""
    known = Templates(templates or TEMPLATES)
    texts = bounded(docs).select(docs[id_col], docs[text_col].alias("__text"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = known.scan(block, least)
                if found:
                    rows, members, share, low, high = zip(*found, strict=True)
                    ids = batch.column(0).slice(block.first).take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([known.names[m] for m in members], pa.string()),
                         pa.array(share, pa.float64()), pa.array(low, pa.int64()),
                         pa.array(high, pa.int64())],
                        [id_col, "license", "containment", "first_word", "last_word"],
                    )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(
        scan,
        f"`{id_col}` {kind}, license string, containment double, first_word long, last_word long",
    )
