"""The automaton's paths of many words at once, in numpy.

The symbols are a trie of bytes, whose arcs are in a table with open addresses. Every place of the
words is walked down the trie together, a byte at a time, which gives the symbols that begin there.
Then all words take their longest symbol that may follow, or step back, one try a word each round,
as ``TextEncoder.word`` does for one; the few words that need many rounds are left to it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Places in a table of arcs between labels.
_ARCS = 1 << 21
#: So few words are not worth a round.
FEW = 40


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys.astype(np.uint64) * _FACTOR >> np.uint64(65 - size.bit_length())).astype(np.int64)


@dataclass
class Trie:
    """Node 1 is the root; ``inner`` and ``last`` are labels of symbols within and at a word's end."""

    keys: np.ndarray
    nodes: np.ndarray
    inner: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, inner: dict[bytes, int], last: dict[bytes, int]) -> Trie:
        arcs: dict[int, int] = {}
        marks = ([-1, -1], [-1, -1])
        for symbols, labels in zip((inner, last), marks, strict=True):
            for symbol, label in symbols.items():
                node = 1
                for byte in symbol:
                    node = arcs.setdefault(node << 8 | byte, len(marks[0]))
                    if node == len(marks[0]):
                        marks[0].append(-1)
                        marks[1].append(-1)
                labels[node] = label
        size = 1 << (2 * len(arcs) + 2).bit_length()
        keys, nodes = [0] * size, [0] * size
        places = _places(np.array(list(arcs), np.int64), size).tolist()
        for at, (key, node) in zip(places, arcs.items(), strict=True):
            while keys[at]:
                at = (at + 1) % size
            keys[at], nodes[at] = key, node
        return cls(
            np.array(keys, np.int32), np.array(nodes, np.int32),
            np.array(marks[0], np.int32), np.array(marks[1], np.int32),
        )

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The nodes behind arcs; 0 where there is none."""
        keys = nodes << 8 | letters
        at = _places(keys, len(self.keys))
        seen = self.keys[at]
        out = np.where(seen == keys, self.nodes[at], 0)
        open_ = np.flatnonzero((seen != keys) & (seen != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.nodes[at[open_[hit]]]
            open_ = open_[~hit & (seen != 0)]
        return out

    def candidates(self, data: np.ndarray, ends: np.ndarray):
        """For each place its symbols, longest first: where they begin in the list, labels, ends."""
        places, nodes = np.arange(len(data)), np.ones(len(data), np.int32)
        levels, counts, n = [], np.zeros(len(data), np.int64), 0
        while len(places):
            nodes = self.step(nodes, data[places + n])
            there = nodes > 0
            places, nodes, n = places[there], nodes[there], n + 1
            final = places + n == ends[places]
            labels = np.where(final, self.last[nodes], self.inner[nodes])
            some = labels >= 0
            levels.append((places[some], labels[some]))
            counts[places[some]] += 1
            places, nodes = places[~final], nodes[~final]
        first = np.concatenate([[0], np.cumsum(counts)])
        labels = np.zeros(first[-1], np.int64)
        stops = np.zeros(first[-1], np.int64)
        free = first[1:].copy()
        for n, (at, found) in enumerate(levels, 1):
            free[at] -= 1
            labels[free[at]], stops[free[at]] = found, at + n
        return first, labels, stops


class Arcs:
    """Which label may follow which: a table whose places keep the arc that came last."""

    def __init__(self, known: dict[int, bool], find):
        #: ``find(last, label)`` decides, and remembers in ``known`` by ``last << 20 | label``.
        self.known, self.find = known, find
        self.table = np.full(_ARCS, -1, np.int64)

    def follow(self, last: np.ndarray, labels: np.ndarray) -> np.ndarray:
        keys = last << 20 | labels
        at = _places(keys, _ARCS)
        seen = self.table[at]
        out = (seen & 1).astype(bool)
        missed = np.flatnonzero(seen >> 1 != keys)
        if len(missed):
            asked, back = np.unique(keys[missed], return_inverse=True)
            found = []
            for key in asked.tolist():
                follows = self.known.get(key)
                if follows is None:
                    follows = self.find(key >> 20, key & 0xFFFFF)
                found.append(follows)
            found = np.array(found, bool)
            self.table[_places(asked, _ARCS)] = asked << 1 | found
            out[missed] = found[back]
        return out


def paths(trie: Trie, arcs: Arcs, data: np.ndarray, offsets: np.ndarray):
    """The words' labels one after another, how many each has, and which words were given up.

    Word ``i`` is ``data[offsets[i]:offsets[i + 1]]``, none is empty. Words given up have no labels.
    """
    begins, word_ends = offsets[:-1], offsets[1:]
    ends = np.repeat(word_ends, word_ends - begins)
    first, labels, stops = trie.candidates(data, ends)
    taken = np.zeros(len(data), np.int64)
    before = np.full(len(data), -1, np.int64)
    given_up = np.zeros(len(begins), bool)
    words, at = np.arange(len(begins)), begins.copy()
    last, tried = np.full(len(begins), -1, np.int64), first[begins]
    while len(words) > FEW:
        # Beyond a place's last symbol a shorter symbol is taken before it.
        over = np.flatnonzero(tried == first[at + 1])
        while len(over):
            back = before[at[over]]
            lost = back < 0
            if lost.any():
                given_up[words[over[lost]]] = True
                tried[over[lost]] = -1
                over, back = over[~lost], back[~lost]
            at[over], tried[over] = back, taken[back] + 1
            earlier = before[back]
            last[over] = np.where(earlier < 0, -1, labels[taken[earlier]])
            over = over[tried[over] == first[back + 1]]
        if (tried < 0).any():
            stay = tried >= 0
            words, at, last, tried = words[stay], at[stay], last[stay], tried[stay]
        label = labels[tried]
        follows = last < 0
        asked = np.flatnonzero(~follows)
        follows[asked] = arcs.follow(last[asked], label[asked])
        tried[~follows] += 1
        on = np.flatnonzero(follows)
        here, stop = at[on], stops[tried[on]]
        taken[here] = tried[on]
        more = stop < word_ends[words[on]]
        on, here, stop = on[more], here[more], stop[more]
        before[stop], at[on], last[on], tried[on] = here, stop, label[on], first[stop]
        ended = follows
        ended[on] = False
        if ended.any():
            stay = ~ended
            words, at, last, tried = words[stay], at[stay], last[stay], tried[stay]
    given_up[words] = True
    on_path = np.zeros(len(data) + 1, bool)
    at, stop = begins[~given_up], word_ends[~given_up]
    while len(at):
        on_path[at] = True
        at = stops[taken[at]]
        more = at < stop
        at, stop = at[more], stop[more]
    counts = np.concatenate([[0], np.cumsum(on_path[:-1])])
    return labels[taken[np.flatnonzero(on_path[:-1])]], counts[word_ends] - counts[begins], given_up
