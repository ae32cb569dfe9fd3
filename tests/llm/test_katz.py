"""Katz backoff against a model of dictionaries, which adds up to 1 after every history."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from faretide.llm.katz import FITTED, fit_discounts, pack, pack_keys, score_held_out, score_texts, unpack, unpack_keys
from faretide.llm.queries import op13_lm_scoring

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BEGIN, END, NEVER = ("begin",), ("end",), ("never",)
FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), END]


def learned(name):
    return name is not None and zlib.crc32(str(name).encode()) % 7 != 2


class Brute:
    """The same model by its definition, one probability at a time."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = [None, *(Counter() for _ in range(order))]
        for text in texts:
            words = [BEGIN, *tokens(text)]
            for end in range(1, len(words)):
                for size in range(1, min(order, end + 1) + 1):
                    self.counts[size][tuple(words[end - size + 1 : end + 1])] += 1
        self.total, self.types = sum(self.counts[1].values()), len(self.counts[1])
        self.fits = [None]
        for size in range(1, order + 1):
            found = Counter(self.counts[size].values())
            self.fits.append(fit_discounts({r: n for r, n in found.items() if r <= FITTED}))
        self.after = [None, None, *(defaultdict(list) for _ in range(2, order + 1))]
        for size in range(2, order + 1):
            for gram, count in self.counts[size].items():
                self.after[size][gram[:-1]].append((gram[-1], count))
        self.known = {}
        left = sum(c - self.kept(1, c) for c in self.counts[1].values())
        self.unknown = left / self.total if self.total else 1.0

    def kept(self, size, count):
        return float(self.fits[size](np.array([count]))[0]) * count

    def probability(self, history, word):
        size = len(history) + 1
        count = self.counts[size][(*history, word)]
        if size == 1:
            return self.kept(1, count) / self.total if count else self.unknown
        after = self.after[size].get(tuple(history))
        if not after:
            return self.probability(history[1:], word)
        if count:
            return self.kept(size, count) / sum(c for _, c in after)
        return self.weight(tuple(history)) * self.probability(history[1:], word)

    def weight(self, history):
        if history not in self.known:
            size, after = len(history) + 1, self.after[len(history) + 1][history]
            left = sum(c - self.kept(size, c) for _, c in after) / sum(c for _, c in after)
            covered = math.fsum(self.probability(history[1:], word) for word, _ in after)
            self.known[history] = left / (1 - covered)
        return self.known[history]

    def scores(self, text):
        words = [BEGIN, *tokens(text)]
        score = sum(
            math.log10(self.probability(tuple(words[max(0, k - self.order + 1) : k]), words[k]))
            for k in range(1, len(words))
        )
        base = sum(
            math.log10((self.counts[1][(w,)] + 1) / (self.total + self.types + 1)) for w in words[1:]
        )
        return len(words) - 1, sum((w,) in self.counts[1] for w in words[1:]), self.total, base, score


def check(found, rows, order, train=None):
    brute = Brute([t for name, t in rows if (train or learned)(name)], order)
    ours = sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in found)
    expected = sorted(
        (name is None, name or 0, name is not None and zlib.crc32(str(name).encode()) % 7 == 2,
         *brute.scores(text)) for name, text in rows
    )
    assert len(ours) == len(expected)
    for left, right in zip(ours, expected, strict=True):
        assert left[:6] == right[:6]
        assert left[6:] == pytest.approx(right[6:], rel=1e-9, abs=1e-9)
    return brute


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("order", [1, 3])
def test_scores_equal_brute_force_over_many_chunks_and_parts(spark, rows, order):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3, "doc_id")
    found = score_held_out(docs, order=order, chunk=9_000, part=4_000).collect()
    brute = check(found, rows, order)
    for size in range(2, order + 1):
        for history in [*brute.after[size]][:40]:
            seen = [brute.probability(history, word) for (word,) in brute.counts[1]]
            assert math.fsum(seen) + brute.probability(history, NEVER) == pytest.approx(1, abs=1e-12)


def test_the_query_beats_the_base_on_held_out_texts(spark, rows):
    found = op13_lm_scoring(spark, FOLDER).collect()
    check(found, rows, 2)
    held = [r for r in found if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    same = defaultdict(set)
    texts = dict(rows)
    for row in found:
        same[texts[row["doc_id"]]].add(round(row["score"], 6))
    assert all(len(scores) == 1 for scores in same.values())


def test_odd_rows(spark):
    long = " ".join(f"w{k * k % 613}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\v"), (4, long), (5, "One two\tONE"), (5, "One two\tONE"),
        (None, "one three"), (6, "日本語 É é É"), (-7, "a\x1cb\x00c a\x1cb"), (8, "unseen words two one"),
        (9, "one two one two one"), (10, "one two"), (11, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["chunk", "ids", "learn", "__text", "__learn", "score", "level", "part", "tokens"]
    docs = docs.select("*", *[F.lit(1).alias(c) for c in clash])
    for order in (2, 3):
        check(score_held_out(docs, order=order, chunk=20, part=50).collect(), rows, order)


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = score_texts(docs, F.lit(False)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found] == [(0, 0, 0, 0)] * 2
    assert score_held_out(docs.where("false")).collect() == []


def test_texts_of_few_kinds_of_words_leave_something(spark):
    """Counts all large, one history with a single follower, and a text seen a thousand times."""
    rows = [(k, "a b a b") for k in range(600)] + [(900, "b a x"), (901, "a a a"), (902, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = score_held_out(docs, order=3, chunk=500, part=3).collect()
    check(found, rows, 3)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_discounts_are_shares_for_any_counts_of_counts():
    cases = [{}, {1: 5}, {7: 1}, {1: 10, 2: 40, 3: 1}, {1: 1000, 2: 300, 3: 150, 4: 90, 900: 1},
             {2: 10, 4: 10}, {1: 3, 1000: 8}, {r: 5 for r in range(1, 200)}]
    for found in cases:
        kept = fit_discounts(found)(np.arange(1, 5000))
        assert ((kept > 0) & (kept < 1)).all()


def test_packing():
    rng = np.random.default_rng(1)
    for kind in (np.uint8, np.uint32, np.int64, np.float64, np.uint64):
        for size in (0, 1, 1000):
            values = rng.integers(0, 200, size).astype(kind)
            assert (unpack(pack(values), kind) == values).all()
    keys = np.sort(rng.integers(0, 2**64, 500, dtype=np.uint64))
    assert (unpack_keys(pack_keys(keys)) == keys).all()
