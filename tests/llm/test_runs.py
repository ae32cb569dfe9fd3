"""Periodic runs against a brute force over all periods, and the query's columns."""

from __future__ import annotations

import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faretide.llm.queries import op11_periodic_runs
from faretide.llm.runs import describe_runs, find_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def brute(words, least=6, power=4):
    """Runs as ``(start, length, period)`` by comparing words at every distance."""
    found = set()
    for period in range(1, len(words) // power + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end + period - at
            if end > at and length >= max(least, power * period):
                inside = words[at : at + length]
                if all(inside[q:] != inside[:-q] for q in range(1, period)):
                    found.add((at, length, period))
            at = max(end, at + 1)
    return sorted(found)


def runs_of(rows, **options):
    first = np.concatenate([[0], np.cumsum([len(row) for row in rows])]).astype(np.int64)
    found = find_runs(np.array([w for row in rows for w in row], np.int64), first, **options)
    return [tuple(run) for run in found.T.tolist()]


def expected_runs(rows):
    return [(k, *run) for k, row in enumerate(rows) for run in brute(row)]


unit = st.lists(st.integers(0, 3), min_size=1, max_size=24)
piece = st.tuples(unit, st.integers(1, 6), st.integers(0, 24)).map(lambda t: t[0] * t[1] + t[0][: t[2]])
text = st.lists(piece, max_size=4).map(lambda parts: [w for part in parts for w in part])


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=5), st.sampled_from([1, 2, 4, 16]))
def test_runs_equal_brute_force(rows, direct):
    assert runs_of(rows, direct=direct) == expected_runs(rows)


@pytest.mark.parametrize("direct", [1, 2, 16])
def test_words_that_fool_hashes_and_minima(direct):
    fibonacci, other = [0], [0, 1]
    while len(other) < 1200:
        fibonacci, other = other, other + fibonacci
    thue = [bin(k).count("1") & 1 for k in range(1024)]
    rows = [other, thue, thue * 5, [7] * 900, ([1] * 40 + [2]) * 9, [], [3], [5, 6] * 3]
    got = runs_of(rows, direct=direct)
    assert [run for run in got if run[0] != 2] == [r for r in expected_runs(rows) if r[0] != 2]
    assert (2, 0, 5120, 1024) in got


def test_a_period_of_thousands_of_words():
    word = [(k * 7919) % 100_003 for k in range(9_000)]
    rows = [[-5, *word * 4, *word[:11], -6], word * 3]
    assert runs_of(rows) == [(0, 1, 36_011, 9_000)]


def test_scans_and_scales_agree_on_every_period():
    for period in range(1, 70):
        unit = list(range(period))
        for extra in (0, period - 1):
            rows = [[-1, *unit * 4, *unit[:extra], -2], [*unit * 3, *unit[: period - 1]]]
            assert runs_of(rows, direct=4) == expected_runs(rows), (period, extra)


def expected_row(name, text):
    words = WORD.findall(text or "")
    count = len(words)
    key = zlib.crc32(str(name).encode()) if name is not None else 1
    if key % 10 == 0 and count:
        part = key // 10
        low = part % count
        period = 1 + (count - low) // (3 + part % 8)
        words = [w if i < low else words[low + (i - low) % period] for i, w in enumerate(words)]
    runs = brute(words)
    out = [None] * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        out = [s, n, q, 1000 * n // q]
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digest = lambda t: sha256(t.encode()).hexdigest()
    return (name, len(runs), *out, digest(listed), digest(kept))


def test_the_query_equals_brute_force_on_short_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {row["doc_id"]: tuple(row) for row in op11_periodic_runs(spark, FOLDER).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    checked = 0
    for name, text in texts:
        if len(text or "") < 6000:
            assert got[name] == expected_row(name, text)
            checked += 1
    assert checked > 150 and any(row[1] for row in got.values())


@pytest.fixture(scope="module")
def odd(spark):
    long = " ".join(f"w{k % 997}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n\v"), (4, long), (5, "a a\ta\na a a"), (5, "a a\ta\na a a"),
        (None, "b c " * 9), (6, "日 本 " * 4 + "é"), (7, "x " * 8 + "y " * 8), (-7, "a\x1cb " * 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select("*", *[F.lit(1).alias(c) for c in ("n_runs", "start", "__text", "runs", "id")])


def test_odd_rows(odd):
    got = sorted(map(tuple, describe_runs(odd).collect()), key=str)
    unedited = []
    for row in odd.select("doc_id", "text").collect():
        name, text = row
        words = WORD.findall(text or "")
        runs = [(0, 60_000, 997)] if name == 4 else brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = (sha256(t.encode()).hexdigest() for t in (listed, kept))
        unedited.append((name, len(runs), *figures, *digests))
    assert got == sorted(unedited, key=str)


def test_ties_take_the_first_run(odd):
    row = describe_runs(odd, spans=True).where("doc_id = 7").first()
    assert (row["start"], row["length"], row["period"]) == (0, 8, 1)
    assert row["collapsed"] == "x y" and len(row["runs"]) == 2


def test_empty_table(odd):
    assert describe_runs(odd.where("false"), edit=True, spans=True).collect() == []


def test_fewer_periods_than_minimizers_need_are_refused():
    with pytest.raises(ValueError, match="four periods"):
        runs_of([[1]], power=3)
