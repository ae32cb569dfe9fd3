"""Whitening against covariances of Python integers and numpy's eigenvectors."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faretide.llm.queries import op12_whitening
from faretide.llm.whitening import cross_products, find_ranges, whiten

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def make(spark, rows, schema=SCHEMA):
    clash = ["n", "component", "dims", "low", "__vector", "part", "label"]
    return spark.createDataFrame(rows, schema).select("*", *[F.lit(1).alias(c) for c in clash])


def expected(rows, components=32):
    """By id: deviation, whitened values up to sign; and the shares of the trace."""
    good = [
        (name, [math.floor(64 * c) + 1_000_000 for c in vector])
        for name, vector in rows
        if vector and all(c is not None and math.isfinite(c) for c in vector)
    ]
    n, dims = len(good), len(good[0][1])
    sums = [sum(x[d] for _, x in good) for d in range(dims)]
    apart = [[n * x[d] - sums[d] for d in range(dims)] for _, x in good]
    cov = np.array([[sum(a[i] * a[j] for a in apart) / n**3 for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    centred = np.array([[v / n for v in a] for a in apart])
    return (
        [name for name, _ in good], [sum(v * v for v in a) for a in apart],
        centred @ axes / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(cov), n,
    )


def check(found, rows, components=32):
    names, deviation, whitened, explained, n = expected(rows, components)
    size = whitened.shape[1]
    assert len(found) == len(names) * size
    ours = np.array([r["whitened"] for r in found], float).reshape(-1, size)
    assert [r["vec_id"] for r in found[::size]] == names
    assert [r["deviation"] for r in found[::size]] == deviation
    assert [r["component"] for r in found] == list(range(1, size + 1)) * len(names)
    assert {r["n"] for r in found} == {n}
    for k in range(size):
        sign = np.sign(ours[:, k] @ whitened[:, k])
        assert np.allclose(ours[:, k] * sign, whitened[:, k], atol=1e-7)
    assert np.allclose([r["explained"] for r in found[:size]], explained, rtol=1e-9)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]}
    assert found[0]["identity_error"] < 1e-9


def test_the_query(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = op12_whitening(spark, FOLDER).orderBy("vec_id", "component").collect()
    check(found, sorted(map(tuple, rows)))


def test_far_from_zero_and_of_unequal_spread(spark):
    rng = np.random.default_rng(3)
    spread = np.array([1000.0, 30.0, 1.0, 0.3, 5e-2])
    rows = [(k, (rng.normal(size=5) * spread + 1e7).tolist()) for k in range(700)]
    check(whiten(make(spark, rows)).orderBy("vec_id", "component").collect(), rows)


def test_cross_products_are_exact_in_any_width(spark):
    rng = np.random.default_rng(4)
    values = [[int(v) for v in rng.integers(-(2**40), 2**40, 3)] for _ in range(150)]
    vectors = make(spark, [(k, [float(v) for v in row]) for k, row in enumerate(values)])
    vectors = vectors.select("vec_id", "embedding").repartition(5)
    ranges = find_ranges(vectors, 1, 0)
    got = cross_products(vectors, ranges, 1, 0)
    low = [min(row[d] for row in values) for d in range(3)]
    raised = [[row[d] - low[d] for d in range(3)] + [1] for row in values]
    for i in range(4):
        for j in range(4):
            assert got[i, j] == sum(row[i] * row[j] for row in raised)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [(k, rng.normal(size=3).tolist()) for k in range(40)]
    good += [(None, good[0][1]), (3, good[3][1]), (3, good[3][1])]
    bad = [(90, None), (91, [1.0, None, 2.0]), (92, [nan, 1.0, 2.0]), (93, [1.0, -inf, 0.0]),
           (94, []), (95, [1e300, 0.0, 0.0]), (96, [1.0, 2.0]), (None, None)]
    table = make(spark, [*bad[:4], *good, *bad[4:]])
    found = whiten(table).collect()
    names, deviation, _, _, n = expected(good)
    assert sorted(str(r["vec_id"]) for r in found if r["component"] == 1) == sorted(map(str, names))
    assert sorted(r["deviation"] for r in found if r["component"] == 2) == sorted(deviation)
    assert {r["n"] for r in found} == {n} and n == 43


def test_components_without_spread(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0]) for k in range(30)]
    found = whiten(make(spark, rows)).orderBy("vec_id", "component").collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert found[0]["explained"] == pytest.approx(1) and found[0]["identity_error"] < 1e-9
    single = whiten(make(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r["whitened"], r["deviation"], r["explained"]) for r in single] == [(None, 0, None)] * 2


def test_deviations_beyond_a_long(spark):
    rows = [(k, [1e12 * k, 0.0]) for k in range(50)]
    found = whiten(make(spark, rows), components=1).collect()
    exact = dict(zip(*expected(rows)[:2], strict=True))
    for row in found:
        fits = exact[row["vec_id"]] < 2**63
        assert row["deviation"] == (exact[row["vec_id"]] if fits else None)
    assert found[0]["identity_error"] < 1e-9


def test_equal_lengths_take_the_shorter_and_none_gives_none(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, [1.0, 5.0, 3.0])]
    assert {r["vec_id"] for r in whiten(make(spark, rows)).collect()} == {1, 2}
    assert whiten(make(spark, rows).where("false")).collect() == []
    assert whiten(make(spark, [(1, None), (2, [])])).collect() == []


def test_reruns_agree_whatever_the_partitions(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    one = whiten(table).drop("identity_error").orderBy("vec_id", "component").collect()
    two = whiten(table.repartition(7)).drop("identity_error").orderBy("vec_id", "component").collect()
    assert [r[:4] for r in one] == [r[:4] for r in two]
    assert np.allclose([r[4] for r in one], [r[4] for r in two], atol=1e-12)


def test_vectors_wider_than_the_bound_are_refused(spark):
    with pytest.raises(Exception, match="at most 2"):
        whiten(make(spark, [(1, [1.0, 2.0, 3.0])]), max_dims=2).collect()
