"""Whitening of embeddings from an exact scatter matrix of bit planes.

Entries become integers, ``floor(scale * c) + shift``. Each dimension's integers, less the
dimension's least, are cut into bit planes, and a plane is packed across rows into 64-bit words.
The cross-product of two dimensions is the sum over their pairs of planes of
``2**(k + l) * popcount(plane k AND plane l)``: whole numbers, without rounding, whatever the
order of rows and tasks. A further dimension of ones gives the sums and the number of rows in the
same way. ``n * G - S S'`` is then the covariance times ``n * n``, centred as integers, and only
its quotient by ``n * n`` is a floating number, handed to ``eigh``.

Rows are read three times, for the range of each dimension, for the cross-products and for the
result. A task keeps one block of planes and the matrix; what is shuffled is a row a task and
pair of dimensions, summed before. The driver holds matrices of dimension by dimension, at most
``max_dims`` wide: their size does not grow with rows.

Defined results: rows whose vector is NULL, or holds a NULL or non-finite entry, or one whose
integer does not fit 61 bits, are dropped. If vectors have several lengths, those of the most
frequent length (the shorter of two) remain. Repeated rows and NULL ids stay. Without a row, or
with vectors of no entry, the result is empty. A component without spread (its eigenvalue is
within rounding of 0) keeps its rows: ``whitened`` is NULL there, and ``identity_error`` is that
of the others (0 without any). ``explained`` is NULL if nothing has spread. ``deviation`` is NULL
where it does not fit a long. Equal eigenvalues (ties) may be any basis of their space. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MAX_DIMS = 2048
#: Integers of this size and more are not taken.
LARGEST = 2.0**61
#: Entries held as planes at a time.
BLOCK = 1 << 19
#: Shifts ``k + l`` are summed in limbs of so many bits.
LIMB = 24


@dataclass(frozen=True)
class Ranges:
    """Of the vectors taken: their length, and each dimension's least and greatest integer."""

    dims: int
    low: tuple[int, ...]
    high: tuple[int, ...]


@dataclass(frozen=True)
class Whitening:
    """What the rows' covariance gives: ``basis`` has a column a component, scaled to whiten."""

    ranges: Ranges
    rows: int
    sums: tuple[int, ...]
    basis: np.ndarray
    explained: tuple[float | None, ...]
    spread: tuple[bool, ...]


def _usable(column: pa.Array, scale: float, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that can be taken, with the length of each, and all their integers end to end."""
    column = column.cast(pa.large_list(pa.float64()))
    valid = pc.is_valid(column).to_numpy(zero_copy_only=False)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    # Entries below a NULL row are not among those of flatten().
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    bounds = np.concatenate([[0], np.cumsum(np.where(valid, lengths, 0))])
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(scale * flat)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(whole) < LARGEST))])
    good = valid & (lengths > 0) & (bad[bounds[1:]] == bad[bounds[:-1]])
    keep = np.repeat(good, np.diff(bounds))
    return np.flatnonzero(good), lengths[good], whole[keep].astype(np.int64) + shift


def _taken(batch: pa.RecordBatch, dims: int, scale: float, shift: int):
    """Row numbers and the matrix of integers of the batch's rows of one length."""
    rows, lengths, flat = _usable(batch.column(1), scale, shift)
    same = lengths == dims
    return rows[same], flat[np.repeat(same, lengths)].reshape(-1, dims)


def _blocks(matrix: np.ndarray) -> Iterator[np.ndarray]:
    step = max(64, BLOCK // max(1, matrix.shape[1]))
    for low in range(0, len(matrix), step):
        yield matrix[low : low + step]


def find_ranges(
    vectors: DataFrame, scale: float = SCALE, shift: int = SHIFT, max_dims: int = MAX_DIMS
) -> Ranges | None:
    """Ranges of the most frequent length's rows; ``vectors`` has an id and a vector."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            rows, lengths, flat = _usable(batch.column(1), scale, shift)
            for dims in np.unique(lengths).tolist():
                if dims > max_dims:
                    raise ValueError(f"a vector of {dims} entries; at most {max_dims} are taken")
                part = flat[np.repeat(lengths == dims, lengths)].reshape(-1, dims)
                seen = found.setdefault(dims, [0, part[0], part[0]])
                found[dims] = [
                    seen[0] + len(part),
                    np.minimum(seen[1], part.min(0)),
                    np.maximum(seen[2], part.max(0)),
                ]
        for dims, (count, low, high) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(dims, dims)), pa.array(np.arange(dims)), pa.array(low),
                 pa.array(high), pa.array(np.full(dims, count))],
                ["dims", "dim", "low", "high", "n"],
            )

    found = vectors.mapInArrow(measure, "dims long, dim long, low long, high long, n long")
    merged = found.groupBy("dims", "dim").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
    )
    counts = merged.where("dim = 0").orderBy(F.desc("n"), "dims").limit(1).select("dims")
    rows = merged.join(counts, "dims").orderBy("dim").collect()
    if not rows:
        return None
    return Ranges(len(rows), tuple(r["low"] for r in rows), tuple(r["high"] for r in rows))


def _planes(values: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Bit planes of all dimensions, each packed across rows: (planes, words)."""
    words = -(-len(values) // 64)
    out = np.zeros((int(widths.sum()), words * 8), np.uint8)
    at = 0
    for dim, width in enumerate(widths.tolist()):
        bits = (values[:, dim, None] >> np.arange(width)) & 1
        packed = np.packbits(bits.astype(np.uint8), axis=0)
        out[at : at + width, : len(packed)] = packed.T
        at += width
    return out.view(np.uint64)


def _cross(planes: np.ndarray, widths: np.ndarray, total: np.ndarray) -> None:
    """Add weighted AND-popcounts to ``total[limb, i, j]`` for all pairs i <= j."""
    dim = np.repeat(np.arange(len(widths)), widths)
    first = np.concatenate([[0], np.cumsum(widths)])[:-1]
    bit = np.arange(len(dim)) - first[dim]
    for a in range(len(dim)):
        i, k = int(dim[a]), int(bit[a])
        begin = int(first[i])
        counts = np.bitwise_count(planes[begin:] & planes[a]).sum(axis=1, dtype=np.int64)
        limb, place = np.divmod(bit[begin:] + k, LIMB)
        np.add.at(total, (limb, i, dim[begin:]), counts << place)


def cross_products(
    vectors: DataFrame, ranges: Ranges, scale: float = SCALE, shift: int = SHIFT
) -> np.ndarray:
    """Exact cross-products of ``x - low`` and of a last dimension of ones, as Python integers."""
    dims = ranges.dims
    low = np.array(ranges.low, np.int64)
    spans = [high - least for least, high in zip(ranges.low, ranges.high, strict=True)]
    widths = np.array([*(span.bit_length() for span in spans), 1])
    limbs = 2 * int(widths.max()) // LIMB + 1

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((limbs, dims + 1, dims + 1), np.int64)
        for batch in batches:
            for part in _blocks(_taken(batch, dims, scale, shift)[1]):
                values = np.ones((len(part), dims + 1), np.int64)
                values[:, :dims] = part - low
                _cross(_planes(values, widths), widths, total)
        limb, i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(limb), pa.array(i), pa.array(j), pa.array(total[limb, i, j])],
            ["limb", "i", "j", "part"],
        )

    parts = vectors.mapInArrow(multiply, "limb long, i long, j long, part long")
    exact = F.sum(F.col("part").cast("decimal(20,0)")).alias("part")
    out = np.zeros((dims + 1, dims + 1), object)
    for row in parts.groupBy("limb", "i", "j").agg(exact).collect():
        value = int(row["part"]) << (LIMB * row["limb"])
        out[row["i"], row["j"]] += value
        if row["i"] != row["j"]:
            out[row["j"], row["i"]] += value
    return out


def fit(
    vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT,
    max_dims: int = MAX_DIMS,
) -> Whitening | None:
    """Components of the rows' covariance; ``None`` without a row to take."""
    ranges = find_ranges(vectors, scale, shift, max_dims)
    if ranges is None:
        return None
    products = cross_products(vectors, ranges, scale, shift)
    rows, raised = products[-1, -1], products[:-1, -1]
    sums = tuple(int(s) + rows * low for s, low in zip(raised, ranges.low, strict=True))
    # Shifting a dimension leaves its covariances as they are.
    centred = rows * products[:-1, :-1] - np.outer(raised, raised)
    covariance = (centred / (rows * rows)).astype(np.float64)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes = values[order], axes[:, order]
    trace = int(centred.trace()) / (rows * rows)
    spread = values > max(trace, 0.0) * ranges.dims * np.finfo(np.float64).eps
    basis = axes / np.sqrt(np.where(spread, values, 1.0))
    explained = tuple(max(float(v), 0.0) / trace if trace else None for v in values)
    return Whitening(ranges, rows, sums, basis, explained, tuple(spread.tolist()))


def _centred(part: np.ndarray, rows: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S`` of each row and dimension, exactly."""
    if sums.dtype == object:
        return rows * part.astype(object) - sums
    return rows * part - sums


def _numbers(model: Whitening) -> tuple[np.ndarray, bool]:
    """``S``, as longs if ``n * x - S`` fits one, and whether its squares' sum does."""
    ends = zip(model.ranges.low, model.ranges.high, model.sums, strict=True)
    far = max(max(abs(model.rows * x - s) for x in (low, high)) for low, high, s in ends)
    wide = max(far, *map(abs, model.sums), model.rows * max(map(abs, model.ranges.high + model.ranges.low)))
    fits = wide < 2**62
    return np.array(model.sums, np.int64 if fits else object), far * far * model.ranges.dims < 2**62


def _each(model: Whitening, scale: float, shift: int) -> Callable:
    """Row numbers, deviations and whitened components of a batch, block by block."""
    sums, small = _numbers(model)

    def each(batch: pa.RecordBatch):
        rows, matrix = _taken(batch, model.ranges.dims, scale, shift)
        at = 0
        for part in _blocks(matrix):
            apart = _centred(part, model.rows, sums)
            square = apart if small and apart.dtype != object else apart.astype(object)
            deviation = (square * square).sum(axis=1)
            whitened = (apart / model.rows).astype(np.float64) @ model.basis
            yield rows[at : at + len(part)], deviation, whitened
            at += len(part)

    return each


def _identity_error(vectors: DataFrame, model: Whitening, scale: float, shift: int) -> float:
    """Largest entry of the whitened rows' covariance, as measured over them, less the identity."""
    each, size = _each(model, scale, shift), model.basis.shape[1]

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for _, _, whitened in each(batch):
                total += whitened.T @ whitened
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "part"]
        )

    sums = vectors.mapInArrow(multiply, "i long, j long, part double")
    found = np.zeros((size, size))
    for row in sums.groupBy("i", "j").agg(F.sum("part").alias("part")).collect():
        found[row["i"], row["j"]] = row["part"] / model.rows
    kept = np.flatnonzero(model.spread)
    if not len(kept):
        return 0.0
    upper = np.triu(np.ones((len(kept), len(kept)), bool))
    return float(np.abs(found[np.ix_(kept, kept)] - np.eye(len(kept)))[upper].max())


def whiten(
    docs: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
    shift: int = SHIFT,
    max_dims: int = MAX_DIMS,
) -> DataFrame:
    """A row for each vector and component: its whitened coordinate, and figures of the fit."""
    vectors = docs.select(docs[id_col].alias("__id"), docs[vector_col].alias("__vector"))
    kind = vectors.schema[0].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
        "explained double, identity_error double"
    )
    model = fit(vectors, components, scale, shift, max_dims)
    if model is None:
        return docs.sparkSession.createDataFrame([], schema)
    error = _identity_error(vectors, model, scale, shift)
    each, size = _each(model, scale, shift), model.basis.shape[1]
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = ~np.array(model.spread)
        for batch in batches:
            for rows, deviation, whitened in each(batch):
                count = len(rows)
                long = [v if v < 2**63 else None for v in deviation.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(rows, size))),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * size, model.rows)),
                        pa.array(long, pa.int64()).take(pa.array(np.repeat(np.arange(count), size))),
                        pa.array(whitened.ravel(), mask=np.tile(none, count)),
                        pa.array(list(model.explained) * count, pa.float64()),
                        pa.array(np.full(count * size, error)),
                    ],
                    names,
                )

    return vectors.mapInArrow(apply, schema)
