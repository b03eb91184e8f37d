"""Embedding whitening with a covariance by polarisation.

Vectors become whole numbers. One pass gives every dimension's exact sum, a second one the exact sums of squares of
every dimension and of every sum of two dimensions, taken of values centred on the whole number next to the mean.
What is left of the mean, at most half a unit, is taken out of the sums exactly. Variances follow, and from their
differences all cross-covariances:

    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

Only sums of a vector's width and of its pairs leave the tasks; ``eigh`` of the width-squared matrix runs on the driver.
All sums are whole numbers of any size, sent in three limbs, so neither the order of rows nor their number rounds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .vectors import dense, lengths

#: A component c counts as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components whose scaled value fits no long make a vector unfit, as infinite ones do.
BELOW = float(1 << 56)
COMPONENTS = 32
#: Eigenvalues up to this share of the largest one are rounding: such directions have no variance to divide by.
LEAST = 1e-12
ROWS = 2048
_LIMB = 48


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(vectors * SCALE).astype(np.int64) + SHIFT


def _limbs(values) -> list[pa.Array]:
    parts = [[], [], []]
    for v in map(int, values):
        parts[0].append(v >> (2 * _LIMB))
        parts[1].append((v >> _LIMB) & ((1 << _LIMB) - 1))
        parts[2].append(v & ((1 << _LIMB) - 1))
    return [pa.array(p, pa.int64()) for p in parts]


def _joined(row) -> int:
    return (int(row["hi"]) << (2 * _LIMB)) + (int(row["mid"]) << _LIMB) + int(row["lo"])


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("hi", "mid", "lo")]


@dataclass
class Whitening:
    """What ``fit`` learns: ``n`` vectors with per-dimension sums ``sums``; ``vectors`` (a column for each component) and
    ``values`` are eigenvectors and eigenvalues of the covariance, by falling value; ``trace`` is the sum of all values."""

    width: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers next to the means, and n times what is left of the means."""
        near = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(near, np.int64), np.array([s - self.n * m for s, m in zip(self.sums, near)], object)


def _column(vector_col: str) -> Column:
    return F.col(vector_col).cast("array<double>")


def width_of(rows: DataFrame, vector_col: str = "embedding") -> int:
    """The length that most whole vectors have (of equally frequent ones the larger); 0 without any."""
    ship(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, n = np.unique(lengths(batch.column(0), BELOW), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(n, pa.int64())], names=["d", "n"])

    found = (rows.select(_column(vector_col).alias("v")).mapInArrow(count, "d bigint, n bigint")
             .groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first())
    return int(found["d"]) if found else 0


def dimension_sums(rows: DataFrame, width: int, vector_col: str = "embedding") -> tuple[int, list[int]]:
    """(number of vectors, exact sum of every dimension); a row per task and dimension is shuffled."""
    ship(rows.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [0] * width, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = whole(dense(batch.column(0).slice(at, ROWS), width, BELOW)[1])
                big = len(x) and int(np.abs(x).max()) > 1 << 48
                sums = [a + int(b) for a, b in zip(sums, (x.astype(object) if big else x).sum(axis=0))]
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), *_limbs([n, *sums])],
                                         names=["k", "hi", "mid", "lo"])

    got = (rows.select(_column(vector_col).alias("v")).mapInArrow(add, "k int, hi bigint, mid bigint, lo bigint")
           .groupBy("k").agg(*_sums()).collect())  # width + 1 rows
    by = {r["k"]: _joined(r) for r in got}
    return by.get(-1, 0), [by.get(k, 0) for k in range(width)]


def square_sums(rows: DataFrame, centre: np.ndarray, vector_col: str = "embedding") -> dict[tuple[int, int], int]:
    """Exact sums of (x_i - c_i)^2, keyed (i, i), and of (x_i - c_i + x_j - c_j)^2, keyed (i, j) with i < j."""
    ship(rows.sparkSession)
    width = len(centre)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = np.zeros(width, object)
        pairs = [np.zeros(width - 1 - i, object) for i in range(width)]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = whole(dense(batch.column(0).slice(at, ROWS), width, BELOW)[1])
                if not len(x):
                    continue
                far = max(int(x[:, i].max()) - int(c) for i, c in enumerate(centre)), min(int(x[:, i].min()) - int(c) for i, c in enumerate(centre))
                small = max(abs(f) for f in far) < 1 << 24  # squares of sums of two, ROWS of them, stay below 2 ** 63
                y = (x - centre) if small else x.astype(object) - centre.astype(object)
                y = np.ascontiguousarray(y.T)
                alone = alone + (y * y).sum(axis=1)
                for i in range(width - 1):
                    s = y[i + 1:] + y[i]
                    pairs[i] = pairs[i] + (np.einsum("ij,ij->i", s, s) if small else (s * s).sum(axis=1))
        keys = [(i, i) for i in range(width)] + [(i, j) for i in range(width) for j in range(i + 1, width)]
        values = [*alone, *(v for p in pairs for v in p)]
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                          *_limbs(values)], names=["i", "j", "hi", "mid", "lo"])

    got = (rows.select(_column(vector_col).alias("v")).mapInArrow(add, "i int, j int, hi bigint, mid bigint, lo bigint")
           .groupBy("i", "j").agg(*_sums()).collect())  # width * (width + 1) / 2 rows
    return {(r["i"], r["j"]): _joined(r) for r in got}


def polarised(squares: dict[tuple[int, int], int], rest: list[int], n: int) -> np.ndarray:
    """The covariance of n vectors from their sums of squares about a point that lies rest / n below the mean.

    n^2 var(i) = n squares(i) - rest(i)^2, likewise for sums of two, all in whole numbers; the halved difference is
    rounded once, when it is divided."""
    width = len(rest)
    var = {(i, j): n * squares[i, j] - (rest[i] + (rest[j] if i != j else 0)) ** 2 for i, j in squares}
    out = np.zeros((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(var[i, i], n * n))
        for j in range(i + 1, width):
            out[i, j] = out[j, i] = float(Fraction(var[i, j] - var[i, i] - var[j, j], 2 * n * n))
    return out


def fit(rows: DataFrame, vector_col: str = "embedding", width: int | None = None) -> Whitening | None:
    """The whitening of the fit list: every row of ``rows`` with a whole vector of the most frequent length.

    Three passes, each a map with partial sums; None without such rows. Repeated rows count as often as they occur;
    vectors of another length, null vectors, and vectors with null, infinite or NaN components or with components that
    no long holds are left out; other columns are not read."""
    width = width_of(rows, vector_col) if width is None else width
    if not width:
        return None
    n, sums = dimension_sums(rows, width, vector_col)
    if not n:
        return None
    model = Whitening(width, n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    near, rest = model.centre()
    covariance = polarised(square_sums(rows, near, vector_col), list(rest), n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    # the sign is free; the largest entry of a component is made positive, so that reruns agree
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(width)])
    kept = values > LEAST * max(values[0], 0.0)
    kept &= values > 0
    model.vectors, model.values, model.trace = vectors[:, kept], values[kept], float(np.trace(covariance))
    return model


def _projected(column: pa.Array, model: Whitening, most: int) -> tuple[np.ndarray, list | np.ndarray, np.ndarray]:
    """(row numbers, deviations, whitened values) of a column's whole vectors."""
    near, rest = model.centre()
    at, v = dense(column, model.width, BELOW)
    x = whole(v)
    far = int(np.abs(x).max()) + int(np.abs(near).max()) if len(x) else 0
    if model.n * (far + 1) < 1 << 62 and model.width * (model.n * (far + 1)) ** 2 < 1 << 63:
        z = model.n * (x - near) - rest.astype(np.int64)
        deviation = (z * z).sum(axis=1)
    else:  # n * x - S in whole numbers of any size
        z = model.n * (x.astype(object) - near.astype(object)) - rest
        deviation = [int(d) if d < 1 << 63 else None for d in (z * z).sum(axis=1)] if len(x) else []
    scaled = model.vectors[:, :most] / np.sqrt(model.values[:most])
    return at, deviation, (z / model.n).astype(np.float64) @ scaled


def whiten(rows: DataFrame, model: Whitening, vector_col: str = "embedding", id_col: str = "vec_id",
           most: int = COMPONENTS) -> DataFrame:
    """(id, component, deviation, whitened) for every row that took part in the fit and every component up to ``most``.

    A map without shuffle. ``deviation`` is the exact sum over dimensions of (n x - S)^2, null where no long holds it.
    Components without variance (a width larger than the vectors span, or one vector alone) are left out. A null id
    stays null; rows that repeat are each whitened."""
    ship(rows.sparkSession)
    most = min(most, len(model.values))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                at, deviation, w = _projected(part.column(1), model, most)
                each = np.repeat(np.arange(len(at)), most)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), len(at))),
                     pa.array(deviation, pa.int64()).take(pa.array(each)), pa.array(w.reshape(-1))],
                    names=["id", "component", "deviation", "whitened"])

    kind = rows.schema[id_col].dataType.simpleString()
    out = rows.select(F.col(id_col).alias("id"), _column(vector_col).alias("v")).mapInArrow(
        work, f"id {kind}, component int, deviation bigint, whitened double")
    return out.withColumnRenamed("id", id_col)


def identity_error(rows: DataFrame, model: Whitening, vector_col: str = "embedding", most: int = COMPONENTS) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured over all rows."""
    ship(rows.sparkSession)
    most = min(most, len(model.values))
    if not most:
        return 0.0

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(most), np.zeros((most, most))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                w = _projected(batch.column(0).slice(start, ROWS), model, most)[2]
                total, products = total + w.sum(axis=0), products + w.T @ w
        i, j = np.indices((most, most))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.full(most, -1), i.ravel()]), pa.int32()), pa.array(np.concatenate([np.arange(most), j.ravel()]), pa.int32()),
             pa.array(np.concatenate([total, products.ravel()]))], names=["i", "j", "s"])

    got = (rows.select(_column(vector_col).alias("v")).mapInArrow(add, "i int, j int, s double")
           .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())  # most * (most + 1) rows
    mean, products = np.zeros(most), np.zeros((most, most))
    for r in got:
        if r["i"] < 0:
            mean[r["j"]] = r["s"] / model.n
        else:
            products[r["i"], r["j"]] = r["s"] / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(most)).max())
