"""Operator 13: whitening of embeddings by leading principal components.

Entries become whole numbers; every distinct vector counts once. Tasks add up sums, then, centred on
the exact mean, products: one matrix of d x d numbers a task, which a shuffle by matrix row adds up.
The driver holds that one matrix. Householder reflections bring it to tridiagonal form, counts of
negative pivots (Sturm) bisect the leading eigenvalues, inverse iteration finds their vectors,
which are made orthogonal to earlier ones of the same cluster, and the reflections turn them back.
Components, d x 16 numbers, go out with the tasks that project every row, and another pass over the
distinct vectors measures how far the covariance of the result is from the identity.

Cases: rows with a null vector or a null or non-finite entry take no part; so do vectors of another
length than the most frequent one (of equally frequent ones the longest). Entries beyond 2**62 / 64 are cut there. Fewer
components than 16 come out where the dimension or the rank is less (an eigenvalue up to 1e-12 of the largest counts as none): one
distinct vector, or none, has no components and gives no rows. deviation is null where it does not fit
64 bits. Repeated rows, and rows with a null id, are returned each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues up to this share of the largest are taken for zero.
RANK = 1e-12
#: Vectors that a task adds up at a time.
ROWS = 4096

_EPS = float(np.finfo(np.float64).eps)


# -- eigenvalues of a symmetric matrix -------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of q.T a q, and the reflections of q, one unit vector (or zeros) a row."""
    a = np.array(a, float)
    n = len(a)
    reflections = np.zeros((max(n - 2, 0), n))
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if np.linalg.norm(x[1:]) == 0:
            continue
        v = x.copy()
        v[0] += size if x[0] >= 0 else -size
        v /= np.linalg.norm(v)
        part = a[k + 1 :, k + 1 :]
        w = part @ v
        w -= (v @ w) * v
        part -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -size if x[0] >= 0 else size
        reflections[k, k + 1 :] = v
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(diagonal: np.ndarray, side: np.ndarray, points: np.ndarray) -> np.ndarray:
    """For each point the number of eigenvalues below it: negative pivots of the shifted factorisation."""
    least = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(side).max(initial=0.0)), 1e-300) * _EPS * _EPS
    counts, pivot = np.zeros(len(points), np.int64), np.ones(len(points))
    for i in range(len(diagonal)):
        pivot = diagonal[i] - points - (side[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        counts += pivot < 0
    return counts


def leading_values(diagonal: np.ndarray, side: np.ndarray, count: int) -> np.ndarray:
    """The count largest eigenvalues, falling, each bisected until its bounds are neighbours."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(side)
    reach[1:] += np.abs(side)
    size = float(np.max(np.abs(diagonal) + reach, initial=0.0))
    low = np.full(count, float(np.min(diagonal - reach)) - _EPS * size)
    high = np.full(count, float(np.max(diagonal + reach)) + _EPS * size)
    wanted = n - np.arange(count)  # the j-th largest is the least x with so many eigenvalues below or at it
    for _ in range(200):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= _EPS * size)):
            break
        over = below(diagonal, side, middle) >= wanted
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """x with (t - shift) x = b by elimination with row exchanges; a pivot of zero counts as least."""
    n = len(diagonal)
    d, upper, second = diagonal - shift, np.append(side, 0.0), np.zeros(n)
    low, x = side.copy(), b.astype(float).copy()
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            d[i], low[i] = low[i], d[i]
            upper[i], d[i + 1] = d[i + 1], upper[i]
            second[i], upper[i + 1] = upper[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(d[i]) < least:
            d[i] = least
        factor = low[i] / d[i]
        d[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * second[i]
        x[i + 1] -= factor * x[i]
    for i in reversed(range(n)):
        if abs(d[i]) < least:
            d[i] = least
        x[i] -= (upper[i] * x[i + 1] if i + 1 < n else 0.0) + (second[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] /= d[i]
    return x


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a row, by inverse iteration; within a cluster of near values each is made orthogonal to those before."""
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(side).max(initial=0.0)))
    if size == 0:
        return np.eye(len(values), n)
    random = np.random.Generator(np.random.PCG64(13))
    found = np.zeros((len(values), n))
    shift, first = np.inf, 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j  # a gap: a new cluster begins
        # shifts of one cluster stay apart, or all would find one vector
        shift = value if j == first else min(value, shift - 4 * _EPS * size)
        x = random.normal(size=n)
        for _ in range(6):
            x = solve_shifted(diagonal, side, shift, x / np.linalg.norm(x), _EPS * size)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= found[first:j].T @ (found[first:j] @ x)
        found[j] = x / np.linalg.norm(x)
    return found


def leading_components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The count largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors, one a row."""
    count = min(count, len(a))
    diagonal, side, reflections = tridiagonal(a)
    values = leading_values(diagonal, side, count)
    vectors = leading_vectors(diagonal, side, values)
    for v in reflections[::-1]:
        vectors -= 2 * np.outer(vectors @ v, v)
    # the largest entry of each is positive, so that a run can be repeated
    top = np.take_along_axis(vectors, np.argmax(np.abs(vectors), 1)[:, None], 1)
    return values, vectors * np.where(top < 0, -1.0, 1.0)


# -- the distributed part --------------------------------------------------------------------


def whole_vectors(df: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """key and x, an array of whole numbers, of the rows that take part."""
    entry = lambda c: c.cast("double")
    broken = lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == F.lit(float("inf")))
    most = float(1 << 62)
    whole = lambda c: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), entry(c) * SCALE))).cast("long") + SHIFT
    sound = df.where(F.col(column).isNotNull() & ~F.exists(column, broken))
    return sound.select(F.col(key), F.transform(column, whole).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a list column, one a row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Whitening:
    """What tasks need to project rows: size of the fit list, sums, components over the root of their values."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - sums, exact modulo 2**64, and x less the mean."""
        from_mean = np.int64(self.n) * x - self.sums
        small = np.abs(x - self.sums // self.n).max(initial=0) < 2**62 // self.n
        mean_whole, rest = self.sums // self.n, self.sums % self.n
        return from_mean, from_mean / self.n if small else (x - mean_whole) - rest / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x)[1] @ self.axes.T

    def deviation(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of squares of n * x - sums, and whether 64 bits hold it."""
        from_mean, near = self.centred(x)
        about = (near * near).sum(1) * float(self.n) ** 2
        with np.errstate(over="ignore"):
            return (from_mean * from_mean).sum(1), about < 9.2e18


def _sums(spark_df: DataFrame, dimension: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dimension, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                # halves of 32 bits, so that sums of a batch are exact
                high, low = x >> 32, x & 0xFFFFFFFF
                total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high.sum(0), low.sum(0), strict=True)]
                n += batch.num_rows
        if n:
            import decimal

            with decimal.localcontext(prec=60):
                values = [decimal.Decimal(t) for t in [*total, n]]
            yield pa.RecordBatch.from_arrays([pa.array(range(dimension + 1)), pa.array(values, pa.decimal128(38, 0))], names=["place", "total"])

    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("total", T.DecimalType(38, 0))])
    rows = spark_df.select("x").mapInArrow(run, schema).groupBy("place").agg(F.sum("total").alias("total")).collect()
    found = {r["place"]: int(r["total"]) for r in rows}
    if not found:
        return 0, np.zeros(dimension, np.int64)
    return found[dimension], np.array([found[i] for i in range(dimension)], dtype=object)


def _products(df: DataFrame, size: int, center, parts: int) -> np.ndarray:
    """Sum over rows of the outer product of center(x) with itself; one size x size matrix a task, added up by matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros((size, size)), False
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                y = center(_matrix(batch.column(0).slice(first, ROWS)))
                total += y.T @ y
                any_ = True
        if any_:
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, size * size + 1, size), pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), values], names=["place", "products"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += _matrix(batch.column(batch.schema.get_field_index("products"))).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["place", "products"])

    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("products", T.ArrayType(T.DoubleType()))])
    rows = df.select("x").coalesce(parts).mapInArrow(run, schema).groupBy("place").applyInArrow(add, schema).collect()
    out = np.zeros((size, size))
    for row in rows:
        out[row["place"]] = row["products"]
    return (out + out.T) / 2


OUT = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]


def whiten(df: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row for every vector that takes part and every component: key, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    schema = T.StructType([df.select(key).schema[0], *(T.StructField(n, t) for n, t in OUT)])
    vectors = whole_vectors(df, column, key)
    common_size = vectors.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    dimension = common_size["size"] if common_size else 0
    if not dimension:
        return spark.createDataFrame([], schema)
    vectors = vectors.where(F.size("x") == dimension)
    fit = common.stage(vectors.select("x").distinct(), "whitening-fit")
    n, sums = _sums(fit, dimension)
    parts = spark.sparkContext.defaultParallelism
    mean = Whitening(n, np.array([int(s) for s in sums], np.int64), np.zeros((0, dimension)), np.zeros(0))
    covariance = _products(fit, dimension, lambda x: mean.centred(x)[1], parts) / n
    values, axes = leading_components(covariance, components)
    count = int((values > RANK * max(float(values[0]), 0.0)).sum()) if values[0] > 0 else 0
    if not count:
        return spark.createDataFrame([], schema)
    values, axes = values[:count], axes[:count]
    model = Whitening(n, mean.sums, axes / np.sqrt(values)[:, None], values / float(np.trace(covariance)))
    of_result = _products(fit, count, model.project, parts) / n
    error = float(np.abs(of_result - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                x = _matrix(part.column(1))
                rows = len(x)
                deviation, holds = model.deviation(x)
                repeat = pa.array(np.repeat(np.arange(rows), count))
                columns = [
                    part.column(0).take(repeat), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)), pa.array(np.full(rows * count, n)),
                    pa.array(deviation, mask=~holds).take(repeat), pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * count, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.select(key, "x").mapInArrow(run, schema)


def op13_householder_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(common.table(spark, sf_dir, "embeddings"))
