"""Whitening of embeddings: pivoted Cholesky of the scatter, one-sided Jacobi on its factor.

The scatter A of the centred vectors is factored as L L' with the largest remaining diagonal entry
first.  Rotations of pairs of columns make the columns of L orthogonal; as L L' is unchanged by
them, the squared column norms are then the eigenvalues of A, and the normalised columns its
eigenvectors, small ones as accurate as large ones.

Only matrices of dimension x dimension entries, whatever the number of vectors, reach the driver.
"""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Scaled entries are held within this magnitude, where doubles are whole numbers.
LARGEST = 2 ** 52
#: Rows whitened at a time.
SLICE = 2048
EPS = np.finfo(float).eps


def pivoted_cholesky(a):
    """L with L L' = a up to rounding, a column per rank, of a positive semidefinite matrix."""
    a, n = np.array(a, float), len(a)
    factor, left = np.zeros((n, n)), np.array(np.diag(a), float)
    enough = n * EPS * (left.max() if n else 0.0)
    for k in range(n):
        pivot = int(left.argmax())
        if left[pivot] <= enough:
            return factor[:, :k]
        root = math.sqrt(left[pivot])
        column = (a[:, pivot] - factor[:, :k] @ factor[pivot, :k]) / root
        column[left < 0] = 0.0            # rows that were pivots already
        column[pivot] = root
        factor[:, k] = column
        left -= column * column
        left[pivot] = -np.inf
    return factor


def rounds(n):
    """Every pair of n columns once, in rounds of disjoint pairs (a round-robin tournament)."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < n]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        seats.insert(1, seats.pop())


def one_sided_jacobi(factor, sweeps=60):
    """(eigenvalues falling, unit eigenvectors as columns) of factor @ factor.T."""
    g = np.array(factor, float)
    plan = list(rounds(g.shape[1]))
    for _ in range(sweeps):
        turned = False
        for i, j in plan:
            x, y = g[:, i], g[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            todo = np.abs(xy) > EPS * np.sqrt(xx * yy)
            if not todo.any():
                continue
            turned = True
            i, j, x, y = i[todo], j[todo], x[:, todo], y[:, todo]
            zeta = (yy[todo] - xx[todo]) / (2 * xy[todo])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            g[:, i], g[:, j] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    norms = np.sqrt((g * g).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, g[:, order] / norms[order]


def scaled(vectors):
    """Whole numbers floor(SCALE * c) + SHIFT of an Arrow list column without nulls, a row each."""
    flat = np.asarray(vectors.flatten(), np.float64).reshape(len(vectors), -1)
    return np.clip(np.floor(SCALE * flat) + SHIFT, -LARGEST, LARGEST).astype(np.int64)


def products(y):
    """y' y of whole numbers, exactly, as Python integers."""
    small = len(y) == 0 or float(np.abs(y).max()) ** 2 * len(y) < 2 ** 53
    out = y.astype(float).T @ y.astype(float) if small else y.astype(object).T @ y.astype(object)
    return out.astype(np.int64).tolist() if small else out.tolist()


def usable(vectors, id_column="vec_id", column="embedding"):
    """vec_id and vector of the rows that take part, with the vectors' common dimension.

    Rows whose vector is null, empty, shorter than the longest, or holds null, NaN or an infinity
    take no part.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter(
        "size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    dimension = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.filter(F.size("v") == dimension), dimension


def column_sums(x):
    """Sums by column of whole numbers, exactly."""
    small = float(np.abs(x).max(initial=0)) * len(x) < 2 ** 62
    return (x if small else x.astype(object)).sum(0).tolist()


def _sums(df, fn, kind):
    """The sum, over all batches of vectors, of the matrix `fn(vectors)`, as a flat list.

    Every task adds up its own batches; the entries of all tasks are added by place, as `kind`.
    They travel as text, which holds whole numbers of any size and gives a double back exactly."""
    def run(batches):
        total = None
        for batch in batches:
            part = np.array(fn(batch.column("v")), object)
            total = part if total is None else total + part
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(range(len(flat)), pa.int64()), "value": pa.array(map(str, flat), pa.string())})

    parts = df.select("v").mapInArrow(run, "place bigint, value string")
    added = parts.groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("total"))
    return [r.total for r in added.orderBy("place").collect()]


class Whitening:
    """Fitted on a table of usable rows: n, sums, eigenvalues, components, trace."""

    def __init__(self, rows, dimension, components=COMPONENTS):
        self.dimension = dimension
        exact = lambda fn: [int(x) for x in _sums(rows, fn, "decimal(38,0)")]
        self.n, *self.sums = exact(lambda v: [len(v), *column_sums(scaled(v))]) or [0]
        # the means, rounded, are taken off before multiplying; their rest is put right exactly
        middle = self.middle = np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)
        around = exact(lambda v: products(scaled(v) - middle))
        rest = [s - self.n * int(m) for s, m in zip(self.sums, middle)]
        scatter = [[around[i * dimension + j] * self.n - rest[i] * rest[j] for j in range(dimension)]
                   for i in range(dimension)]
        a = np.array([[float(Fraction(x, self.n ** 2)) for x in row] for row in scatter]).reshape(dimension, dimension)
        values, vectors = one_sided_jacobi(pivoted_cholesky(a))
        self.values, self.vectors = values[:components], vectors[:, :components]
        self.trace = float(sum((Fraction(scatter[i][i], self.n ** 2) for i in range(dimension)), Fraction(0)))
        self.rest = np.array([float(Fraction(r, self.n)) for r in rest])

    def centred(self, x):
        return (x - self.middle).astype(float) - self.rest

    def whiten(self, x):
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x):
        """Sum over dimensions of (n x - S)^2 of each row, exact."""
        # the difference is n (x - middle) - (S - n middle)
        rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        y = x - self.middle
        bound = (self.n * (float(np.abs(y).max(initial=0)) + 1)) ** 2 * max(1, self.dimension)
        kind = np.int64 if bound < 2 ** 62 else object
        d = y.astype(kind) * self.n - np.array(rest, kind)
        return (d * d).sum(1).tolist()


def identity_error(rows, fit):
    """Largest entry of the covariance of the whitened rows minus the identity."""
    k = len(fit.values)

    def sums(v):
        w = fit.whiten(scaled(v))
        return np.vstack([w.sum(0), w.T @ w])

    total = np.array(_sums(rows, sums, "double")).reshape(k + 1, k) / fit.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(spark, vectors, id_column="vec_id", column="embedding", components=COMPONENTS):
    """vec_id, component, n, deviation, whitened, explained, identity_error per usable row and
    component.

    See `usable` for the rows that take part; a null vec_id stays null, repeated rows count and are
    returned as often as they occur, other columns are ignored.  Components of no variance do not
    exist: a table of one distinct vector, or an empty one, gives no rows.  Scaled entries are held
    within 2^52.  Sums are exact to 38 digits, beyond which Spark's own overflow rule applies.
    `deviation` is a decimal of 38 digits.  Eigenvalues that are equal leave their components free
    to turn among themselves; all rows get the same ones.
    """
    rows, dimension = usable(vectors, id_column, column)
    schema = (f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n bigint, deviation string, "
              "whitened double, explained double, identity_error double")
    exact = lambda df: df.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
    fit = Whitening(rows, dimension, components)
    k = len(fit.values)
    if k == 0:
        return exact(spark.createDataFrame([], schema))
    error, explained = identity_error(rows, fit), fit.values / fit.trace

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                x = scaled(batch.column("v"))
                m = len(x)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    "n": pa.array(np.full(m * k, fit.n), pa.int64()),
                    "deviation": pa.array([str(d) for d in fit.deviations(x) for _ in range(k)], pa.string()),
                    "whitened": pa.array(fit.whiten(x).ravel(), pa.float64()),
                    "explained": pa.array(np.tile(explained, m), pa.float64()),
                    "identity_error": pa.array(np.full(m * k, error), pa.float64())})

    return exact(rows.mapInArrow(run, schema))
