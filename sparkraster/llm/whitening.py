"""Whitening of vectors by principal components, their spectrum kept by rank-one updates.

*Incremental.* A part of the data holds its count, exact sums, and the eigenvectors and
eigenvalues of its scatter about its mean. A row changes the scatter by one rank: the roots of the
secular equation are the new eigenvalues, and the vectors that they give, the coordinates computed anew from
the roots so that they stay orthogonal, turn the old basis. Coordinates of no weight and equal eigenvalues are
deflated first. A batch of rows is turned to its triangular factor first, so it takes as many updates as there are dimensions.

*Combined.* Two parts are one by an update per eigenpair of the second, and one for the distance of their
means. Sixteen parts meet in a task at a time, until one is left; nothing grows with the data.

*Refined.* In the basis found, the exact covariance is summed up over all rows; its eigenvectors turn
the basis to the components (Rayleigh-Ritz on the whole space, so they are those of the covariance).

*Measured.* The whitened rows' own covariance is summed up in a pass of its own; its distance from the identity is reported.

Cases: vectors that are null, or hold null or non-finite entries, are dropped, and so are empty ones. Vectors of another
dimension than the most frequent one (of equally frequent ones the largest) are dropped, too. A component without variance
(a single row, all rows equal, fewer rows than components) has whitened null and takes no part in the identity error. Repeated rows and null
keys count each for themselves; a deviation beyond a long is null. An empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy

#: Parts that meet in a task.
FAN_IN = 16
EPS, TINY = float(np.finfo(float).eps), float(np.finfo(float).tiny)
#: Rows of a batch.
ROWS = 4096
#: Fixed-point scale and shift of the entries.
SCALE, SHIFT = 1024, 100_000


def secular(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - x)), as the index of the nearer pole and the distance from it.

    ``poles`` ascend strictly and ``weights`` are above 0, so each root lies between a pole and the next (the last one less than
    the sum of weights above its pole). Steps fit a pole on either side; a step outside what signs allow halves it.
    """
    n = len(poles)
    right = np.append(poles[1:], poles[-1] + weights.sum())
    middle = poles + (right - poles) / 2
    at = np.arange(n)
    above = 1 + (weights / (poles - middle[:, None])).sum(1) < 0  # the root lies in the upper half
    nearer = np.where(above & (at < n - 1), at + 1, at)
    shifted = poles - poles[nearer][:, None]
    lower = np.where(above, middle, poles) - poles[nearer]
    upper = np.where(above, right, middle) - poles[nearer]
    low_pole, high_pole = poles - poles[nearer], right - poles[nearer]
    x = lower + (upper - lower) / 2
    below, done = np.tri(n), np.zeros(n, bool)
    for _ in range(60):
        gap = shifted - x[:, None]
        gap[gap == 0] = TINY
        terms = weights / gap
        slopes = terms / gap
        value, size = 1 + terms.sum(1), 1 + np.abs(terms).sum(1)
        lower, upper = np.where(value < 0, x, lower), np.where(value < 0, upper, x)
        done |= (np.abs(value) <= EPS * n * size) | (upper - lower <= 2 * EPS * np.abs(x))
        if done.all():
            break
        before, after = (slopes * below).sum(1), (slopes * (1 - below)).sum(1)
        d1, d2 = low_pole - x, high_pole - x
        c = value - d1 * before - d2 * after
        a, b = (d1 + d2) * value - d1 * d2 * (before + after), d1 * d2 * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
        new = x + step
        half = ~(np.isfinite(new) & (new > lower) & (new < upper))
        x = np.where(done, x, np.where(half, lower + (upper - lower) / 2, new))
    return nearer, x


def updated(values: np.ndarray, vectors: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of vectors diag(values) vectors' + row row'."""
    z = row @ vectors
    norm2 = float(z @ z)
    if norm2 == 0 or not np.isfinite(norm2):
        return values, vectors
    tiny = 8 * EPS * max(float(values[-1]), norm2)
    # Equal eigenvalues: a reflection leaves one coordinate of weight among them.
    close = np.diff(values) <= tiny
    if close.any():
        values, vectors = values.copy(), vectors.copy()
        cuts = np.flatnonzero(~close) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            if b - a > 1:
                u = z[a:b].copy()
                length = np.sqrt(u @ u)
                u[-1] += length if u[-1] >= 0 else -length
                if u @ u > 0:
                    own = vectors[:, a:b]
                    vectors[:, a:b] = own - np.outer(own @ u, 2 * u / (u @ u))
                    last = -length if z[b - 1] >= 0 else length
                    z[a:b], z[b - 1] = 0, last
                values[a:b] = values[a:b].mean()
    alive = np.abs(z) * np.sqrt(norm2) > tiny
    if not alive.any():
        return values, vectors
    d, w = values[alive], z[alive] ** 2
    pole, x = secular(d, w)
    n = len(d)
    gaps = (d[None, :] - d[pole][:, None]) - x[:, None]  # pole j minus root i
    # The coordinates that have exactly these roots.
    other = d[None, :] - d[:, None]
    np.fill_diagonal(other, 1)
    ratio = -gaps / other.T  # root i minus pole j, over pole i minus pole j; the diagonal over 1
    exact = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(z[alive])
    turn = exact[None, :] / gaps
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[alive] = d[pole] + x
    vectors[:, alive] = vectors[:, alive] @ turn.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums and the scatter's eigenpairs of some rows of whole numbers."""

    def __init__(self, dims: int):
        self.n, self.sums = 0, np.array([0] * dims, object)
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def add(self, rows: np.ndarray) -> None:
        """Some rows: an update for each one, centred at their mean, and one for the distance of that mean.

        More rows than dimensions are turned to their triangular factor first, which has the same scatter in as many rows as dimensions.
        """
        own = Spectrum(rows.shape[1])
        own.n, own.sums = len(rows), rows.sum(0).astype(object)
        centred = rows - own.mean()
        for row in np.linalg.qr(centred, mode="r") if len(rows) > rows.shape[1] else centred:
            self.values, self.vectors = updated(self.values, self.vectors, row)
        if self.n:
            self._apart(own.mean() - self.mean(), self.n * own.n / (self.n + own.n))
        self.n, self.sums = self.n + own.n, self.sums + own.sums

    def mean(self) -> np.ndarray:
        return (self.sums / self.n).astype(float)

    def _apart(self, gap: np.ndarray, weight: float) -> None:
        self.values, self.vectors = updated(self.values, self.vectors, gap * np.sqrt(weight))

    def combine(self, other: Spectrum) -> None:
        if other.n and self.n:
            for value, vector in zip(other.values, other.vectors.T):
                if value > 0:
                    self.values, self.vectors = updated(self.values, self.vectors, vector * np.sqrt(value))
            self._apart(other.mean() - self.mean(), self.n * other.n / (self.n + other.n))
        elif other.n:
            self.values, self.vectors = other.values, other.vectors
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(v) for v in self.sums], "matrix": np.vstack([self.values, self.vectors]).tobytes()}

    @classmethod
    def of(cls, row: dict) -> Spectrum:
        out = cls(len(row["sums"]))
        out.n, out.sums = row["n"], np.array([int(v) for v in row["sums"]], object)
        matrix = np.frombuffer(row["matrix"]).reshape(len(out.sums) + 1, -1)
        out.values, out.vectors = matrix[0].copy(), matrix[1:].copy()
        return out


class Moments:
    """Count, mean and centred products of some rows of numbers."""

    def __init__(self, dims: int):
        self.n, self.mean, self.products = 0, np.zeros(dims), np.zeros((dims, dims))

    def add(self, rows: np.ndarray) -> None:
        if len(rows):
            own = Moments(rows.shape[1])
            own.n, own.mean = len(rows), rows.mean(0)
            centred = rows - own.mean
            own.products = centred.T @ centred
            self.combine(own)

    def combine(self, other: Moments) -> None:
        if other.n:
            n, gap = self.n + other.n, other.mean - self.mean
            self.products = self.products + other.products + np.outer(gap, gap) * (self.n * other.n / n)
            self.mean, self.n = self.mean + gap * (other.n / n), n

    def row(self) -> dict:
        return {"n": self.n, "sums": [], "matrix": np.vstack([self.mean, self.products]).tobytes()}

    @classmethod
    def of(cls, row: dict) -> Moments:
        matrix = np.frombuffer(row["matrix"])
        dims = int((np.sqrt(1 + 4 * len(matrix)) - 1) / 2 + 0.5)
        out = cls(dims)
        out.n, out.mean, out.products = row["n"], matrix[:dims].copy(), matrix[dims:].reshape(dims, dims).copy()
        return out


_PART = pa.schema([("place", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("matrix", pa.binary())])
_KINDS = "place long, n long, sums array<string>, matrix binary"


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column(batch.num_columns - 1)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _summed(make, take):
    """Batches to one part per task: ``make()`` starts it, ``take(part, vectors)`` takes rows in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = make()
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                take(part, batch.slice(a, ROWS))
        if part.n:
            yield pa.RecordBatch.from_pylist([part.row() | {"place": TaskContext.get().partitionId()}], _PART)

    return run


def _combined(kind):
    """Parts of a group to one."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        part = kind.of(rows[0])
        for row in rows[1:]:
            part.combine(kind.of(row))
        return pa.Table.from_pylist([part.row() | {"place": key[0].as_py()}], _PART)

    return run


def _one(parts: DataFrame, kind, name: str):
    """The only part left after groups of ``FAN_IN`` were combined again and again; None if there is none."""
    parts = stored(parts, name)
    while True:
        most = parts.agg(F.max("place")).first()[0]
        if most is None:
            return None
        if most < 1:
            return kind.of(parts.first().asDict())  # one row, dims squared
        grouped = parts.withColumn("place", F.floor(F.col("place") / FAN_IN).cast("long"))
        # A group of places that holds no part leaves a gap, no more.
        parts = stored(grouped.withColumn("group", F.col("place")).groupBy("group").applyInArrow(_combined(kind), _KINDS), name)


def _rows(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x) of the rows that count: finite entries as whole numbers."""
    c = F.col(vector).cast("array<double>")
    rows = df.select(F.col(key).cast("long").alias("key"), c.alias("c"))
    rows = rows.where("c is not null and size(c) > 0 and forall(c, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))")
    return rows.select("key", F.transform("c", lambda v: (F.floor(v * SCALE) + SHIFT).cast("long")).alias("x"))


def _spectrum_of(dims: int):
    return _summed(lambda: Spectrum(dims), lambda part, batch: part.add(_vectors(batch, dims)))


def _moments_of(dims: int, pivot: np.ndarray, basis: np.ndarray):
    """Moments of (x - pivot) in ``basis``."""
    return _summed(lambda: Moments(basis.shape[1]), lambda part, batch: part.add((_vectors(batch, dims) - pivot) @ basis))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of (n x - S)^2, exactly."""
    mean = [s // n for s in sums]
    gap, rest = x - np.array(mean), np.array([s - m * n for s, m in zip(sums, mean)], object)
    most = int(np.abs(gap).max(initial=0)) + 1
    if (most * n) ** 2 * x.shape[1] < 2**62:
        own = gap * n - rest.astype(np.int64)
        return (own * own).sum(1).tolist()
    own = gap.astype(object) * n - rest
    return [v if v < 2**63 else None for v in (own * own).sum(1).tolist()]


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for every vector that counts and component.

    Components are numbered by falling variance, ``components`` at most.
    """
    spark = df.sparkSession
    rows = _rows(df, key, vector)
    kinds = "key long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = kinds.replace("key", key, 1)
    sizes = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], names)
    dims = sizes[0]["dims"]
    rows = rows.where(F.size("x") == dims)
    whole = _one(rows.mapInArrow(tidy(_spectrum_of(dims)), _KINDS), Spectrum, "spectra")
    n, sums = whole.n, [int(s) for s in whole.sums]
    # Whole numbers first, so that nothing is lost in the difference.
    base = np.array([s // n for s in sums])
    rest = np.array([(s - int(b) * n) / n for s, b in zip(sums, base)])
    exact = _one(rows.mapInArrow(tidy(_moments_of(dims, base, whole.vectors)), _KINDS), Moments, "covariance")
    values, turn = np.linalg.eigh(exact.products / n)
    values, basis = np.maximum(values[::-1], 0), (whole.vectors @ turn)[:, ::-1]
    many = min(components, dims)
    total = float(values.sum())
    there = values[:many] > 64 * EPS * max(total, TINY)
    scaled = basis[:, :many] / np.sqrt(np.where(there, values[:many], 1.0))
    error = 0.0
    if there.any():
        seen = _one(rows.mapInArrow(tidy(_moments_of(dims, base, scaled[:, there])), _KINDS), Moments, "identity")
        error = float(np.abs(seen.products / n - np.eye(int(there.sum()))).max())
    explained = (values[:many] / total if total else np.zeros(many)).tolist()
    schema = pa.schema([(a, {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}[b]) for a, b in map(str.split, kinds.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _vectors(part, dims)
                m = len(x)
                white = ((x - base) - rest) @ scaled
                columns = [
                    part.column(0).take(pa.array(np.repeat(np.arange(m), many))), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), m)), pa.array([n] * (m * many), pa.int64()),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), many))), pa.array(white.ravel(), mask=np.tile(~there, m)),
                    pa.array(explained * m, pa.float64()), pa.array([error] * (m * many)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(tidy(run), kinds).withColumnRenamed("key", key)
