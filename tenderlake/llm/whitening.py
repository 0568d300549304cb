"""Whitening of vectors by an incremental eigendecomposition.

Every partition keeps the spectrum of the scatter of the vectors it has seen: their number, their mean,
and the eigenvalues and eigenvectors around it. A batch of vectors is centred on its own mean
and brought to triangular form, whose few rows have the scatter of the batch; each of them, and the step between
the two means, is one symmetric rank-one change. A rank-one change is solved in the eigenbasis: coordinates
that do not move are deflated, the roots of the secular equation are the new eigenvalues, and the
Cauchy vectors of these roots turn the basis. Spectra of partitions are combined the same way, one eigenpair after the other,
a few at a time until one is left. Rounding that has built up goes in a final distributed Rayleigh-Ritz step:
all vectors are projected on the basis once more and the small projected covariance is diagonalised.

Sums of the integer vectors are exact, so deviations are exact too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.session import staged

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Spectra that one task combines at a time; each holds the square of the number of dimensions.
FAN_IN = 16
#: Eigenvalues below this share of the largest are no component: their direction is not determined.
LEAST = 1e-12
_EPS = np.finfo(np.float64).eps
_ROUNDS = 80
_OUT_ROWS = 4096
_STATE = "dims int, n long, sums array<long>, mean array<double>, values array<double>, basis binary"


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + z z'`` for ascending, distinct ``d`` and ``z`` without zeros.

    Returns for each root the index of its nearest pole and its distance from that pole, which
    keeps full precision however close they are. All roots are found at once: each lies between
    two poles, and a step of the two-pole rational interpolation that leaves the root's bracket is
    replaced by bisection.
    """
    k = len(d)
    squares = z * z
    upper = np.append(d[1:], d[-1] + squares.sum())
    half = (upper - d) / 2
    # the nearest pole: by the sign in the middle of the interval; the last root hangs on the last pole
    middle = 1 + np.sum(squares / ((d - d[:, None]) - half[:, None]), axis=1)
    left = middle >= 0
    left[-1] = True
    pole = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    gaps = d - d[pole][:, None]
    low, high = np.where(left, 0.0, -half), np.where(left, half, 0.0)
    high[-1] = upper[-1] - d[-1]
    at = (low + high) / 2
    below = np.tril(np.ones((k, k), bool))
    first, second = d - d[pole], upper - d[pole]
    for _ in range(_ROUNDS):
        inverse = 1 / (gaps - at[:, None])
        terms = squares * inverse
        value = 1 + terms.sum(axis=1)
        size = 1 + np.abs(terms).sum(axis=1)
        low, high = np.where(value < 0, at, low), np.where(value > 0, at, high)
        done = (np.abs(value) <= 4 * _EPS * k * size) | (high - low <= 2 * _EPS * np.abs(at))
        if done.all():
            break
        slopes = terms * inverse
        psi = np.where(below, slopes, 0).sum(axis=1)
        phi = slopes.sum(axis=1) - psi
        a, b = first - at, second - at
        c = value - a * psi - b * phi
        linear, constant = (a + b) * value - a * b * (psi + phi), a * b * value
        root = np.sqrt(np.maximum(linear * linear - 4 * constant * c, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(linear <= 0, (linear - root) / (2 * c), 2 * constant / (linear + root))
        moved = at + step
        inside = np.isfinite(moved) & (moved > low) & (moved < high)
        # between bounds of one sign, the geometric mean halves the exponent as well
        geometric = np.sign(low + high) * np.sqrt(np.abs(low * high))
        between = np.where((low * high > 0), geometric, (low + high) / 2)
        between = np.where(low * high == 0, np.where(np.abs(low + high) > 0, (low + high) / 16, 0.0), between)
        at = np.where(done, at, np.where(inside, moved, between))
    return pole, at


@dataclass
class Spectrum:
    """Number, exact sums, mean, and eigenpairs (ascending) of the scatter around the mean."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims, np.int64), np.zeros(dims), np.zeros(dims), np.eye(dims))

    def rank_one(self, vector: np.ndarray) -> None:
        """Add ``vector vector'`` to the scatter."""
        z = vector @ self.basis
        d = self.values
        tolerance = 8 * _EPS * max(abs(d[-1]) if len(d) else 0.0, float(z @ z))
        if tolerance == 0:
            return
        # poles that coincide: a rotation puts all of their weight on one of them
        for i in np.flatnonzero(np.diff(d) <= tolerance).tolist():
            length = np.hypot(z[i], z[i + 1])
            if length > 0:
                c, s = z[i + 1] / length, z[i] / length
                one, two = self.basis[:, i].copy(), self.basis[:, i + 1].copy()
                self.basis[:, i], self.basis[:, i + 1] = c * one - s * two, s * one + c * two
                z[i], z[i + 1] = 0.0, length
        moving = np.flatnonzero(np.abs(z) * np.sqrt(z @ z) > tolerance)
        if not len(moving):
            return
        poles, weight = d[moving], z[moving]
        pole, offset = secular_roots(poles, weight)
        distance = (poles - poles[pole][:, None]) - offset[:, None]  # pole j minus root i
        # the weights that have exactly these roots, so that the vectors come out orthogonal
        apart = poles[:, None] - poles
        np.fill_diagonal(apart, 1.0)
        ratios = -distance / apart.T
        np.fill_diagonal(ratios, -np.diag(distance))
        exact = np.sqrt(np.abs(np.prod(ratios, axis=0))) * np.sign(weight)
        vectors = exact / distance
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        values = d.copy()
        values[moving] = poles[pole] + offset
        basis = self.basis
        basis[:, moving] = basis[:, moving] @ vectors.T
        order = np.argsort(values, kind="stable")
        self.values, self.basis = values[order], basis[:, order]

    def _join(self, n: int, sums: np.ndarray, mean: np.ndarray) -> None:
        both = self.n + n
        if self.n and n:
            self.rank_one((mean - self.mean) * np.sqrt(self.n * (n / both)))
        self.mean = self.mean + (mean - self.mean) * (n / both)
        self.sums, self.n = self.sums + sums, both

    def add(self, x: np.ndarray) -> None:
        """Add integer vectors, one in each row."""
        if not len(x):
            return
        mean = (x - x[0]).mean(axis=0) + x[0]
        centred = x - mean
        for row in np.linalg.qr(centred, mode="r") if len(x) > x.shape[1] else centred:
            self.rank_one(row)
        self._join(len(x), x.sum(axis=0), mean)

    def combine(self, other: Spectrum) -> None:
        """Add another spectrum, one eigenpair after the other."""
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.rank_one(vector * np.sqrt(value))
        if other.n:
            self._join(other.n, other.sums, other.mean)

    def row(self) -> dict:
        return {"dims": len(self.mean), "n": self.n, "sums": self.sums, "mean": self.mean, "values": self.values,
                "basis": np.ascontiguousarray(self.basis).tobytes()}

    @classmethod
    def of(cls, row) -> Spectrum:
        basis = np.frombuffer(row.basis).reshape(row.dims, row.dims).copy()
        return cls(int(row.n), *(np.array(v) for v in (row.sums, row.mean, row.values)), basis)


def _integers(column: pd.Series) -> np.ndarray:
    """``floor(64 c)`` of each entry, as longs; the common shift is added where it matters."""
    scaled = np.floor(np.array(column.tolist(), dtype=np.float64) * SCALE)
    if len(scaled) and np.abs(scaled).max() >= 1 << 52:
        raise OverflowError("an entry is too large to be counted in 64ths exactly")
    return scaled.astype(np.int64)


def _by_length(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    for dims, part in pdf.groupby(pdf["embedding"].map(len)):
        yield int(dims), part


def fit_spectra(points: DataFrame) -> dict[int, Spectrum]:
    """The spectrum of all vectors, for each length of vectors; ``points`` has ``embedding``."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[int, Spectrum] = {}
        for pdf in frames:
            for dims, part in _by_length(pdf):
                own.setdefault(dims, Spectrum.empty(dims)).add(_integers(part["embedding"]))
        if own:
            yield pd.DataFrame([s.row() for s in own.values()])

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.itertuples())
        total = Spectrum.of(rows[0])
        for row in rows[1:]:
            total.combine(Spectrum.of(row))
        return pd.DataFrame([total.row()])

    states = staged(points.select("embedding").mapInPandas(partial, _STATE))
    most = states.groupBy("dims").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        # numbered by their order, so that groups are even; the rows are few and small
        place = F.row_number().over(Window.partitionBy("dims").orderBy("n", "sums", "mean", "values")) - 1
        groups = states.withColumn("__group", F.floor(place / FAN_IN)).groupBy("dims", "__group")
        states = staged(groups.applyInPandas(merge, _STATE))
        most = -(-most // FAN_IN)
    return {row.dims: Spectrum.of(row) for row in states.toLocalIterator()}


def _summed(points: DataFrame, task, dims: int) -> np.ndarray:
    """Add up one matrix from every task, row by row in Spark; ``dims`` rows reach the driver."""
    rows = points.mapInPandas(task, "row int, entries array<double>")
    at = F.posexplode("entries").alias("column", "entry")
    found = rows.select("row", at).groupBy("row", "column").agg(F.sum("entry").alias("entry"))
    total = np.zeros((dims, dims))
    for r in found.collect():
        total[r.row, r.column] = r.entry
    return total


def _rows_of(total: np.ndarray | None) -> Iterator[pd.DataFrame]:
    if total is not None:
        yield pd.DataFrame({"row": np.arange(len(total), dtype=np.int32), "entries": list(total)})


@dataclass
class Whitening:
    """Components by falling eigenvalue: directions as columns, eigenvalues, shares of the trace."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - self.sums / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The exact sum over dimensions of ``(n x - S)^2``."""
        if self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.sums).max(initial=0)) < 1 << 62:
            apart = x * self.n - self.sums
            if float((apart.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < 1 << 62:
                return (apart * apart).sum(axis=1)
        exact = [sum((self.n * int(a) - int(s)) ** 2 for a, s in zip(row, self.sums)) for row in x]
        if max(exact) >= 1 << 63:
            raise OverflowError("a deviation does not fit a long")
        return np.array(exact, np.int64)


def refine(points: DataFrame, spectrum: Spectrum, components: int) -> Whitening:
    """Rayleigh-Ritz on the basis of a spectrum, and the check of what it whitens."""
    dims, n = len(spectrum.mean), spectrum.n
    basis, _ = np.linalg.qr(spectrum.basis[:, ::-1])
    centre = spectrum.sums / n
    own = points.where(F.size("embedding") == dims).select("embedding")

    def product(of) -> object:
        def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for pdf in frames:
                if len(pdf):
                    y = of(_integers(pdf["embedding"]))
                    total = y.T @ y if total is None else total + y.T @ y
            yield from _rows_of(total)

        return task

    small = _summed(own, product(lambda x: (x - centre) @ basis), dims) / n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    most = min(components, int(np.count_nonzero(values > LEAST * max(values[0], 0)))) if values[0] > 0 else 0
    directions = (basis @ turn)[:, :most]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(most)])
    trace = np.trace(small)
    found = Whitening(n, spectrum.sums, directions, values[:most], values[:most] / trace if most else values[:0])
    if most:
        # the mean of what is whitened is zero by the exact sums, so the products are its covariance
        covariance = _summed(own, product(found.whiten), most) / n
        found.identity_error = float(np.abs(covariance - np.eye(most)).max())
    return found


def whiten_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row per vector and component.

    Rows whose vector is null or holds null or non-finite entries are left out; every other row counts, repeated rows
    and null ids too. An entry ``c`` becomes ``floor(64 c) + 1000000``. Vectors of each length are a
    fit list of their own. Directions without variance are no components, so equal vectors, a single
    vector, empty vectors and an empty table give no rows. Within equal eigenvalues any basis may be returned, the
    same for all rows; a direction's largest entry is positive. Further columns are not read. Entries of 2^46 or
    more and deviations beyond a long raise an OverflowError.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    points = rows.where(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0))
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    models = {dims: refine(points, spectrum, components) for dims, spectrum in fit_spectra(points).items()}
    held = spark.sparkContext.broadcast(models)

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for dims, part in _by_length(pdf):
                m = held.value[dims]
                k = len(m.values)
                for at in range(0, len(part) if k else 0, _OUT_ROWS):
                    some = part.iloc[at : at + _OUT_ROWS]
                    x = _integers(some["embedding"])
                    yield pd.DataFrame({
                        "vec_id": some["vec_id"].astype("Int64").repeat(k).array, "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                        "n": m.n, "deviation": m.deviation(x).repeat(k), "whitened": m.whiten(x).ravel(),
                        "explained": np.tile(m.explained, len(x)), "identity_error": m.identity_error,
                    })

    return points.mapInPandas(project, kind)
