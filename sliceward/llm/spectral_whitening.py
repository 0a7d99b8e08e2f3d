"""Embedding whitening by incremental eigendecomposition.

Every part of the vectors keeps a spectrum: number, mean, and eigenvalues and eigenvectors of the scatter of what it has
seen. A vector is a centred rank-one update, which solves the secular equation of the spectrum after deflation and turns
the eigenvectors. Spectra of two parts are combined by successive rank-one updates with the scaled eigenvectors of one and
the difference of the means, in a tree over the parts. The combined eigenvectors then span the space in which a last pass
over all vectors takes the exact covariance (Rayleigh-Ritz), so that what rounding has left is removed.

A spectrum has dimension * (dimension + 1) numbers, whatever the number of vectors; nothing else reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceward.sources.stored import settle

COMPONENTS = 8
# Scale and shift of an entry.
SCALE, SHIFT = 1024, 100_000
#: An eigenvalue below this part of the trace counts as zero.
NOTHING = 1e-10
#: Spectra that one task combines.
FAN_IN = 8
#: Steps at most for a root of the secular equation.
STEPS = 60
EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum z2 / (d - x), one in each interval between the poles d and one above the last.

    d ascends strictly, z2 is positive. Returns for each root its nearest pole's number and the distance from that pole,
    which keeps differences of roots and poles exact to the last digits.
    """
    k, at = len(d), np.arange(len(d))
    upper = np.append(d[1:], d[-1] + z2.sum())
    half = (upper - d) / 2
    middle = 1 + (z2 / ((d - d[:, None]) - half[:, None])).sum(axis=1)
    near = np.where((middle <= 0) & (at < k - 1), at + 1, at)
    poles = d - d[near][:, None]
    # The root's place is between low and high, counted from its pole.
    above = near > at
    low = np.where(above, -half, np.where(middle <= 0, half, 0.0))
    high = np.where(above, 0.0, np.where(middle <= 0, 2 * half, half))
    x = (low + high) / 2
    left = np.tril(np.ones((k, k)))
    ends = np.stack((poles[at, at], np.append(poles[at[:-1], at[1:]], np.inf)))
    open_roots = np.ones(k, bool)
    for _ in range(STEPS):
        gap = poles - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            part = z2 / gap
            slope = part / gap
        below, below_slope = (part * left).sum(axis=1), (slope * left).sum(axis=1)
        over, over_slope = part.sum(axis=1) - below, slope.sum(axis=1) - below_slope
        value = 1 + below + over
        size = 1 + np.abs(below) + np.abs(over)
        open_roots &= np.abs(value) > 4 * EPS * k * size
        open_roots &= (high - low) > 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if not open_roots.any():
            break
        low = np.where(value <= 0, x, low)
        high = np.where(value >= 0, x, high)
        # Both sums are taken as a constant and one pole at the end of the interval; the equation gets quadratic.
        to_left, to_right = ends[0] - x, ends[1] - x
        with np.errstate(all="ignore"):
            q, s = below_slope * to_left**2, np.where(np.isinf(to_right), 0.0, over_slope * to_right**2)
            c = value - below_slope * to_left - np.where(np.isinf(to_right), 0.0, over_slope * to_right)
            # c + q / (to_left - y) + s / (to_right - y) = 0 for the step y.
            b = -(c * (to_left + to_right) + q + s)
            e = c * to_left * to_right + q * to_right + s * to_left
            root = np.sqrt(np.maximum(b * b - 4 * c * e, 0))
            pair = np.stack(((-b - root) / (2 * c), (-b + root) / (2 * c), 2 * e / (-b - root), 2 * e / (-b + root), np.where(np.isinf(to_right), to_left + q / (value - below_slope * to_left), np.nan)))
            places = x + pair
            good = (places > low) & (places < high)
        step = np.where(good.any(axis=0), np.take_along_axis(places, good.argmax(axis=0)[None, :], 0)[0], (low + high) / 2)
        x = np.where(open_roots, step, x)
    return near, x


class Spectrum:
    """Number, mean and eigendecomposition of the scatter of the vectors so far; values ascend, vectors are columns."""

    def __init__(self, dims: int, n: int = 0, mean=None, values=None, vectors=None) -> None:
        self.n, self.mean = n, np.zeros(dims) if mean is None else mean
        self.values = np.zeros(dims) if values is None else values
        self.vectors = np.eye(dims) if vectors is None else vectors

    def add(self, vector: np.ndarray) -> None:
        """Centred update by one more vector."""
        off = vector - self.mean
        self.rank_one(off * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: Spectrum) -> None:
        """The spectrum of both sets of vectors."""
        if other.n == 0:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.rank_one(np.sqrt(value) * vector)
        total = self.n + other.n
        off = other.mean - self.mean
        self.rank_one(off * np.sqrt(self.n / total * other.n))
        self.n, self.mean = total, self.mean + off * (other.n / total)

    def rank_one(self, vector: np.ndarray) -> None:
        """The eigendecomposition of the scatter plus the outer product of a vector with itself."""
        z = vector @ self.vectors
        weight = float(z @ z)
        if weight == 0 or not len(z):
            return
        d = self.values
        tiny = 8 * EPS * max(float(d[-1]), weight)
        # Deflation of equal values: in their common space the vectors are turned so that one takes all of z.
        close = np.diff(d) <= tiny
        if close.any():
            heads = np.flatnonzero(np.append(True, ~close))
            for low, high in zip(heads, [*heads[1:], len(d)], strict=True):
                if high - low > 1:
                    turn = z[low:high].copy()
                    norm = np.copysign(np.sqrt(turn @ turn), turn[-1])
                    turn[-1] += norm
                    length = turn @ turn
                    if length > 0:
                        own = self.vectors[:, low:high]
                        own -= np.outer(own @ turn, turn * (2 / length))
                        z[low:high] = 0
                        z[high - 1] = -norm
        # Deflation of small parts: what z hardly touches stays as it is.
        active = np.flatnonzero(z * z > tiny * EPS + (EPS * np.sqrt(weight)) ** 2)
        if not len(active):
            return
        own, part = d[active], z[active]
        near, place = secular_roots(own, part * part)
        # Distances of all poles from all roots, and with them the vector that has exactly these roots.
        gap = (own[None, :] - own[near][:, None]) - place[:, None]
        poles = own[None, :] - own[:, None]
        np.fill_diagonal(poles, 1.0)
        with np.errstate(divide="ignore"):
            exact = np.exp((np.log(np.abs(gap)).sum(axis=0) - np.log(np.abs(poles)).sum(axis=0)) / 2)
        turned = (np.where(part < 0, -exact, exact) / gap).T
        turned /= np.sqrt((turned * turned).sum(axis=0))
        self.vectors[:, active] = self.vectors[:, active] @ turned
        values = d.copy()
        values[active] = own[near] + place
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], self.vectors[:, order]

    def packed(self) -> bytes:
        return np.concatenate(([self.n], self.mean, self.values, self.vectors.ravel())).tobytes()

    @classmethod
    def unpacked(cls, raw: bytes, dims: int) -> Spectrum:
        all_of = np.frombuffer(raw).copy()
        mean, values, vectors = np.split(all_of[1:], [dims, 2 * dims])
        return cls(dims, int(all_of[0]), mean, values, vectors.reshape(dims, dims))


def entries(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows that take part: no null vector, no null or non-finite entry."""
    whole = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    x = F.transform("embedding", lambda e: F.floor(e.cast("double") * SCALE).cast("long") + SHIFT)
    return vectors.filter(F.coalesce(whole, F.lit(False))).select("vec_id", x.alias("x"))


def rows_of(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def combined(parts: DataFrame, count: int, together: Callable[[list[bytes]], bytes]) -> bytes | None:
    """All values of the stored rows (part long, value binary) put together in a tree, FAN_IN at a time."""

    def joined(table: pa.Table) -> pa.Table:
        order = np.argsort(table["part"].to_numpy(), kind="stable")
        values = [table["value"][int(i)].as_py() for i in order]
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN_IN]), "value": pa.array([together(values)], pa.binary())})

    while count > 1:
        parts = parts.groupBy(F.expr(f"part div {FAN_IN}")).applyInArrow(joined, "part long, value binary")
        count = -(-count // FAN_IN)
    row = parts.first()
    return bytes(row["value"]) if row else None


class Whitening:
    """What a fit gives: n and exact sums per dimension, eigenvalues falling, unit eigenvectors as columns, the trace."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float) -> None:
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean; the difference is taken in integers."""
        return (self.n * x - self.sums) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def per_part(rows: DataFrame, work: Callable[[Iterator[np.ndarray]], bytes], dims: int) -> tuple[DataFrame, int]:
    """work(batches of x) for every part that has rows, stored as (part, value); one more than the last part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = (rows_of(b, dims) for b in batches if b.num_rows)
        first = next(filled, None)
        if first is not None:
            value = work(x for xs in ([first], filled) for x in xs)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([value], pa.binary())], ["part", "value"])

    stored = settle(rows.select("x").mapInArrow(run, "part long, value binary"), "spectra")
    return stored, (stored.agg(F.max("part")).first()[0] or 0) + 1


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening along the first components of the rows' x (arrays of one length); None without rows or variance.

    Components whose eigenvalue is at most 1e-10 of the trace count as zero and are left out.
    """
    lengths = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    dims = lengths[1] or 0
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of {lengths[0]} to {lengths[1]} entries")
    if not dims:
        return None

    def spectrum(batches: Iterator[np.ndarray]) -> bytes:
        sums, found = np.zeros(dims, np.int64), Spectrum(dims)
        for batch in batches:
            sums += batch.sum(axis=0)
            for x in (batch - SHIFT).astype(np.float64):
                found.add(x)
        return sums.tobytes() + found.packed()

    def both(values: list[bytes]) -> bytes:
        sums, cut = np.zeros(dims, np.int64), 8 * dims
        found = Spectrum(dims)
        for at, value in enumerate(values):
            sums += np.frombuffer(value[:cut], np.int64)
            other = Spectrum.unpacked(value[cut:], dims)
            if at == 0:
                found = other
            else:
                found.combine(other)
        return sums.tobytes() + found.packed()

    raw = combined(*per_part(rows, spectrum, dims), both)
    sums, found = np.frombuffer(raw[: 8 * dims], np.int64), Spectrum.unpacked(raw[8 * dims :], dims)
    rough = Whitening(found.n, sums, np.ones(dims), found.vectors[:, ::-1], 0.0)

    def products(batches: Iterator[np.ndarray]) -> bytes:
        total = np.zeros((dims, dims))
        for batch in batches:
            y = rough.centred(batch) @ rough.vectors
            total += y.T @ y
        return total.tobytes()

    def added(values: list[bytes]) -> bytes:
        return sum(np.frombuffer(v) for v in values).tobytes()

    raw = combined(*per_part(rows, products, dims), added)
    inside = np.frombuffer(raw).reshape(dims, dims) / rough.n
    values, turned = np.linalg.eigh((inside + inside.T) / 2)
    trace = float(np.trace(inside))
    first = np.argsort(-values, kind="stable")[:components]
    first = first[values[first] > NOTHING * trace]
    vectors = rough.vectors @ turned[:, first]
    return Whitening(rough.n, sums, values[first], vectors / np.linalg.norm(vectors, axis=0), trace) if len(first) else None


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity, over all rows."""
    dims, k = len(fitted.sums), len(fitted.values)

    def moments(batches: Iterator[np.ndarray]) -> bytes:
        total, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            w = fitted.whitened(batch)
            total, mean = total + w.T @ w, mean + w.sum(axis=0)
        return np.concatenate((total.ravel(), mean)).tobytes()

    def added(values: list[bytes]) -> bytes:
        return sum(np.frombuffer(v) for v in values).tobytes()

    moments_of_all = np.frombuffer(combined(*per_part(rows, moments, dims), added)) / fitted.n
    mean = moments_of_all[k * k :]
    return float(np.abs(moments_of_all[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def deviations(n: int, x: np.ndarray, sums: np.ndarray) -> pa.Array:
    """Exact sums of squares of n * x - sums; null where one does not fit a long."""
    off = n * x - sums
    if (off.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 1 << 62:
        return pa.array((off * off).sum(axis=1))
    exact = [sum(int(v) ** 2 for v in row) for row in off]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component.

    Rows with a null vector or a null or non-finite entry take no part; all others are fitted on and returned, repeated
    rows each, a null vec_id as null. Vectors must have one length, else there is an error. Without rows, without entries
    or if all rows are equal there is no component and so no row; vectors of lower rank have fewer components (see
    ``fit``). ``deviation`` is null where it does not fit a long. Equal eigenvalues are in any order, a vector has either
    sign. Other columns are not read.
    """
    rows = entries(vectors)
    fitted = fit(rows, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    error, dims, k = identity_error(rows, fitted), len(fitted.sums), len(fitted.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = rows_of(batch, dims)
            each = np.repeat(np.arange(len(x)), k)
            columns = [
                batch.column("vec_id").take(pa.array(each)).cast(pa.int64()),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), fitted.n)),
                deviations(fitted.n, x, fitted.sums).take(pa.array(each)),
                pa.array(fitted.whitened(x).ravel()),
                pa.array(np.tile(fitted.values / fitted.trace, len(x))),
                pa.array(np.full(len(each), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return rows.mapInArrow(project, RESULT)


def op13_spectral_whitening(spark, sf_dir: str) -> DataFrame:
    """The embeddings along their first eight whitened components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
