"""Embedding whitening: components by spectral divide and conquer with polar decompositions, projected next to the data."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import pick, settle

RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
_EPS = float(np.finfo(float).eps)
_ROWS = 4096  # vectors that are multiplied at a time
_EXACT = 1 << 53  # whole numbers below this are exact as doubles


@dataclass(frozen=True)
class Settings:
    """Entries become whole numbers floor(scale * entry) + offset; `components` are returned."""

    components: int = 16
    scale: int = 64
    offset: int = 1_000_000


@dataclass(frozen=True)
class Space:
    """What vectors of one length are whitened with: count and sums of the distinct vectors, axes and variances by falling variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - sums, exact, and x less the mean."""
        reach = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        kind = np.int64 if reach < 1 << 61 else object
        moved = x.astype(kind) * self.n - np.array(self.sums, kind)
        return moved, (moved / self.n).astype(float)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.axes / np.sqrt(self.variances))


# --- symmetric matrices -----------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps.

    Steps with a large weight go through a QR decomposition, later ones through
    a Cholesky decomposition. The factor has the eigenvectors of `a`, and the
    signs of its eigenvalues as eigenvalues.
    """
    size = len(a)
    one = np.eye(size)
    x = a / np.linalg.norm(a)
    low = max(np.abs(np.linalg.qr(x, "r").diagonal()).min() / size, _EPS)
    for _ in range(60):
        if abs(1 - low) < 10 * _EPS:
            break
        root = np.sqrt(1 + np.cbrt(4 * (1 - low**2) / low**4))
        weight = root + np.sqrt(max(0.0, 8 - 4 * (root**2 - 1) + 8 * (2 - low**2) / (low**2 * root))) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack((np.sqrt(c) * x, one)))[0]
            step = q[:size] @ q[size:].T * (weight - b / c) / np.sqrt(c)
        else:
            factor = np.linalg.cholesky(one + c * x.T @ x)
            step = np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T * (weight - b / c)
        x = b / c * x + step
        x = (x + x.T) / 2
        low = min(1.0, low * (weight + b * low**2) / (1 + c * low**2))
    return x


def _split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None if the matrix is a multiple of one.

    The median of the diagonal halves well; the mean always has eigenvalues on
    both sides. A shift that meets an eigenvalue gives no projector and is moved.
    """
    size, norm = len(a), np.linalg.norm(a)
    mean = np.trace(a) / size
    spread = np.linalg.norm(a - mean * np.eye(size)) / np.sqrt(size)
    if spread <= 4 * _EPS * norm:
        return None
    best = None
    for shift in (float(np.median(a.diagonal())), mean, *(mean + spread * move for move in (0.05, -0.05, 0.11, -0.11, 0.23, -0.23, 0.4, -0.4))):
        projector = (polar(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        basis = np.linalg.qr(projector @ rng.standard_normal((size, rank)))[0]
        whole = np.linalg.qr(projector @ basis, "complete")[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 8 * _EPS * size * norm:
            break
    return best and best[1:]


def spectrum(a: np.ndarray, seed: int = 11) -> Iterator[tuple[float, np.ndarray]]:
    """Eigenvalues of a symmetric matrix, falling, each with its unit vector; only as far as they are asked for.

    Polar decompositions of the shifted matrix project on the subspaces of
    larger and of smaller eigenvalues; each is split again by itself.
    """
    rng = np.random.default_rng(seed)
    whole = max(np.linalg.norm(a), np.finfo(float).tiny)
    open_ = [(a, np.eye(len(a)))]
    while open_:
        part, axes = open_.pop()
        rest = np.linalg.norm(part - np.diag(part.diagonal()))
        halves = _split(part, rng) if len(part) > 1 and rest > _EPS * whole else None
        if halves is None:
            for i in np.argsort(-part.diagonal(), kind="stable"):
                axis = axes[:, i] / np.linalg.norm(axes[:, i])
                yield float(part[i, i]), axis * np.sign(axis[np.abs(axis).argmax()])
        else:
            for basis in reversed(halves):  # the larger eigenvalues are taken up next
                inner = basis.T @ part @ basis
                open_.append(((inner + inner.T) / 2, axes @ basis))


# --- exact sums over the distinct vectors -----------------------------------------------------


def whole_vectors(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(vec_id, x): vectors of whole numbers.

    Left out are vectors that are null or empty or hold a null, a value that is
    not finite, or one too large for a long.
    """
    rows = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double") * s.scale).alias("scaled")
    )
    bad = F.exists("scaled", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= float(1 << 61)))
    good = rows.where(F.col("scaled").isNotNull() & (F.size("scaled") > 0) & ~F.coalesce(bad, F.lit(True)))
    return good.select("vec_id", F.transform("scaled", lambda c: F.floor(c) + F.lit(s.offset).cast("long")).alias("x"))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column as matrices of one length each, with their places, a bounded number of rows at a time."""
    sizes = np.diff(np.asarray(column.offsets))
    values, starts = column.values.to_numpy(), np.asarray(column.offsets)[:-1]
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        for at in range(0, len(places), _ROWS):
            some = places[at : at + _ROWS]
            yield some, values[starts[some][:, None] + np.arange(size)]


def products(x: np.ndarray) -> np.ndarray:
    """x.T @ x of whole numbers, exact: as doubles where no sum can leave their whole numbers."""
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < _EXACT:
        y = x.astype(float)
        return (y.T @ y).astype(np.int64).astype(object)
    y = x.astype(object)
    return y.T @ y


def _column_sums(x: np.ndarray) -> np.ndarray:
    fits = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
    return x.sum(axis=0).astype(object) if fits else x.astype(object).sum(axis=0)


def _summed(fit: DataFrame, values_of, kind: str = "decimal(38,0)") -> dict[int, dict[tuple[int, int], int | float]]:
    """Sums over all vectors, by length and place (i, j): a task adds up first, so it passes on one row per place."""

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                totals[x.shape[1]] = totals.get(x.shape[1], 0) + values_of(x)
        for size, total in totals.items():
            i, j = np.triu_indices(len(total)) if total.ndim == 2 else (np.arange(len(total)), np.zeros(len(total), int))
            flat = total[i, j] if total.ndim == 2 else total
            values = pa.array([Decimal(int(v)) for v in flat], pa.decimal128(38, 0)) if kind != "double" else pa.array(flat.astype(float))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), size), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["size", "i", "j", "v"])

    sums = fit.select("x").mapInArrow(run, f"size int, i int, j int, v {kind}").groupBy("size", "i", "j").agg(F.sum("v").alias("v"))
    out: dict = defaultdict(dict)
    for row in sums.collect():  # as many as a matrix of the vectors' length has places
        out[row.size][row.i, row.j] = float(row.v) if kind == "double" else int(row.v)
    return out


def _symmetric(values: dict, size: int) -> np.ndarray:
    out = np.zeros((size, size), object)
    for (i, j), v in values.items():
        out[i, j] = out[j, i] = v
    return out


def fit_spaces(fit: DataFrame, s: Settings = Settings()) -> dict[int, Space]:
    """Per length of vector what to whiten with, from distinct vectors `x`.

    Counts, sums and products are whole numbers and exact. Vectors are centred
    by the whole number next to the mean before they are multiplied; what is
    left of the mean is taken off exactly. Components whose variance is zero
    within rounding are left out.
    """
    first = _summed(fit, lambda x: np.append(_column_sums(x), len(x)))
    counts = {size: values[size, 0] for size, values in first.items()}
    sums = {size: [values[i, 0] for i in range(size)] for size, values in first.items()}
    near = {size: [(2 * t + n) // (2 * n) for t in sums[size]] for size, n in counts.items()}

    def centred_products(x: np.ndarray) -> np.ndarray:
        return products(x - np.array(near[x.shape[1]], np.int64))

    spaces = {}
    for size, values in _summed(fit, centred_products).items():
        n = counts[size]
        rest = np.array([t - n * m for t, m in zip(sums[size], near[size])], object)
        variance = ((_symmetric(values, size) * n - np.outer(rest, rest)) / (n * n)).astype(float)
        found = []
        for value, axis in spectrum(variance):
            if len(found) == s.components or value <= 0 or value <= 16 * size * _EPS * (found[0][0] if found else 0.0):
                break
            found.append((value, axis))
        axes = np.array([axis for _, axis in found]).T.reshape(size, len(found))
        spaces[size] = Space(n, sums[size], axes, np.array([value for value, _ in found]), float(np.trace(variance)))
    return spaces


def identity_errors(fit: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """Per length the largest absolute entry of the whitened distinct vectors' covariance minus the identity."""

    def moments(x: np.ndarray) -> np.ndarray:
        space = spaces[x.shape[1]]
        w = np.column_stack((space.whitened(space.centred(x)[1]), np.ones(len(x))))  # centred; the ones give what is left of a mean
        return w.T @ w

    errors = {}
    for size, values in _summed(fit, moments, "double").items():
        space = spaces[size]
        k = len(space.variances)
        both = _symmetric(values, k + 1).astype(float) / space.n
        errors[size] = float(np.abs(both[:k, :k] - np.outer(both[k, :k], both[k, :k]) - np.eye(k)).max(initial=0.0))
    return errors


def whiten(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Every usable vector of `vectors` (vec_id, embedding) on the whitened components, one row per vector and component.

    Entries are rounded down to whole numbers, and the components are those of
    the covariance of the distinct whole vectors, so copies do not weigh more.
    They are numbered by falling variance; an axis points to where its largest
    entry is positive. `deviation` is the sum over dimensions of (n x - sum)^2.
    Vectors that are null or empty or hold null or non-finite entries are left
    out. Vectors of different lengths are whitened apart. Fewer components than
    asked for are returned where the vectors span fewer; a single distinct
    vector has none. Repeated rows are returned each; a null vec_id stays null;
    further columns are left out.

    The driver holds one matrix per length of vector, whatever their number; the
    axes go to the tasks with the code.
    """
    rows = whole_vectors(vectors, s)
    fit = settle(rows.select("x").distinct(), "whitening-fit")
    spaces = fit_spaces(fit, s)
    errors = identity_errors(fit, spaces)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for places, x in _matrices(batch.column(1)):
                space = spaces[x.shape[1]]
                k = len(space.variances)
                if not k:
                    continue
                moved, centred = space.centred(x)
                wide = int(np.abs(moved).max()) ** 2 * x.shape[1] >= 1 << 62
                squares = ((moved.astype(object) if wide else moved) ** 2).sum(axis=1)
                times = lambda values: np.repeat(values, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(times(places))),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(x) * k, space.n), pa.int64()),
                        pa.array([Decimal(int(v)) for v in squares], pa.decimal128(38, 0)).take(pa.array(times(np.arange(len(x))))),
                        pa.array(space.whitened(centred).ravel()),
                        pa.array(np.tile(space.variances / space.total, len(x))),
                        pa.array(np.full(len(x) * k, errors[x.shape[1]])),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, RESULT)
