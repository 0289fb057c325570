"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers x, and everything about them that can be exact is: their number n, the
sums S, and each vector's squared distance from the mean. The covariance V itself is never formed.
What runs over the vectors is the product VQ = Xc'(Xc Q) / n with a narrow block Q: each task sums
its own vectors, centred first, and Spark adds up what the tasks give, one number per cell of d x b.

A few Lanczos steps find where the spectrum begins. Then each cycle damps what lies between there
and the block's least Ritz value by a Chebyshev polynomial of V, which takes one such pass per
degree, and QR and Rayleigh-Ritz follow. The degree is limited so that the leading directions do
not drown the last wanted one. A pair (e, q) counts as found when |Vq - eq| is at most `CERTIFIED` of e,
beyond what rounding at the largest eigenvalue leaves open; the cycles go on while that still falls,
to rounding. `GUARD` columns beyond the wanted ones keep the last of these apart from the rest.

Only the block, d x (components + GUARD) numbers, goes to the tasks and comes back. vectors is read
once per pass: give a table, or store what took long to make.

Defined results: rows whose vector is null, or holds null, NaN or infinite entries are dropped, and
so are those of another length than most of the others have (of equally frequent lengths the
greater counts). Entries too large for a long are cut at 4e18. Directions without variance (e below
1e-9 of the largest) have no component; if all vectors are equal there are none, and identity_error
is 0. Null and repeated ids are rows like any others; equal rows get equal results; other columns are
ignored, those of clashing names too; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS, GUARD = 32, 16
SCALE, SHIFT, MOST = 64, 1_000_000, 4 * 10**18
#: Largest residual of a found pair, and where nothing is left to gain, both of its eigenvalue.
CERTIFIED, ROUNDING = 1e-10, 1e-14
#: Of the largest eigenvalue: what rounding leaves of any residual.
NOISE = 4 * np.finfo(np.float64).eps
LANCZOS_STEPS, MOST_DEGREE, MOST_CYCLES = 10, 12, 200
#: Most that a filter may raise the first direction above the last wanted one.
SPREAD = 1e8
#: Least eigenvalue of a component, of the largest one.
RANK = 1e-9


@dataclass(frozen=True)
class Moments:
    """n vectors of d entries; shift and rest: the mean is shift + rest / n, all whole numbers."""

    n: int
    d: int
    shift: np.ndarray
    rest: np.ndarray


@dataclass(frozen=True)
class Whitening:
    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int


def _rows(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, entries): the rows with d finite entries and their x."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values
    flat = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(np.asarray(column.is_valid()) & (np.diff(offsets) == d))
    found = flat[offsets[places][:, None] + np.arange(d)]
    finite = np.isfinite(found).all(axis=1)
    whole = np.clip(np.floor(found[finite] * SCALE), -float(MOST), float(MOST)).astype(np.int64) + SHIFT
    return places[finite], whole


def _centred(x: np.ndarray, m: Moments) -> np.ndarray:
    return (x - m.shift).astype(np.float64) - m.rest.astype(np.float64) / m.n


def _summed(vectors: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all vectors of what `of` gives for the x of some of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            places, x = _rows(batch.column(0), d)
            if len(places):
                total += of(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])

    cells = vectors.select("vector").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(shape)
    out.ravel()[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    return out


def moments(vectors: DataFrame) -> Moments | None:
    """n and S of the column vector; None if no vector remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            lengths = np.unique(pc.fill_null(pc.list_value_length(batch.column(0)), -1).to_numpy(zero_copy_only=False))
            for d in map(int, lengths[lengths >= 0]):
                _, x = _rows(batch.column(0), d)
                n, known = sums.get(d, (0, [0] * d))
                upper, lower = (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)
                sums[d] = n + len(x), [s + (int(a) << 20) + int(b) for s, a, b in zip(known, upper, lower)]
        for d, (n, found) in sums.items():
            if n:
                columns = [pa.array([d] * (d + 1)), pa.array([*range(-1, d)]), pa.array([Decimal(s) for s in [n, *found]], pa.decimal128(38, 0))]
                yield pa.RecordBatch.from_arrays(columns, ["d", "place", "s"])

    found = vectors.select("vector").mapInArrow(run, "d long, place long, s decimal(38,0)").groupBy("d", "place").agg(F.sum("s").cast("decimal(38,0)").alias("s"))
    # Lengths are few in any sane table; only the most frequent one's sums come to the driver.
    first = found.where("place = -1").orderBy(F.desc("s"), F.desc("d")).first()
    if first is None:
        return None
    n, d = int(first.s), first.d
    sums = {r.place: int(r.s) for r in found.where((F.col("d") == d) & (F.col("place") >= 0)).collect()}
    return Moments(n, d, np.array([sums[i] // n for i in range(d)], dtype=np.int64), np.array([sums[i] % n for i in range(d)], dtype=np.int64))


def _least_of_spectrum(product: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator) -> float:
    """A bound below which V has hardly any spectrum: the least Ritz value of a few Lanczos steps, less its residual."""
    q = [rng.standard_normal(d)]
    q[0] /= np.linalg.norm(q[0])
    alpha, beta = [], []
    for _ in range(min(LANCZOS_STEPS, d)):
        w = product(q[-1][:, None])[:, 0]
        alpha.append(float(q[-1] @ w))
        basis = np.array(q)
        for _ in range(2):
            w = w - basis.T @ (basis @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * abs(alpha[0]):
            break
        q.append(w / beta[-1])
    n = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: n - 1], 1) + np.diag(beta[: n - 1], -1))
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def _degree(low: float, cut: float, last: float, top: float) -> int:
    """The highest degree at which the filter raises the first direction at most SPREAD times above the last wanted one."""
    at = lambda e: np.arccosh(max(1.0, (2 * e - cut - low) / (cut - low)))
    return int(np.clip(np.log(SPREAD) / max(at(top) - at(last), 1e-9), 1, MOST_DEGREE))


def _filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V, at most 1 on [low, cut] times its value at top, applied to q by its recurrence."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    first = sigma = half / (top - middle)
    before, now = q, (product(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (product(now) - middle * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def fit(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD, seed: int = 1) -> Whitening | None:
    """Mean, leading eigenvalues and unit eigenvectors of the column vector; None if no vector remains."""
    m = moments(vectors)
    if m is None:
        return None
    d, wanted, passes = m.d, min(components, m.d), 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        # Small blocks go with the tasks' code: d x b numbers.
        return _summed(vectors, d, lambda x: (c := _centred(x, m)).T @ (c @ q), q.shape) / m.n

    trace = float(_summed(vectors, d, lambda x: np.square(_centred(x, m)).sum(axis=0), (d,)).sum() / m.n)
    if d == 0 or trace == 0:
        return Whitening(m, np.zeros(0), np.zeros((d, 0)), trace, 0.0, passes)
    rng, width = np.random.default_rng(seed), min(d, wanted + guard)
    low = 0.0 if width == d else _least_of_spectrum(product, d, rng)
    q, before, stalled = np.linalg.qr(rng.standard_normal((d, width)))[0], np.inf, 0
    for _ in range(MOST_CYCLES):
        w = product(q)
        h = q.T @ w
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        open_by = np.linalg.norm(w - q * values, axis=0)[:wanted]
        residual = float((open_by / np.maximum(values[:wanted], NOISE / CERTIFIED * values[0])).max())
        stalled = stalled + 1 if residual > before / 2 else 0
        # Found: at rounding, or certified and not falling any more.
        if (open_by <= ROUNDING * values[:wanted] + NOISE * values[0]).all() or (residual <= CERTIFIED and stalled > 1):
            break
        before = min(before, residual)
        cut, top = float(values[-1]), float(values[0])
        below = low if low < cut else 0.0
        if cut <= 1e-12 * top:  # The block holds all the variance there is: plain iteration.
            q = np.linalg.qr(w)[0]
        else:
            last = max(float(values[wanted - 1]), cut * (1 + 1e-6))
            q = np.linalg.qr(_filtered(product, q, below, cut, top, _degree(below, cut, last, top)))[0]
    else:
        raise RuntimeError(f"No certified components after {MOST_CYCLES} cycles: residual {residual:.1e}")
    keep = values[:wanted] > RANK * values[0]
    return Whitening(m, values[:wanted][keep], q[:, :wanted][:, keep], trace, residual, passes)


def _deviations(x: np.ndarray, m: Moments) -> pa.Array:
    """Sums over the entries of (n x - S)^2, exact."""
    y = x - m.shift
    most = int(np.abs(y).max(initial=0)) + 1
    if m.d * (m.n * most) ** 2 < 1 << 62:
        return pa.array(np.square(m.n * y - m.rest).sum(axis=1)).cast(pa.decimal128(38, 0))
    exact = [sum((m.n * int(a) - int(r)) ** 2 for a, r in zip(row, m.rest)) for row in y]
    return pa.array([Decimal(e) if e < 10**38 else None for e in exact], pa.decimal128(38, 0))


def whitened(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation decimal(38,0) (null beyond it), whitened array<double> for each remaining row of vectors (vec_id, vector)."""
    m, turn = model.moments, model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, x = _rows(batch.column(1), m.d)
            y = _centred(x, m) @ turn
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), _deviations(x, m), rows], ["vec_id", "deviation", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "vector").mapInArrow(run, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    m, turn, k = model.moments, model.vectors / np.sqrt(model.values), len(model.values)
    if k == 0:
        return 0.0
    mean = _summed(vectors, m.d, lambda x: (_centred(x, m) @ turn).sum(axis=0), (k,)) / m.n
    found = _summed(vectors, m.d, lambda x: (y := _centred(x, m) @ turn - mean).T @ y, (k, k)) / m.n
    return float(np.abs(found - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, guard: int = GUARD) -> DataFrame:
    """vec_id, n, deviation, whitened, explained (share of the trace, by component), identity_error for each remaining row of vectors (vec_id, vector)."""
    model = fit(vectors, components, guard)
    if model is None:
        none = vectors.where(F.lit(False)).select("vec_id", F.lit(None).cast("long").alias("n"), F.lit(None).cast("decimal(38,0)").alias("deviation"))
        return none.withColumns({"whitened": F.array().cast("array<double>"), "explained": F.array().cast("array<double>"), "identity_error": F.lit(0.0)})
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    found = whitened(vectors, model).withColumns({"n": F.lit(model.moments.n).cast("long"), "explained": shares, "identity_error": F.lit(identity_error(vectors, model))})
    return found.select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")
