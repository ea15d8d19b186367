"""Operator 11: whitening of embeddings by Chebyshev-filtered subspace
iteration.

The covariance V of the fit list is never formed. A pass over the staged fit
list multiplies it to a small block Q: every task computes Zt (Z Q) over its
centred rows Z, Spark adds the tasks' sums up by dimension, and the driver
gets one (dimensions x columns) block. A Chebyshev recurrence of such passes
damps the part of the spectrum between a Lanczos estimate of its lower end
and the block's smallest Ritz value; QR and a Rayleigh-Ritz step follow. This
repeats until the residual |V q - e q| of every wanted pair is below
``TOLERANCE`` times the largest eigenvalue. Converged leading pairs are locked
and projected out of the filter. A block that fails to converge is doubled; at
full width Rayleigh-Ritz is exact, so the iteration always ends.

The fit list holds every distinct integer vector once (a partial aggregation
comes before its shuffle, so a vector repeated in a third of all rows costs a
row a task). Entries are stored in the fewest bytes that hold a row's entries,
many rows to a block of at most ``BLOCK_BYTES``.

Edge cases: rows whose vector is null or holds a null or non-finite entry are
dropped, and so are rows of another length than the commonest one (ties: the
longest); vectors of length 0 have no components. Entries with |64 c| of 2^62
or more are held at that bound. Components of eigenvalue 0 (up to
``RANK`` times the largest) can't be whitened and are left out, so equal
vectors only, or a single one, give no rows. ``deviation`` is null where the
exact value, always in ``deviation_exact``, passes a long. An empty table
gives an empty result; null and repeated ids give one set of rows a row.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkwright.llm.common import stage

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
BOUND = float(2**62)
BLOCK_BYTES = 4 << 20
TOLERANCE = 5e-14  # of the largest eigenvalue, for a residual
RANK = 1e-12  # of the largest eigenvalue
LANCZOS = 10  # steps for the lower end of the spectrum
DEGREE = 20  # of a filter, at most
SPREAD = 1e10  # a filter amplifies the leading column by at most this
ROUNDS = 30  # filters before the block is doubled
EMPTY = "{id} long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def grid_points(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their vectors floor(64 c) as int64) of an Arrow list column."""
    offsets = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls are nan
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    first, last = offsets[:-1], offsets[1:]
    ok = (last - first == d) & (bad[last] == bad[first]) & column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(ok)
    cells = values[first[rows][:, None] + np.arange(d)]
    return rows, np.clip(np.floor(cells * SCALE), -BOUND, BOUND).astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Each vector in the fewest bytes an entry that hold it: equal vectors
    give equal bytes."""
    size = np.maximum(x.max(1), ~x.min(1))
    out: list[bytes] = [b""] * len(x)
    for low, high, kind in ((0, 7, "i1"), (7, 15, "<i2"), (15, 31, "<i4"), (31, 63, "<i8")):
        at = np.flatnonzero((size >> low != 0) & (size >> high == 0)) if low else np.flatnonzero(size >> high == 0)
        for i, row in zip(at, x[at].astype(kind)):
            out[i] = row.tobytes()
    return out


def fit_list(vectors: DataFrame, d: int) -> DataFrame:
    """(rows, block) of the distinct vectors, staged."""

    def packed(batches):
        for b in batches:
            _, x = grid_points(b.column(0), d)
            if len(x):
                yield pa.RecordBatch.from_pydict({"v": pa.array(_packed(x), pa.binary())})

    def blocks(batches):
        def out(rows):
            return pa.RecordBatch.from_pydict({"rows": pa.array([len(rows)], pa.int64()), "block": pa.array([b"".join(rows)], pa.binary())})

        for b in batches:
            open_rows: dict[int, list[bytes]] = {}
            for v in b.column(0).to_pylist():
                rows = open_rows.setdefault(len(v), [])
                rows.append(v)
                if len(rows) * len(v) >= BLOCK_BYTES:
                    yield out(open_rows.pop(len(v)))
            for rows in open_rows.values():
                yield out(rows)

    return stage(vectors.mapInArrow(packed, "v binary").distinct().mapInArrow(blocks, "rows long, block binary"), "fit_list")


def _blocks(batches, d: int):
    for b in batches:
        for rows, block in zip(b.column("rows").to_pylist(), b.column("block")):
            raw = block.as_buffer()
            yield np.frombuffer(raw, f"<i{raw.size // (rows * d)}").reshape(rows, d)


class Covariance:
    """V of a staged fit list, known by its products with small blocks."""

    def __init__(self, fit: DataFrame, d: int):
        self.fit, self.d, self.passes = fit, d, 0
        self.n = fit.agg(F.sum("rows")).first()[0] or 0
        if self.n:
            self.sums = self._sums()
            self.floor = np.array([s // self.n for s in self.sums], np.int64)
            self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def _sums(self) -> list[int]:
        d = self.d

        def run(batches):
            total = np.zeros(d, object)
            for x in _blocks(batches, d):
                total += x.astype(object).sum(0) if x.itemsize == 8 else x.sum(0, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "s": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))})

        rows = self.fit.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
        return [int(r.s) for r in sorted(rows)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.int64) - self.floor).astype(np.float64) - self.rest

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q, and the trace of V as a side result: one pass."""
        d, width, floor, rest = self.d, q.shape[1], self.floor, self.rest

        def run(batches):
            total, squares = np.zeros((d, width)), 0.0
            for x in _blocks(batches, d):
                z = (x.astype(np.int64) - floor).astype(np.float64) - rest
                total += z.T @ (z @ q)
                squares += float(np.vdot(z, z))
            cells = np.append(total.reshape(-1), squares)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(np.arange(len(cells), dtype=np.int32)), "x": cells})

        parts = self.fit.mapInArrow(run, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).toArrow()
        self.passes += 1
        out = np.empty(d * width + 1)
        out[parts["cell"].to_numpy()] = parts["x"].to_numpy()
        self.trace = float(out[-1] / self.n)
        return out[:-1].reshape(d, width) / self.n


def lower_end(v: Covariance, rng: np.random.Generator, steps: int) -> float:
    """An estimate from below of the smallest eigenvalue, by Lanczos steps."""
    basis, alpha, beta = [], [], []
    q = rng.standard_normal(v.d)
    q /= np.linalg.norm(q)
    for _ in range(min(steps, v.d)):
        basis.append(q)
        w = v.times(q[:, None])[:, 0]
        alpha.append(float(q @ w))
        for _ in range(2):
            for p in basis:
                w = w - (p @ w) * p
        size = float(np.linalg.norm(w))
        beta.append(size)
        if size <= 1e-12 * max(map(abs, alpha)):
            break
        q = w / size
    off = beta[: len(alpha) - 1]
    t = np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1)
    return max(0.0, float(np.linalg.eigvalsh(t)[0]) - beta[-1])


def chebyshev(v: Covariance, q: np.ndarray, vq: np.ndarray, locked: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V that is small on [low, cut] and
    grows above it, applied to q (vq = V q saves its first pass)."""
    centre, half = (cut + low) / 2, max((cut - low) / 2, 1e-12 * top)

    def away(y):
        return y - locked @ (locked.T @ y) if locked.shape[1] else y

    first = sigma = half / (top - centre)
    before, now = q, away(vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, away(v.times(now) - centre * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def _ritz(q: np.ndarray, vq: np.ndarray):
    h = q.T @ vq
    e, u = np.linalg.eigh((h + h.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    q, vq = q @ u, vq @ u
    return e, q, vq, np.linalg.norm(vq - q * e, axis=0)


def leading_pairs(v: Covariance, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns, residuals) of the k leading
    components of V, certified by their residuals."""
    rng = np.random.default_rng(seed)
    k = min(k, v.d)
    width = min(v.d, 2 * k)
    low = lower_end(v, rng, LANCZOS) if width < v.d else 0.0
    q = np.linalg.qr(rng.standard_normal((v.d, width)))[0]
    e, q, vq, residual = _ritz(q, v.times(q))
    rounds = 0
    while width < v.d and (residual[:k] > TOLERANCE * e[0]).any():
        done = int(np.argmax(residual[:k] > TOLERANCE * e[0]))  # leading converged pairs
        if rounds == ROUNDS:
            rounds, more = 0, min(v.d, 2 * width) - width
            extra = rng.standard_normal((v.d, more))
            extra = np.linalg.qr(np.hstack([q, extra]))[0][:, width:]
            width += more
            q, vq = np.hstack([q, extra]), np.hstack([vq, v.times(extra)])
        else:
            rounds += 1
            cut = max(float(e[-1]), low)
            top = max(float(e[done]), cut * (1 + 1e-9) + 1e-300)
            rate = np.arccosh(max((2 * top - cut - low) / max(cut - low, 1e-12 * top), 1 + 1e-9))
            degree = int(np.clip(np.arccosh(SPREAD) / rate, 2, DEGREE))
            held = q[:, :done]
            y = chebyshev(v, q[:, done:], vq[:, done:], held, degree, low, cut, top)
            y /= np.maximum(np.linalg.norm(y, axis=0), 1e-300)
            for _ in range(2):  # a second time for full orthogonality
                y = np.linalg.qr(y - held @ (held.T @ y))[0]
            q, vq = np.hstack([held, y]), np.hstack([vq[:, :done], v.times(y)])
        e, q, vq, residual = _ritz(q, vq)
    return e[:k], q[:, :k], residual[:k]


@dataclass
class Whitening:
    """n, column sums of floor(64 c), eigenvalues, vectors and quality figures."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    passes: int


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a one-column table of vectors; None where no vector
    or no spread is left."""
    col = vectors.columns[0]
    fine = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sizes = vectors.where(fine).groupBy(F.size(col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None or sizes.d == 0:
        return None
    v = Covariance(fit_list(vectors, sizes.d), sizes.d)
    if v.n < 2:
        return None
    values, q, _ = leading_pairs(v, components)
    some = values > RANK * max(values[0], 0)
    if values[0] <= 0 or not some.any():
        return None
    values, q = values[some], q[:, some]
    p = q / np.sqrt(values)
    error = np.abs(p.T @ v.times(p) - np.eye(len(values))).max()  # measured on the fit list
    return Whitening(v.n, v.sums, values, q, v.trace, float(error), v.passes)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums of (n x - s)^2: from x - floor(s / n), in machine integers
    where nothing can overflow."""
    floor = [s // n for s in sums]
    rest = [s % n for s in sums]
    big = max((int(np.abs(x).max()) if x.size else 0) + max(map(abs, floor)), 1)
    wide = n * big > 2**31 or len(sums) * (n * big) ** 2 >= 2**62
    kind = object if wide else np.int64
    y = n * (x.astype(kind) - np.array(floor, kind)) - np.array(rest, kind)
    return (y * y).sum(1).tolist()


def whiten(df: DataFrame, model: Whitening, id_col: str, vec_col: str) -> DataFrame:
    """id, deviation (exact), whitened (one value a component) for every row
    that has a usable vector."""
    n, sums = model.n, model.sums
    floor = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    p, d = model.vectors / np.sqrt(model.values), len(sums)

    def run(batches):
        for b in batches:
            rows, x = grid_points(b.column(1), d)
            w = ((x - floor).astype(np.float64) - rest) @ p
            exact = [Decimal(t) for t in _deviations(x, n, sums)]
            flat = pa.array(w.reshape(-1))
            yield pa.RecordBatch.from_pydict({
                "id": b.column(0).take(pa.array(rows)), "deviation": pa.array(exact, pa.decimal128(38, 0)),
                "whitened": pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * p.shape[1], flat),
            })

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")


def whiten_digest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component; see the module's docstring."""
    model = fit_whitening(df.select(F.col(vec_col).alias("v")), components)
    if model is None:
        return df.sparkSession.createDataFrame([], EMPTY.format(id=id_col))
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    rows = whiten(df.select(F.col(id_col).cast("long").alias(id_col), vec_col), model, id_col, vec_col)
    rows = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as long)").alias("deviation"), "whitened", F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"), F.col("deviation").alias("deviation_exact"),
    )
