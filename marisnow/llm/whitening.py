"""Embedding whitening by Chebyshev-filtered subspace iteration.

Plan
----
1. Components become longs; the different vectors, each once, are the fit
   list, kept as packed matrices in the shared scratch folder.
2. One job gives the count and the exact sums of components and squares; the
   mean and the trace of the covariance follow.
3. A pass multiplies the covariance with a narrow block Q: every task centres
   its rows and returns its share of X'(XQ), dims x width, and Spark adds the
   shares.  The covariance itself is never formed.
4. A few Lanczos steps bracket the spectrum.  Each round runs the Chebyshev
   recurrence over such passes, which damps everything between the spectrum's
   lower end and the block's smallest Ritz value, then QR and Rayleigh-Ritz.
   Rounds end when the residuals of the wanted pairs certify them.
5. Every row is projected; one more pass over the fit list measures how far
   the covariance of the result is from the identity.

Only dims x width matrices meet on the driver, whatever the number of rows."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marisnow.llm.common import discard, whole_vectors, written

log = logging.getLogger(__name__)

SCALE = 256
K = 4
#: columns of the block beyond the wanted ones, Lanczos steps, degree of a round's polynomial
SPARE, LANCZOS, DEGREE = 28, 8, 8
MAX_ROUNDS = 200
#: residual, as a share of the largest eigenvalue, that certifies a pair; where
#: rounding stops the progress above it, LOOSE is accepted
TIGHT, LOOSE = 2e-14, 1e-10
#: an eigenvalue below this share of the largest counts as zero
NULL_SHARE = 1e-12
#: vectors in a packed matrix
PACK = 4096


@dataclass
class Whitening:
    """``n`` vectors with component sums ``total``; ``basis`` (dims x k) holds
    the unit eigenvectors of the covariance, ``values`` its eigenvalues."""

    n: int
    total: list[int]
    trace: float
    basis: np.ndarray
    values: np.ndarray
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))
    passes: int = 0
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else np.zeros(0)


def _rows(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _packed(dims: int):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, PACK):
                part = b.column(0).slice(lo, PACK)
                yield pa.RecordBatch.from_arrays([pa.array([_rows(part, dims).tobytes()], pa.binary())], ["m"])

    return run


def _matrices(column: pa.Array, dims: int):
    for m in column:
        yield np.frombuffer(m.as_py(), dtype=np.int64).reshape(-1, dims)


def moments(fit: DataFrame, dims: int) -> tuple[int, list[int], list[int]]:
    """Count, and per dimension the exact sums of components and squares."""

    def run(batches):
        n, one, two = 0, [0] * dims, [0] * dims
        for b in batches:
            for x in _matrices(b.column(0), dims):
                high = int(np.abs(x).max(initial=0))
                x = x if high * high * len(x) < 2 ** 62 else x.astype(object)  # Python's integers where longs would wrap
                n += len(x)
                one = [a + int(s) for a, s in zip(one, x.sum(0))]
                two = [a + int(s) for a, s in zip(two, (x * x).sum(0))]
        big = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims), pa.array(one, big),
                                          pa.array(two, big)], ["i", "n", "one", "two"])

    got = fit.mapInArrow(run, "i int, n long, one decimal(38,0), two decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two")).orderBy("i").collect()
    return got[0]["n"] if got else 0, [int(r["one"]) for r in got], [int(r["two"]) for r in got]


def _centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return x - total / n


class Covariance:
    """The fit list's covariance as an operator: ``self @ q`` is one pass."""

    def __init__(self, fit: DataFrame, dims: int, n: int, total: list[int]):
        self.fit, self.dims, self.n, self.total, self.passes = fit, dims, n, np.array(total, dtype=float), 0

    def _sum(self, share, rows: int, width: int) -> np.ndarray:
        """Sum over all tasks of ``share(centred rows)``, a rows x width matrix."""
        dims, n, total = self.dims, self.n, self.total
        names = [f"c{j}" for j in range(width)]

        def run(batches):
            out = np.zeros((rows, width))
            for b in batches:
                for x in _matrices(b.column(0), dims):
                    out += share(_centred(x, n, total))
            yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *(pa.array(out[:, j]) for j in range(width))], ["i", *names])

        ddl = "i int, " + ", ".join(f"{c} double" for c in names)
        got = self.fit.mapInArrow(run, ddl).groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).toPandas()
        out = np.zeros((rows, width))
        out[got["i"].to_numpy()] = got[names].to_numpy()
        self.passes += 1
        return out / n

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        return self._sum(lambda x: x.T @ (x @ q), self.dims, q.shape[1])

    def of(self, project: np.ndarray) -> np.ndarray:
        """Covariance of the centred rows after ``project`` (dims x k)."""

        def share(x):
            w = x @ project
            return w.T @ w

        return self._sum(share, project.shape[1], project.shape[1])


def lower_end(cov, dims: int, steps: int, rng) -> float:
    """An estimate from below of the smallest eigenvalue, by Lanczos: the
    smallest Ritz value less its residual (0 at least)."""
    q = rng.standard_normal(dims)
    q /= np.linalg.norm(q)
    basis, alpha, beta = [q], [], []
    for _ in range(min(steps, dims)):
        w = (cov @ basis[-1][:, None])[:, 0]
        alpha.append(float(basis[-1] @ w))
        for b in (*basis, *basis):  # full orthogonalisation, twice
            w = w - (b @ w) * b
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(map(abs, alpha)):
            break
        basis.append(w / beta[-1])
    t = np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, float(values[0] - max(abs(beta[-1] * vectors[-1, 0]), 0.02 * abs(values[0]))))


def top_pairs(cov, dims: int, k: int, spare: int = SPARE, degree: int = DEGREE, lanczos: int = LANCZOS,
              tight: float = TIGHT, loose: float = LOOSE, seed: int = 0):
    """``(values, basis, residuals)`` of the ``k`` largest eigenvalues of the
    operator ``cov`` (anything with ``@``), by Chebyshev-filtered subspace
    iteration.  A pair is certified by its residual: within that distance of
    its value lies an eigenvalue.  Raises if the residuals stay above
    ``loose`` times the largest eigenvalue."""
    k = min(k, dims)
    width = min(dims, k + spare)
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((dims, width)))
    low = lower_end(cov, dims, lanczos, rng) if width < dims else 0.0
    last, best = np.inf, None
    for _ in range(MAX_ROUNDS):
        w = cov @ q
        ritz, turn = np.linalg.eigh((q.T @ w + w.T @ q) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        scale = max(abs(float(ritz[0])), 1e-300)
        residuals = np.linalg.norm(w[:, :k] - q[:, :k] * ritz[:k], axis=0) / scale
        worst = float(residuals.max(initial=0.0))
        if best is None or worst < best[0]:
            best = (worst, ritz[:k].copy(), q[:, :k].copy(), residuals)
        if worst <= tight or width == dims or ritz[0] <= 0 or worst <= loose and worst > last / 2:
            break
        last = worst
        if ritz[-1] <= low:  # the block has met the lower end: the bracket was too narrow
            low = 0.0
        cut = float(ritz[-1])
        if cut <= low * (1 + 1e-9) or cut <= NULL_SHARE * scale:  # nothing left to damp but the null space
            q, _ = np.linalg.qr(w)
            continue
        mid, half = (cut + low) / 2, (cut - low) / 2
        before, now = q, (w - mid * q) / half
        for _ in range(degree - 1):
            before, now = now, 2.0 / half * ((cov @ now) - mid * now) - before
            size = np.linalg.norm(now, axis=0)
            if size.max() > 1e100:  # both steps of the recurrence by one factor
                before, now = before / size, now / size
        q, _ = np.linalg.qr(now / np.maximum(np.linalg.norm(now, axis=0), 1e-300))
    worst, values, basis, residuals = best
    if worst > loose and width < dims and values[0] > 0:
        raise ArithmeticError(f"eigenpairs are certified to {worst:.1e} only")
    return values, basis, residuals


def fit(vectors: DataFrame, dims: int, k: int = K) -> Whitening:
    """Model of the different vectors in ``_v`` (arrays of ``dims`` longs)."""
    lists = written(vectors.select("_v").distinct().mapInArrow(_packed(dims), "m binary"), "whiten-fit")
    n, one, two = moments(lists, dims)
    if not n:
        return Whitening(0, [0] * dims, 0.0, np.zeros((dims, 0)), np.zeros(0))
    trace = sum(n * b - a * a for a, b in zip(one, two)) / n ** 2
    cov = Covariance(lists, dims, n, one)
    values, basis, residuals = top_pairs(cov, dims, k) if trace > 0 else (np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
    keep = values > NULL_SHARE * max(float(values.max(initial=0.0)), 1e-300)
    model = Whitening(n, one, trace, np.ascontiguousarray(basis[:, keep]), values[keep], residuals[keep])
    if keep.any():
        error = cov.of(model.basis / np.sqrt(model.values)) - np.eye(int(keep.sum()))
        model.identity_error = float(np.abs(error).max())
    model.passes = cov.passes
    log.info("whitening: %d vectors, %d passes, residuals %s", n, model.passes, model.residuals)
    discard(lists)
    return model


def _deviation(x: np.ndarray, n: int, total: list[int]) -> list[int]:
    high = n * int(np.abs(x).max(initial=0)) + max(map(abs, total), default=0)
    if high * high * max(x.shape[1], 1) >= 2 ** 62 or n * high >= 2 ** 62:
        x = x.astype(object)
    off = x * n - np.array(total, dtype=x.dtype)
    return [int(d) for d in (off * off).sum(1)] if x.shape[1] else [0] * len(x)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``:
    each row's coordinates on the first ``k`` principal components, of unit
    variance over the different vectors.

    Rows whose vector is null or holds null or non-finite components are
    left out; empty vectors have no dimension and give no rows.  Shorter
    vectors are filled up with zeros.  Repeated rows each get theirs but count
    once in the fit; a null id passes through.  Components without variance
    (all rows alike, or fewer dimensions than ``k``) are left out, so a table
    of equal vectors and an empty table give no rows.  Equal eigenvalues give
    any orthonormal pair, the same for all rows.  ``deviation`` is exact
    (decimal); other columns are not read, whatever their names."""
    src = df.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_e"))
    src = whole_vectors(src, "_e", scale).select("_id", "_v")
    shortest, dims = src.agg(F.min(F.size("_v")), F.max(F.size("_v"))).first()
    dims = dims or 0
    if dims and shortest < dims:
        src = src.withColumn("_v", F.concat("_v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("_v"))))
    model = fit(src, dims, k) if dims else Whitening(0, [], 0.0, np.zeros((0, 0)), np.zeros(0))
    number = len(model.values)
    project = model.basis / np.sqrt(model.values) if number else model.basis
    n, total, explained, error = model.n, model.total, model.explained, model.identity_error
    middle = np.array(total, dtype=float)
    add = StructType.fromDDL("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    names = ["_id", *(f.name for f in add)]

    def run(batches):
        for b in batches:
            if not number or not b.num_rows:
                continue
            x = _rows(b.column(1), dims)
            rows = len(x)
            at = pa.array(np.repeat(np.arange(rows), number))
            deviation = pa.array(_deviation(x, n, total), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(at), pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * number, n)), deviation.take(at), pa.array((_centred(x, n, middle) @ project).ravel()),
                pa.array(np.tile(explained, rows)), pa.array(np.full(rows * number, error))], names)

    out = src.mapInArrow(run, StructType([src.schema["_id"], *add.fields]))
    return out.withColumnRenamed("_id", id_col)
