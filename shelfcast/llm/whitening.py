"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor (operator 11).

Each entry c of a vector becomes the integer ``x = floor(scale * c) + shift``.  The
*fit list* holds each distinct x vector once (n vectors).  Over it:

1. sums S, exact; the nearest integer mean ``m = round(S / n)`` is the centre;
2. scatter of ``y = x - m``, exact: every task multiplies centred 15-bit limbs as
   doubles (products and their sums stay below 2**53) and adds integers.  What
   the rounding of the mean leaves (under 1/2 a dimension) is taken off as
   integers too: ``n Y - s s'``, so no step cancels and no order of tasks shows;
3. pivoted Cholesky ``P'AP = L L'`` of the scatter A; a pivot that is rounding
   noise of its own variance ends it, so constant or dependent dimensions lower
   the rank and give no component;
4. one-sided Jacobi directly on the columns of L: rotations in a round-robin order
   make them orthogonal.  Their squared norms are the eigenvalues of A (n times
   those of the covariance), the normalised columns its eigenvectors.

Steps 1 and 2 and the check of the result (covariance of the whitened fit list
against the identity) are Spark jobs over a staged table; every task gives its
sums once, and Spark groups them by dimension.  The driver sees matrices of
dims x dims, nothing that grows with the rows; steps 3 and 4 run there, in
extended precision where the platform has it.

Defined results: a vector that is null, empty, or holds a null or non-finite entry
(or one with ``|floor(scale * c)| >= 2**53``, which has no exact integer) is dropped.
If vectors differ in length, the commonest length counts (the longer on a tie), others
are dropped.  Repeated rows and equal vectors all get a result; they count once
in the fit list.  Fewer than two distinct vectors have no variance: no component,
no whitened value.  Ids may be null or repeated.  Only the id and the vector are
read; other columns, whatever their names, do not matter.  ``deviation`` is null
where it does not fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import quoted, ship, stage

LIMB = 15            # bits of a limb: 2**20 products of two limbs add up below 2**53
ROWS = 1 << 20
INT = 32             # bytes of a partial sum
MOST = 2.0 ** 53


class Whitening(NamedTuple):
    rows: DataFrame            # vec_id, dims, x: all vectors that were not dropped
    dims: int
    n: int                     # distinct vectors
    centre: list[int]          # m
    rest: list[int]            # s = S - n m
    vectors: np.ndarray        # dims x components
    values: np.ndarray         # eigenvalues of the covariance, falling
    trace: float
    identity_error: float


# ---- integer vectors as bytes ---------------------------------------------------------------------------------------

def _bytes(q: np.ndarray) -> bytes:
    """In the narrowest of 2, 4 or 8 bytes, so equal vectors have equal bytes and shuffles stay small."""
    most = np.abs(q).max(initial=0)
    return q.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8").tobytes()


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers from their bytes."""
    out = np.empty((len(column), dims), np.int64)
    data = column.to_pylist()
    widths = np.array([len(b) for b in data]) // max(dims, 1)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join(data[i] for i in at), f"<i{w}").reshape(-1, dims)
    return out


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id, dims and ``floor(scale * c)`` of every vector that has only finite entries."""
    id_type = vectors.schema[id_col].dataType
    source = vectors.select(quoted(id_col).alias("vec_id"), quoted(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1)
            flat = pc.list_flatten(v).to_numpy(zero_copy_only=False).astype(np.float64)
            q = np.floor(flat * scale)
            sound = np.isfinite(q) & (np.abs(q) < MOST)
            keep = np.asarray(pc.fill_null(pc.list_value_length(v), 0)) > 0
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(v), 0)))
            keep[np.unique(np.asarray(pc.list_parent_indices(v))[~sound])] = False
            at = np.flatnonzero(keep)
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            q = np.where(sound, q, 0).astype(np.int64)
            x = [_bytes(q[starts[i]:ends[i]]) for i in at]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array((ends - starts)[at], pa.int32()),
                                              pa.array(x, pa.binary())], ["vec_id", "dims", "x"])

    return source.mapInArrow(run, f"vec_id {id_type.simpleString()}, dims int, x binary")


# ---- sums over all tasks ---------------------------------------------------------------------------------------------

def _pack(values) -> bytes:
    return b"".join(int(v).to_bytes(INT, "little", signed=True) for v in values)


def _unpack(data: bytes) -> list[int]:
    return [int.from_bytes(data[i:i + INT], "little", signed=True) for i in range(0, len(data), INT)]


def _add_ints(parts: list[bytes]) -> bytes:
    if len(parts) == 1:
        return parts[0]
    return _pack(map(sum, zip(*map(_unpack, parts), strict=True)))


def _add_doubles(parts: list[bytes]) -> bytes:
    """Exactly rounded sums: the order of tasks does not matter."""
    return np.array([math.fsum(c) for c in np.stack([np.frombuffer(p) for p in parts]).T]).tobytes()


def summed(parts: DataFrame, add) -> dict[int, bytes]:
    """Parts (key, part) of all tasks added up by key; at most dims + 1 keys reach the driver."""

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"key": table.column("key").slice(0, 1), "part": pa.array([add(table.column("part").to_pylist())])})

    return {r["key"]: r["part"] for r in parts.groupBy("key").applyInArrow(run, "key int, part binary").collect()}


def _per_task(fit: DataFrame, sums) -> DataFrame:
    """``sums(chunks)`` of each task's vectors as rows (key, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sums(batch.column(0) for batch in batches if batch.num_rows)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.int32()), pa.array(list(got.values()), pa.binary())], ["key", "part"])

    return fit.mapInArrow(run, "key int, part binary")


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed digits to the base 2**LIMB as doubles, lowest first."""
    out = []
    half = 1 << (LIMB - 1)
    while True:
        if np.abs(y).max(initial=0) < 2 * half:
            return [*out, y.astype(np.float64)]
        low = ((y + half) & (2 * half - 1)) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB


def _sums(dims: int):
    def run(columns) -> dict[int, bytes]:
        total, n = [0] * dims, 0
        for column in columns:
            q = _matrix(column, dims)
            n += len(q)
            high, low = q >> 26, q & ((1 << 26) - 1)
            total = [t + (int(a) << 26) + int(b) for t, a, b in zip(total, high.sum(0), low.sum(0), strict=True)]
        return {0: _pack([n, *total])} if n else {}
    return run


def _scatter(dims: int, centre: list[int]):
    def run(columns) -> dict[int, bytes]:
        by_shift: dict[int, np.ndarray] = {}
        mid = np.array(centre, np.int64)
        for column in columns:
            whole = _matrix(column, dims) - mid
            for a in range(0, len(whole), ROWS):
                limbs = _limbs(whole[a:a + ROWS])
                for i, x in enumerate(limbs):
                    for j, y in enumerate(limbs):
                        s = by_shift.setdefault(LIMB * (i + j), np.zeros((dims, dims), np.int64))
                        s += (x.T @ y).astype(np.int64)
        if not by_shift:
            return {}
        rows = [[0] * dims for _ in range(dims)]
        for shift, m in by_shift.items():
            rows = [[a + (b << shift) for a, b in zip(r, got, strict=True)] for r, got in zip(rows, m.tolist(), strict=True)]
        return {i: _pack(r) for i, r in enumerate(rows)}
    return run


def _whitener(dims: int, n: int, centre: list[int], rest: list[int], vectors: np.ndarray, values: np.ndarray):
    """Function from integer rows to whitened rows (doubles)."""
    mid = np.array(centre, np.int64)
    w = vectors / np.sqrt(values)
    off = np.array([float(Fraction(s, n)) for s in rest]) @ w

    def run(q: np.ndarray) -> np.ndarray:
        return (q - mid).astype(np.float64) @ w - off
    return run


def _moments(dims: int, whitener):
    def run(columns) -> dict[int, bytes]:
        got = None
        for column in columns:
            z = whitener(_matrix(column, dims))
            part = np.vstack([z.sum(0), z.T @ z])
            got = part if got is None else got + part
        return {} if got is None else {i: r.tobytes() for i, r in enumerate(got)}
    return run


# ---- the decomposition ----------------------------------------------------------------------------------------------

def _extended(num: int, den: int) -> np.longdouble:
    high = num / den if den else 0.0
    return np.longdouble(high) + np.longdouble(float(Fraction(num, den) - Fraction(high)))


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal L (dims x rank) and the pivot order with ``a[order][:, order] = L L'``."""
    a, d = a.copy(), len(a)
    order, low = np.arange(d), np.zeros_like(a)
    noise = 64 * max(d, 1) * np.finfo(a.dtype).eps * np.diag(a).copy()
    rank = 0
    for k in range(d):
        left = np.where(np.diag(a)[k:] > noise[k:], np.diag(a)[k:], 0)
        p = k + int(np.argmax(left))
        if left[p - k] <= 0:
            break
        for m in (a, low):
            m[[k, p]] = m[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        order[[k, p]], noise[[k, p]] = order[[p, k]], noise[[p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
        rank = k + 1
    return low[:, :rank], order


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Round-robin: in each round disjoint pairs, over all rounds every pair once (n even)."""
    ring, out = list(range(1, n)), []
    for _ in range(n - 1):
        line = [0, *ring]
        out.append((np.array(line[:n // 2]), np.array(line[n // 2:][::-1])))
        ring = ring[-1:] + ring[:-1]
    return out


def one_sided_jacobi(low: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``low`` rotated pairwise until they are orthogonal."""
    r = low.shape[1]
    if r < 2:
        return low.copy()
    w = np.hstack([low, np.zeros((len(low), r % 2), low.dtype)])
    eps, rounds = np.finfo(w.dtype).eps, _rounds(r + r % 2)
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = w[:, i], w[:, j]
            a, b, g = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(g) > 4 * eps * np.sqrt(a * b)
            if not turn.any():
                continue
            turned = True
            zeta = np.where(turn, b - a, 1) / np.where(turn, 2 * g, 1)
            t = np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = np.where(turn, 1 / np.sqrt(1 + t * t), 1)
            s = np.where(turn, c * t, 0)
            w[:, i], w[:, j] = c * x - s * y, s * x + c * y
        if not turned:
            break
    return w[:, :r]


def decompose(scatter: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` unit eigenvectors (columns) and eigenvalues of a scatter matrix, by falling eigenvalue."""
    low, order = pivoted_cholesky(scatter)
    w = one_sided_jacobi(low)
    values = (w * w).sum(0)
    best = np.argsort(-values, kind="stable")[:most]
    vectors = np.zeros((len(scatter), len(best)), scatter.dtype)
    vectors[order] = w[:, best] / np.sqrt(values[best])
    top = np.abs(vectors).argmax(0) if len(best) else np.array([], int)
    return vectors * np.where(vectors[top, np.arange(len(best))] < 0, -1, 1), values[best]


# ---- the operator ---------------------------------------------------------------------------------------------------

def fit_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
                  scale: float = 64.0) -> Whitening:
    """Components of the distinct integer vectors of ``vectors``.

    ``shift`` of the contract moves every x and the mean alike, so neither
    deviations nor components see it; it is left out here.
    """
    ship(vectors.sparkSession)
    rows = stage(integer_rows(vectors, id_col, vector_col, scale), "integer-vectors")
    got = rows.groupBy("dims").count().orderBy(F.col("count").desc(), F.col("dims").desc()).first()
    dims = got["dims"] if got else 0
    fit = stage(rows.where(F.col("dims") == dims).select("x").distinct(), "fit-list")
    first = _unpack(summed(_per_task(fit, _sums(dims)), _add_ints).get(0, _pack([0] * (dims + 1))))
    n, total = first[0], first[1:]
    none = Whitening(rows, dims, n, total, [0] * dims, np.zeros((dims, 0)), np.zeros(0), 0.0, 0.0)
    if n < 2:
        return none
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * m for s, m in zip(total, centre, strict=True)]
    scatter = {k: _unpack(p) for k, p in summed(_per_task(fit, _scatter(dims, centre)), _add_ints).items()}
    exact = [[n * scatter[i][j] - rest[i] * rest[j] for j in range(dims)] for i in range(dims)]
    a = np.array([[_extended(v, n) for v in r] for r in exact], np.longdouble)
    basis, values = decompose(a, components)
    trace = float(Fraction(sum(exact[i][i] for i in range(dims)), n * n))
    model = none._replace(centre=centre, rest=rest, vectors=basis.astype(np.float64),
                          values=(values / np.longdouble(n)).astype(np.float64), trace=trace)
    k = len(model.values)
    if not k:
        return model
    parts = summed(_per_task(fit, _moments(dims, _whitener(dims, n, centre, rest, model.vectors, model.values))), _add_doubles)
    moments = np.array([np.frombuffer(parts[i]) for i in range(k + 1)]) / n
    cov = moments[1:] - np.outer(moments[0], moments[0])
    return model._replace(identity_error=float(np.abs(cov - np.eye(k)).max()))


def whiten(model: Whitening) -> DataFrame:
    """One row per vector: vec_id, deviation (exact sum of (n x - S)^2) and whitened (array, a value per component)."""
    dims, n, centre, rest = model.dims, model.n, model.centre, model.rest
    whitener = _whitener(dims, max(n, 1), centre, rest, model.vectors, model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mid = np.array(centre, np.int64)
        for batch in batches:
            q = _matrix(batch.column(1), dims)
            y = q - mid
            if dims * (n * int(np.abs(y).max(initial=0)) + max(map(abs, rest), default=0)) ** 2 < 2**63:
                t = n * y - np.array(rest, np.int64)
                deviation = pa.array((t * t).sum(1), pa.int64())
            else:
                exact = [sum((n * a - s) ** 2 for a, s in zip(r, rest, strict=True)) for r in y.tolist()]
                deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            z = whitener(q)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, lists], ["vec_id", "deviation", "whitened"])

    kind = model.rows.schema["vec_id"].dataType.simpleString()
    return model.rows.where(F.col("dims") == dims).select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, deviation long, whitened array<double>")


def whitened_components(model: Whitening) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    shares = F.lit([float(v / model.trace) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    long = whiten(model).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    return long.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", F.get(shares, F.col("i")).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
