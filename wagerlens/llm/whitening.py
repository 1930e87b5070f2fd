"""Embedding whitening by a bidiagonal qd solver.

Blockwise QR shrinks the centred rows to one triangle R without ever forming the covariance; Householder
reflections bidiagonalise R; dqds finds the singular values, small ones as accurately as large ones; twisted
factorisations give the directions. Rows are read by Spark tasks; only triangles and sums of d numbers travel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import materialize, ship_package

ROWS = 4096
"""Rows that a task factors at a time."""
FAN_IN = 16
"""Triangles that one task joins into one; more are joined in rounds."""
CLUSTER = 1e-3
"""Singular values nearer than this, relative to the larger, have their directions orthogonalised."""
_EPS = float(np.finfo(np.float64).eps)
_ROW = "vec_id long, x array<long>"


def usable(vectors: DataFrame, column: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """vec_id and x, floor(scale * entry) + shift for each entry, of the rows whose vector is whole and finite."""
    entry = F.col(column)
    whole = entry.isNotNull() & F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift))
    return vectors.where(whole & (F.size(entry) > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """n, and the exact sum of each dimension. Vectors of different lengths are refused."""
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b")).first()
    if not shape.n:
        return 0, np.zeros(0, np.int64)
    if shape.a != shape.b:
        raise ValueError(f"vectors of {shape.a} and of {shape.b} entries")
    sums = rows.select(F.posexplode("x").alias("dim", "value")).groupBy("dim").agg(F.sum("value").alias("total"))
    return shape.n, np.array([r.total for r in sums.orderBy("dim").collect()], np.int64)  # a row for each dimension


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    lists = batch.column("x")
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[int(offsets[0]) : int(offsets[-1])].reshape(-1, d)


def _lifted(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: the centred row times n."""
    if n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) >= 1 << 63:
        raise ArithmeticError("centred rows do not fit 64-bit integers")
    return n * x - sums


def triangle(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of a QR factorisation of all centred rows, rounded once when they become doubles.

    Each task folds its blocks of rows into one triangle; FAN_IN triangles at a time are stacked and factored
    again, a round after the other, until one is left. A triangle is d * d doubles whatever it stands for.
    """
    d = len(sums)

    def fold(r: np.ndarray | None, block: np.ndarray) -> np.ndarray:
        return np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")

    def packed(r: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        if r is not None:
            task = pa.array([TaskContext.get().partitionId()], pa.int32())
            full = np.zeros((d, d))
            full[: len(r)] = r
            yield pa.RecordBatch.from_arrays([task, pa.array([full.tobytes()], pa.binary())], ["task", "r"])

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                r = fold(r, _lifted(_matrix(batch.slice(at, ROWS), d), n, sums) / n)
        yield from packed(r)

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for raw in batch.column("r").to_pylist():
                r = fold(r, np.frombuffer(raw).reshape(d, d))
        yield from packed(r)

    left = materialize(rows.mapInArrow(of_rows, "task int, r binary"), "triangles")
    count = left.count()
    while count > 1:
        groups = -(-count // FAN_IN)
        ranked = left.repartitionByRange(groups, "task").sortWithinPartitions("task")
        left = materialize(ranked.mapInArrow(of_triangles, "task int, r binary"), "triangles")
        before, count = count, left.count()
        if count >= before:  # ranges cut by a sample may leave as many: the rest meets in one task, FAN_IN of them at most
            left = materialize(left.repartition(1).sortWithinPartitions("task").mapInArrow(of_triangles, "task int, r binary"), "triangles")
            count = 1
    return np.frombuffer(left.first().r).reshape(d, d)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): U' r v is upper bidiagonal with diagonal a and superdiagonal b, v orthogonal, by Householder reflections."""
    work = np.array(r, np.float64)
    d = len(work)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        w = x.copy()
        scale = np.abs(w).max(initial=0.0)
        if scale == 0 or len(w) == 1:
            return w, 0.0
        w /= scale
        w[0] += np.copysign(np.sqrt(w @ w), w[0])
        return w, 2.0 / (w @ w)

    for k in range(d):
        w, beta = reflector(work[k:, k])
        work[k:, k:] -= beta * np.outer(w, w @ work[k:, k:])
        if k < d - 2:
            w, beta = reflector(work[k, k + 1 :])
            work[k:, k + 1 :] -= beta * np.outer(work[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ w, w)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with shift; None if the shift was too large. The third is the smallest d it met."""
    n = len(q)
    up, over = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        if d < 0:
            return None
        up[i] = d + e[i]
        if up[i] == 0.0:
            over[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / up[i]
            over[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    up[-1] = d
    return up, over, least


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values of the upper bidiagonal matrix (a, b), falling, by dqds.

    The qd array holds squares. Each step without a shift keeps the relative accuracy of every value; shifts are
    a part of the smallest d of the step before, which is near the smallest value, and a step that turns out
    to have shifted too far is taken again with a quarter of it, at last with none. The array splits where an
    off-diagonal no longer counts.
    """
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(len(a))
    found: list[float] = []
    todo = [([float(x) for x in (a / top) ** 2], [float(x) for x in (b / top) ** 2], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        guess, steps = 0.0, 0
        while q:
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _EPS * _EPS * (moved + min(q[i], q[i + 1])) or e[i] == 0.0), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], moved))
                q, e, guess = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            if q[-1] == 0.0 or 0.0 in q:  # an exact zero value: one step without a shift moves it to the end
                stepped = _dqds(q, e, 0.0)
                q, e, _ = stepped
                e[-1] = 0.0 if q[-1] == 0.0 else e[-1]
                steps += 1
                if steps > 100 * len(q) + 1000:
                    raise ArithmeticError("dqds does not converge")
                continue
            shift = guess
            while (stepped := _dqds(q, e, shift)) is None:
                shift = shift / 4 if shift > _EPS * min(q) else 0.0
            q, e, least = stepped
            moved += shift
            guess = max(0.0, least) * (1 - 1e-3 if shift else 0.5)
            if e and e[-1] < q[-1] * 1e-4:  # the last value has nearly come out: what is left bounds the next shift
                guess = max(0.0, min(guess, q[-1] - e[-1]))
            steps += 1
            if steps > 100 * len(q) + 1000:
                raise ArithmeticError("dqds does not converge")
    return top * np.sqrt(np.sort(np.maximum(found, 0.0))[::-1])


def _twisted(a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """The unit vector z with B'B z = lam z as nearly as doubles can, by the twisted factorisation with the smallest pivot.

    B'B - lam is factored from the top (stationary qd) and from the bottom (progressive qd), both from the
    entries of B itself; they meet at the row whose pivot nearly vanishes, and z solves outwards from there.
    """
    n = len(a)
    tiny = _EPS * max(float(np.max(a * a)), lam, np.finfo(np.float64).tiny)
    q, e, c = a * a, b * b, a[:-1] * b  # B'B: diagonal q[i] + e[i-1], off-diagonal c
    lower, s = np.zeros(max(n - 1, 0)), np.zeros(n)
    s[0] = -lam
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny * _EPS else tiny * _EPS
        lower[i] = c[i] / pivot
        s[i + 1] = e[i] * s[i] / pivot - lam
    upper, p = np.zeros(max(n - 1, 0)), np.zeros(n)
    p[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        pivot = p[i + 1] + e[i]
        pivot = pivot if abs(pivot) > tiny * _EPS else tiny * _EPS
        upper[i] = c[i] / pivot
        p[i] = p[i + 1] * q[i] / pivot - lam
    twist = int(np.argmin(np.abs(s + p + lam)))
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(singular values falling, right singular vectors as columns) of a triangle; no vectors for values that are zero to working precision."""
    a, b, v = bidiagonalise(r)
    sigma = singular_values(a, b)
    d = len(sigma)
    kept = int(np.sum(sigma > 4 * d * _EPS * sigma[0]))
    z = np.zeros((d, kept))
    start = 0
    for k in range(kept):
        if k and sigma[k - 1] - sigma[k] > max(CLUSTER * sigma[k - 1], 64 * _EPS * sigma[0]):
            start = k
        one = _twisted(a, b, float(sigma[k]) ** 2)
        for _ in range(2):  # against those of its cluster, twice for full accuracy
            one = one - z[:, start:k] @ (z[:, start:k].T @ one)
            size = np.linalg.norm(one)
            if size < 0.1:  # the same vector came out again: any other of the cluster's space, by inverse iteration
                one = _another(a, b, float(sigma[k]) ** 2, z[:, start:k])
            else:
                one = one / size
        z[:, k] = one
    return sigma, v @ z


def _another(a: np.ndarray, b: np.ndarray, lam: float, known: np.ndarray) -> np.ndarray:
    """A vector for lam across those `known`: inverse iteration on B'B - lam from fixed starts, made orthogonal each time."""
    n = len(a)
    t = np.diag(a * a + np.concatenate([[0.0], b * b])) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    size = float(np.abs(t).max())
    # a little beside the value, by another little in each row: equal values must leave an answer
    shifted = t - np.diag(lam + _EPS * size * (8 + 4 * np.cos(1.0 + np.arange(n))))
    best, least = np.zeros(n), np.inf
    for start in range(2 * n):
        z = np.cos(np.arange(n) * (start + 1.0) + start)
        for _ in range(4):
            for _ in range(2):
                z = z - known @ (known.T @ z)
            z = np.linalg.solve(shifted, z / np.linalg.norm(z))
        for _ in range(2):
            z = z - known @ (known.T @ z)
            z = z / np.linalg.norm(z)
        left = np.linalg.norm(t @ z - lam * z)
        if left < least:
            best, least = z, left
        if least <= 64 * n * _EPS * size:
            break
    return best


class Whitening:
    """What a fit leaves: n, sums, directions (columns), their eigenvalues, the trace."""

    def __init__(self, n: int, sums: np.ndarray, vectors: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.vectors, self.values, self.trace = n, sums, vectors, values, trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (_lifted(x, self.n, self.sums) / self.n) @ self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = 32) -> Whitening | None:
    """The whitening of `rows` (from `usable`) onto the `components` largest directions; None without rows.

    Directions along which the rows do not vary (eigenvalue zero to working precision) cannot be whitened
    and are left out. Signs are chosen so that a direction's largest entry is positive.
    """
    n, sums = totals(rows)
    if not n:
        return None
    sigma, vectors = directions(triangle(rows, n, sums))
    values = sigma**2 / n
    vectors = vectors[:, :components]
    kept = vectors.shape[1]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, vectors * signs, values[:kept], float(values.sum()))


def _moments(rows: DataFrame, shared: Broadcast) -> float:
    """The largest entry of the whitened rows' covariance less the identity, measured on all rows.

    Each task adds up its own first and second moments; those are added by place in a shuffle.
    """
    d = len(shared.value.sums)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        k = len(fitted.values)
        total = np.zeros((k + 1, k + 1))  # a column of ones in front: counts, sums and products at once
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                w = fitted.whitened(_matrix(batch.slice(at, ROWS), d))
                w = np.hstack([np.ones((len(w), 1)), w])
                total += w.T @ w
        place = np.arange((k + 1) ** 2)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(total.ravel())], ["place", "value"])

    parts = rows.mapInArrow(of_task, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    k = len(shared.value.values)
    total = np.zeros((k + 1) ** 2)
    for r in parts.collect():  # (components + 1) squared
        total[r.place] = r.value
    total = total.reshape(k + 1, k + 1) / shared.value.n
    return float(np.abs(total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 32, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out. All others must be of one
    length and are fitted on and returned, repeated ids too, each row for itself; a null vec_id stays null.
    Fewer components come out where the rows vary in fewer directions: equal rows give no rows, nor does an
    empty table. Other columns are ignored. Whole numbers that exceed 64 bits raise instead of wrapping.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialize(usable(vectors, column), "vectors")
    fitted = fit(rows, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(fitted)  # components * d doubles
    error = _moments(rows, shared)
    d = len(fitted.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        k = len(f.values)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part, d)
                lifted = _lifted(x, f.n, f.sums)
                if d * int(np.abs(lifted).max(initial=0)) ** 2 >= 1 << 63:
                    raise ArithmeticError("a deviation does not fit a 64-bit integer")
                deviation, m = (lifted * lifted).sum(axis=1), len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, f.n)), pa.array(np.repeat(deviation, k)), pa.array(f.whitened(x).ravel()),
                    pa.array(np.tile(f.values / f.trace, m)), pa.array(np.full(m * k, error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
