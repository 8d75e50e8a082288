"""Whitening of vectors: blockwise QR, a bidiagonal matrix, its singular values by qd sweeps, directions by twisted factorisations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objsync.llm.common import free_names, stored

# Triangles that one task stacks in a round of the reduction.
FAN_IN = 32
EPS = np.finfo(float).eps
# A square below this has no exact place in a long.
EXACT = float(2**62)

ROW = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """Each component c as the long floor(scale * c) + shift, at most 2**62 either way; null where one is null or not finite."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~odd, F.transform(wide, lambda c: F.floor(
        F.greatest(F.least(c * scale, F.lit(EXACT)), F.lit(-EXACT))).cast("long") + shift))


@dataclass(frozen=True)
class Whitener:
    """What a fit gives: the count and sums, the kept directions (columns) and their eigenvalues."""

    n: int
    sums: np.ndarray
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def fit(vectors: DataFrame, components: int = 16) -> tuple[Whitener | None, DataFrame]:
    """Fit on the distinct ``vector`` (array<long>) values; the model and the stored list of them.

    All vectors have one length; others than the most common length (the longer one
    if two are as common) are left out, null and empty ones too. Copies are combined before
    the shuffle, so each distinct vector counts once. A direction along which the
    vectors do not spread beyond rounding cannot be scaled to one and is not kept.
    No model where there is no vector.

    Each task reduces its centred rows to one triangle; triangles are stacked
    ``FAN_IN`` at a time in tasks until one is left. Only sums and that triangle, whose sizes
    follow the vectors' length and not their number, reach the driver.
    """
    filled = vectors.select("vector", F.size("vector").alias("width")).filter("vector is not null and width > 0")
    unique = filled.groupBy("vector").agg(F.first("width").alias("width"), F.count("*").alias("copies"))
    held = stored(unique, "vectors")
    widths = held.groupBy("width").agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("width")).limit(1).collect()
    if not widths:
        return None, held
    width = widths[0]["width"]
    held = held.filter(F.col("width") == width).select("vector")
    n, sums = _totals(held, width)
    triangle = _triangle(held, n, sums)
    values, vectors_ = singular(triangle)
    keep = (values > max(width, 8) * EPS * values.max(initial=0)) & (values > 0)
    values, vectors_ = values[keep][:components], vectors_[:, keep][:, :components]
    trace = float((triangle * triangle).sum()) / n
    return Whitener(n, sums, vectors_, values * values / n, trace), held


def whiten(vectors: DataFrame, model: Whitener | None, listed: DataFrame, key: str = "vec_id") -> DataFrame:
    """One row for each row with a vector and each kept component, numbered from 1 by falling eigenvalue.

    Result: the key, ``component``, ``n`` (distinct vectors), ``deviation`` (the sum of
    the squares of n*x - S, exact; null beyond what a long holds), ``whitened``,
    ``explained`` (the share of all variance) and ``identity_error`` (how far the covariance
    of the fit list's whitened rows is from the identity, measured on those rows).
    Rows without a vector or with one of another length take no part; repeated rows
    and keys and null keys each give rows of their own.
    """
    kept = free_names(vectors, ["vector", *[f.split()[0] for f in ROW.split(", ")]])
    kind = kept.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {ROW}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = _identity_error(listed, model)
    width, count = len(model.sums), len(model.eigenvalues)
    shared = model.eigenvalues / model.trace if count else model.eigenvalues

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            moved = _centred(x, model)
            out = _project(moved, model)
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays([
                batch.column(key).take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(each), model.n)), _squares(moved).take(pa.array(each)), pa.array(out.ravel()),
                pa.array(np.tile(shared, len(x))), pa.array(np.full(len(each), error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.filter(F.size("vector") == width).select(F.col(f"`{key}`"), "vector").mapInArrow(rows, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, model: Whitener) -> np.ndarray:
    """n*x - S in whole numbers: longs where they fit, else Python's."""
    top = float(np.abs(x.astype(float)).max(initial=0)) * model.n + float(np.abs(model.sums.astype(float)).max(initial=0))
    if top < EXACT:
        return x * np.int64(model.n) - model.sums.astype(np.int64)
    return x.astype(object) * model.n - model.sums


def _project(moved: np.ndarray, model: Whitener) -> np.ndarray:
    return (moved.astype(float) / model.n) @ (model.directions / np.sqrt(model.eigenvalues))


def _squares(moved: np.ndarray) -> pa.Array:
    rough = (moved.astype(float) ** 2).sum(axis=1)
    if moved.dtype != object and rough.max(initial=0) < EXACT:
        return pa.array((moved * moved).sum(axis=1))
    whole = [sum(int(v) ** 2 for v in row) for row in moved]
    return pa.array([v if v < 2**63 else None for v in whole], type=pa.int64())


def _totals(held: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """The rows and the sum of each dimension, as whole numbers of any size."""
    def partial(batches):
        n, low, high = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            # Halves are summed apart, so no sum overflows.
            low += (x & 0xFFFFFFFF).sum(axis=0)
            high += (x >> 32).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([low.tolist()]), pa.array([high.tolist()])], ["n", "low", "high"])

    parts = held.mapInArrow(partial, "n long, low array<long>, high array<long>")
    each = parts.select("n", F.posexplode(F.arrays_zip("low", "high")).alias("dim", "v"))
    rows = each.groupBy("dim").agg(F.sum("n").alias("n"), *[
        F.sum(F.col(f"v.{c}").cast("decimal(20,0)")).alias(c) for c in ("low", "high")]).orderBy("dim").collect()
    return rows[0]["n"], np.array([int(r["low"]) + (int(r["high"]) << 32) for r in rows], dtype=object)


def _triangle(held: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    width = len(sums)
    model = Whitener(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)

    def blocks(batches):
        r = np.zeros((0, width))
        for batch in batches:
            centred = _centred(_matrix(batch.column(0), width), model).astype(float) / n
            r = np.linalg.qr(np.vstack([r, centred]), mode="r")
        yield _packed(r, width)

    def stack(batches):
        r = np.zeros((0, width))
        for batch in batches:
            for flat in batch.column("r").to_pylist():
                r = np.linalg.qr(np.vstack([r, np.array(flat).reshape(-1, width)]), mode="r")
        yield _packed(r, width)

    parts = stored(held.mapInArrow(blocks, "r array<double>"), "triangles")
    left = parts.count()
    while left > 1:
        left = -(-left // FAN_IN)
        parts = stored(parts.repartition(left).mapInArrow(stack, "r array<double>"), "triangles")
        left = parts.count()
    return np.array(parts.first()["r"]).reshape(-1, width)


def _packed(r: np.ndarray, width: int) -> pa.RecordBatch:
    full = np.zeros((width, width))
    full[:len(r)] = r
    return pa.RecordBatch.from_arrays([pa.array([full.ravel()], type=pa.list_(pa.float64()))], ["r"])


def _identity_error(listed: DataFrame, model: Whitener) -> float:
    width, count = len(model.sums), len(model.eigenvalues)
    if not count:
        return 0.0

    def partial(batches):
        total = np.zeros((count, count))
        for batch in batches:
            out = _project(_centred(_matrix(batch.column(0), width), model), model)
            total += out.T @ out
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], type=pa.list_(pa.float64()))], ["part"])

    parts = listed.mapInArrow(partial, "part array<double>").select(F.posexplode("part").alias("at", "v"))
    cells = parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    covariance = np.array([r["v"] for r in cells]).reshape(count, count) / model.n
    return float(np.abs(covariance - np.eye(count)).max())


def singular(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The singular values of a square matrix, falling, and its right singular vectors as columns."""
    diagonal, upper, right = bidiagonal(r)
    values, inner = bidiagonal_vectors(diagonal, upper)
    return values, _reflect(right, inner)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """The diagonal and the entries above it of U'RV, with the reflections that V is made of."""
    a, size = r.astype(float).copy(), len(r)
    right: list[np.ndarray | None] = []
    for k in range(size):
        left = _reflection(a[k:, k])
        if left is not None:
            a[k:, k:] -= 2 * np.outer(left, left @ a[k:, k:])
        row = _reflection(a[k, k + 1:]) if k + 2 < size else None
        if row is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ row, row)
        right.append(row)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflection(x: np.ndarray) -> np.ndarray | None:
    """The unit vector of the reflection that takes x to a multiple of the first axis."""
    top = np.abs(x).max(initial=0)
    if len(x) < 2 or top == 0 or not np.abs(x[1:]).max():
        return None
    v = x / top
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v / np.linalg.norm(v)


def _reflect(right: list[np.ndarray | None], inner: np.ndarray) -> np.ndarray:
    out = inner.copy()
    for k in range(len(right) - 1, -1, -1):
        if right[k] is not None:
            out[k + 1:] -= 2 * np.outer(right[k], right[k] @ out[k + 1:])
    return out


def bidiagonal_vectors(diagonal: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right singular vectors of an upper bidiagonal matrix.

    The matrix falls into blocks where an entry above the diagonal is zero to
    rounding; vectors of different blocks are orthogonal by their places.
    """
    size = len(diagonal)
    top = max(np.abs(diagonal).max(initial=0), np.abs(upper).max(initial=0))
    if top == 0:
        return np.zeros(size), np.eye(size)
    # A zero on the diagonal becomes one at rounding level, so that every quotient exists.
    a = np.where(np.abs(diagonal) < EPS * top / 16, EPS * top / 16, diagonal)
    cuts = [0, *[k + 1 for k in range(size - 1) if abs(upper[k]) <= EPS * top / 16], size]
    values, vectors = [], np.zeros((size, size))
    for first, last in zip(cuts, cuts[1:], strict=False):
        squares = qd_values(a[first:last] ** 2, upper[first:last - 1] ** 2)
        vectors[first:last, len(values):len(values) + last - first] = _twisted_all(a[first:last], upper[first:last - 1], squares)
        values.extend(np.sqrt(squares))
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], vectors[:, order]


def qd_values(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, from the squares of a bidiagonal's entries, by differential qd sweeps with shifts.

    A sweep with a shift beyond the smallest value turns a quotient negative; it
    is then repeated with a smaller shift, at last with none, which cannot fail.
    """
    found = []
    pending = [(q.astype(float).copy(), e.astype(float).copy(), 0.0)]
    while pending:
        q, e, moved = pending.pop()
        guess = 0.0
        while len(q):
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            small = e <= (EPS * EPS) * (moved + np.minimum(q[:-1], q[1:]) + EPS * q[1:])
            if small.any():
                cut = int(np.flatnonzero(small)[-1])
                pending.append((q[cut + 1:].copy(), e[cut + 1:].copy(), moved))
                q, e = q[:cut + 1], e[:cut]
                continue
            if len(q) == 2:
                half = (q[0] - q[1] + e[0]) / 2
                large = q[1] + half + np.sqrt(half * half + q[1] * e[0])
                found.extend([large + moved, q[0] * q[1] / large + moved])
                break
            if q[0] * 1.5 < q[-1]:  # the small end belongs to the right, where values split off
                q, e = q[::-1].copy(), e[::-1].copy()
            shift = guess
            while True:
                swept = _sweep(q, e, shift)
                if swept is not None:
                    break
                shift = 0.0 if shift < EPS * moved or shift < 1e-3 * guess else shift / 4
            q, e, least = swept
            moved += shift
            guess = min(least, _last_value(q, e)) * (1 - 1e-8)
    return np.sort(np.array(found))[::-1]


def _last_value(q: np.ndarray, e: np.ndarray) -> float:
    """The smaller value of the last two rows: close to the smallest of all once they are about to split off."""
    t1, t2 = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1]
    off = q[-2] * e[-1]
    half = (t1 - t2) / 2
    return max(0.0, t2 - off / (abs(half) + np.sqrt(half * half + off))) if half >= 0 else max(0.0, t1 - off)


def _sweep(q: np.ndarray, e: np.ndarray, shift: float):
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = least = q[0] - shift
    if d < 0:
        return None
    for k in range(len(e)):
        new_q[k] = d + e[k]
        if new_q[k] <= 0:
            return None
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
        if d < 0 or not np.isfinite(d):
            return None
        least = min(least, d)
    new_q[-1] = d
    return new_q, new_e, least


def _twisted_all(a: np.ndarray, b: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """A unit vector for each squared value; those of close values are kept orthogonal."""
    vectors = np.zeros((len(a), len(a)))
    for k, value in enumerate(squares):
        near = [j for j in range(k) if squares[j] - value <= 1e-3 * squares[j]]
        best, kept = None, 0.0
        for candidate in _twisted(a, b, value):
            rest = candidate.copy()
            for _ in range(2):
                for j in near:
                    rest -= (vectors[:, j] @ rest) * vectors[:, j]
            norm = np.linalg.norm(rest)
            if norm > kept:
                best, kept = rest / norm, norm
            if kept > 0.5:
                break
        vectors[:, k] = best
    return vectors


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> Iterator[np.ndarray]:
    """Vectors that B'B takes to ``value`` times themselves but for one entry, the most accurate first.

    B'B = LDL'. The stationary sweep factors LDL' - value from the top and the
    progressive one from the bottom; joined at the row where the leftover is least,
    they solve for the vector by multiplications only.
    """
    size = len(a)
    d, low = a * a, b / a[:-1] if size > 1 else b
    tiny = np.finfo(float).tiny / EPS
    s, p = np.empty(size), np.empty(size)
    down, up = np.empty(size - 1), np.empty(size - 1)
    s[0] = -value
    for k in range(size - 1):
        pivot = d[k] + s[k]
        pivot = pivot if abs(pivot) > tiny else -max(tiny, EPS * value)
        down[k] = d[k] * low[k] / pivot
        s[k + 1] = down[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(size - 2, -1, -1):
        pivot = d[k] * low[k] * low[k] + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else -max(tiny, EPS * value)
        ratio = d[k] / pivot
        up[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    for twist in np.argsort(np.abs(s + p + value), kind="stable"):
        z = np.zeros(size)
        z[twist] = 1.0
        for k in range(twist - 1, -1, -1):
            z[k] = -down[k] * z[k + 1]
        for k in range(twist, size - 1):
            z[k + 1] = -up[k] * z[k]
        norm = np.linalg.norm(z)
        if np.isfinite(norm):
            yield z / norm
