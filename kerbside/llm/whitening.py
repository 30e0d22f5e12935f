"""Whitening of embeddings from the singular values of the centred rows, found by qd transforms.

Entries become whole numbers, floor(256 * c). Each task reduces its centred rows to one upper
triangle by QR, block by block; triangles are merged in two rounds. What remains is as wide as
a vector, so the driver bidiagonalises it by Householder reflections, finds the singular values
by the differential qd algorithm with zero-safe shifts, and the directions by twisted
factorisations. All rows are then projected in one pass.

Defined cases: a vector that is missing, or has a missing or non-finite entry, is dropped; a
shorter vector counts as ending in zeros; repeated rows each get a result, and count once in the
fit; no rows left give no rows; there are as many components as dimensions, at most `components`;
along a direction without variance `whitened` is null, and so is `explained` where no direction
has any; `deviation` is null where it passes 64 bits; columns other than `vec_id` and `embedding`
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored

COMPONENTS = 4
SCALE = 256
# Rows that a task reduces at a time.
BLOCK = 2_048
EPS = np.finfo(np.float64).eps


# ---- singular values and directions of a small matrix ------------------------------


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of U' M V, and the reflections (vectors) that make up V."""
    a = matrix.copy()
    n = a.shape[1]
    right = []

    def reflection(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflection(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflection(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                right.append(np.concatenate([np.zeros(k + 1), v]))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, in falling order.

    Every sweep takes a shift from q; one that makes a d negative is undone and repeated with a
    smaller shift. A split block goes on by itself.
    """
    found: list[float] = []
    blocks = [(diagonal.astype(float) ** 2, above.astype(float) ** 2, 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        failures = 0
        while len(q):
            n = len(q)
            # Split where an off-diagonal entry is nothing beside its neighbours.
            small = np.flatnonzero(e <= EPS * EPS * (q[:-1] + q[1:] + moved))
            if n == 1:
                found.append(moved + q[0])
                break
            if len(small):
                cut = int(small[-1]) + 1
                blocks.append((q[:cut], e[: cut - 1], moved))
                q, e = q[cut:], e[cut:]
                failures = 0
                continue
            if not q.all():
                # A zero in q: one sweep without a shift brings it to the end.
                shift = 0.0
            else:
                # The smaller eigenvalue of the last two-by-two corner, from below.
                t, b = q[-2] + e[-1], q[-1]
                half = (t + b + (e[-2] if n > 2 else 0.0)) / 2
                root = math.sqrt(max(half * half - q[-2] * b, 0.0))
                low = q[-2] * b / (half + root) if half + root else 0.0
                shift = low * (1 - 1e-3 * 8**failures) if failures < 3 else 0.0
            shifted = _sweep(q, e, max(shift, 0.0))
            if shifted is None:
                failures += 1
                continue
            q, e = shifted
            moved += max(shift, 0.0)
            failures = 0 if shift else failures
    return np.sort(np.maximum(found, 0.0))[::-1]


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One differential qd transform; None where the shift passed the least eigenvalue."""
    out_q, out_e = np.empty_like(q), np.empty_like(e)
    d = float(q[0]) - shift
    for i in range(len(e)):
        if d < 0:
            return None
        out_q[i] = d + e[i]
        if out_q[i] == 0:
            out_e[i], d = 0.0, float(q[i + 1]) - shift
            continue
        ratio = q[i + 1] / out_q[i]
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
    if d < 0:
        return None
    out_q[-1] = d
    return out_q, out_e


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float,
            others: list[np.ndarray]) -> np.ndarray:
    """The unit eigenvector of B'B at an eigenvalue, orthogonal to `others`.

    Two factorisations of B'B - value, from the top and from the bottom, meet at the row where
    their sum leaves least; the vector follows from there in both directions.
    """
    n = len(diagonal)
    main = diagonal**2 + np.concatenate([[0.0], above**2])
    side = diagonal[:-1] * above
    tiny = EPS * EPS * max(float(np.max(main, initial=0.0)), 1e-300)
    # A split matrix has its vectors inside one part each.
    parts = np.split(np.arange(n), np.flatnonzero(np.abs(side) <= EPS * math.sqrt(tiny)) + 1)
    best: tuple[float, np.ndarray] | None = None
    for part in parts:
        a, b = main[part] - value, side[part[:-1]]
        size = len(part)
        top, bottom = np.empty(size), np.empty(size)
        top[0], bottom[-1] = a[0], a[-1]
        for i in range(1, size):
            top[i] = a[i] - b[i - 1] ** 2 / (top[i - 1] or tiny)
        for i in range(size - 2, -1, -1):
            bottom[i] = a[i] - b[i] ** 2 / (bottom[i + 1] or tiny)
        for r in np.argsort(np.abs(top + bottom - a), kind="stable")[: 1 + len(others)]:
            z = np.zeros(n)
            x = np.zeros(size)
            x[r] = 1.0
            for i in range(r - 1, -1, -1):
                x[i] = -b[i] * x[i + 1] / (top[i] or tiny)
            for i in range(r + 1, size):
                x[i] = -b[i - 1] * x[i - 1] / (bottom[i] or tiny)
            z[part] = x / np.linalg.norm(x)
            for _ in range(2):
                for o in others:
                    z -= (o @ z) * o
            left = np.linalg.norm(z)
            if left < 0.01:  # that one is found already
                continue
            z /= left
            rest = main * z - value * z
            rest[:-1] += side * z[1:]
            rest[1:] += side * z[:-1]
            error = float(np.linalg.norm(rest))
            if best is None or error < best[0]:
                best = error, z
    if best is None:
        # Every twist gave a vector known already: any unit vector apart from those will do.
        for k in range(n):
            z = np.eye(n)[k]
            for o in others + others:
                z = z - (o @ z) * o
            if np.linalg.norm(z) > 0.5 / math.sqrt(n):
                return z / np.linalg.norm(z)
    return best[1]


def principal(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a square matrix and their right directions."""
    top = float(np.max(np.abs(matrix), initial=0.0))
    n = matrix.shape[1]
    wanted = min(components, n)
    if top == 0:
        return np.zeros(wanted), np.eye(n)[:wanted]
    diagonal, above, right = bidiagonal(matrix / top)
    values = dqds(diagonal, above)[:wanted]
    directions: list[np.ndarray] = []
    for value in values:
        directions.append(twisted(diagonal, above, float(value), directions))
    out = []
    for z in directions:
        for v in reversed(right):
            z = z - 2 * v * (v @ z)
        out.append(z / np.linalg.norm(z))
    return values * top * top, np.array(out)


# ---- the operator ------------------------------------------------------------------


def whole_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, x): the usable rows, their entries as whole numbers of one length."""
    c = F.col("embedding").cast("array<double>")
    # Neither NaN nor infinite; `exists` without nulls, which the first test handles.
    fine = ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = rows.where(F.col("embedding").isNotNull() & fine).select(
        "vec_id", F.transform(c, lambda v: F.floor(v * SCALE).cast("long")).alias("x"))
    width = usable.agg(F.max(F.size("x"))).first()[0] or 0
    return usable.select("vec_id", F.concat(
        "x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("x")
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _centre(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows less their mean, rounded once: (n * x - S) / n."""
    return _scaled(x, n, sums).astype(np.float64) / n


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64-bit numbers where they fit."""
    reach = n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, sums), default=0)
    kind = np.int64 if reach < 2**62 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for block in _blocks(batches):
            part = _matrix(block).astype(object).sum(axis=0) if (
                np.abs(_matrix(block)).max(initial=0) > 2**50) else _matrix(block).sum(axis=0)
            part = [int(v) for v in part]
            sums = part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
            n += block.num_rows
        if n:
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array(range(-1, len(sums)), pa.int32()),
                 "total": pa.array([str(v) for v in [n, *sums]])})

    # Decimals hold 38 digits; entries have 19 at most.
    found = dict(fit.mapInArrow(run, "dim int, total string").groupBy("dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    return int(found.get(-1, 0)), [int(found[i]) for i in range(len(found) - 1)]


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The upper triangle R of the centred rows: R'R is n times their covariance."""
    width = len(sums)

    def squeeze(held: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.concatenate([held, rows]), mode="r")

    def as_row(held: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"r": pa.array([held.ravel().tolist()], pa.list_(pa.float64()))})

    def reduce_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for block in _blocks(batches):
            held = squeeze(held, _centre(_matrix(block), n, sums))
        if len(held):
            yield as_row(held)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, width))
        for batch in batches:
            for row in batch.column("r"):
                held = squeeze(held, np.array(row.values).reshape(-1, width))
        if len(held):
            yield as_row(held)

    parts = stored(fit.select("x").mapInArrow(reduce_rows, "r array<double>"), "triangles")
    # Two rounds, so that no task merges more triangles than the root of their number.
    middle = max(math.isqrt(parts.count()), 1)
    parts = parts.repartition(middle).mapInArrow(merge, "r array<double>")
    last = stored(parts.repartition(1).mapInArrow(merge, "r array<double>"), "triangle").first()
    held = np.zeros((width, width))
    if last is not None:
        r = np.array(last["r"]).reshape(-1, width)
        held[: len(r)] = r
    return held


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and
    component, numbered from 1 by falling variance."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    vectors = stored(whole_vectors(rows), "vectors")
    fit = stored(vectors.select("x").distinct(), "fit")
    n, sums = totals(fit)
    width = len(sums)
    if not n or not width:
        return rows.sparkSession.createDataFrame([], schema)
    r = triangle(fit, n, sums)
    squares, directions = principal(r, components)
    trace = float(np.sum(r * r)) / n
    variances = squares / n
    # Less than rounding leaves of a direction without variance.
    flat = variances <= (EPS * width) ** 2 * trace
    explained = [None if trace == 0 else float(v / trace) for v in variances]
    scale = np.where(flat, np.nan, 1 / np.sqrt(np.where(flat, 1.0, variances)))
    project = directions.T * scale

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(squares)
        first, second = np.zeros(k), np.zeros((k, k))
        for block in _blocks(batches):
            white = _centre(_matrix(block), n, sums) @ project
            first += white.sum(axis=0)
            second += white.T @ white
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(k + k * k), pa.int32()),
            "total": pa.array(np.concatenate([first, second.ravel()]))})

    found = dict(fit.mapInArrow(moments, "place int, total double").groupBy("place").agg(
        F.sum("total").alias("total")).collect())
    k = len(squares)
    mean = np.array([found[i] for i in range(k)]) / n
    spread = np.array([found[i] for i in range(k, k + k * k)]).reshape(k, k) / n
    off = np.abs(spread - np.outer(mean, mean) - np.eye(k))[np.ix_(~flat, ~flat)]
    identity_error = float(off.max()) if off.size else None

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            x = _matrix(block)
            white = _centre(x, n, sums) @ project
            exact = _scaled(x, n, sums)
            if float(np.abs(exact).max(initial=0)) ** 2 * width >= 2**62:
                exact = exact.astype(object)
            deviation = (exact * exact).sum(axis=1)
            deviation = [int(v) if v < 2**63 else None for v in deviation]
            size = len(x)
            yield pa.RecordBatch.from_pydict({
                "vec_id": block.column("vec_id").take(pa.array(np.repeat(np.arange(size), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                "n": pa.array(np.full(size * k, n), pa.int64()),
                "deviation": pa.array(deviation, pa.int64()).take(
                    pa.array(np.repeat(np.arange(size), k))),
                "whitened": pc.if_else(pa.array(np.tile(flat, size)), None,
                                       pa.array(white.ravel())),
                "explained": pa.array(explained * size, pa.float64()),
                "identity_error": pa.array([identity_error] * (size * k), pa.float64()),
            })

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(
        apply, schema)
