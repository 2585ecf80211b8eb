"""Whitening of embeddings: blockwise QR, Householder bidiagonalisation, dqds singular values, twisted factorisations."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import shared_path

EPS = np.finfo(np.float64).eps
BLOCK_ROWS = 4096
MERGED = 32
MOST_STEPS = 60


# ---- the solver, on one small triangle


def triangle(rows: np.ndarray) -> np.ndarray:
    """The upper triangle R of a QR factorisation, square whatever the number of rows."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))]) if len(r) < rows.shape[1] else r


def reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha) such that x - beta v (v x) is alpha in its first entry and zero elsewhere."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.abs(x[1:]).any():
        return np.zeros_like(x), 0.0, float(x[0])
    v = x / scale
    norm = math.sqrt(v @ v)
    alpha = -math.copysign(norm, v[0])
    v[0] -= alpha
    return v, 2.0 / (v @ v), alpha * scale


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, f, V): R = U B V' with B upper bidiagonal, of diagonal ``d`` and ``f`` above it."""
    a, n = r.copy(), r.shape[1]
    right, f = np.eye(n), np.zeros(max(n - 1, 0))
    d = np.zeros(n)
    for k in range(n):
        v, beta, d[k] = reflector(a[k:, k].copy())
        a[k:, k + 1:] -= beta * np.outer(v, v @ a[k:, k + 1:])
        if k + 1 < n:
            v, beta, f[k] = reflector(a[k, k + 1:].copy())
            a[k + 1:, k + 1:] -= beta * np.outer(a[k + 1:, k + 1:] @ v, v)
            right[:, k + 1:] -= beta * np.outer(right[:, k + 1:] @ v, v)
    return d, f, right


def dqd_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One differential quotient-difference transform with a shift; None where the shift is beyond the smallest value."""
    made, above = np.empty_like(q), np.empty_like(e)
    d = least = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None
        made[i] = d + e[i]
        if made[i] == 0:  # only where d and e vanish: the row below starts anew
            above[i], ratio = 0.0, 1.0
        else:
            ratio = q[i + 1] / made[i]
            above[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    made[-1] = d
    return made, above, least


def dqds(d: np.ndarray, f: np.ndarray) -> np.ndarray:
    """The singular values, descending, of the bidiagonal (d, f), to high relative accuracy.

    Works on squares. Small values go out at the lower end; a couple that has vanished elsewhere splits the
    problem. The shift is what the last two rows suggest, made smaller until it is below every value.
    """
    values: list[float] = []
    stack = [(d * d, f * f, 0.0)]
    while stack:
        q, e, moved = stack.pop()
        steps = 0
        while len(q):
            if len(q) == 1:
                values.append(moved + q[0])
                break
            small = e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:]))
            if small[-1]:
                values.append(moved + q[-1])
                q, e, steps = q[:-1], e[:-1], 0
                continue
            if small.any():
                cut = int(np.flatnonzero(small)[-1]) + 1
                stack.append((q[:cut], e[:cut - 1], moved))
                q, e, steps = q[cut:], e[cut:], 0
                continue
            if q[0] * 1.5 < q[-1]:
                q, e = q[::-1].copy(), e[::-1].copy()
            half = (q[-2] + e[-1] + q[-1]) / 2  # the smaller value of the last two rows
            root = math.sqrt(max(half * half - q[-2] * q[-1], 0.0))
            shift = q[-2] * q[-1] / (half + root) if half + root else 0.0
            shift = max(0.0, min(shift, float(q.min()))) if steps < MOST_STEPS * len(q) else 0.0
            while (step := dqd_step(q, e, shift)) is None:
                shift = shift * 0.75 - EPS * shift if shift > EPS * moved + 1e-300 else 0.0
            q, e, steps = step[0], step[1], steps + 1
            moved += shift
    return np.sqrt(np.sort(np.array(values))[::-1])


def twisted(d: np.ndarray, f: np.ndarray, value: float) -> np.ndarray:
    """The unit right singular vector of the bidiagonal (d, f) for a singular value.

    B'B - value^2 is factored from the top (stationary) and from the bottom (progressive); the two meet at
    the row with the smallest pivot, and the vector follows from there without a division by small numbers.
    """
    n, lam = len(d), value * value
    if n == 1:
        return np.ones(1)
    diag = d * d + np.concatenate([[0.0], f * f])
    off = d[:-1] * f
    tiny = EPS * EPS * max(lam, float(np.abs(diag).max()), 1e-300)
    down, up = np.empty(n), np.empty(n)
    s = -lam  # top: differential form, s is the part of a pivot without its own square
    for i in range(n):
        down[i] = s + d[i] * d[i]
        if i + 1 < n:
            pivot = down[i] if abs(down[i]) > tiny else math.copysign(tiny, down[i] or 1.0)
            s = f[i] * f[i] * (s / pivot) - lam
    p = d[-1] * d[-1] - lam  # bottom: the same upwards
    for i in range(n - 1, -1, -1):
        if i:
            up[i] = p + f[i - 1] * f[i - 1]
            pivot = up[i] if abs(up[i]) > tiny else math.copysign(tiny, up[i] or 1.0)
            p = d[i - 1] * d[i - 1] * (p / pivot) - lam
        else:
            up[0] = p
    meet = int(np.argmin(np.abs(down + up - diag + lam)))
    z = np.zeros(n)
    z[meet] = 1.0
    for i in range(meet - 1, -1, -1):
        pivot = down[i] if abs(down[i]) > tiny else math.copysign(tiny, down[i] or 1.0)
        z[i] = -off[i] * z[i + 1] / pivot
    for i in range(meet + 1, n):
        pivot = up[i] if abs(up[i]) > tiny else math.copysign(tiny, up[i] or 1.0)
        z[i] = -off[i - 1] * z[i - 1] / pivot
    return z / np.linalg.norm(z)


def right_vectors(d: np.ndarray, f: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors in columns) of the ``count`` largest singular values of the bidiagonal (d, f).

    The bidiagonal is split where a couple has vanished. Within a part values that lie close together
    may share directions, so their vectors are made orthogonal; where nothing is left a vector is found anew
    by inverse steps from a fixed start.
    """
    n = len(d)
    bound = EPS * max(np.abs(d).max(initial=0.0), np.abs(f).max(initial=0.0))
    cuts = [0, *(np.flatnonzero(np.abs(f) <= bound) + 1).tolist(), n]
    found: list[tuple[float, int, int]] = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        found += [(float(v), a, b) for v in dqds(d[a:b], f[a:b - 1])]
    found.sort(key=lambda x: -x[0])
    found, vectors = found[:count], []
    gap = math.sqrt(EPS) * (found[0][0] if found else 0.0)
    for k, (value, a, b) in enumerate(found):
        z = np.zeros(n)
        z[a:b] = twisted(d[a:b], f[a:b - 1], value)
        near = [vectors[j] for j in range(k) if found[j][1] == a and abs(found[j][0] - value) <= gap]
        if near:
            z = apart(z, near, d[a:b], f[a:b - 1], value, a, b)
        vectors.append(z)
    return np.array([v for v, _, _ in found]), np.array(vectors).reshape(len(found), n).T


def apart(z: np.ndarray, near: list[np.ndarray], d: np.ndarray, f: np.ndarray, value: float, a: int, b: int) -> np.ndarray:
    """``z`` made orthogonal to vectors of the same cluster, by inverse steps within its part."""
    draw = np.random.default_rng(len(near))
    square = np.diag(d * d + np.concatenate([[0.0], f * f])) + np.diag(d[:-1] * f, 1) + np.diag(d[:-1] * f, -1)
    shifted = square - (value * value * (1 + 4 * EPS) + 1e-300) * np.eye(b - a)
    others = np.array([x[a:b] for x in near])
    part = z[a:b].copy()
    for _ in range(4):
        for _ in range(2):
            part -= others.T @ (others @ part)
        norm = np.linalg.norm(part)
        if norm < 1e-8:
            part = draw.standard_normal(b - a)
            continue
        part /= norm
        try:
            part = np.linalg.solve(shifted, part)
        except np.linalg.LinAlgError:
            break
        part /= np.linalg.norm(part)
    for _ in range(2):
        part -= others.T @ (others @ part)
        part /= np.linalg.norm(part)
    out = np.zeros_like(z)
    out[a:b] = part
    return out


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, directions in columns) of the ``count`` largest of a triangle, signs and scale settled."""
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    d, f, right = bidiagonal(r / scale)
    values, z = right_vectors(d, f, min(count, len(d)))
    keep = values > len(d) * EPS * values[0]
    vectors = right @ z[:, keep]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    return values[keep] * scale, vectors * signs


# ---- the tables


def matrix(batch: pa.RecordBatch, column: str, kind) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(kind, copy=False).reshape(batch.num_rows, -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, x) of the rows that take part: every entry a finite number, and as many entries as most rows have."""
    entries = F.col(vector_col).cast("array<double>")
    whole = F.size(entries) > 0
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(F.col(id_col).alias("_id"), entries.alias("c")).where(F.col("c").isNotNull() & whole & finite)
    sizes = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()  # as many rows as lengths
    rows = rows.where(F.size("c") == (sizes["d"] if sizes else 0))
    return rows.select("_id", F.transform("c", lambda c: F.floor(c * scale) + F.lit(0).cast("long")).alias("x"))


def moments(distinct: DataFrame) -> tuple[int, list[int], list[int]]:
    """(n, sums, sums of squares) by dimension, exact: the sums of blocks travel as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "x", np.int64)
            wide = x if len(x) * int(np.abs(x).max(initial=0) + 1) ** 2 < 1 << 62 and x.min(initial=0) > -(1 << 62) else x.astype(object)
            s, t = (wide.sum(0).astype(object), (wide * wide).sum(0).astype(object))
            n, total, squares = (n + len(x), s if total is None else total + s, t if squares is None else squares + t)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([[str(v) for v in total]]), pa.array([[str(v) for v in squares]])], ["n", "s", "t"])

    parts = distinct.select("x").mapInArrow(run, "n long, s array<string>, t array<string>")
    n = parts.agg(F.sum("n").alias("n")).first()["n"] or 0
    long = parts.select(F.posexplode(F.arrays_zip("s", "t")).alias("i", "v"))
    exact = "decimal(38,0)"
    found = long.groupBy("i").agg(F.sum(F.col("v.s").cast(exact)).alias("s"), F.sum(F.col("v.t").cast(exact)).alias("t")).orderBy("i").collect()
    return n, [int(r["s"]) for r in found], [int(r["t"]) for r in found]  # one row per dimension


def stacked_triangle(distinct: DataFrame, mean: np.ndarray) -> np.ndarray:
    """The triangle of all centred rows: of blocks in each task, then of triangles, ``MERGED`` at a time."""
    width = len(mean)

    def pack(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows = matrix(batch.slice(at, BLOCK_ROWS), "x", np.float64) - mean
                r = triangle(rows if r is None else np.vstack([r, rows]))
        if r is not None:
            yield pack(r)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for held in batch.column("r").to_pylist():
                one = np.frombuffer(held, np.float64).reshape(width, width)
                r = one if r is None else triangle(np.vstack([r, one]))
        if r is not None:
            yield pack(r)

    found = distinct.select("x").mapInArrow(blocks, "r binary")
    parts = found.rdd.getNumPartitions()
    while parts > MERGED:
        parts = -(-parts // MERGED)
        found = found.repartition(parts).mapInArrow(merge, "r binary")
    rows = found.collect()  # at most MERGED triangles of the width squared
    return triangle(np.vstack([np.frombuffer(r["r"], np.float64).reshape(width, width) for r in rows]))


def whiten(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Entries become integers ``floor(scale * entry)``; each distinct integer vector counts once (n). Centred rows are reduced to a
    triangle block by block, the triangle to a bidiagonal, and the directions are those of its largest
    singular values. ``deviation`` is exact, the sum of (n x - S)^2 over dimensions, null beyond 64 bits. Components are
    numbered from 1 by falling variance; those without variance, of equal or single rows, are left out.

    Rows take no part if their vector is null, empty, or holds a null or non-finite entry, or has another number of entries
    than most rows. Repeated rows are returned each; empty tables give no rows; other columns are
    ignored. The driver and each task hold some triangles of the width squared, 0.5 MB each for 256 dimensions.
    """
    spark = vectors.sparkSession
    usable(vectors, id_col, vector_col, scale).write.parquet(path := shared_path(spark, "whitening"))
    rows = spark.read.parquet(path)
    rows.select("x").distinct().write.parquet(path := shared_path(spark, "whitening-fit"))
    distinct = spark.read.schema("x array<long>").parquet(path)
    n, sums, squares = moments(distinct)
    mean = np.array([s / n for s in sums]) if n else np.zeros(0)
    values, directions = principal(stacked_triangle(distinct, mean), components) if n else (np.zeros(0), np.zeros((0, 0)))
    variances = values * values / n if n else values
    trace = sum(n * t - s * s for s, t in zip(sums, squares, strict=True)) / (n * n) if n else 0.0  # exact before the division
    unit = directions / np.sqrt(variances)
    explained = [float(v / trace) for v in variances]
    whole = np.array(sums, object)

    def deviations(x: np.ndarray) -> list[int | None]:
        most = n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, sums), default=0)
        if len(sums) * most * most < 1 << 62:
            return ((n * x - whole.astype(np.int64)) ** 2).sum(1).tolist()
        exact = ((n * x.astype(object) - whole) ** 2).sum(1)
        return [v if v < 1 << 63 else None for v in exact.tolist()]

    def whitened(x: np.ndarray) -> np.ndarray:
        return (x - mean) @ unit

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        total, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = whitened(matrix(batch, "x", np.int64)) if batch.num_rows else np.zeros((0, k))
            total, second = total + w.sum(0), second + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()]), pa.array([second.ravel().tolist()])], ["total", "second"])

    k = len(values)
    if k:
        sent = distinct.mapInArrow(products, "total array<double>, second array<double>")
        sent = sent.agg(*(F.sum(F.col("total")[i]).alias(f"a{i}") for i in range(k)), *(F.sum(F.col("second")[i]).alias(f"b{i}") for i in range(k * k)))
        got = np.array(sent.first(), float)  # one row
        average = got[:k] / n
        error = float(np.abs(got[k:].reshape(k, k) / n - np.outer(average, average) - np.eye(k)).max())
    else:
        error = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            x = matrix(batch, "x", np.int64)
            dev = deviations(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n, np.int64)), pa.array([v for v in dev for _ in range(k)], pa.int64()),
                 pa.array(whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    ).withColumnRenamed("_id", id_col)
