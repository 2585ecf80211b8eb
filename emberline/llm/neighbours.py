"""Approximate nearest neighbours by collision counting over query-centred windows of sorted projections."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.llm.common import parts_for

PROJECTIONS = 48
WINDOW = 2.719
GROWTH = 1.15
LEVELS = 64
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


def threshold(projections: int = PROJECTIONS, window: float = WINDOW) -> int:
    """Collisions that a vector at the search radius reaches but for about one case in a thousand."""
    share = math.erf(window / 2 / math.sqrt(2))
    return max(1, math.floor(projections * share - 3.1 * math.sqrt(projections * share * (1 - share))))


class Index:
    """Sorted arrays of the projections of one block of vectors; ``copies`` says how many rows each stands for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors, self.copies = ids, vectors, copies
        self.axes = np.random.default_rng(projections * 100_003 + vectors.shape[1]).standard_normal((vectors.shape[1], projections))
        placed = vectors @ self.axes
        self.order = np.argsort(placed, axis=0, kind="stable").T.copy()
        self.values = np.sort(placed, axis=0).T.copy()
        self.least = threshold(projections)
        self.farthest = 2 * float(np.sqrt((vectors * vectors).sum(1)).max(initial=0.0))

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` nearest (distance, id), the query's own row left out.

        The windows start at a radius at which ``k`` vectors could have enough collisions and grow by
        virtual rehashing: each level takes in only what lies beyond the last. A vector is verified when its
        collisions reach the threshold; the search ends once the ``k``-th verified distance is within the
        radius, or every window holds the whole block.
        """
        n, places = len(self.ids), query @ self.axes
        reach = max(self.farthest, 2 * float(np.sqrt(query @ query)))
        radii = reach * GROWTH ** np.arange(1.0 - LEVELS, 1.0)
        half = np.concatenate([radii[:-1] * WINDOW / 2, [np.inf]])
        lows = np.array([np.searchsorted(v, p - half, "left") for v, p in zip(self.values, places, strict=True)])
        highs = np.array([np.searchsorted(v, p + half, "right") for v, p in zip(self.values, places, strict=True)])
        level = int(np.argmax((highs - lows).sum(0) >= min(n, k) * self.least))
        counts, left = np.zeros(n, np.int64), np.minimum(self.copies, k + 1)
        same = np.flatnonzero(self.ids == own)
        left[same[(self.vectors[same] == query).all(1)]] -= 1
        seen = left == 0
        best_d, best_i = np.zeros(0), np.zeros(0, np.int64)
        low = high = None
        for at in range(level, LEVELS):
            a, b = lows[:, at], highs[:, at]
            if low is None:
                new = [o[x:y] for o, x, y in zip(self.order, a.tolist(), b.tolist(), strict=True)]
            else:
                new = [o[x:y] for o, x, y in zip(self.order, a.tolist(), low.tolist(), strict=True) if x < y]
                new += [o[x:y] for o, x, y in zip(self.order, high.tolist(), b.tolist(), strict=True) if x < y]
            low, high = a, b
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            fresh = np.flatnonzero((counts >= self.least) & ~seen)
            if len(fresh):
                seen[fresh] = True
                apart = self.vectors[fresh] - query
                best_d = np.concatenate([best_d, np.repeat(np.sqrt((apart * apart).sum(1)), left[fresh])])
                best_i = np.concatenate([best_i, np.repeat(self.ids[fresh], left[fresh])])
                keep = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[keep], best_i[keep]
            if len(best_d) >= k and best_d[k - 1] <= radii[at]:
                break
        return list(zip(best_d.tolist(), best_i.tolist(), strict=True))


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds, the ``k`` nearest other rows.

    The score is the Euclidean distance in double precision; ties go to the smaller id. Rows are dealt by a
    hash of id and vector to blocks of about ``BLOCK_ROWS``, each indexed whole in a task; every block of queries
    meets every block of rows once, sends its ``k`` nearest there, and these are merged.

    Null vectors, those with null or non-finite components, zero and empty ones, and rows with a null id take
    no part; vectors of different lengths never meet. Rows that repeat an id are rows of their own, as queries
    and as candidates of one another and of others; equal rows are searched once and counted as often as they stand. A table of one row, or an empty one, gives no rows. Other columns are ignored.
    """

    def run(rows, asked):
        schema = pa.schema([("query_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("times", pa.int64()),
                            ("vec_id", pa.int64()), ("score", pa.float64())])
        if not rows.num_rows or not asked.num_rows:
            return schema.empty_table()

        def matrix(t):
            return np.array(t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(t.num_rows, -1)

        index = Index(rows.column("id").to_numpy(), matrix(rows), rows.column("copies").to_numpy())
        near = [index.search(own, q, k) for own, q in zip(asked.column("id").to_pylist(), matrix(asked), strict=True)]
        of = np.repeat(np.arange(len(near)), [len(n) for n in near])
        found = [x for n in near for x in n]
        query = asked.select(["id", "h1", "h2", "copies"]).combine_chunks().take(pa.array(of))
        return pa.table([*query.columns, pa.array([i for _, i in found], pa.int64()), pa.array([d for d, _ in found], pa.float64())], schema=schema)

    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), queries.alias("asked"))
            .where(usable(F.col("v")) & F.col("id").isNotNull())
            .groupBy("id", "v").agg(F.count("*").alias("copies"), F.max("asked").alias("asked"))
            .withColumns({"dim": F.size("v"), "h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(2), "v")}))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("asked").alias("q")).first()
    blocks, groups = parts_for(sizes["n"], BLOCK_ROWS), parts_for(sizes["q"], BLOCK_QUERIES)

    def dealt(number: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", "h1", F.lit(salt)), F.lit(number))

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))

    held = rows.select("dim", dealt(blocks, 1).alias("block"), every(groups).alias("group"), "id", "v", "copies")
    asked = rows.where("asked").select("dim", every(blocks).alias("block"), dealt(groups, 2).alias("group"), "id", "v", "copies", "h1", "h2")
    found = held.groupBy("dim", "block", "group").cogroup(asked.groupBy("dim", "block", "group")).applyInArrow(
        run, "query_id long, h1 long, h2 long, times long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "h1", "h2").orderBy("score", "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score")
