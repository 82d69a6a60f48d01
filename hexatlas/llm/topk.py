"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into 2, 4, 8, 16 and 32 segments; with segment means m and deviations s of len components, a segment of the distance
|q - x|^2 is at least len ((m_q - m_x)^2 + (s_q - s_x)^2). As q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, that bounds the inner product from
above by the sum of len (m_q m_x + s_q s_x). Bounds are taken coarse to fine; candidates whose bound falls under the k-th score already
found go, and the survivors' products are computed in whole numbers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import best_rows, blockwise, finite
from .common import load

K, EVERY, LEVELS, SCALE = 10, 100, (2, 4, 8, 16, 32), 1024


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per vector sqrt(len) times each segment's mean and deviation: a product of two such rows bounds the vectors' product."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    lens = np.diff(cuts)
    sums, squares = np.add.reduceat(x, cuts[:-1], axis=1), np.add.reduceat(x * x, cuts[:-1], axis=1)
    deviation = np.sqrt(np.maximum(squares / lens - (sums / lens) ** 2, 0))
    return np.hstack([sums / np.sqrt(lens), deviation * np.sqrt(lens)])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in longs where they cannot overflow, else in Python's numbers."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.size, 1) < 2.0 ** 62:
        return (x.astype(np.int64) * q.astype(np.int64)).sum(axis=1)
    exact = [sum(int(a) * int(b) for a, b in zip(q, row)) for row in x]
    if any(abs(v) >= 2 ** 63 for v in exact):
        raise ValueError("an inner product doesn't fit a long")
    return np.array(exact, dtype=np.int64)


def search_block(k: int):
    def search(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> list[tuple]:
        q, x = np.floor(SCALE * q), np.floor(SCALE * x)
        slack = 1e-9 * np.sqrt((x * x).sum(axis=1)) + 1e-9  # of rounding in the bounds
        norms = np.sqrt((q * q).sum(axis=1)) + 1
        sx, sq = [statistics(x, s) for s in LEVELS], [statistics(q, s) for s in LEVELS]
        out = []
        for i, qid in enumerate(qids):
            alive = np.flatnonzero(ids != qid)
            if not len(alive):
                continue
            done_ids, done_scores, least = np.empty(0, np.int64), np.empty(0, np.int64), None
            for f, g in zip(sx, sq):
                bound = f[alive] @ g[i] + slack[alive] * norms[i]
                if least is not None:
                    keep = bound >= least
                    alive, bound = alive[keep], bound[keep]
                if len(alive) <= 4 * k:
                    break
                # the most promising are settled now, and raise the least score that still counts
                first = np.argpartition(-bound, 2 * k)[:2 * k]
                done_ids = np.concatenate([done_ids, ids[alive[first]]])
                done_scores = np.concatenate([done_scores, products(q[i], x[alive[first]])])
                alive = np.delete(alive, first)
                if len(np.unique(done_ids)) >= k:
                    least = best_rows(qid, done_ids, done_scores, k)[-1][2]
            done_ids = np.concatenate([done_ids, ids[alive]])
            done_scores = np.concatenate([done_scores, products(q[i], x[alive])])
            out += best_rows(qid, done_ids, done_scores, k)
        return out

    return search


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of rows (vec_id, embedding); see blockwise for repeats, nulls and lengths.

    Vectors null, empty or holding null or non-finite components take no part. No queries or no candidates: no rows.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).where(finite(F.col("v")))
    return blockwise(usable, is_query, search_block(k), "long", k)


def op9_exact_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


def op9_sql() -> str:
    return f"""
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM scaled q JOIN scaled c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= {K}"""
