"""Approximate nearest neighbours by low-dimensional stable projections in kd-trees.

Vectors of length 1 are projected on DIMS directions of independent normal (2-stable) components. For two vectors at distance d the
squared projected distance over d^2 follows a chi-square law of DIMS degrees. Each block's projections are indexed by a kd-tree; a
query takes the tree's leaves in the order of their projected distance, in batches that double, verifies their vectors, and stops when the
next leaf lies so far that a neighbour nearer than the k-th found would be expected there with a chance of at most 1 - CERTAINTY.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import best_rows, blockwise, finite
from .common import load

K, EVERY, DIMS, LEAF, CERTAINTY, SEED = 5, 50, 8, 64, 0.98, 5


def chi_square_quantile(p: float, degrees: int) -> float:
    """Of an even number of degrees, by halving."""
    def below(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


class Tree:
    """kd-tree by medians: ``order`` has the rows leaf by leaf, a leaf is order[starts[i]:starts[i + 1]] within the box low[i], high[i]."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, found = points, []
        self._build(np.arange(len(points)), leaf, found)
        self.order = np.concatenate(found)
        self.starts = np.cumsum([0] + [len(rows) for rows in found])
        self.low = np.array([points[rows].min(axis=0) for rows in found])
        self.high = np.array([points[rows].max(axis=0) for rows in found])

    def _build(self, rows: np.ndarray, leaf: int, found: list) -> None:
        if len(rows) <= leaf:
            found.append(rows)
            return
        own = self.points[rows]
        axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
        halves = np.argpartition(own[:, axis], len(rows) // 2)
        for part in (halves[:len(rows) // 2], halves[len(rows) // 2:]):
            self._build(rows[part], leaf, found)

    def batches(self, at: np.ndarray):
        """(squared distance of the first box, leaves, their squared distances), nearest first: one leaf, then as many as came before."""
        d = np.maximum(np.maximum(self.low - at, at - self.high), 0)
        gaps = (d * d).sum(axis=1)
        near, i = np.argsort(gaps, kind="stable"), 0
        while i < len(near):
            batch = near[i:max(1, 2 * i)]
            yield float(gaps[batch[0]]), batch, gaps[batch]
            i += len(batch)

    def rows(self, leaves: np.ndarray) -> np.ndarray:
        return np.concatenate([self.order[self.starts[n]:self.starts[n + 1]] for n in leaves])


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, so that squares of the largest component neither overflow nor vanish; cosines stay as they are."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def search_block(k: int, certainty: float, dims: int):
    limit = chi_square_quantile(certainty, dims)

    def search(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> list[tuple]:
        q, x = scaled(q), scaled(x)
        directions = np.random.default_rng(SEED).standard_normal((x.shape[1], dims))
        lengths, q_lengths = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        tree = Tree((x / lengths[:, None]) @ directions)
        targets = (q / q_lengths[:, None]) @ directions
        out = []
        for i, qid in enumerate(qids):
            names, found, kth = ids[:0], np.empty(0), math.inf
            for gap, leaves, gaps in tree.batches(targets[i]):
                if gap > limit * kth + 1e-12:
                    break
                rows = tree.rows(leaves[gaps <= limit * kth + 1e-12])
                rows = rows[ids[rows] != qid]
                names = np.concatenate([names, ids[rows]])
                found = np.concatenate([found, (x[rows] * q[i]).sum(axis=1) / (lengths[rows] * q_lengths[i])])
                if len(found) >= k:
                    top = np.argpartition(-found, k - 1)[:k]
                    if len(set(names[top].tolist())) == k:
                        kth = max(0.0, 2 - 2 * float(found[top].min()))
                        stay = found >= found[top].min()  # ties of the k-th stay
                        found, names = found[stay], names[stay]
            if len(names):
                out += best_rows(qid, names, found, k)
        return out

    return search


def nearest(vectors: DataFrame, is_query, k: int = K, certainty: float = CERTAINTY, dims: int = DIMS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) of rows (vec_id, embedding), score the cosine; see blockwise for repeats, nulls and lengths.

    Vectors null, empty, zero or holding null or non-finite components take no part. Lengths of any size
    are compared alike, however large or small. dims is even.
    """
    v = F.col("v")
    usable = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
              .where(finite(v) & F.exists(v, lambda x: x != 0)))
    return blockwise(usable, is_query, search_block(k, certainty, dims), "double", k)


def op5_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
