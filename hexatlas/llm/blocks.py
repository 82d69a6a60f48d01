"""Searches of a stated query set against all vectors, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

BLOCK, QUERIES = 8192, 1024


def finite(vector: Column) -> Column:
    """Not null, not empty, and no component null or non-finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def blockwise(vectors: DataFrame, is_query: Column, search: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list], kind: str,
              k: int, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k largest scores over all rows but those of its own vec_id, ties to smaller ids.

    search(query ids, query matrix, candidate ids, candidate matrix) returns rows (query_id, vec_id, score) with at least each query's k
    best of the block. Rows are dealt to blocks in turn, so no value can fill one; each block of candidates meets each block of
    queries in a task of its own. Vectors meet vectors of their own length only. Of rows that repeat a vec_id, a query is the
    smallest vector; as candidates the best counts. Null vec_ids take no part.
    """
    rows = stash(vectors.where("vec_id IS NOT NULL").select("vec_id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"),
                                                            is_query.alias("q"), F.monotonically_increasing_id().alias("at")))
    asked = rows.where("q").groupBy("vec_id", "dim").agg(F.min("v").alias("v")).withColumn("at", F.xxhash64("vec_id", "dim"))
    asked = stash(asked)
    n, m = rows.count(), asked.count()
    nb, nq = max(1, -(-n // block)), max(1, -(-m // queries))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.select("dim", F.pmod("at", F.lit(nb)).cast("int").alias("b"), every(nq).alias("qb"), F.lit(False).alias("q"), "vec_id", "v")
    right = asked.select("dim", every(nb).alias("b"), F.pmod("at", F.lit(nq)).cast("int").alias("qb"), F.lit(True).alias("q"), "vec_id", "v")

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        ask, there = pdf[pdf["q"]], pdf[~pdf["q"]]
        found = []
        if len(ask) and len(there):
            found = search(ask["vec_id"].to_numpy(), np.stack(ask["v"].to_list()), there["vec_id"].to_numpy(), np.stack(there["v"].to_list()))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    met = left.unionByName(right).repartition(max(nb * nq, 1), "dim", "b", "qb").groupBy("dim", "b", "qb").applyInPandas(
        each, f"query_id long, vec_id long, score {kind}")
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_rows(query_id: int, ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    order = np.lexsort((ids, -scores))
    out: dict[int, tuple] = {}
    for i in order:
        out.setdefault(int(ids[i]), (int(query_id), int(ids[i]), scores[i].item()))
        if len(out) == k:
            break
    return list(out.values())
