"""Operator 7: exact top-k by inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks by a hash of their id, and every block keeps one
sorted list per dimension.  A query reads its dimensions' lists from the end
its sign favours, some entries of every list at a time, scores each vector it
meets in full, and stops when no unread vector can still beat (or tie with)
its kth best: the bound is the inner product of the query with the values at
which its lists stand.  The blocks' answers meet in one ranking per query.

Queries and vectors meet in a grid of (query block, vector block) cells, so no
task holds more than one block of each; nothing is broadcast.

Defined results: vectors null, or with null or non-finite components, and rows
with a null id take no part; rows that repeat an id count once, as the least
of its vectors; vectors of different lengths never meet; ties go to the
smaller id; the empty vector scores 0.  Scores are exact integers, clipped to
64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import python_ready

#: Vectors in a block and queries in a block, about.
VECTORS, QUERIES = 8_192, 512
_DEPTH = 32


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component x as double; without the vectors that take no part."""
    v = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return (table.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
            .select(F.col(id_col).alias("vec_id"), v.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def threshold_top(lists: np.ndarray, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int,
                  k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of one block for one query; ``lists``: rows by ascending value, per dimension."""
    n, dims = vectors.shape
    used = np.flatnonzero(query)
    q = query[used]
    seen = np.zeros(n, dtype=bool)
    best_scores, best_ids = np.empty(0, dtype=query.dtype), np.empty(0, dtype=ids.dtype)
    at, step = 0, _DEPTH
    while at < n:
        to = min(n, at + step)
        low, high = lists[at:to, used[q < 0]], lists[n - to:n - at, used[q > 0]]
        if len(used):
            met = np.unique(np.concatenate([low.ravel(), high.ravel()]))
            met = met[~seen[met]]
        else:  # every score is 0
            met, to = np.arange(n), n
        seen[met] = True
        scores, found = vectors[met] @ query, ids[met]
        ours = found != own
        best_scores = np.concatenate([best_scores, scores[ours]])
        best_ids = np.concatenate([best_ids, found[ours]])
        order = np.lexsort((best_ids, -best_scores))[:k]
        best_scores, best_ids = best_scores[order], best_ids[order]
        at, step = to, step * 2
        if len(order) == k and at < n:
            rows = np.where(q < 0, lists[at - 1, used], lists[n - at, used])
            if best_scores[-1] > (vectors[rows, used] * q).sum():
                break
    return list(zip(best_scores.tolist(), best_ids.tolist()))


def _cell(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(rows):
            rows = rows.sort_values("vec_id")
            vectors, asked = np.array(rows["v"].tolist()), np.array(queries["v"].tolist())
            if max(np.abs(vectors).max(initial=0), np.abs(asked).max(initial=0)) >= 1 << 27:
                vectors, asked = vectors.astype(object), asked.astype(object)  # no overflow
            ids = rows["vec_id"].to_numpy()
            lists = np.argsort(vectors, axis=0, kind="stable")
            for own, query in zip(queries["vec_id"], asked):
                out += [(own, v, max(-(1 << 63), min((1 << 63) - 1, s)))
                        for s, v in threshold_top(lists, vectors, ids, query, own, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def top_k(table: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every row for which ``is_query`` (over vec_id) holds."""
    python_ready(table.sparkSession)
    rows = integer_vectors(table, id_col, vector_col, scale).withColumn("dims", F.size("v"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).head()
    n_vec, n_query = max(1, -(-counts["n"] // VECTORS)), max(1, -(-counts["q"] // QUERIES))
    blocks = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    block = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    vectors = rows.select("*", block(n_vec, 1).alias("vb"), F.explode(blocks(n_query)).alias("qb"))
    queries = rows.filter(is_query).select("*", block(n_query, 2).alias("qb"), F.explode(blocks(n_vec)).alias("vb"))
    cells = (queries.groupBy("dims", "qb", "vb").cogroup(vectors.groupBy("dims", "qb", "vb"))
             .applyInPandas(_cell(k), "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return cells.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
