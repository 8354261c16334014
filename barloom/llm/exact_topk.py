"""Exact top-k search: tiled integer matrix products, a selection per tile, a tree of merges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from barloom.llm.vectors import best, lowest, packs, search, usable

SCALE = 1024
#: Rows of a shard and of a pack of queries; a tile is at most their product.
SHARD, QUERIES = 8192, 512
#: Whole numbers below this are exact in a double.
EXACT = float(1 << 53)


def to_steps(mat: np.ndarray) -> np.ndarray:
    most = np.finfo(np.float64).max
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * mat), -most, most)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as longs; beyond a long they end at its limits."""
    with np.errstate(over="ignore"):
        small = np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT
    if small:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    full = whole(a) @ whole(b).T
    limit = (1 << 63) - 1
    return np.vectorize(lambda x: min(max(x, -limit - 1), limit), otypes=[object])(full).astype(np.int64)


def tile(k: int):
    def meet(q_ids: np.ndarray, q: np.ndarray, shard: tuple[np.ndarray, np.ndarray]):
        ids, mat = shard
        scores = products(q, mat)
        own = q_ids[:, None] == ids[None, :]
        scores[own] = lowest(scores.dtype)
        if scores.shape[1] > k:
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
        else:
            least = np.full((len(scores), 1), lowest(scores.dtype))
        rows, columns = np.nonzero((scores >= least) & ~own)
        return best(rows, ids[columns], scores[rows, columns], len(q_ids), k)

    return meet


def top_k(rows: DataFrame, chosen, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest integer inner product.

    rows has vec_id and embedding; components x become floor(1024 * x). Queries are
    the rows where `chosen` holds. Every row is a candidate but those with the
    query's own vec_id; ties go to the smaller vec_id. Rows without an id, with a
    null or empty vector or with a null or non-finite component take no part, and
    only vectors of equal length meet. A query id that repeats gets its list for
    each of its rows; candidate ids that repeat keep all their rows. Scores are exact
    longs; one beyond a long counts as its limit, and a component whose 1024-fold is beyond
    a double as the largest double.
    """
    good = usable(rows, nonzero=False)
    shards = packs(good, SHARD, to_steps)
    queries = packs(good.where(chosen), QUERIES, to_steps)
    return search(queries, shards, k, lambda ids, mat: (ids, mat), tile(k), np.int64)
