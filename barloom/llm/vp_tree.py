"""Approximate nearest neighbours by vantage-point trees, one for each shard.

Inner products become distances: with M the largest norm of the shard, every
vector x gets one more component sqrt(M^2 - |x|^2) and a query a zero, so that
the squared distance is |q|^2 + M^2 - 2 q.x and nearest means the largest inner
product. A branch is left out if the triangle inequality, its bound multiplied
by `factor`, puts it beyond the k-th best found so far. Factor one is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from barloom.llm.vectors import NONE, best, packs, search, usable

SHARD, QUERIES = 8192, 1024
LEAF = 128
#: Products that differ by less are settled by the exact sum.
NEAR = 1e-9


@dataclass
class Node:
    members: np.ndarray | None = None  # of a leaf
    vantage: int = 0
    inner: Node | None = None
    outer: Node | None = None
    inner_range: tuple[float, float] = (0.0, 0.0)
    outer_range: tuple[float, float] = (0.0, 0.0)


def build(points: np.ndarray, members: np.ndarray, draw: np.random.Generator) -> Node:
    if len(members) <= LEAF:
        return Node(members)
    vantage = int(draw.choice(members))
    far = np.linalg.norm(points[members] - points[vantage], axis=1)
    near = far <= np.median(far)
    if near.all():
        near = far < far.max()
    if not near.any() or near.all():  # all equally far
        return Node(members)
    sides = [(far[s].min(), far[s].max()) for s in (near, ~near)]
    return Node(None, vantage, build(points, members[near], draw), build(points, members[~near], draw), *sides)


class Shard:
    """A pack of vectors and its tree. Copies of a vector are one point with the list of their ids."""

    def __init__(self, ids: np.ndarray, mat: np.ndarray):
        vectors, which = np.unique(mat, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.lexsort((ids, which))
        #: The ids of point i are ids[starts[i]:starts[i + 1]], smallest first.
        self.ids, self.starts = ids[order], np.searchsorted(which[order], np.arange(len(vectors) + 1))
        #: The smallest id of each point, which decides between equal scores; the last stands for no point.
        self.first = np.append(self.ids[self.starts[:-1]], NONE)
        norms = (vectors**2).sum(axis=1)
        self.most = norms.max()
        points = np.column_stack([vectors, np.sqrt(np.maximum(self.most - norms, 0))])
        self.vectors = points[:, :-1]
        self.root = build(points, np.arange(len(points)), np.random.default_rng(5))


class Search:
    """A block of queries in one tree; keeps the best `k` vectors of each query."""

    def __init__(self, queries: np.ndarray, shard: Shard, k: int, factor: float):
        self.q, self.x, self.first, self.most, self.factor = queries, shard.vectors, shard.first, shard.most, factor
        self.q_norms = (queries**2).sum(axis=1)
        self.at = np.full((len(queries), k), -1)
        self.scores = np.full((len(queries), k), -np.inf)
        self.visit(shard.root, np.arange(len(queries)))

    def reach(self, qs: np.ndarray) -> np.ndarray:
        """Distance within which a vector can still be among the best."""
        square = self.q_norms[qs] + self.most - 2 * (self.scores[qs, 0] - NEAR)
        return np.sqrt(np.maximum(square, 0))

    def leaf(self, members: np.ndarray, qs: np.ndarray) -> None:
        k = self.at.shape[1]
        products = self.q[qs] @ self.x[members].T
        reached = products.max(axis=1) >= self.scores[qs, 0]  # the lists of the others stay as they are
        qs, products = qs[reached], products[reached]
        if not len(qs):
            return
        scores = np.concatenate([self.scores[qs], products], axis=1)
        at = np.concatenate([self.at[qs], np.broadcast_to(members, (len(qs), len(members)))], axis=1)
        keep = np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]  # the smallest of the kept comes first
        kept = np.take_along_axis(scores, keep, axis=1)
        # Where more are equal to the least kept than there is room for, the smallest ids stay.
        edge = kept[:, :1]
        crowd = np.flatnonzero(((scores == edge).sum(axis=1) > (kept == edge).sum(axis=1)) & np.isfinite(edge[:, 0]))
        if len(crowd):
            order = np.lexsort((self.first[at[crowd]], -scores[crowd]), axis=1)
            keep[crowd] = order[:, :k][:, ::-1]
        self.scores[qs] = np.take_along_axis(scores, keep, axis=1)
        self.at[qs] = np.take_along_axis(at, keep, axis=1)

    def visit(self, node: Node, qs: np.ndarray) -> None:
        if not len(qs):
            return
        if node.members is not None:
            return self.leaf(node.members, qs)
        square = self.q_norms[qs] + self.most - 2 * (self.q[qs] @ self.x[node.vantage])
        far = np.sqrt(np.maximum(square, 0))
        inward = far - node.inner_range[1] <= node.outer_range[0] - far
        self.visit(node.inner, qs[inward])
        self.visit(node.outer, qs[~inward])
        for side, (low, high), rest in ((node.outer, node.outer_range, inward), (node.inner, node.inner_range, ~inward)):
            bound = np.maximum(np.maximum(far[rest] - high, low - far[rest]), 0)
            self.visit(side, qs[rest][bound * self.factor <= self.reach(qs[rest])])


def meeting(k: int, factor: float):
    def meet(q_ids: np.ndarray, q: np.ndarray, shard: Shard):
        vectors, starts = shard.vectors, shard.starts
        done = Search(q, shard, min(k + 1, len(vectors)), factor)
        # One of the k + 1 may be the query itself; of its copies k + 1 are enough.
        rows, columns = np.nonzero(done.at >= 0)
        points = done.at[rows, columns]
        exact = (q[rows] * vectors[points]).sum(axis=1)
        copies = np.minimum(starts[points + 1] - starts[points], k + 1)
        rows, exact, points = (np.repeat(a, copies) for a in (rows, exact, points))
        step = np.arange(len(rows)) - np.repeat(np.cumsum(copies) - copies, copies)
        found = shard.ids[starts[points] + step]
        other = found != q_ids[rows]
        return best(rows[other], found[other], exact[other], len(q_ids), k)

    return meet


def nearest(rows: DataFrame, chosen, k: int = 20, factor: float = 4.0) -> DataFrame:
    """(query_id, rank, vec_id, score): k rows with a large inner product for each query.

    rows has vec_id and embedding; queries are the rows where `chosen` holds. Every
    row is indexed and a candidate, but those with the query's own vec_id. Ties go
    to the smaller vec_id; score is the inner product in double precision. Rows
    without an id, with a null, empty or zero vector or with a null or non-finite
    component take no part, and only vectors of equal length meet. A query id that
    repeats gets its list for each of its rows. With factor 1 the result is exact.
    """
    good = usable(rows, nonzero=True)
    return search(packs(good.where(chosen), QUERIES), packs(good, SHARD), k, Shard, meeting(k, factor))
