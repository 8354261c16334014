"""Ranked lexical search by exact inner products over sparse ball trees.

A document is a sparse vector of integer term values; a query weighs terms. Scaled by the
terms' weights, the score is the product of the query's term counts with the document's
vector, so distances between documents are ruled by rare terms. Each shard of documents
becomes a ball tree: a subtree is known by its centroid and by a radius that holds all its
vectors, so no score in it is above (query . centroid) + |query| * radius. Bounds are widened
by more than all rounding errors. A query opens subtrees best bound first, until the best
bound left is below its k-th score; scores of leaves are exact integers.

Queries come in blocks of bounded size. Vectors hold only the terms of the block's queries,
as no other term can add to a score; statistics count all terms of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import settled

#: Documents of a leaf and of a tree; entries of a tree; query terms, with repeats, of a block.
LEAF, SHARD, ENTRIES, BLOCK = 48, 8192, 4_000_000, 1_000_000
#: A subtree gets at least one of so many rows of the one above.
UNEVEN = 16
EPS = 2.0**-52
#: Separators become blanks and A to Z lower case; bytes above 7F are parts of terms.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
VECTOR = "doc_id long, n long, term array<int>, tf array<int>"
FOUND = "item int, item_id long, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order; none for null."""
    return text.translate(BYTES).split() if text else []


@dataclass(frozen=True)
class Items:
    """A block of queries: their ids and, per query, the counts of its terms by number."""

    ids: list[int | None]
    counts: list[dict[int, int]]
    number: dict[bytes, int]


def blocks(items: DataFrame) -> Iterator[Items]:
    """The queries in blocks of about BLOCK terms; those without terms find nothing and are left out."""
    ids, counts, number, size = [], [], {}, 0
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).toLocalIterator():
        own = Counter(number.setdefault(t, len(number)) for t in terms(row["text"] and bytes(row["text"])))
        if own:
            ids.append(row["item_id"])
            counts.append(dict(own))
            size += own.total()
        if size >= BLOCK:
            yield Items(ids, counts, number)
            ids, counts, number, size = [], [], {}, 0
    if ids:
        yield Items(ids, counts, number)


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, term, tf): of every document with terms their number and those that the queries know."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, sizes, term, tf, ends = [], [], [], [], [0]
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text")):
                own = terms(text.as_py())
                if not own:
                    continue
                counts = Counter(filter(items.number.__contains__, own))
                ids.append(doc_id)
                sizes.append(len(own))
                term.extend(map(items.number.__getitem__, counts))
                tf.extend(counts.values())
                ends.append(len(term))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf)]
            columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "term", "tf"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(batches, VECTOR)


@dataclass(frozen=True)
class Statistics:
    documents: int
    length: int  # terms of all documents
    weight: np.ndarray  # by number of the term


def statistics(rows: DataFrame, size: int) -> Statistics:
    """Counts over all documents; document frequencies of the `size` terms that the queries know."""
    total = rows.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    held = np.zeros(size, np.int64)
    for row in rows.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        held[row["term"]] = row["count"]
    n = total["documents"]
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held.tolist()]
    return Statistics(n, total["length"] or 0, np.array(weight, np.int64))


def values(n: np.ndarray, tf: np.ndarray, counts: Statistics) -> np.ndarray:
    """The value of a term of each entry: its times in a document of n terms, damped by the document's length."""
    if 75 * int(n.max(initial=0)) * counts.documents >= 1 << 63:
        n = n.astype(object)
    m = (25 + 75 * n * counts.documents // max(counts.length, 1)).astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Tree:
    """A ball tree over sparse rows; every row has an entry at least."""

    def __init__(self, ids: list[int | None], sizes: np.ndarray, term: np.ndarray, value: np.ndarray, weight: np.ndarray):
        self.terms, own = np.unique(term, return_inverse=True)
        scaled = (weight[term] * value).astype(np.float64)
        self.size = len(self.terms)
        ends = np.cumsum(sizes)
        self.begin = ends - sizes
        self.sizes, self.term, self.scaled = sizes, own.astype(np.int64), scaled
        self.norm2 = np.add.reduceat(scaled * scaled, self.begin)
        self.order = np.arange(len(sizes))
        self.parts: list[tuple[int, int, int, int]] = []  # first row, last, left and right subtree (-1: leaf)
        self.radius: list[float] = []
        self.centres: list[tuple[np.ndarray, np.ndarray]] = []
        self._split()
        self._lay_out(ids, value)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all entries of some rows, and where each row begins among them."""
        n = self.sizes[rows]
        first = np.cumsum(n) - n
        return np.arange(int(n.sum())) + np.repeat(self.begin[rows] - first, n), first

    def _split(self) -> None:
        todo = [(0, len(self.order), -1, 0)]
        while todo:
            a, b, above, side = todo.pop()
            rows = self.order[a:b]
            at, first = self._entries(rows)
            term, scaled = self.term[at], self.scaled[at]
            centre = np.bincount(term, scaled, self.size) / len(rows)
            far = self._distances(rows, centre, term, scaled, first)
            node = len(self.parts)
            self.parts.append((a, b, -1, -1))
            self.radius.append(math.sqrt(far.max()) * (1 + 4 * EPS))
            some = np.flatnonzero(centre)
            self.centres.append((some, centre[some]))
            if above >= 0:
                x = list(self.parts[above])
                x[2 + side] = node
                self.parts[above] = tuple(x)
            if b - a <= LEAF:
                continue
            one = self._row(rows[far.argmax()])
            other = self._row(rows[self._distances(rows, one, term, scaled, first).argmax()])
            # Nearer to the one than to the other, as along this line; else halves.
            along = np.add.reduceat(scaled * (one - other)[term], first) - (one @ one - other @ other) / 2
            middle = int((along < 0).sum())
            if min(middle, b - a - middle) * UNEVEN < b - a:
                middle = (b - a) // 2
            self.order[a:b] = rows[np.argpartition(along, middle)]
            todo += [(a, a + middle, node, 0), (a + middle, b, node, 1)]

    def _row(self, row: int) -> np.ndarray:
        dense = np.zeros(self.size)
        here = slice(self.begin[row], self.begin[row] + self.sizes[row])
        dense[self.term[here]] = self.scaled[here]
        return dense

    def _distances(self, rows, point, term, scaled, first) -> np.ndarray:
        """Squared distances to a point, no smaller than they are."""
        dot = np.add.reduceat(scaled * point[term], first)
        own, other = self.norm2[rows], point @ point
        wide = 2 * EPS * (self.size + 8) * (own + other + 2 * dot)
        return np.maximum(own + other - 2 * dot, 0) + wide

    def _lay_out(self, ids: list[int | None], value: np.ndarray) -> None:
        """Rows in the order of the leaves, centroids by term."""
        at, self.begin = self._entries(self.order)
        self.term, self.value = self.term[at], value[at]
        self.end = self.begin + self.sizes[self.order]
        self.ids = [ids[i] for i in self.order]
        node = np.repeat(np.arange(len(self.centres)), [len(c[0]) for c in self.centres])
        term = np.concatenate([c[0] for c in self.centres])
        order = np.argsort(term, kind="stable")
        self.centre_node, self.centre = node[order], np.concatenate([c[1] for c in self.centres])[order]
        self.centre_at = np.searchsorted(term[order], np.arange(self.size + 1))
        self.radii = np.array(self.radius)
        del self.scaled, self.norm2, self.centres, self.radius

    def search(self, term: np.ndarray, count: np.ndarray, weight: np.ndarray, k: int, best: list[tuple]) -> int:
        """Puts better rows into `best`, a heap of up to k (score, has an id, -id); gives the number of rows scored."""
        at = np.searchsorted(self.terms, term)
        known = at < self.size
        known[known] = self.terms[at[known]] == term[known]
        if not known.any():
            return 0
        own, times = at[known], count[known].astype(np.float64)
        of_node = np.concatenate([self.centre_node[self.centre_at[t] : self.centre_at[t + 1]] for t in own])
        parts = [self.centre[self.centre_at[t] : self.centre_at[t + 1]] * c for t, c in zip(own, times)]
        dots = np.bincount(of_node, np.concatenate(parts), len(self.parts))
        bounds = dots + math.sqrt(float(times @ times)) * self.radii
        bounds = (bounds * (1 + 2 * EPS * (len(own) + 16))).tolist()
        gain = np.zeros(self.size, np.int64)
        gain[own] = weight[known] * count[known]
        scored, heap = 0, [(-bounds[0], 0)]
        while heap:
            bound, node = heappop(heap)
            if len(best) == k and -bound < best[0][0]:
                break
            a, b, left, right = self.parts[node]
            if left >= 0:
                heappush(heap, (-bounds[left], left))
                heappush(heap, (-bounds[right], right))
                continue
            here = slice(self.begin[a], self.end[b - 1])
            scores = np.add.reduceat(gain[self.term[here]] * self.value[here], self.begin[a:b] - self.begin[a])
            scored += b - a
            least = best[0][0] if len(best) == k else 1
            for i in np.flatnonzero(scores >= least).tolist():
                doc_id = self.ids[a + i]
                entry = (int(scores[i]), doc_id is not None, -(doc_id or 0))
                if len(best) < k:
                    heappush(best, entry)
                elif entry > best[0]:
                    heapreplace(best, entry)
        return scored


def _trees(parts: Iterator[pa.RecordBatch], counts: Statistics) -> Iterator[Tree]:
    """Trees over SHARD documents or ENTRIES entries each, of the rows with entries."""

    def made(held: list[tuple]) -> Tree:
        ids = [i for h in held for i in h[0]]
        n, sizes, term, tf = (np.concatenate([h[i] for h in held]) for i in range(1, 5))
        value = values(np.repeat(n, sizes), tf, counts)
        return Tree(ids, sizes, term, value, counts.weight)

    held, rows, entries = [], 0, 0
    for part in parts:
        for at in range(0, part.num_rows, 512):
            few = part.slice(at, 512)
            few = few.filter(pc.greater(pc.list_value_length(few.column("term")), 0))
            if not few.num_rows:
                continue
            sizes = pc.list_value_length(few.column("term")).to_numpy().astype(np.int64)
            flat = [few.column(c).flatten().to_numpy().astype(np.int64) for c in ("term", "tf")]
            held.append((few.column("doc_id").to_pylist(), few.column("n").to_numpy(), sizes, *flat))
            rows, entries = rows + few.num_rows, entries + len(flat[0])
            if rows >= SHARD or entries >= ENTRIES:
                yield made(held)
                held, rows, entries = [], 0, 0
    if held:
        yield made(held)


def _found(rows: DataFrame, items: Items, counts: Statistics, k: int) -> DataFrame:
    """Each task's best k of each query."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = []
        for own in items.counts:
            term = np.array(sorted(own), np.int64)
            queries.append((term, np.array([own[t] for t in term.tolist()], np.int64), counts.weight[term]))
        best: list[list[tuple]] = [[] for _ in queries]
        for tree in _trees(parts, counts):
            for query, heap in zip(queries, best):
                tree.search(*query, k, heap)
        out = [
            (at, items.ids[at], -minus if has else None, score)
            for at, heap in enumerate(best)
            for score, has, minus in heap
        ]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["item", "item_id", "doc_id", "score"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    return rows.mapInArrow(batches, FOUND)


def _block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    rows = settled(vectors(docs, items))
    found = _found(rows, items, statistics(rows, len(items.number)), k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): of each item the k documents with the highest score above 0.

    Equal scores go by ascending doc_id. Null and empty texts have no terms: such documents count
    nowhere, such items find nothing. Every row is a document or an item of its own, also if its id
    repeats; a null doc_id comes last among equals. Only doc_id, item_id and the two texts are read,
    so other columns may have any name. Ids and scores are longs; a score beyond a long is not defined.
    """
    spark: SparkSession = docs.sparkSession
    lists = [_block(docs, block, k) for block in blocks(items)]
    return reduce(DataFrame.unionByName, lists) if lists else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


SQL = r"""
WITH found AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), own AS (SELECT doc_id, terms, len(terms) AS n FROM found WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM own),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM own) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
