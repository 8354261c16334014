"""Vectors in packs: a pack is a matrix with its ids, one row of a table.

Packs of the table are dealt to lanes, and the packs of queries to sections. A task
holds one lane, indexed once, and a section of the queries streams by it pack by pack.
So the table crosses the network once for each section and the queries once for each
lane, not once for each pack of the other side. A task keeps the best k of each
query, and the lists of the lanes are merged in a tree of bounded fan-in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import settled

PACK = "pack int, dim int, ids binary, mat binary"
LIST = "q int, dim int, node int, queries binary, ids binary, scores binary"
FAN = 8
#: Bytes of vectors that a task holds (its indexes are a few times that), and of queries that go by it.
HELD, ASKED = 32 << 20, 256 << 20
#: The id of an empty place in a list.
NONE = np.iinfo(np.int64).max


class Packs(NamedTuple):
    frame: DataFrame
    #: How many packs there are of each length of vectors, at most.
    n: int
    #: Bytes of all vectors.
    size: int


def usable(rows: DataFrame, nonzero: bool) -> DataFrame:
    """Rows (vec_id, embedding) with an id and a vector of finite numbers (not all zero, if asked)."""
    v = F.col("embedding")
    good = F.col("vec_id").isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    if nonzero:
        good = good & F.exists(v, lambda x: x != 0)
    return rows.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))


def packs(rows: DataFrame, size: int, prepare: Callable[[np.ndarray], np.ndarray] = lambda x: x) -> Packs:
    """Packs of about `size` rows each, dealt evenly. Vectors of different lengths go to packs of their own."""
    total, numbers = rows.agg(F.count(F.lit(1)), F.sum(F.size("embedding"))).first()
    n = max(1, -(-total // size))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        ids = whole.column("vec_id").to_numpy()
        lists = whole.column("embedding").combine_chunks()
        lengths, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        for dim in np.unique(lengths):
            own = np.flatnonzero(lengths == dim)
            own = own[np.argsort(ids[own], kind="stable")]
            mat = prepare(flat[starts[own][:, None] + np.arange(dim)].astype(np.float64))
            columns = [[TaskContext.get().partitionId()], [int(dim)], [ids[own].astype(np.int64).tobytes()], [mat.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["pack", "dim", "ids", "mat"])

    return Packs(settled(rows.repartition(n).mapInArrow(packed, PACK)), n, 8 * (numbers or 0))


def matrix(ids: bytes, mat: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(mat, np.float64).reshape(len(own), -1)


def lowest(kind) -> float | int:
    """The score of an empty place, for scores that are doubles or longs."""
    return np.iinfo(np.int64).min if np.dtype(kind) == np.int64 else -np.inf


def _falling(scores: np.ndarray) -> np.ndarray:
    """Numbers that grow as the scores fall; exact for every long."""
    return ~scores if scores.dtype == np.int64 else -scores


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of entries (row, id, score) the best k of each row: highest score, then smallest id."""
    order = np.lexsort((ids, _falling(scores), rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    fits = place < k
    out_ids, out = np.full((n, k), NONE), np.full((n, k), lowest(scores.dtype))
    out_ids[rows[fits], place[fits]] = ids[fits]
    out[rows[fits], place[fits]] = scores[fits]
    return out_ids, out


def search(queries: Packs, table: Packs, k: int, index: Callable, meet: Callable, kind=np.float64) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's best k over all packs.

    index(ids, matrix) is made once of each pack that a task holds; meet(query ids, queries,
    index) returns ids and scores of the kind, k to a row, empty places with the id NONE.
    """
    lanes = min(table.n, max(-(-table.size // HELD), table.frame.sparkSession.sparkContext.defaultParallelism))
    sections = min(queries.n, max(1, -(-queries.size // ASKED)))
    cells = laid_out(queries.frame, table.frame, lanes, sections)
    return _rows(_merged(cells.mapInArrow(meetings(k, sections, index, meet), LIST), lanes, k, kind), kind)


def laid_out(queries: DataFrame, table: DataFrame, lanes: int, sections: int) -> DataFrame:
    """One partition for each lane and section: the packs of the lane, then those of the section's queries."""
    lane = F.expr(f"explode(sequence(0, {lanes - 1}))").alias("lane")
    section = F.expr(f"explode(sequence(0, {sections - 1}))").alias("section")
    own, asked = (F.col("pack") % lanes).alias("lane"), (F.col("pack") % sections).alias("section")
    vectors = ["dim", "ids", "mat"]
    held = table.select(own, section, F.lit(None).cast("int").alias("q"), *vectors)
    rows = held.unionAll(queries.select(lane, asked, F.col("pack").alias("q"), *vectors))
    cell = (F.col("lane") * sections + F.col("section")).alias("cell")
    parted = rows.select(cell, "q", *vectors).repartitionById(lanes * sections, F.col("cell"))
    return parted.sortWithinPartitions("cell", F.asc_nulls_first("q"))


def meetings(k: int, sections: int, index: Callable, meet: Callable) -> Callable:
    """The work of a task on its rows of laid_out()."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["cell"] != cell:
                    cell, held = row["cell"], {}
                ids, mat = matrix(row["ids"], row["mat"])
                here: list[Any] = held.setdefault(row["dim"], [])
                if row["q"] is None:
                    here.append(index(ids, mat))
                elif here:
                    found = [np.concatenate(x, axis=1) for x in zip(*[meet(ids, mat, one) for one in here])]
                    yield _list(row["q"], row["dim"], cell // sections, ids, *_top(*found, k))

    return met


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best k of each row of lists side by side."""
    order = np.lexsort((ids, _falling(scores)), axis=1)[:, :k]
    ids, scores = (np.ascontiguousarray(np.take_along_axis(x, order, axis=1)) for x in (ids, scores))
    return ids, scores


def _list(q: int, dim: int, node: int, queries: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    columns = [[q], [dim], [node], [queries.tobytes()], [ids.tobytes()], [scores.tobytes()]]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["q", "dim", "node", "queries", "ids", "scores"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _merged(lists: DataFrame, n: int, k: int, kind) -> DataFrame:
    def merge(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        queries = np.frombuffer(rows[0]["queries"], np.int64)
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64).reshape(len(queries), k) for r in rows], axis=1)
        scores = np.concatenate([np.frombuffer(r["scores"], kind).reshape(len(queries), k) for r in rows], axis=1)
        picked = _top(ids, scores, k)
        return pa.Table.from_batches([_list(rows[0]["q"], rows[0]["dim"], rows[0]["node"] // FAN, queries, *picked)])

    while n > 1:
        branch = F.expr(f"node div {FAN}").alias("branch")
        lists = lists.groupBy("q", "dim", branch).applyInArrow(merge, LIST)
        n = -(-n // FAN)
    return lists


def _rows(lists: DataFrame, kind) -> DataFrame:
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries, ids = np.frombuffer(row["queries"], np.int64), np.frombuffer(row["ids"], np.int64)
                ids = ids.reshape(len(queries), -1)
                at, rank = np.nonzero(ids != NONE)
                scores = np.frombuffer(row["scores"], kind).reshape(ids.shape)
                columns = [queries[at], (rank + 1).astype(np.int32), ids[at, rank], scores[at, rank]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "rank", "vec_id", "score"])

    told = "long" if np.dtype(kind) == np.int64 else "double"
    return lists.mapInArrow(unpacked, f"query_id long, rank int, vec_id long, score {told}")
