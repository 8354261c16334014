"""SimHash near-duplicate groups with pigeonring filtering.

A fingerprint has four segments of 16 bits in a ring. If two fingerprints differ
in at most three bits, then some segment starts a chain in which, for every
length l, the first l segments differ in at most 3 * l / 4 bits together: 0, 1, 2
and 3. So each fingerprint is dealt out by one segment as it is and the next one
with at most one bit changed. Pairs that meet are held to the rest of the chain,
then to the full distance.

Pairs never leave a task: each partition returns the forest of its links, at
most one row per fingerprint. Groups that would be too large are tiled: a tile
meets a block of the plain members with a block of the changed ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import shingles
from barloom.llm.common import Scratch, by_text, inner, settled, spread

DISTANCE = 3
SEGMENTS = 4
BITS = 16
#: One of so many fingerprints is looked at to find the groups worth tiling.
LOOK = 16
#: Members of a tile on either side.
TILE = 2048
#: Pairs of a group compared at once, and rows looked at together.
STRIP, ROWS = 1 << 18, 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = [digest(join(s), 42) for s in zip(*(words[i:] for i in range(shingle)))]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = np.array(hashes[at : at + (1 << 14)], dtype="<u8")
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(packed.view("<u8")[0])


def printed(shingle: int = 3):
    """The fingerprint of the text column as a signed long."""

    def make(texts: list[str | None]) -> pa.Array:
        out = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pa.array(out.view(np.int64))

    return by_text(make, "long")("text")


def _segment(column, i: int):
    return F.shiftrightunsigned(column, BITS * (i % SEGMENTS)).bitwiseAND(0xFFFF)


def _keys(fps: DataFrame) -> DataFrame:
    """(key, fp, role): where a fingerprint stands as it is (3) and changed by a bit (2)."""
    fp = F.col("fp")
    parts = []
    for i in range(SEGMENTS):
        first = F.shiftleft(F.lit(i).cast("long"), 32).bitwiseOR(F.shiftleft(_segment(fp, i), BITS))
        for mask in [0, *(1 << b for b in range(BITS))]:
            parts.append(first.bitwiseOR(_segment(fp, i + 1).bitwiseXOR(F.lit(mask).cast("long"))))
    keyed = fps.select("fp", F.posexplode(F.array(*parts)).alias("at", "key"))
    role = F.when(F.col("at") % (BITS + 1) == 0, 3).otherwise(2).cast("byte")
    return keyed.select("key", "fp", role.alias("role"))


def _tiled(keyed: DataFrame, fps: DataFrame) -> DataFrame:
    """(key, fp, role) with every large group cut into tiles of about TILE x TILE members.

    The size is guessed from a sixteenth of the fingerprints. A wrong guess makes
    tiles larger or smaller and changes no link.
    """
    look = _keys(fps.where(spread(F.col("fp"), "look") < 1 / LOOK))
    large = settled(
        look.groupBy("key")
        .count()
        .where(F.col("count") * LOOK > 2 * TILE)
        .select("key", F.ceil(F.col("count") * LOOK / TILE).cast("long").alias("cut"))
    )
    if large.isEmpty():
        return keyed  # nothing to cut, and no join to shuffle all keys for
    both = keyed.join(large, "key", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("cut"))
    lane = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cut") - 1))
    plain = both.where(F.col("cut").isNull()).select("key", "fp", "role")
    cut = both.where(F.col("cut").isNotNull())
    changed = cut.select("key", "fp", F.lit(2).cast("byte").alias("role"), own.alias("v"), lane.alias("e"))
    stands = cut.where("role = 3").select(
        "key", "fp", F.lit(1).cast("byte").alias("role"), lane.alias("v"), own.alias("e")
    )
    tiles = changed.unionByName(stands)
    return plain.unionByName(tiles.select(F.xxhash64("key", "e", "v").alias("key"), "fp", "role"))


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether fingerprints differ in DISTANCE bits at most, tried by chains first."""
    x = a ^ b
    d = [np.bitwise_count((x >> np.uint64(BITS * i)) & np.uint64(0xFFFF)) for i in range(SEGMENTS)]
    chained = np.zeros(x.shape, bool)
    for start in range(SEGMENTS):
        within, total = np.ones(x.shape, bool), np.zeros(x.shape, np.uint8)
        for length in range(1, SEGMENTS + 1):
            total = total + d[(start + length - 1) % SEGMENTS]
            within &= total * SEGMENTS <= length * DISTANCE
        chained |= within
    out = np.zeros(x.shape, bool)
    out[chained] = np.bitwise_count(x[chained]) <= DISTANCE
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links with the smallest node that it is connected to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            break
        label = new
    far = label != np.arange(len(nodes))
    return nodes[far], nodes[label[far]]


def _group_links(fp: np.ndarray, role: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Links inside groups, which are ranges of the sorted rows."""
    left, right = [], []
    size = ends - starts
    for step in range(1, 33):  # small groups: rows that far apart, all groups at once
        which = (size > step) & (size <= 33)
        if not which.any():
            break
        rows = np.concatenate([np.arange(s, e - step) for s, e in zip(starts[which], ends[which])])
        mate = rows + step
        fits = ((role[rows] | role[mate]) & 1).astype(bool) & (fp[rows] != fp[mate])
        rows, mate = rows[fits], mate[fits]
        fits = _linked(fp[rows], fp[mate])
        left.append(fp[rows[fits]])
        right.append(fp[mate[fits]])
    for s, e in zip(starts[size > 33], ends[size > 33]):
        members, stands = fp[s:e], fp[s:e][(role[s:e] & 1) > 0]
        rows = max(1, STRIP // len(members))
        for at in range(0, len(stands), rows):
            i, j = np.nonzero(_linked(stands[at : at + rows, None], members[None, :]))
            a, b = _forest(stands[at + i], members[j])
            left.append(a)
            right.append(b)
    return left, right


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the links of a partition whose rows come in order of their key."""
    held: list[list[np.ndarray]] = []  # key, fp, role
    links: tuple[list, list] = ([], [])

    def take(key: np.ndarray, fp: np.ndarray, role: np.ndarray) -> None:
        border = np.flatnonzero(key[1:] != key[:-1]) + 1
        starts, ends = np.concatenate([[0], border]), np.concatenate([border, [len(key)]])
        many = ends - starts > 1
        for to, new in zip(links, _group_links(fp.view(np.uint64), role, starts[many], ends[many])):
            to.extend(new)

    def joined() -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*held)]

    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(name).to_numpy() for name in ("key", "fp", "role")])
        if sum(len(x[0]) for x in held) < ROWS or held[0][0][0] == held[-1][0][-1]:
            continue  # few rows, or one group so far
        rows = joined()
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        take(*(x[:cut] for x in rows))
        held = [[x[cut:] for x in rows]]
        if sum(map(len, links[0])) > 1 << 20:
            links = tuple([x] for x in _forest(*map(np.concatenate, links)))
    if held:
        take(*joined())
    if links[0]:
        forest = [pa.array(x.view(np.int64)) for x in _forest(*map(np.concatenate, links))]
        yield pa.RecordBatch.from_arrays(forest, ["a", "b"])


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links enough to connect what is within DISTANCE, of distinct fingerprints."""
    dealt = _tiled(_keys(fps), fps).repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_meet, "a long, b long")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The forest of a partition's edges: each node with the smallest one that it reaches there."""
    held, size = [], 0

    def forest() -> tuple[np.ndarray, np.ndarray]:
        return _forest(*(np.concatenate(x) for x in zip(*held)))

    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(n).to_numpy() for n in ("a", "b")))
            size += batch.num_rows
        if size > 1 << 20:
            held = [forest()]
            size = len(held[0][0]) // 2
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest()], ["a", "b"])


def _folded(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a > b, that connect the same nodes: the forests of parts dealt by the greater end."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    return down.repartition("a").mapInArrow(_fold, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges.

    Forests of parts of the edges come first and often leave stars alone. Then large and
    small stars in turn until every node has one edge to a root; a small star is folded
    into the forest of its part. Sides of a join are written tables, so a hot centre can
    be split; those of a round are deleted when the next one stands.
    """
    scratch = Scratch(edges.sparkSession)
    edges = scratch.keep(_folded(_folded(edges)))
    while True:
        ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        ends = ends.unionAll(edges.select("b", F.lit(0), F.lit(1)))
        roles = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        if roles.where("below > 1 or below = 1 and above = 1").isEmpty():
            break
        both = edges.unionAll(edges.select("b", "a"))
        least = scratch.keep(both.groupBy("a").agg(F.min("b").alias("m")))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        done = scratch.keep(_folded(large))
        scratch.drop(edges, least)
        edges = done
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _named(rows: DataFrame, edges) -> DataFrame:
    """(doc_id, fp, root, component_id) from rows (doc_id, fp, ...); root is a fingerprint that stands for the component."""
    fps = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(edges(fps.select("fp"))).withColumnRenamed("node", "fp")
    known = fps.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    known = settled(known)
    ids = settled(known.groupBy("root").agg(F.min("least").alias("component_id")))
    named = settled(known.join(ids, "root").select("fp", "root", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text, ...).

    Fingerprints link at DISTANCE or fewer differing bits; component_id is the
    smallest doc_id reachable. Null, empty and blank texts have fingerprint 0 and
    link like any other. Rows with a null doc_id take part; component_id is null
    only if no row of the component has an id. Repeated rows come back repeated.
    """
    rows = settled(docs.select("doc_id", printed(shingle).alias("fp")))
    return _named(rows, links).drop("root")


def kept(docs: DataFrame, shingle: int = 3, similar: bool = False) -> DataFrame:
    """The rows of docs, one of each near-duplicate group: that with the smallest doc_id.

    With `similar`, texts also link whose sets of five-word shingles have a
    Jaccard similarity of 0.8 or more. Of rows of a group that repeat this doc_id
    one stays, and one of a group without ids.
    """
    if similar:
        scratch = Scratch(docs.sparkSession)
        made = docs.select("doc_id", printed(shingle).alias("fp"), shingles.sketched().alias("_s"))
        rows = scratch.keep(made.select("doc_id", "fp", "_s.same", "_s.size", "_s.keys", "_s.sketch"))
        edges = lambda fps: shingles.links(docs, rows, links(fps), components, scratch)
    else:
        rows, edges = settled(docs.select("doc_id", printed(shingle).alias("fp"))), links
    groups = settled(_named(rows, edges))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("_first")
    stay = settled(groups.groupBy("root").agg(first).select("_first.doc_id", "_first.fp"))
    again = groups.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if stay.where("doc_id is null").isEmpty() and stay.join(again, "doc_id", "left_semi").isEmpty():
        return docs.join(stay.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    name = inner(docs, "_fp")
    own = docs.withColumn(name, printed(shingle))
    one = stay.select(F.col("doc_id").alias("_id"), F.col("fp").alias(name))
    same = own["doc_id"].eqNullSafe(one["_id"]) & (own[name] == one[name])
    return own.join(one, same, "left_semi").dropDuplicates(["doc_id", name]).select(*docs.columns)
