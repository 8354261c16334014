"""Links between texts whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Candidates share one of 24 MinHash bands of three: a pair at exactly 0.8 shares
none with a probability of (1 - 0.8^3)^24, below 4e-8. Of candidates at least 36 of
the 72 MinHash values agree in their lowest byte, which a pair at 0.8 misses with a
probability below 4e-9. Every link is held to the exact similarity of both sets, and
sets travel only for texts that have such a candidate.

Members of a band's group meet a hub first. Groups that this leaves in several
components are compared pair by pair if they are small. The members of large ones, such
as many texts of one boilerplate, are pooled and met by prefix filtering: shingles are
ordered by how common they are in the pool. Similar sets share one that is among the
rarest |y| - ceil(0.8 |y|) + 1 of the larger and |x| - ceil(8 |x| / 9) + 1 of the smaller,
and only members with such a shingle in common meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, by_text

WORDS = 5
BANDS, DEEP = 24, 3
#: MinHash values that agree at least; members of a tile on either side.
AGREE, TILE = 36, 512
_DRAW = np.random.default_rng(11)
_TIMES = _DRAW.integers(0, 1 << 63, BANDS * DEEP, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 63, BANDS * DEEP, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles in order; a text of fewer words is one shingle, a blank one none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < WORDS:
        return np.array([digest(join(words), 5)], np.uint64)
    return np.unique(np.array([digest(join(s), 5) for s in zip(*(words[i:] for i in range(WORDS)))], np.uint64))


def _name(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), 6)


def _least(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set."""
    least = np.full(BANDS * DEEP, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 2048):
        mixed = found[at : at + 2048, None] * _TIMES + _PLUS
        np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(axis=0), out=least)
    return least


def _bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, DEEP)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)], np.uint64)


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def sketched():
    """(same, size, keys, sketch) of the text column; all null for a blank text.

    A name of its set, the number of its shingles, the bands, and a byte of each MinHash value.
    """

    def make(texts: list[str | None]) -> pa.Array:
        rows = []
        for text in texts:
            found = shingles(text)
            if not len(found):
                rows.append({})
                continue
            least = _least(found)
            same = int(np.uint64(_name(found)).view(np.int64))
            keys, sketch = _bands(least).view(np.int64), least.astype(np.uint8).tobytes()
            rows.append({"same": same, "size": len(found), "keys": keys, "sketch": sketch})
        kinds = [("same", pa.int64()), ("size", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())]
        return pa.array(rows, pa.struct(kinds))

    return by_text(make, "struct<same:long,size:long,keys:array<long>,sketch:binary>")("text")


def _whole():
    """(same, set) of the text column."""

    def make(texts: list[str | None]) -> pa.Array:
        sets = [shingles(t) for t in texts]
        names = _longs([_name(s) for s in sets])
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        values = _longs(np.concatenate(sets) if sets else [])
        lists = pa.ListArray.from_arrays(pa.array(ends), values)
        return pa.StructArray.from_arrays([names, lists], ["same", "set"])

    return by_text(make, "struct<same:long,set:array<long>>")("text")


def _pairs(fp: np.ndarray, root: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links of similar sets enough to connect what is in different components."""
    if (root == root[0]).all():
        return []
    root, size = root.copy(), np.array([len(s) for s in sets])
    starts = np.cumsum(size) - size
    kinds, codes = np.unique(np.concatenate(sets), return_inverse=True)
    mark, out = np.zeros(len(kinds), np.int32), []
    for i in range(len(sets) - 1):
        near = (root != root[i]) & (size * 5 >= size[i] * 4) & (size * 4 <= size[i] * 5)
        near[: i + 1] = False
        if not near.any():
            continue
        own = codes[starts[i] : starts[i] + size[i]]
        mark[own] = 1
        common = np.add.reduceat(mark[codes], starts)
        mark[own] = 0
        for j in np.flatnonzero(near & (common * 5 >= (size + size[i] - common) * 4)):
            if root[j] != root[i]:
                out.append((fp[i], fp[j]))
                root[root == root[j]] = root[i]
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the tiles of a partition, whose rows come in order of their tile."""
    held, tile = [], None

    def done() -> pa.RecordBatch:
        fp, root = (np.array([row[i] for row in held], np.int64) for i in range(2))
        found = np.array(_pairs(fp, root, [row[2] for row in held]) if held else [], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("tile", "fp", "root")]
        for k, (name, fp, root) in enumerate(zip(*columns)):
            if name != tile:
                yield done()
                held, tile = [], name
            held.append((fp, root, batch.column("set")[k].values.to_numpy()))
    yield done()


def _agreeing(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether the sketches of two sets leave a similarity of 0.8 possible."""
    for pair in batches:
        x, y = (np.frombuffer(b"".join(side.to_pylist()), np.uint8).reshape(-1, BANDS * DEEP) for side in pair)
        yield pa.array((x == y).sum(axis=1) >= AGREE)


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the members of small groups, in order of their key, those whose sketch and size fit one of another component."""
    held: list[tuple] = []
    key = None

    def done() -> pa.RecordBatch:
        same, root, size = (np.array([row[i] for row in held], np.int64) for i in range(3))
        sketch = np.frombuffer(b"".join(row[3] for row in held), np.uint8).reshape(-1, BANDS * DEEP)
        fits = np.zeros(len(held), bool)
        for i in range(len(held) - 1):
            rest = slice(i + 1, None)
            near = (root[rest] != root[i]) & (size[rest] * 5 >= size[i] * 4) & (size[rest] * 4 <= size[i] * 5)
            near &= (sketch[rest] == sketch[i]).sum(axis=1) >= AGREE
            fits[rest] |= near
            fits[i] |= near.any()
        return pa.RecordBatch.from_pydict({"tile": np.full(int(fits.sum()), key or 0), "same": same[fits], "root": root[fits]})

    for batch in batches:
        for name, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "same", "root", "size", "sketch"))):
            if name != key:
                yield done()
                held, key = [], name
            held.append(tuple(row))
    yield done()


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(same, set) of the sets in wanted (same, least), from the whole text of one document of each."""
    ids = wanted.select(F.col("least").alias("_least")).distinct()
    some = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("_least")), "left_semi")
    found = some.select(_whole().alias("_s")).select("_s.same", "_s.set")
    return found.join(wanted.select("same"), "same", "left_semi").dropDuplicates(["same"])


def _grouped(keyed: DataFrame) -> DataFrame:
    """(key, n, hub) of the groups of two or more in keyed (key, same); those with the same members are one."""
    who = F.bit_xor(F.xxhash64("same")).alias("who")
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), who, F.min("same").alias("hub"))
    return groups.where("n > 1").groupBy("n", "who", "hub").agg(F.min("key").alias("key")).select("key", "n", "hub")


def _apart(members: DataFrame) -> DataFrame:
    """The members (key, ..., root) of groups that lie in several components."""
    roots = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return members.join(roots.where("low <> high").select("key"), "key", "left_semi")


def _rarely_shared(pool: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(tile, same, root): of a pool of sets (same, root), those that meet, by the rare shingles that they share."""
    each = scratch.keep(pool.join(sets, "same").select("same", F.size("set").alias("size"), F.explode("set").alias("key")))
    common = each.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    order = Window.partitionBy("same").orderBy(F.coalesce("times", F.lit(1)), "key")
    ranked = each.join(common, "key", "left").withColumn("at", F.row_number().over(order))
    # A shingle of its own meets nothing, but has its place in the order.
    prefix = ranked.where("at <= size - (4 * size + 4) div 5 + 1 and times > 1")
    smaller = F.expr("at <= size - (8 * size + 8) div 9 + 1").alias("smaller")
    rare = scratch.keep(prefix.select("key", "same", smaller))
    useful = rare.where("smaller").select("key").distinct()
    groups = _grouped(rare.join(useful, "key", "left_semi"))
    met = rare.join(groups.select("key", "n"), "key").join(pool, "same")
    left = scratch.keep(_apart(met.select("key", "n", "same", "root")))
    scratch.drop(each, rare)
    # A shingle that very many still share is cut into blocks that meet two by two.
    cut = F.ceil(F.col("n") / TILE).cast("long")
    left = left.withColumn("own", F.pmod(F.xxhash64("same"), cut))
    left = left.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), cut - 1)))
    tile = F.xxhash64("key", F.least("own", "lane"), F.greatest("own", "lane"))
    return left.select(tile.alias("tile"), "same", "root")


def links(docs: DataFrame, rows: DataFrame, first: DataFrame, components: Callable, scratch: Scratch) -> DataFrame:
    """(a, b): links of the fingerprints of similar texts, enough to connect them together with `first`.

    rows is a kept table with doc_id, fp and the columns of sketched() for each row of docs
    (doc_id, text, ...). Blank texts have no set and no link here; rows with a null doc_id
    take part like any other.
    """
    known = rows.where("same is not null")
    one = [F.first(c).alias(c) for c in ("size", "keys", "sketch")]
    spans = [F.min("fp").alias("fp"), F.max("fp").alias("last"), F.min("doc_id").alias("least")]
    sets = scratch.keep(known.groupBy("same").agg(*spans, *one))
    # One set under several fingerprints: texts that only repeat their shingles more or less often.
    several = sets.where("fp <> last").select("same", F.col("fp").alias("b"))
    equal = known.select("same", F.col("fp").alias("a")).distinct().join(several, "same").where("a <> b").select("a", "b")

    keyed = sets.select("same", F.explode("keys").alias("key"))
    members = scratch.keep(keyed.join(_grouped(keyed), "key"))
    looks = sets.select("same", "sketch")
    pairs = members.where("same <> hub").select("same", "hub").distinct()
    pairs = pairs.join(looks, "same").join(looks.select(F.col("same").alias("hub"), F.col("sketch").alias("look")), "hub")
    likely = scratch.keep(pairs.where(F.arrow_udf(_agreeing, "boolean")("sketch", "look")).select("same", "hub"))

    needed = likely.select("same").union(likely.select("hub")).distinct()
    held = scratch.keep(_sets(docs, sets.select("same", "least").join(needed, "same", "left_semi")))
    prints = sets.select("same", "fp")
    mine = held.join(prints, "same")
    a = mine.select("same", F.col("fp").alias("a"), F.col("set").alias("x"))
    b = mine.select(F.col("same").alias("hub"), F.col("fp").alias("b"), F.col("set").alias("y"))
    star = likely.join(a, "same").join(b, "hub").where("a <> b")
    common = F.size(F.array_intersect("x", "y"))
    star = star.where(common * 5 >= (F.size("x") + F.size("y") - common) * 4).select("a", "b")

    roots = scratch.keep(components(first.unionByName(equal).unionByName(star)))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    placed = placed.select("same", "fp", F.coalesce("root", "fp").alias("root"))
    left = scratch.keep(_apart(members.select("key", "n", "same").join(placed.select("same", "root"), "same")))
    scratch.drop(members, likely)
    stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    small = left.where(F.col("n") <= TILE).join(sets.select("same", "size", "sketch"), "same")
    small = small.repartition("key").sortWithinPartitions("key")
    tiles = scratch.keep(small.mapInArrow(_promising, "tile long, same long, root long"))
    pool = scratch.keep(left.where(F.col("n") > TILE).select("same", "root").distinct())
    if not pool.isEmpty():
        mass = sets.select("same", "least").join(pool.select("same"), "same", "left_semi")
        cut = _rarely_shared(pool, scratch.keep(_sets(docs, mass)), scratch)
        tiles = scratch.keep(tiles.unionByName(cut))
    if tiles.isEmpty():
        return stars
    asked = sets.select("same", "least", "fp").join(tiles.select("same").distinct(), "same", "left_semi")
    more = scratch.keep(_sets(docs, asked)).join(asked.select("same", "fp"), "same")
    dealt = tiles.join(more, "same").select("tile", "fp", "root", "set").repartition("tile").sortWithinPartitions("tile")
    return stars.unionByName(dealt.mapInArrow(_compared, "a long, b long"))
