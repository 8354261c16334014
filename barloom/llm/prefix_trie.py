"""The prefix trie of conversations, by a skeleton of range splitters.

A conversation is one row: the digests of its turns in order, its path. Splitters
cut all conversations, sorted by path and id, into ranges of about equal work. The
prefixes of the splitters form a small trie, the skeleton, which every task gets.
The members of any node outside the skeleton lie in one range, because a splitter
between two members would begin with the node's path. So each range, sorted, is
walked once with a stack of the open nodes, and finishes all nodes but those of the
skeleton; of these it gives partial aggregates, which are reduced and then added up
from the leaves of the skeleton to its root.

A range is cut by id among equal paths, so copies of one conversation may fill many
ranges. Ends of a skeleton node are kept in pieces of ids, hashed in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import settled, spread

#: Nodes of the skeleton at most; sampled conversations per range; ids in a piece of ends.
SKELETON, SAMPLED, PIECE = 100_000, 16, 8192
#: What a row of the walk is: a finished node, one below the skeleton, a part of a skeleton node, a piece of its ends.
NODE, BELOW, PART, ENDS = range(4)
NUMBERS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
WALK = pa.schema(
    [("kind", pa.int32()), ("bone", pa.int32()), *((n, pa.int64()) for n in NUMBERS), ("words", pa.int64()), ("ends", pa.binary())]
)
WALK_SQL = "kind int, bone int, " + ", ".join(f"{n} long" for n in NUMBERS) + ", words long, ends binary"
LOWEST = -(1 << 63)


def paths(conversations: DataFrame, shared: int = 20) -> DataFrame:
    """(conv_id, path, words) of every conversation as it is rebuilt.

    Conversation c takes the first h turns of conversation c - c % shared, then its own
    after its first h; h is the CRC-32 of c in decimals, modulo 4. Turns go by `turn`, null
    first; equal ones by a digest of role and text. Null roles and texts count as empty;
    rows without conv_id belong to no conversation. Repeated rows are turns of their own.
    A path holds 16 bytes of SHA-256 a turn, `words` the word count of each turn's text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(mark, 256)), 1, 16)
    n_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    turn = F.struct("turn", digest.alias("digest"), n_words.alias("words")).alias("turn")
    c = F.col("conv_id").cast("long")
    rows = conversations.where(c.isNotNull()).select((c - c % shared).alias("base"), c.alias("conv_id"), turn)
    # By base at once: the groups and both sides of the join are then where they are needed.
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    heads = own.where("base = conv_id").select("base", F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.size("turns"))
    whole = own.join(heads, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"))
    return whole.select("conv_id", F.col("turns.digest").alias("path"), F.col("turns.words").alias("words"))


def splitters(rows: DataFrame, ranges: int) -> list[tuple[list[bytes], int]]:
    """Up to ranges - 1 places (path, conv_id) that cut the rows into ranges of like size.

    From a sample by a hash of the id, about SAMPLED rows a range, weighed by turns. A path
    longer than its share of SKELETON is cut short and stands before all that begin with it.
    """
    deep = max(1, SKELETON // ranges)
    total = rows.count()
    drawn = rows.where(spread(F.col("conv_id"), "splitters") < min(1.0, SAMPLED * ranges / max(total, 1)))
    cut = drawn.select("conv_id", F.slice("path", 1, deep).alias("path"), F.size("path").alias("n"))
    sample = sorted(([bytes(d) for d in r["path"]], r["conv_id"] if r["n"] <= deep else LOWEST, r["n"] + 1) for r in cut.collect())
    whole, seen, found = sum(n for _, _, n in sample), 0, []
    for path, conv_id, n in sample:
        if seen * ranges >= (len(found) + 1) * whole and (path, conv_id) not in found[-1:]:
            found.append((path, conv_id))
        seen += n
    return found


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, parents come before children."""

    def __init__(self, places: list[tuple[list[bytes], int]]):
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.depth = [-1], [0]
        for path, _ in places:
            at = 0
            for digest in path:
                if (at, digest) not in self.child:
                    self.child[at, digest] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = self.child[at, digest]


class Open:
    """A node whose members are being read."""

    __slots__ = ("bone", "words", "least", "convs", "children", "leaves", "saved", "sha", "ids", "wait")

    def __init__(self, bone: int, words: int):
        self.bone, self.words, self.least = bone, words, None
        self.convs = self.children = self.leaves = self.saved = 0
        self.sha = None  # of the ends so far
        self.ids: list[int] = []  # ends not yet put out, of skeleton nodes
        self.wait: list[tuple] = []  # finished children, until the smallest member is known

    def end(self, conv_id: int) -> None:
        self.convs += 1
        self.least = conv_id if self.least is None else min(self.least, conv_id)
        if self.bone >= 0:
            self.ids.append(conv_id)
        elif self.sha is None:
            self.sha = hashlib.sha256(b"%d" % conv_id)
        else:
            self.sha.update(b",%d" % conv_id)


def _piece(node: Open) -> tuple:
    """Ends of a skeleton node; conv_id is the first, by which pieces are put in order."""
    row = (ENDS, node.bone, node.ids[0], *[None] * 7, ",".join(map(str, node.ids)).encode())
    node.ids = []
    return row


def walk(rows: Iterator[tuple[list[bytes], list[int], int]], skeleton: Skeleton) -> Iterator[tuple]:
    """The rows of WALK of one range, given sorted by path and id."""
    stack, last = [Open(0, 0)], []

    def closed() -> Iterator[tuple]:
        node, depth = stack.pop(), len(stack)
        if node.bone >= 0:
            if node.ids:
                yield _piece(node)
            numbers = (node.least, depth, None, node.convs, node.children, node.leaves, node.saved)
            yield (PART, node.bone, *numbers, node.words, None)
            return
        for row in node.wait:
            yield (NODE, None, row[0], row[1], node.least, *row[2:])
        node.leaves = node.leaves or 1
        node.saved += (node.convs - 1) * node.words
        ends = node.sha.digest() if node.sha else None
        row = (node.least, depth, node.convs, node.children, node.leaves, node.saved, None, ends)
        above = stack[-1]
        above.convs += node.convs
        above.least = node.least if above.least is None else min(above.least, node.least)
        above.children += 1
        above.leaves += node.leaves
        above.saved += node.saved
        if above.bone >= 0:
            yield (BELOW, above.bone, row[0], row[1], None, *row[2:])
        else:
            above.wait.append(row)

    some = False
    for path, words, conv_id in rows:
        some = True
        same = 0
        for a, b in zip(path, last):
            if a != b:
                break
            same += 1
        while len(stack) > same + 1:
            yield from closed()
        for at in range(same, len(path)):
            above = stack[-1].bone
            stack.append(Open(skeleton.child.get((above, path[at]), -1) if above >= 0 else -1, words[at]))
        stack[-1].end(conv_id)
        if len(stack[-1].ids) >= PIECE:
            yield _piece(stack[-1])
        last = path
    while some and stack:
        yield from closed()


def _batches(rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), WALK)], schema=WALK)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), WALK)], schema=WALK)


def hashed(pieces: DataFrame) -> DataFrame:
    """(bone, ends): the SHA-256 of the ids of each skeleton node, from its pieces in order.

    A hash is a chain, so a node's ids go through one task; they stream through it piece by piece.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, done = None, None, []
        for part in parts:
            for bone, ends in zip(part.column("bone").to_pylist(), part.column("ends").to_pylist()):
                if bone == at:
                    sha.update(b"," + ends)
                    continue
                if sha:
                    done.append((at, sha.digest()))
                at, sha = bone, hashlib.sha256(ends)
        if sha:
            done.append((at, sha.digest()))
        yield pa.RecordBatch.from_pydict({"bone": pa.array([d[0] for d in done], pa.int32()), "ends": pa.array([d[1] for d in done], pa.binary())})

    ordered = pieces.repartition("bone").sortWithinPartitions("bone", "conv_id")
    return ordered.select("bone", "ends").mapInArrow(batches, "bone int, ends binary")


def reduced(walked: DataFrame, skeleton: Skeleton) -> list[tuple]:
    """(bone, the numbers of a node, ends) of every skeleton node that has members.

    The parts are summed by Spark; what comes to the driver is one row a skeleton node.
    """
    sums = [F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = walked.where(F.col("kind") == PART).groupBy("bone")
    rows = parts.agg(F.min("conv_id").alias("conv_id"), F.max("words").alias("words"), *sums).collect()
    ends = {r["bone"]: bytes(r["ends"]) for r in hashed(walked.where(F.col("kind") == ENDS)).collect()}
    size = len(skeleton.parent)
    least, words = [None] * size, [0] * size
    convs, children, leaves, saved = ([0] * size for _ in range(4))
    for r in rows:
        b = r["bone"]
        least[b], words[b] = r["conv_id"], r["words"]
        convs[b], children[b], leaves[b], saved[b] = r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]
    for b in range(size - 1, -1, -1):
        leaves[b] = leaves[b] or 1
        saved[b] += (convs[b] - 1) * words[b]
        if b and convs[b]:
            a = skeleton.parent[b]
            least[a] = least[b] if least[a] is None else min(least[a], least[b])
            convs[a] += convs[b]
            children[a] += 1
            leaves[a] += leaves[b]
            saved[a] += saved[b]
    above = [least[a] if a >= 0 else None for a in skeleton.parent]
    return [
        (b, least[b], skeleton.depth[b], above[b], convs[b], children[b], leaves[b], saved[b], ends.get(b))
        for b in range(size)
        if convs[b]
    ]


def trie(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """The nodes of the trie of rows (conv_id, path, words), one row each.

    conv_id is the smallest member, parent_conv_id that of the node above (null for the root),
    n_convs the members, n_children the children, n_leaves the childless nodes at or below,
    saved_tokens the words that members beyond the first repeat, summed at and below, ends_sha256
    the hash of the comma-joined ids of the conversations that end at the node. A conversation
    without turns ends at the root. No conversations give no nodes. Further columns are not read.
    A conversation is held as one row of 16 bytes a turn; a range is never held as a whole.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = settled(rows.select("conv_id", "path", "words"))
    places = splitters(rows, ranges)
    skeleton = Skeleton(places)

    def number(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for path, conv_id in batches:
            keys = zip(path.to_pylist(), conv_id.to_pylist())
            yield pa.array([bisect_right(places, key) for key in keys], pa.int32())

    def walked_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple[list[bytes], list[int], int]]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("path", "words", "conv_id")))

        return _batches(walk(read(), skeleton))

    number.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    place: Column = F.arrow_udf(number, "int")("path", "conv_id")
    dealt = rows.withColumn("place", place).repartitionById(ranges, "place").sortWithinPartitions("path", "conv_id")
    walked = settled(dealt.select("path", "words", "conv_id").mapInArrow(walked_range, WALK_SQL))
    bones = spark.createDataFrame(
        reduced(walked, skeleton), "bone int, " + ", ".join(f"{n} long" for n in NUMBERS) + ", ends binary"
    )
    known = F.broadcast(bones.select("bone", F.col("conv_id").alias("above")))  # at most SKELETON rows
    local = walked.where(F.col("kind").isin(NODE, BELOW)).join(known, "bone", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    nodes = local.select(*NUMBERS, "ends").unionByName(bones.select(*NUMBERS, "ends"))
    ends = F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256))
    return nodes.select(*NUMBERS, ends.alias("ends_sha256"))


SQL = r"""
WITH entries AS (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda a, x: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)
), lookup AS (SELECT list(v ORDER BY i) AS t FROM entries),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]))) % 4 AS h
  FROM own, lookup
), rebuilt AS (
  SELECT c.conv_id, list_concat(CASE WHEN b.conv_id IS NULL THEN [] ELSE list_slice(b.turns, 1, c.h) END,
                                list_slice(c.turns, c.h + 1, len(c.turns))) AS p
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), steps AS (
  SELECT conv_id, p, unnest(range(CAST(len(p) + 1 AS BIGINT))) AS d FROM rebuilt
), nodes AS (
  SELECT list_slice(p, 1, d) AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(p) = d), '') AS ends
  FROM steps GROUP BY 1, 2
), sized AS (
  SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND list_slice(k.node, 1, n.d) = n.node) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.node[n.d].t, '[^\x20\x09-\x0D]+')) END AS own
  FROM nodes n
), ups AS (SELECT list_slice(node, 1, up) AS top, own, n_children = 0 AS leaf FROM (SELECT *, unnest(range(d + 1)) AS up FROM sized)),
sums AS (SELECT top, sum(own) AS saved, count(*) FILTER (leaf) AS n_leaves FROM ups GROUP BY top)
SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM sized n JOIN sums s ON s.top = n.node
LEFT JOIN nodes a ON a.d = n.d - 1 AND a.node = list_slice(n.node, 1, n.d - 1)
"""
