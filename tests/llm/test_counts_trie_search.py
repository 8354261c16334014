"""Token counts, the prefix trie and ranked search against the library and plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import ball_search, prefix_trie, token_counts
from barloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# Token counts


@pytest.fixture(scope="module")
def model():
    return token_counts.load()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.path())


def by_library(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts(n=600):
    draw = random.Random(5)
    few = [*"aAbBsStTrRveLlMdD'm 12²½_-!\t\n\x1c\x85\xa0", "́", "̀", "İ", "ı", "Σ", "ς", "ß", "é", "一", "ก", "😀", "\U0001fadf"]
    few += ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "'s", "'re", "Ⅷ", "Ᲊ"]
    texts = ["".join(draw.choice(few) for _ in range(draw.randint(0, 40))) for _ in range(n)]
    wide = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    return texts + ["".join(draw.choice(wide) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_counts_are_the_librarys(spark, model, library):
    texts = [None, "", " ", "a", "x" * 5000, "ab " * 200_000, "é" * 300_000, *odd_texts()]
    rows = [(i, t, 9, "kept") for i, t in enumerate(texts)] + [(0, "again", 1, "kept")]
    got = token_counts.with_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, _x string"), model, limit=30)
    assert got.columns == ["doc_id", "text", "_x", "n_bytes", "n_tokens", "over_limit"]
    found = [(r.text, r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()]
    want = by_library(library, [f[0] for f in found])
    assert [f[2] for f in found] == want
    assert [f[1] for f in found] == [len((f[0] or "").encode()) for f in found]
    assert [f[3] for f in found] == [n > 30 for n in want]
    assert len(found) == len(rows)


def test_counts_of_the_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(zip(texts, by_library(library, texts.values())))
    got = QUERIES["op11_tokens"](spark, SF)
    assert got.columns[:4] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: r.n_tokens for r in got.collect()} == want


def test_counts_of_an_empty_table(spark, model):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.with_counts(none, model).count() == 0


def plain_merged(symbols, ranks, made):
    """The lowest, then leftmost pair is merged, found by going over the whole word each time."""
    while True:
        pairs = [(ranks[a << 20 | b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a << 20 | b in ranks]
        if not pairs:
            return len(symbols)
        rank, i = min(pairs)
        symbols = symbols[:i] + [made[rank]] + symbols[i + 2 :]


def test_heap_merges_as_the_plain_loop():
    draw = random.Random(2)
    for _ in range(300):
        pairs = [(a, b) for a in range(12) for b in range(12)]
        chosen = draw.sample(pairs, 20)
        ranks = {a << 20 | b: r for r, (a, b) in enumerate(chosen)}
        made = [draw.randrange(12) for _ in chosen]
        word = [draw.randrange(4) for _ in range(draw.randint(2, 30))]
        assert token_counts.merged(list(word), ranks, made) == plain_merged(word, ranks, made)


def test_texts_are_cut_into_slices_without_a_trace(model, library, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE", 7)
    counter = token_counts.Counter(model)
    texts = odd_texts(200)
    assert [counter.of_text(t) for t in texts] == by_library(library, texts)


def test_another_kind_of_model_is_refused(tmp_path):
    import json

    parts = json.loads(open(token_counts.path(), encoding="utf-8").read())
    parts["normalizer"]["normalizers"].pop()
    (tmp_path / "m.json").write_text(json.dumps(parts))
    with pytest.raises(ValueError):
        token_counts.load(str(tmp_path / "m.json"))


# The prefix trie


def plain_trie(rows):
    """Nodes of the rebuilt conversations, from (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + t[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = Counter(), Counter()
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found_trie(frame):
    return sorted(tuple(-1 if v is None else v for v in r) for r in frame.collect())


TURNS = "conv_id long, turn long, role string, text string"


def conversations(draw, n, alike):
    rows = []
    for c in range(n):
        if draw.random() < alike:
            rows += [(c, t, "user", f"same words {t}") for t in range(4)]
            continue
        c = draw.choice([c, c, -c, c + 1000])
        for t in range(draw.randint(0, 5)):
            role = draw.choice(["user", "user", "bot", None])
            rows.append((c, draw.choice([t, t, None]), role, draw.choice(["a b", "a\tb ", "", None, "\xa0 é x"])))
    draw.shuffle(rows)
    # The order of equal turns is that of digests, which the plain version does not know.
    seen, kept = {}, []
    for row in rows:
        if seen.setdefault(row[:2], row) == row:
            kept.append(row)
    return kept


@pytest.mark.parametrize("seed, n, alike, ranges", [(1, 60, 0.0, 1), (2, 150, 0.5, 7), (3, 200, 0.9, 16), (4, 40, 0.2, 64)])
def test_trie_is_that_of_all_prefixes(spark, seed, n, alike, ranges, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = conversations(random.Random(seed), n, alike)
    frame = spark.createDataFrame(rows, TURNS).withColumn("path", F.lit(1)).withColumn("bone", F.lit(2))
    assert found_trie(prefix_trie.trie(prefix_trie.paths(frame), ranges)) == plain_trie(rows)


def test_trie_with_short_splitters(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON", 16)  # two turns a splitter
    rows = [(c, t, "u", f"{min(t, 4)} {c % 3 if t == 5 else 0}") for c in range(90) for t in range(6)]
    assert found_trie(prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(rows, TURNS)), 8)) == plain_trie(rows)


def test_trie_of_odd_tables(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(prefix_trie.paths(empty)).count() == 0
    rows = [(None, 1, "u", "lost"), (7, None, None, None), (7, None, None, None), (7, 3, "u", "x")]
    assert found_trie(prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(rows, TURNS)))) == plain_trie(rows)
    # Repeated turns stay; equal turns that differ go in one order in every conversation.
    twins = [(c, 1, "u", t) for c in (20, 21) for t in ("x", "y", "z")]
    nodes = prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(twins, TURNS))).collect()
    assert max(r.depth for r in nodes) == 3 and all(r.n_convs == 2 for r in nodes)


def test_trie_of_one_very_long_conversation(spark):
    rows = [(3, t, "u", str(t)) for t in range(5000)]
    nodes = prefix_trie.trie(prefix_trie.paths(spark.createDataFrame(rows, TURNS)), 8)
    h = zlib.crc32(b"3") % 4
    assert nodes.count() == 5000 - h + 1
    assert nodes.agg(F.max("depth"), F.max("n_children")).first() == (5000 - h, 1)


def test_skeleton_is_small_and_shards_do_the_rest(spark):
    rows = conversations(random.Random(9), 300, 0.3)
    paths = prefix_trie.paths(spark.createDataFrame(rows, TURNS)).cache()
    places = prefix_trie.splitters(paths, 8)
    assert 1 <= len(places) <= 7
    skeleton = prefix_trie.Skeleton(places)
    assert len(skeleton.parent) <= 1 + sum(len(p) for p, _ in places)
    paths.unpersist()


# Ranked search


def plain_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_ranks(docs, items, k):
    own = [(i, plain_terms(t)) for i, t in docs]
    own = [(i, t, Counter(t)) for i, t in own if t]
    n_docs, length = len(own), sum(len(t) for _, t, _ in own)
    df = Counter(t for _, _, c in own for t in c)
    out = []
    for at, (item_id, text) in enumerate(items):
        scores = []
        for i, t, c in own:
            m = 100 - 75 + (75 * len(t) * n_docs) // length
            score = 0
            for term in plain_terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item_id, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found_ranks(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(draw, n):
    words = [f"w{i}" for i in range(60)] + ["Ä", "é1", "İx", "A-b", "a\x00b", "x_y", "Z\x85z", "\xa0"]
    texts = [" ".join(draw.choice(words[: draw.choice([5, 20, 68])]) for _ in range(draw.choice([0, 1, 3, 8, 40]))) for _ in range(n)]
    return [(draw.choice([i, i, i, 3, None]), draw.choice([t, t, t, None, texts[0]])) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, k, leaf, shard, block", [(1, 10, 48, 8192, 10**6), (2, 3, 2, 50, 30), (3, 400, 4, 7, 1)])
def test_ranks_are_those_of_all_scores(spark, seed, k, leaf, shard, block, monkeypatch):
    for name, value in (("LEAF", leaf), ("SHARD", shard), ("BLOCK", block)):
        monkeypatch.setattr(ball_search, name, value)
    draw = random.Random(seed)
    docs = corpus(draw, 300)
    items = [(1, "w1 W1 w2 a"), (2, None), (3, ""), (4, "unheard of"), (5, docs[7][1]), (5, "w3"), (None, "é1 ÄÄ Ä w50 w50")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("item_id", F.lit("x"))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    assert found_ranks(ball_search.rank(rows.repartition(3), asked, k)) == plain_ranks(docs, items, k)


def test_ranks_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ball_search.rank(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert ball_search.rank(docs, items.where("false")).count() == 0
    assert found_ranks(ball_search.rank(docs, items)) == plain_ranks([(1, "a")], [(1, "a")], 10)


def made_tree(draw, n, topics):
    """Rows of 9 or 10 of a topic's 10 terms, with like values; few rows take a term of another topic."""
    rows = []
    for _ in range(n):
        topic = draw.randrange(topics)
        row = set(draw.sample(range(10 * topic, 10 * topic + 10), draw.randint(9, 10)))
        rows.append(sorted(row | ({draw.randrange(10 * topics)} if draw.random() < 0.1 else set())))
    sizes = np.array([len(r) for r in rows])
    term = np.array([t for r in rows for t in r])
    value = np.array([draw.randrange(500_000, 600_000) for _ in term])
    weight = np.array([draw.randrange(0, 30_000) for _ in range(10 * topics)])
    return rows, sizes, term, value, weight


def test_tree_prunes_and_stays_exact(monkeypatch):
    monkeypatch.setattr(ball_search, "LEAF", 16)
    draw = random.Random(3)
    rows, sizes, term, value, weight = made_tree(draw, 3000, 40)
    tree = ball_search.Tree(list(range(len(rows))), sizes, term, value, weight)
    starts = np.cumsum(sizes) - sizes
    scored = 0
    for _ in range(40):
        asked = np.array(sorted(draw.sample(rows, 1)[0]))
        count = np.array([draw.randrange(1, 4) for _ in asked])
        gain = dict(zip(asked.tolist(), (weight[asked] * count).tolist()))
        pairs = [zip(term[s : s + n].tolist(), value[s : s + n].tolist()) for s, n in zip(starts, sizes)]
        scores = [sum(gain.get(t, 0) * v for t, v in row) for row in pairs]
        best = []
        scored += tree.search(asked, count, weight[asked], 5, best)
        want = sorted(((s, True, -i) for i, s in enumerate(scores) if s > 0), reverse=True)[:5]
        assert sorted(best, reverse=True) == want
    assert scored < 0.7 * 40 * len(rows)


def test_bounds_hold_all_rows_of_a_subtree():
    draw = random.Random(4)
    rows, sizes, term, value, weight = made_tree(draw, 500, 6)
    kept = {}
    whole = ball_search.Tree._lay_out

    def spy(self, ids, values):
        kept.update(scaled=self.scaled, begin=self.begin, term=self.term, centres=self.centres, radius=self.radius)
        whole(self, ids, values)

    ball_search.Tree._lay_out = spy
    try:
        tree = ball_search.Tree(list(range(len(rows))), sizes, term, value, weight)
    finally:
        ball_search.Tree._lay_out = whole
    for (a, b, _, _), (some, at), radius in zip(tree.parts, kept["centres"], kept["radius"]):
        centre = np.zeros(tree.size)
        centre[some] = at
        for i in tree.ids[a:b]:
            row = np.zeros(tree.size)
            here = slice(kept["begin"][i], kept["begin"][i] + sizes[i])
            row[kept["term"][here]] = kept["scaled"][here]
            assert np.linalg.norm(row - centre) <= radius
