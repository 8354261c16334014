"""SimHash groups, vector search, mixing and pieces against plain versions and small odd inputs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import exact_topk, mixing, pieces, simhash, vp_tree
from barloom.llm import vectors as vector_packs

TEXT = "doc_id long, text string, lang string, source string, n_chars long"
VECTOR = "vec_id long, embedding array<double>, label int"


def plain_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints):
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return [top(i) for i in range(len(prints))]


def test_fingerprints():
    for text in ("a", "A B", "one Two  three\tfour\nfive É é", "x y z " * 50, "", None, " \n "):
        assert simhash.fingerprint(text) == plain_print(text)


def walk(seed, n, far=2):
    """Fingerprints in clusters that chain and crowd."""
    draw = random.Random(seed)
    out = []
    while len(out) < n:
        x = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 2, 5, 60])):
            out.append(x)
            for _ in range(draw.randint(0, far + 2)):
                x ^= 1 << draw.randrange(64)
    return list(dict.fromkeys(out))[:n]


@pytest.mark.parametrize("tile", [2048, 8])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "LOOK", 1)
    prints = walk(3, 700)
    want = plain_groups(prints)
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    fps = spark.createDataFrame(signed, "fp long").repartition(5)
    roots = {r.node: r.root for r in simhash.components(simhash.links(fps)).collect()}
    got = [roots.get(s, s) for (s,) in signed]
    assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))


def test_long_chains_are_one_component(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001), (5000, 5000)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and got[1000] == got[1001] != got[0]


def test_groups_and_kept_rows(spark):
    long = " ".join(f"w{i}" for i in range(400))
    texts = [
        (5, long), (3, long), (9, long + " tail"), (7, "other words here"), (1, None), (2, ""), (4, " \n"),
        (None, long), (None, "alone without an id"), (None, "alone without an id"), (7, "other words here"), (8, "a"),
    ]
    table = spark.createDataFrame([(i, t, "en", None, 1) for i, t in texts], TEXT).withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(table)
    assert got.count() == len(texts)
    of = {(r.doc_id, r.fp): r.component_id for r in got.collect()}
    prints = [plain_print(t) for _, t in texts]
    for (i, _), p, g in zip(texts, prints, plain_groups(prints)):
        ids = [j for (j, _), h in zip(texts, plain_groups(prints)) if h == g and j is not None]
        assert of[(i, int(np.uint64(p).astype(np.int64)))] == (min(ids) if ids else None)
    kept = simhash.kept(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 3), (False, 7), (False, 8), (True, 0)
    ]
    assert simhash.near_duplicates(table.limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], VECTOR)


def plain_top(rows, every, k, score, keep):
    good = [(i, v) for i, v in rows if keep(i, v)]
    out = {}
    for q, a in good:
        if q % every == 0:
            best = sorted((-score(a, b), i) for i, b in good if i != q and len(b) == len(a))
            out[q] = [(i, -s) for s, i in best[:k]]
    return out


def listed(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def odd_rows(seed):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(size=6).round(2).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # copies
    rows += [(400, None), (401, [0.0] * 6), (402, [1.0, None] + [0.0] * 4), (403, [float("nan")] * 6), (404, [float("inf")] * 6)]
    rows += [(405, []), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (None, [1.0] * 6)]
    return [(i, v) for i, v in rows]


def usable(i, v):
    return i is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


def test_exact_top_k(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "SHARD", 37)
    monkeypatch.setattr(exact_topk, "QUERIES", 4)
    rows = odd_rows(1)
    steps = lambda a, b: int(sum(np.floor(1024 * np.array(a)) * np.floor(1024 * np.array(b))))
    want = plain_top(rows, 10, 5, steps, usable)
    got = listed(exact_topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=5))
    assert got == {q: v for q, v in want.items() if v}
    assert exact_topk.top_k(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    far = [(0, [1e6, 1e6]), (1, [1e6, 1.0]), (2, [1e12, 1e12])]
    assert [i for i, _ in listed(exact_topk.top_k(vectors(spark, far), F.col("vec_id") == 0))[0]] == [2, 1]


def test_trees_with_factor_one_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vp_tree, "SHARD", 90)
    monkeypatch.setattr(vp_tree, "LEAF", 8)
    rows = odd_rows(2)
    inner = lambda a, b: float(np.dot(a, b))
    want = plain_top(rows, 20, 7, lambda a, b: round(inner(a, b), 9), lambda i, v: usable(i, v) and any(v))
    got = listed(vp_tree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7, factor=1.0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    for q, found in got.items():
        assert np.allclose([s for _, s in found], [s for _, s in want[q]])


def test_recall_of_the_registered_search(spark):
    from barloom.llm.queries import QUERIES

    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    mat, ids = np.array(table.embedding.tolist(), float), table.vec_id.to_numpy()
    got = QUERIES["op2_neighbours"](spark, "/root/testdata/sf0.1").toPandas().groupby("query_id").vec_id.apply(set)
    hits = 0
    for q, found in got.items():
        scores = mat @ mat[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(found & set(ids[np.lexsort((ids, -scores))[:20]]))
    assert len(got) == (ids % 20 == 0).sum() and hits / (20 * len(got)) >= 0.95


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.discard(s)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix(spark, seed):
    draw = random.Random(seed)
    sources = [None, "a", "b", "B", "é", "tiny", "empty"]
    rows = []
    for i in range(1500):
        source = draw.choices(sources, [5, 50, 20, 10, 5, 1, 1])[0]
        n = 0 if source == "empty" else draw.choice([1, 5, 5, 40, 300])
        rows.append((i, None if n == 0 and i % 2 else "w " * n, "en", source, 1))
    rows += [(None, "no id", "en", "a", 1)] + [rows[7]] * 5
    table = spark.createDataFrame(rows, TEXT).withColumn("size", F.lit("clash"))
    got = mixing.mix(table).collect()
    again = mixing.mix(table.repartition(7)).collect()
    keys = lambda found: sorted((r.doc_id or -1, r.source or "", r.copies) for r in found)
    assert keys(got) == keys(again) and len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = plain_targets(sizes)
    for source in sizes:
        own = [r for r in got if r.source == source]
        assert own[0].source_size == sizes[source] and own[0].target == pytest.approx(want[source])
        assert all(0 <= r.copies <= 3 for r in own)
        assert abs(sum(r.copies * r.size for r in own) - want[source]) <= max(900, 0.05 * want[source])
    assert mixing.emitted(table).count() == sum(r.copies for r in got)
    assert mixing.mix(table.limit(0)).count() == 0


ODD = [
    "", None, "   ", "  a", "a  ", "日本語 emoji 😀 \x00 z", "a\tb\nc    d" + " " * 40 + "e", "x" * 5000, "= " * 30, "<s></s>",
    "﷽ ﷽", " " * 17, "ééé\u0301 ß", "plain words here", "plain words here",
]


def test_pieces_are_the_librarys(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    table = spark.createDataFrame([(i, t, "en", None, 1) for i, t in enumerate(ODD)], TEXT).withColumn("ids", F.lit("clash"))
    model = pieces.load()
    rows = pieces.decode(pieces.encode(table, model), model).orderBy("doc_id").collect()
    for row in rows:
        assert row.decoded == row.text
        assert row.ids == (None if row.text is None else library.encode(row.text))
    assert pieces.encode(table.limit(0), model).count() == 0


def test_long_stretches_are_merged_as_the_library_does():
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    model, draw = pieces.load(), random.Random(3)
    encoder, decoder = pieces.Encoder(model), pieces.Decoder(model)
    texts = [None, "short one", ""]
    for letters in ("abcdefgh", "aé一x\0", "abcABC0123+/", "the andingtion"):
        texts += ["".join(draw.choice(letters) for _ in range(n)) for n in (pieces.LONG - 1, pieces.LONG, 3000, 50_000)]
    texts += [t + " end" for t in texts[3:6]]
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [library.encode(t or "") for t in texts]
    assert decoder.texts(ids, counts) == [t or "" for t in texts]
    broken = np.array([*model.byte_ids[0xC3:0xC5], ids[0]])
    assert decoder.texts(broken, np.array([1, 2])) == [pieces.decode_ids(broken[:1], model), pieces.decode_ids(broken[1:], model)]


def test_pieces_of_whole_texts(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for row in pieces.encode(table, pieces.load()).collect():
        assert row.ids == library.encode(row.text)



def plain_near(texts):
    """Groups of texts by either rule: three bits, or a similarity of 0.8 of the sets of five words."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else {"blank"} for t in texts]
    prints, group = [plain_print(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            near = len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4 or (prints[i] ^ prints[j]).bit_count() <= 3
            if near and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def test_kept_reaches_a_shingle_similarity(spark, monkeypatch):
    from barloom.llm import shingles

    monkeypatch.setattr(shingles, "TILE", 3)
    draw = random.Random(4)
    texts = []
    for _ in range(20):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.randint(60, 400))]
        texts.append(" ".join(words))
        for _ in range(draw.choice([0, 1, 2, 6])):  # chains of edits around the threshold
            words = [f"n{draw.randrange(4000)}" if draw.random() < draw.choice([0.01, 0.02, 0.03]) else w for w in words]
            texts.append(" ".join(words))
    texts += [None, "", "a b", "A  b", "x y z x y z x y z x y z", "x y z x y z x y z x y z " * 9]
    group, prints = plain_near(texts), [plain_print(t) for t in texts]
    least = {}
    for i, g in enumerate(group):
        least.setdefault(g, i)
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], TEXT)
    assert sorted(r.doc_id for r in simhash.kept(table, similar=True).collect()) == sorted(least.values())
    assert len(least) < len(set(plain_groups(prints)))


def test_kept_goes_by_row_where_ids_repeat(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "uv")
    rows = [(1, one), (2, one), (1, two), (3, two), (4, "alone it is"), (4, two)]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], TEXT)
    assert sorted((r.doc_id, r.text) for r in simhash.kept(table).collect()) == [(1, one), (1, two), (4, "alone it is")]


def test_unlinked_texts_of_one_boilerplate_do_not_meet_in_pairs(spark):
    """5,000 texts with 70 % in common: none links, and rare shingles let none of them meet."""
    from barloom.llm import shingles
    from barloom.llm.common import Scratch

    plate = [f"b{i}" for i in range(280)]
    texts = [" ".join(plate + [f"t{i}x{j}" for j in range(60)]) for i in range(5000)]
    texts[4321] = texts[1234] + " end"  # one true pair among them
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], TEXT).repartition(8).cache()
    kept = simhash.kept(table, similar=True)
    gone = {r.doc_id for r in table.select("doc_id").subtract(kept.select("doc_id")).collect()}
    prints = [simhash.fingerprint(t) for t in texts]
    near = plain_groups(prints)
    assert 4321 in gone and all(near[i] != i or i == 4321 for i in gone)

    sets = table.select(shingles._whole().alias("s")).select("s.*").limit(2000)
    met = shingles._rarely_shared(sets.select("same", F.col("same").alias("root")), sets, Scratch(spark))
    assert met.count() <= 4
    table.unpersist()


def test_components_of_paths_and_hubs(spark):
    draw = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, j) for j in range(1001, 1500)]
    edges += [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(250)] + [(-5, 7), (9, 9)]
    draw.shuffle(edges)
    names = list(range(-5, 2300))
    draw.shuffle(names)
    edges = [(names[a], names[b]) for a, b in edges]
    group = {x: x for e in edges for x in e}
    for a, b in edges:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        if old != new:
            group = {k: new if v == old else v for k, v in group.items()}
    got = simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(8)).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got} == {k: v for k, v in group.items() if k in linked}
    assert len(got) == len(linked)


def test_crowds_of_tied_neighbours_go_by_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(vp_tree, "SHARD", 300)
    draw = np.random.default_rng(3)
    vectors = draw.choice([-1.0, 1.0], (1024, 12))
    ids = draw.permutation(1024)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = vp_tree.nearest(table, F.col("vec_id") % 50 == 0, k=20, factor=1.0).collect()
    by_id = dict(zip(ids.tolist(), vectors))
    for q in range(0, 1024, 50):
        want = sorted((-float(by_id[q] @ v), i) for i, v in by_id.items() if i != q)[:20]
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [(i, -s) for s, i in want]


def test_top_k_is_exact_beyond_doubles(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "SHARD", 20)
    draw = random.Random(5)
    vectors = [[draw.choice([1e9, -1e9, 0.5, 2.0**40 + 0.25, 1 / 1024]) + draw.randrange(1000) / 1024 for _ in range(3)] for _ in range(90)]
    vectors += [[1e306, 0.0, 1.0], [-1e306, 0.0, 1.0], [1.7e308, 1.7e308, 1.7e308], [0.0, 0.0, 0.0]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    most, limit = int(np.finfo(float).max), (1 << 63) - 1
    whole = [[max(-most, min(most, int(np.floor(x * 1024)) if abs(x) < 1e305 else int(np.sign(x)) * most)) for x in v] for v in vectors]
    got = exact_topk.top_k(table, F.col("vec_id") % 10 == 0, k=10).collect()
    assert dict(exact_topk.top_k(table, F.lit(True)).dtypes)["score"] == "bigint"
    seen = 0
    for q in range(0, len(vectors), 10):
        scores = [max(-limit - 1, min(limit, sum(a * b for a, b in zip(whole[q], v)))) for v in whole]
        want = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:10]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [(r.vec_id, r.score) for r in own] == [(i, -s) for s, i in want]
        seen += sum(abs(r.score) > 1 << 53 for r in own)
    assert seen > 20


def test_a_pack_is_indexed_once_for_all_queries_of_its_task(spark, monkeypatch):
    draw = np.random.default_rng(8)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(400)]
    good = vector_packs.usable(vectors(spark, rows), True)
    table, queries = vector_packs.packs(good, 50), vector_packs.packs(good.where("vec_id % 5 = 0"), 10)
    assert (table.n, table.size, queries.n) == (8, 400 * 4 * 8, 8)
    cells = vector_packs.laid_out(queries.frame, table.frame, 4, 2)
    parts = cells.withColumn("part", F.spark_partition_id()).groupBy("part").agg(F.count("*").alias("n"), F.count("q").alias("q"), F.countDistinct("cell").alias("cells"))
    assert [(r.n, r.q, r.cells) for r in parts.collect()] == [(2 + 4, 4, 1)] * 8  # two packs of the table, four of queries
    made = []

    def index(ids, mat):
        made.append(len(ids))
        return vp_tree.Shard(ids, mat)

    work = vector_packs.meetings(3, 2, index, vp_tree.meeting(3, 1.0))
    lists = list(work(iter(cells.toArrow().to_batches(max_chunksize=5))))
    assert len(made) == 8 * 2 and sum(made) == 400 * 2  # once for each section
    assert len(lists) == 8 * 4  # a list for each pack of queries and lane


@pytest.mark.parametrize("held, asked", [(1 << 30, 1 << 30), (2000, 700)])
def test_lanes_and_sections_change_no_result(spark, monkeypatch, held, asked):
    monkeypatch.setattr(vector_packs, "HELD", held)
    monkeypatch.setattr(vector_packs, "ASKED", asked)
    for module in (vp_tree, exact_topk):
        monkeypatch.setattr(module, "SHARD", 11)
        monkeypatch.setattr(module, "QUERIES", 3)
    rows = odd_rows(4)
    steps = lambda a, b: int(sum(np.floor(1024 * np.array(a)) * np.floor(1024 * np.array(b))))
    want = plain_top(rows, 10, 5, steps, usable)
    got = listed(exact_topk.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0, k=5))
    assert got == {q: v for q, v in want.items() if v}
    want = plain_top(rows, 20, 7, lambda a, b: round(float(np.dot(a, b)), 9), lambda i, v: usable(i, v) and any(v))
    got = listed(vp_tree.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=7, factor=1.0))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
