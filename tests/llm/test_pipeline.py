"""The stages of the pipeline, alone on odd rows and together."""

import pytest

import corpus_pipeline
from barloom.llm import pieces, simhash
from test_pairs import TEXT, plain_groups, plain_near
from test_text import plain_base

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
ODD = [
    (1, "the and of that is in", "en", "a", 21), (1, "the and of that is in", "en", "a", 21), (2, None, None, None, None),
    (3, "", "en", "a", 0), (None, "the of and to", "en", None, 13), (None, None, None, None, None),
    (4, "le la de " * 30_000, "fr", "b", 1), (5, "123 !!", "fr", "b", 6), (6, 'of the token="abcdefghijk" and', "en", "a", 30),
]


def odd(spark):
    return spark.createDataFrame(ODD, TEXT)


@pytest.mark.parametrize("name", STAGES)
def test_stages_take_odd_and_empty_tables(spark, name):
    for docs in (odd(spark), odd(spark).limit(0)):
        out = STAGES[name](spark, docs, SF)
        rows = out.collect()
        if name != "pieces":
            assert out.columns == docs.columns
        if name in ("secrets", "pieces"):
            assert len(rows) == docs.count()


def test_language_stage_keeps_texts_with_letters(spark):
    kept = STAGES["language"](spark, odd(spark), SF).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 1, 4, 6]


def test_stages_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = STAGES["language"](spark, docs, SF)
    assert kept.count() >= 0.98 * len(texts)
    ids = sorted(texts)
    groups = plain_near([texts[i] for i in ids])
    least = {}
    for i, g in zip(ids, groups):
        least.setdefault(g, i)
    assert sorted(r.doc_id for r in STAGES["near_duplicates"](spark, docs, SF).collect()) == sorted(least.values())
    clean = STAGES["secrets"](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in clean) == ids
    for row in clean:
        if not plain_base(texts[row.doc_id]):
            assert row.text == texts[row.doc_id]
        assert not plain_base(row.text) and row.n_chars == len(row.text)


def test_the_whole_run(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == ["doc_id", "source", "lang", "ids", "n_ids"] and rows
    model = pieces.load()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {}
    for row in rows:
        text = pieces.decode_ids(row.ids, model)
        assert row.n_ids == len(row.ids) and (text == texts[row.doc_id] or "[SECRET]" in text)
        kept[row.doc_id] = kept.get(row.doc_id, 0) + 1
    assert max(kept.values()) <= 3
    prints = [simhash.fingerprint(texts[i]) for i in kept]
    assert len(set(plain_groups(prints))) == len(prints)
