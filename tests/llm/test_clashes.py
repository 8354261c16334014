"""Further columns whose names the operators use inside change nothing and stay."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import (
    ball_search, exact_topk, html_text, language, license_scan, mixing, pieces, prefix_trie, secret_scan, simhash,
    token_counts, url_filter, vp_tree,
)

SF = "/root/testdata/sf0.001"
NAMES = (
    "_found _fp _id _size _salt _key _class _at _first first n words part key fp root least same keys sketch place pack dim"
    " ids_ mat q node tile lane own hub base turn path bone ends item tf term copies_ prediction features label _row _rule _method"
).split()


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def both(spark, name, of, apply, kept):
    plain = spark.read.parquet(f"{SF}/{name}.parquet").limit(60)
    more = plain.select("*", *(F.lit(f"own {c}").alias(c) for c in NAMES if c not in plain.columns))
    a, b = apply(plain), apply(more)
    if kept:
        extra = [c for c in NAMES if c not in plain.columns]
        assert set(extra) <= set(b.columns), set(extra) - set(b.columns)
        for c in extra:
            assert b.where(F.col(c).isNull() | (F.col(c) != f"own {c}")).isEmpty()
    assert rows_of(a.select(*of)) == rows_of(b.select(*of))


def secrets(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    return secret_scan.train(secret_scan.identifiers(table).unionByName(secret_scan.random_strings(spark, 500)))


def languages(spark):
    return language.train(spark.read.parquet(f"{SF}/documents.parquet"), language.held_out())


CASES = {
    "secrets": ("documents", ["doc_id", "spans"], lambda s: lambda d: secret_scan.scan(d, secrets(s)), True),
    "redacted": ("documents", ["doc_id", "text"], lambda s: lambda d: secret_scan.redacted(d, secrets(s)), True),
    "language": ("documents", ["doc_id", "lang_pred"], lambda s: lambda d: language.identify(d, languages(s)), True),
    "accepted": ("documents", ["doc_id"], lambda s: lambda d: language.accepted(d, languages(s)), True),
    "mix": ("documents", ["doc_id", "target", "copies"], lambda s: mixing.mix, True),
    "emitted": ("documents", ["doc_id"], lambda s: mixing.emitted, True),
    "licenses": ("documents", ["doc_id", "license"], lambda s: lambda d: license_scan.licenses(d, license_scan.templates(s)), False),
    "groups": ("documents", ["doc_id", "component_id"], lambda s: simhash.near_duplicates, False),
    "kept": ("documents", ["doc_id"], lambda s: lambda d: simhash.kept(d, similar=True), True),
    "kept twice": ("documents", ["doc_id", "text"], lambda s: lambda d: simhash.kept(d.union(d)), True),
    "pieces": ("documents", ["doc_id", "ids"], lambda s: lambda d: pieces.encode(d, pieces.load()), True),
    "counts": ("documents", ["doc_id", "n_tokens"], lambda s: lambda d: token_counts.with_counts(d, token_counts.load()), True),
    "html": ("pages", ["page_id", "text"], lambda s: lambda d: html_text.extract(d, html_text.train()), True),
    "urls": ("pages", ["page_id", "rule", "verdict"], lambda s: lambda d: url_filter.judge(d, url_filter.train(url_filter.by_terms(d)), url_filter.RULES), False),
    "neighbours": ("embeddings", ["query_id", "rank", "vec_id"], lambda s: lambda d: vp_tree.nearest(d, F.col("vec_id") % 20 == 0, k=5), False),
    "top k": ("embeddings", ["query_id", "rank", "vec_id"], lambda s: lambda d: exact_topk.top_k(d, F.col("vec_id") % 20 == 0, k=5), False),
    "trie": ("conversations", prefix_trie.NUMBERS, lambda s: lambda d: prefix_trie.trie(prefix_trie.paths(d)), False),
    "search": ("documents", ["item_id", "rank", "doc_id"], lambda s: lambda d: ball_search.rank(d, s.read.parquet(f"{SF}/benchmark.parquet")), False),
}


@pytest.mark.parametrize("case", CASES)
def test_operator_with_clashing_columns(spark, case):
    name, of, made, kept = CASES[case]
    both(spark, name, of, made(spark), kept)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_with_clashing_columns(spark, stage):
    apply = dict(corpus_pipeline.STAGES)[stage]
    both(spark, "documents", ["doc_id"], lambda d: apply(spark, d, SF), stage != "pieces")
