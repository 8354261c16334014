"""The corpus operators as queries over the sample tables, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    ball_search,
    exact_topk,
    html_text,
    language,
    license_scan,
    mixing,
    pieces,
    prefix_trie,
    secret_scan,
    simhash,
    token_counts,
    url_filter,
    vp_tree,
)
from barloom.llm.common import table, with_small_batches


def secret_ratio(spark: SparkSession, docs: DataFrame):
    """The models of the secret scan, from random strings and the words of the corpus."""
    samples = secret_scan.identifiers(docs).unionByName(secret_scan.random_strings(spark))
    return secret_scan.train(samples)


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs.select("doc_id", "text"), secret_ratio(spark, docs))
    return found.drop("text")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_tree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, language.held_out())
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.by_terms(pages))
    return url_filter.judge(pages, model, url_filter.RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"), license_scan.templates(spark))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = F.col("size") * F.col("copies")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    return html_text.extract(table(spark, sf_dir, "pages"), html_text.train()).drop("html")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    model = pieces.load()
    back = pieces.decode(pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    same = F.col("text").eqNullSafe(F.col("decoded"))
    return back.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).alias("n_ids"), same.alias("round_trip"))


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_counts(docs, token_counts.load(), limit=2048).drop("text")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.paths(table(spark, sf_dir, "conversations"), shared=20))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_small_batches(spark)
    return ball_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_neighbours": op2_neighbours,
    "op3_language": op3_language,
    "op4_urls": op4_urls,
    "op5_licenses": op5_licenses,
    "op6_mixing": op6_mixing,
    "op7_topk": op7_topk,
    "op8_simhash": op8_simhash,
    "op9_html": op9_html,
    "op10_pieces": op10_pieces,
    "op11_tokens": op11_tokens,
    "op12_trie": op12_trie,
    "op13_search": op13_search,
}

ORACLES = {
    "op5_licenses": license_scan.SQL,
    "op6_mixing": mixing.SQL,
    "op7_topk": """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op12_trie": prefix_trie.SQL,
    "op13_search": ball_search.SQL,
}
