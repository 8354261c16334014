"""A corpus from documents: stages that each work on all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import language, mixing, pieces, secret_scan, simhash
from barloom.llm.common import shared_folder, table, with_small_batches
from barloom.llm.queries import secret_ratio


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters or without a leading language go."""
    with_small_batches(spark)
    return language.accepted(docs, language.train(docs, language.held_out()))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near SimHashes or of a shingle similarity of 0.8 or more."""
    with_small_batches(spark)
    return simhash.kept(docs, similar=True)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    with_small_batches(spark)
    return secret_scan.redacted(docs, secret_ratio(spark, docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.emitted(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, ids, n_ids) of all documents."""
    with_small_batches(spark)
    whole = pieces.encode(docs.select("doc_id", "source", "lang", "text"), pieces.load())
    return whole.withColumn("n_ids", F.coalesce(F.size("ids"), F.lit(0))).drop("text")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("secrets", without_secrets),
    ("mix", mixed),
    ("pieces", encoded),
]

#: Language codes, fingerprints in Python and tokens are beyond SQL; tests hold stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    root = shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{root}/pipeline-{uuid.uuid4().hex}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
