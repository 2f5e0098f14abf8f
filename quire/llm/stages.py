"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame with the columns of documents, but the last.

All of them take any table with doc_id, text and other columns, whatever those are called, and hand the others on
unchanged. A null text is an empty one to every stage and stays null. Rows without a doc_id, rows that share one and
repeated rows are rows of their own, except where a group of near-equal texts keeps one. Texts of any length are read
whole. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontamination, ngram_jaccard, secret_scan, toxicity
from quire.llm.common import shielded
from quire.sources.shipping import ship


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the clause grammar, fitted on the labels of these documents, takes for toxic. Without
    labels of both kinds the seed words decide; empty texts stay."""
    ship(spark)
    model = toxicity.train(docs, toxicity.labels_of(spark, sf_dir))
    return shielded(docs, ("score", "n_matches", "predicted"), lambda d: toxicity.scored(d, model).where("predicted = 0"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-equal texts: that of the least doc_id (documents without one come last),
    of these the least digest of the text. Empty texts are one group, as equal texts are."""
    ship(spark)
    return ngram_jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of a benchmark item; with an empty benchmark none."""
    ship(spark)
    return decontamination.clean(docs, decontamination.benchmark(spark, sf_dir))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every document, with its secrets replaced by [SECRET]; n_chars follows the text (where that is null it stays)."""
    ship(spark)
    masked = secret_scan.redact(docs)
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and the ids of every document; no tokens for an empty text."""
    ship(spark)
    return bpe.encode_documents(docs, with_ids=True).drop("decoded")
