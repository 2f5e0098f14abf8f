"""Corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quire.llm import stages
from quire.sources.shared import shared_dir

STAGES = [
    ("toxicity", stages.reject_toxic),
    ("ngram_jaccard", stages.one_of_each_group),
    ("decontamination", stages.without_benchmark),
    ("secrets", stages.secrets_masked),
    ("bpe", stages.encoded),
]
#: The toxicity model, the signatures and the tokenizer have no SQL; tests hold run() against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
