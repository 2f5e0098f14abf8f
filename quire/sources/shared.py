"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset a local master (tests) gets a
    temporary one; on a cluster, where executors could not see it, this is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _LOCAL.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="quire-shared-"))


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/quire-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
