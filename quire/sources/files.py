"""Small documents under exact names, in whatever store the path names."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file of that name, through Spark's own file systems."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_document(df: DataFrame, path: str) -> None:
    """A bounded, ordered table as one minified JSON array; equal data give equal bytes. Null members are left out."""
    rows = [json.loads(r[0]) for r in df.selectExpr("to_json(struct(*))").collect()]
    write_text(df.sparkSession, path, json.dumps(rows, ensure_ascii=False, separators=(",", ":")))


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished versions (v1, v2 ...) of a table in a folder, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    found = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()]
    return sorted(n for n in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{n}/_SUCCESS")))


def remove(spark: SparkSession, path: str) -> None:
    """A folder with all it holds, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """A file of that name, whole from the moment it is there; False if there is one already."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{target.getParent()}/.{uuid.uuid4().hex}")
    write_text(spark, draft.toString(), text)
    done = not fs.exists(target) and fs.rename(draft, target)
    if not done:
        fs.delete(draft, False)
    return done


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Sets when a file was last changed, where the store keeps such times."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(target, millis, -1)


def rename_only(spark: SparkSession, folder: str, path: str) -> None:
    """The only data file of a folder that Spark wrote becomes a file of that name; the folder goes."""
    (name,) = [n for n in names(spark, folder) if n.startswith("part-")]
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (f"{folder}/{name}", path))
    source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target)
    remove(spark, folder)
