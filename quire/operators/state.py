"""Refresh queues and merges of what several lookups found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import or_blank, prefix_int
from quire.operators.rows import distinct_first


def ttl_queue(papers: DataFrame, cache: DataFrame, key: str, t: str, order: str, today: int, min_age_days: int, cap: int | None) -> DataFrame:
    """Different keys that are not fresh (checked within min_age_days), never-checked ones first, then the oldest. Without a
    cap all of them, in no order."""
    due = distinct_first(papers, key, order).join(cache.select(key, t), key, "left").where(F.coalesce(F.col(t) <= today - min_age_days, F.lit(True)))
    return due if cap is None else due.orderBy(F.coalesce(t, F.lit(0)), order, key).limit(cap)


def search_queue(papers: DataFrame, cache: DataFrame, key: str, year: str, none: str, version: str, current: int, first_year: int, cap: int | None) -> DataFrame:
    """Papers whose key is cached as not found and was not searched under the current version; unsearched ones first,
    newer years first. Without a cap all of them, in no order."""
    due = papers.join(cache.where(F.coalesce(F.col(none), F.lit(False))).select(key, version), key)
    due = due.where((F.coalesce(version, F.lit(0)) < current) & (prefix_int(F.col(year)) >= first_year))
    return due if cap is None else due.orderBy(F.coalesce(version, F.lit(0)) != 0, prefix_int(F.col(year)).desc(), key).limit(cap)


def counted(oa: Column, s2: Column, oa_done: Column, s2_done: Column, previous: Column, previous_s2: Column | None = None) -> Column:
    """struct(c, s2): the larger count; the second source is named only if strictly larger. A larger earlier count
    survives, with its source, unless both lookups concluded. A count of 0 is null. A lookup that did not conclude has no count."""
    a = F.when(oa_done, F.coalesce(oa, F.lit(0))).otherwise(0)
    b = F.when(s2_done, F.coalesce(s2, F.lit(0))).otherwise(0)
    best = F.greatest(a, b)
    carried = (F.coalesce(previous, F.lit(0)) > best) & ~(oa_done & s2_done)
    source = F.coalesce(previous_s2, F.lit(False)) if previous_s2 is not None else F.lit(False)
    return F.struct(F.nullif(F.when(carried, previous).otherwise(best), F.lit(0)).alias("c"), F.when(carried, source).otherwise(b > a).alias("s2"))


def stamp(found: DataFrame, requested: DataFrame, key: str, answered: Column) -> DataFrame:
    """Requested keys with what was found; a key that an answered lookup lacks is stamped none, a failed one is not."""
    joined = requested.join(found, key, "left")
    return joined.where(answered).withColumn("none", F.col("u").isNull())


def coverage(papers: DataFrame, cache: DataFrame, key: str, found: str) -> DataFrame:
    """One row: papers, linked papers, and papers whose key the cache has not met."""
    joined = papers.join(cache.select(key, F.col(found).alias("_f"), F.lit(True).alias("_in")), key, "left")
    return joined.agg(F.count("*").alias("total"), F.count_if(F.col("_f").isNotNull()).alias("linked"), F.count_if(F.col("_in").isNull() & (or_blank(F.col(key).cast("string")) != "")).alias("backlog"))
