"""First-seen registry: which keys are new, who may claim them, and which of them count as news."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def claims(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Keys the registry does not hold, each with the first source that has it: reg_key, src_ord."""
    return rows.join(registry.select("reg_key"), "reg_key", "left_anti").groupBy("reg_key").agg(F.min("src_ord").alias("src_ord"))


def register(rows: DataFrame, registry: DataFrame, pull_date: str, first_run: bool = False, influx: int = 250, seeds: int = 3) -> DataFrame:
    """New registry rows (reg_key, first_seen) from `rows` (src_ord, reg_key, pos); pos is the order within a source.

    A key unseen so far belongs to the first source that has it. A source with more than `influx` unseen keys, or any
    on a first run, is being taken in: its first `seeds` places are news, the rest is known without a date. Repeats of
    a key within a source count towards both numbers, as the list does.
    """
    claimed = rows.join(claims(rows, registry), ["reg_key", "src_ord"])
    size = claimed.groupBy("src_ord").agg(F.count("*").alias("_n"))
    ranked = claimed.groupBy("src_ord", "reg_key").agg(F.min("pos").alias("pos")).join(size, "src_ord")
    ranked = ranked.join(_least_positions(claimed, seeds), "src_ord", "left")
    baseline = F.lit(first_run) | (F.col("_n") > influx)
    news = ~baseline | F.coalesce(F.array_contains("_s", F.col("pos")), F.lit(False))
    return ranked.select("reg_key", F.when(news, F.lit(pull_date).cast("date")).alias("first_seen"))


def _least_positions(claimed: DataFrame, seeds: int) -> DataFrame:
    """The least `seeds` positions of each source. row_number with a constant bound is cut before the shuffle, so each
    task passes on at most `seeds` rows of a source."""
    place = F.row_number().over(Window.partitionBy("src_ord").orderBy("pos"))
    return claimed.withColumn("_k", place).where(F.col("_k") <= seeds).groupBy("src_ord").agg(F.collect_list("pos").alias("_s"))


def influx_counts(rows: DataFrame, registry: DataFrame) -> DataFrame:
    return rows.join(registry.select("reg_key"), "reg_key", "left_anti").groupBy("src_ord").agg(F.count("*").alias("n_new"))
