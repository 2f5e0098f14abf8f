"""Author identities and affiliation rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import affiliation_key, norm_name, without_initials
from quire.operators.components import connected_components


def pair_guard(pairs: DataFrame, ident: str, name: str) -> DataFrame:
    """Different (ident, name) pairs with their counts n, kept where the identifier has one name or the pair counts
    twice or more. The number of names is an aggregate joined back, not a window over an identifier's rows."""
    counted = pairs.groupBy(ident, name).agg(F.count("*").alias("n"))
    names = counted.groupBy(ident).agg(F.count("*").alias("_names"))
    return counted.join(names, ident).where((F.col("_names") == 1) | (F.col("n") >= 2)).drop("_names")


def identities(mentions: DataFrame) -> DataFrame:
    """(name_key, root) for mentions (name, orcid): names that share an identifier, or differ by a middle initial."""
    keyed = mentions.select(norm_name(F.col("name")).alias("name_key"), "orcid").where("name_key <> ''")
    names = keyed.select("name_key").distinct()
    by_id = pair_guard(keyed.where("orcid <> ''"), "orcid", "name_key").select(F.concat(F.lit("n:"), "name_key").alias("a"), F.concat(F.lit("o:"), "orcid").alias("b"))
    shorter = names.select("name_key", without_initials(F.col("name_key")).alias("short")).where("short <> name_key")
    by_initial = shorter.join(names.select(F.col("name_key").alias("short")), "short", "left_semi")
    edges = by_id.unionByName(by_initial.select(F.concat(F.lit("n:"), "name_key").alias("a"), F.concat(F.lit("n:"), "short").alias("b")))
    labels = connected_components(edges)
    own = F.concat(F.lit("n:"), "name_key")
    return names.join(labels, own == labels["node"], "left").select("name_key", F.coalesce("component", own).alias("root"))


def mode_and_variants(counts: DataFrame, group: str, value: str, n: str, first: str) -> DataFrame:
    """(group, mode, variants[]): values by frequency, ties by first occurrence."""
    item = F.struct((-F.col(n)).alias("o"), F.col(first).alias("f"), F.col(value).alias("v"))
    ranked = F.transform(F.array_sort(F.collect_list(item)), lambda s: s["v"])
    return counts.groupBy(group).agg(ranked.alias("_v")).select(group, F.get("_v", F.lit(0)).alias("mode"), F.slice("_v", F.lit(2), F.size("_v")).alias("variants"))


def ordered_set(value, order):  # noqa: ANN001, ANN201
    """Different values in the order of their first occurrence."""
    return F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct(order, value))), lambda s: s[value]))


def author_rollup(mentions: DataFrame, roots: DataFrame) -> DataFrame:
    """author, papers (mentions), areas, journals, variants per root; mentions: (ord, name, orcid, area, journal).

    Everything is counted by (root, value) first, so an author with very many mentions is merged before it moves.
    """
    rows = mentions.withColumn("name_key", norm_name(F.col("name"))).where("name_key <> ''").join(roots, "name_key")
    names = rows.groupBy("root", "name").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    total = names.groupBy("root").agg(F.sum("n").alias("papers"))
    out = total.join(mode_and_variants(names, "root", "name", "n", "first"), "root")
    for column in ("area", "journal"):
        firsts = rows.where(F.coalesce(column, F.lit("")) != "").groupBy("root", column).agg(F.min("ord").alias("o"))
        out = out.join(firsts.groupBy("root").agg(ordered_set(column, "o").alias(column + "s")), "root", "left")
    none = F.array().cast("array<string>")
    return out.select("root", F.col("mode").alias("author"), "papers", F.coalesce("areas", none).alias("areas"), F.coalesce("journals", none).alias("journals"), "variants")


def facet_rollup(rows: DataFrame, owner: str, name: str, area: str, order: str) -> DataFrame:
    """name, papers, areas, area_count: each facet once an owner, by folded key, in its first spelling."""
    keyed = rows.withColumn("_k", affiliation_key(F.col(name))).where("_k <> ''")
    once = keyed.groupBy(owner, "_k").agg(F.min_by(F.struct(name, area, order), order).alias("_r")).select("_k", F.col("_r." + name).alias("name"), F.col("_r." + area).alias("area"), F.col("_r." + order).alias("o"))
    base = once.groupBy("_k").agg(F.count("*").alias("papers"), F.min_by("name", "o").alias("name"))
    firsts = once.where(F.coalesce("area", F.lit("")) != "").groupBy("_k", "area").agg(F.min("o").alias("o"))
    areas = firsts.groupBy("_k").agg(ordered_set("area", "o").alias("areas"))
    out = base.join(areas, "_k", "left").withColumn("areas", F.coalesce("areas", F.array().cast("array<string>")))
    return out.select(F.col("_k").alias("facet_key"), "name", "papers", "areas", F.size("areas").alias("area_count"))
