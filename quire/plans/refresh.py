"""Citation counts and open links: what to ask for, and what the replies change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.config import Config
from quire.functions.text import blank_to_null, canon_arxiv, or_blank, pick_preprint, preprint_from_doi, sanitised_query
from quire.operators import matching, rows, state


def citation_requests(papers: DataFrame, cache: DataFrame, today: int, config: Config) -> DataFrame:
    """Different keys whose count is not fresh: never-checked ones first, then the oldest; the place in the published
    order decides ties."""
    keyed = papers.select("doi_key", F.struct("src_ord", (-F.col("pub_rank")).alias("r"), "doi_key").alias("o"))
    return state.ttl_queue(keyed, cache, "doi_key", "t", "o", today, config.min_age_days, config.citation_cap).select("doi_key")


def concluded(requests: DataFrame, first: DataFrame, second: DataFrame, cache: DataFrame, today: int) -> DataFrame:
    """New cache rows from two lookups. Replies are (doi_key, c, done): done tells that the lookup was answered for the key;
    an answered key without a count is a concluded 0. A key that neither concluded has no row."""
    a = first.select("doi_key", F.col("c").alias("_oa"), F.col("done").alias("_od"))
    b = second.select("doi_key", F.col("c").alias("_s2"), F.col("done").alias("_sd"))
    joined = requests.join(a, "doi_key", "left").join(b, "doi_key", "left").join(cache.select("doi_key", F.col("c").alias("_p"), F.col("s2").alias("_ps")), "doi_key", "left")
    od, sd = (F.coalesce(c, F.lit(False)) for c in ("_od", "_sd"))
    got = joined.where(od | sd).select("doi_key", state.counted(F.col("_oa"), F.col("_s2"), od, sd, F.col("_p"), F.col("_ps")).alias("g"))
    return got.select("doi_key", "g.c", F.lit(today).alias("t"), "g.s2")


def concluded_counts(requests: DataFrame, first: DataFrame, second: DataFrame, cache: DataFrame, today: int) -> DataFrame:
    """The cache after two lookups, see concluded()."""
    return rows.overlay_all(cache, concluded(requests, first, second, cache, today), "doi_key")


def apply_citations(papers: DataFrame, cache: DataFrame) -> DataFrame:
    """Counts only rise; the source is named where the cache is strictly larger."""
    label = F.when(F.col("_s2"), "s2").otherwise("oa")
    side = cache.where("doi_key <> ''").select("doi_key", F.col("c").alias("_c"), F.coalesce("s2", F.lit(False)).alias("_s2"))
    return rows.lift_max(papers, side, "doi_key", "cited_by", "cited_src", "_c", label)


def apply_preprints(papers: DataFrame, cache: DataFrame) -> DataFrame:
    """The cache's link in its latest-version form where there is one; an old link survives a miss."""
    side = cache.where(blank_to_null(F.col("url")).isNotNull()).select("doi_key", canon_arxiv(F.col("url")).alias("_u"), F.col("src").alias("_s"))
    joined = papers.join(side, "doi_key", "left")
    return joined.withColumns({"preprint": F.coalesce("_u", "preprint"), "preprint_src": F.when(F.col("_u").isNotNull(), F.col("_s")).otherwise(F.col("preprint_src"))}).select(*papers.columns)


def preprint_requests(papers: DataFrame, cache: DataFrame) -> DataFrame:
    """Different keys that the cache has not met, in batches of 50 for the lookup."""
    fresh = rows.distinct_first(papers, "doi_key", "ord").join(cache.select("doi_key"), "doi_key", "left_anti")
    return rows.numbered_batches(fresh.select("doi_key"), ["doi_key"], 50)


def found_by_doi(requests: DataFrame, works: DataFrame, answered: DataFrame) -> DataFrame:
    """New cache rows from works (doi_key, hit; of several the first by `ord`, if they have one): a usable link, or none
    for a key of an answered batch (batch)."""
    order = F.col("ord") if "ord" in works.columns else F.col("l")
    links = works.select("*", pick_preprint(matching.candidate_urls("hit", oa_url=True)).alias("l")).where("l is not null")
    links = links.groupBy("doi_key").agg(F.min_by("l", order).alias("l"))
    found = links.select("doi_key", F.col("l.u").alias("u"), F.col("l.s").alias("s"))
    done = requests.join(answered.select("batch"), "batch", "left_semi").select("doi_key")
    stamped = state.stamp(found, done, "doi_key", F.lit(True))
    return stamped.select("doi_key", F.col("u").alias("url"), F.col("s").alias("src"), "none", F.lit(None).cast("int").alias("ts"))


def title_requests(papers: DataFrame, cache: DataFrame, config: Config) -> DataFrame:
    """Papers to search by title, with the sanitised query; an empty query is a miss without a search."""
    due = state.search_queue(papers.select("doi_key", "title", "year", "authors"), cache, "doi_key", "year", "none", "ts", config.search_version, config.search_first_year, config.search_cap)
    return due.withColumn("query", sanitised_query(F.col("title")))


def found_by_title(requests: DataFrame, hits: DataFrame, works: DataFrame, failed: DataFrame, config: Config) -> DataFrame:
    """New cache rows: the first engine's match, else the second's; keys of a failed search keep their state."""
    first = matching.match_hits(requests, hits).select("doi_key", "u", "s")
    rest = requests.join(first.select("doi_key"), "doi_key", "left_anti")
    second = matching.match_works(rest, works).select("doi_key", "u", "s")
    tried = requests.join(failed.select("doi_key"), "doi_key", "left_anti").select("doi_key")
    stamped = state.stamp(first.unionByName(second), tried, "doi_key", F.lit(True))
    return stamped.select("doi_key", F.col("u").alias("url"), F.col("s").alias("src"), "none", F.lit(config.search_version).cast("int").alias("ts"))


def stale(papers: DataFrame, cache: DataFrame, today: int, config: Config) -> DataFrame:
    """One row: different keys, and those whose count is stale or was never looked up."""
    keys = papers.where(or_blank(F.col("doi_key")) != "").select("doi_key").distinct().join(cache.select("doi_key", "t"), "doi_key", "left")
    old: Column = F.coalesce(F.col("t") <= today - config.min_age_days, F.lit(True))
    return keys.agg(F.count("*").alias("total"), F.count_if(old).alias("stale"))


__all__ = ["apply_citations", "apply_preprints", "citation_requests", "concluded", "concluded_counts", "found_by_doi", "found_by_title", "preprint_from_doi", "preprint_requests", "stale", "title_requests"]
