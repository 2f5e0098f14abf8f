"""Lookups answered from tables: the bulk dumps that the services publish, joined with the requests instead of called.

At a size where a call for each key takes weeks, a dump is the way to ask: each lookup is one equal-join, so nothing is
limited, paced or lost. Jobs take a Dumps wherever they take the services' addresses; every request counts as answered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.schemas import SEARCH_HIT, WORK_HIT
from quire.operators import matching
from quire.sources.shared import written


@dataclass(frozen=True)
class Dumps:
    """works: (ord, body) records of the open catalogue (SEARCH_HIT as JSON); counts: (doi_key, c) of the second source;
    registered: (ord, body) works of the registry (WORK_HIT as JSON); journals: (issn, title) of the registry."""

    works: DataFrame
    counts: DataFrame | None = None
    registered: DataFrame | None = None
    journals: DataFrame | None = None

    def keyed(self, requests: DataFrame, select: str = "", seconds: float = 0) -> DataFrame:
        """(batch, doi_key, done, body); of several records of a key the last one."""
        key = F.regexp_replace(F.lower(F.get_json_object("body", "$.doi")), "^https?://doi\\.org/", "")
        records = self.works.select(key.alias("doi_key"), "ord", "body").where("doi_key is not null").groupBy("doi_key").agg(F.max_by("body", "ord").alias("body"))
        return requests.select("batch", "doi_key").join(records, "doi_key", "left").select("batch", "doi_key", F.lit(True).alias("done"), "body")

    def counted(self, requests: DataFrame, seconds: float = 0) -> DataFrame:
        """(doi_key, c, done)."""
        return requests.select("doi_key").join(self.counts, "doi_key", "left").select("doi_key", "c", F.lit(True).alias("done"))

    def titled(self, requests: DataFrame, engine: str, seconds: float = 0) -> DataFrame:
        """(doi_key, done, hits) for requests (doi_key, title, year, authors): the first record that matches and has an
        address, found by corpus against corpus."""
        if engine == "open":
            hit = F.from_json("body", SEARCH_HIT)
            usable = F.coalesce(matching.pick_preprint(matching.candidate_urls("hit")), matching.preprint_from_doi(F.col("hit.doi")))
            parts = ("hit.title", "hit.publication_year", F.transform("hit.authorships", lambda a: a["author"]["display_name"]))
            corpus = self.works
        else:
            hit = F.from_json("body", WORK_HIT)
            usable = matching.preprint_from_doi(F.col("hit.DOI"))
            parts = (F.try_element_at("hit.title", F.lit(1)), F.try_element_at(F.try_element_at("hit.issued.date-parts", F.lit(1)), F.lit(1)), F.transform("hit.author", lambda a: a["family"]))
            corpus = self.registered
        title, year, names = (F.col(p) if isinstance(p, str) else p for p in parts)
        held = written(corpus.withColumn("hit", hit).where(usable.isNotNull()).select(F.col("ord").alias("id"), "ord", title.alias("title"), year.cast("string").alias("year"), names.alias("authors"), "body"))
        found = matching.match_corpora(requests.select(F.col("doi_key").alias("id"), "title", "year", "authors"), held.drop("body"))
        bodies = found.join(held.select(F.col("id").alias("work"), "body"), "work").select(F.col("id").alias("doi_key"), "body")
        joined = requests.select("doi_key").join(bodies, "doi_key", "left")
        return joined.select("doi_key", F.lit(True).alias("done"), F.when(F.col("body").isNotNull(), F.array("body")).otherwise(F.array().cast("array<string>")).alias("hits"))

    def named(self, journals: DataFrame) -> DataFrame:
        """(key, issn, title, warning) for journals (key, issns): what the registry calls each journal's first ISSN."""
        issn = F.try_element_at("issns", F.lit(1))
        joined = journals.select("key", issn.alias("issn")).join(self.journals.select("issn", "title", F.lit(True).alias("_in")), "issn", "left")
        none = F.coalesce("issn", F.lit("")) == ""
        missing = F.concat(F.lit("no journal for ISSN "), "issn", F.lit(" (HTTP 404)"))
        return joined.select("key", F.when(~none, F.col("issn")).alias("issn"), "title", F.when(none, F.lit("no ISSN")).when(F.col("_in").isNull(), missing).alias("warning"))
