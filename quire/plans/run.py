"""The whole build: sources to published tables, as one function of a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.config import Config
from quire.functions.schemas import PAPER, PAPER_COLUMNS
from quire.plans import build, publish, refresh
from quire.sources import json_docs
from quire.sources.shared import written


def catalogue(spark: SparkSession, landing: str, config: Config, committed: DataFrame | None = None) -> dict[str, DataFrame]:
    """papers, registry, authors, affiliations, recent, manifest, meta and the reasons of the fallback from a landing folder.

    The folder holds journals.json, works-<key>.json for each journal (or works-<key>.<issn>.<page>.json, a file a page)
    and, if there are any, fixups.json, overrides.json, editors.json, own-editors.json, supplement.json, preprints.json,
    citations.json and registry.json. A journal without works keeps its committed papers.

    config.mock: a build from fixtures alone; editors.json, which other builds share, is left out.
    """
    dims = json_docs.journals(spark, f"{landing}/journals.json")
    scope = build.local(build.active(dims, config.only))
    works = json_docs.works_folder(spark, landing, scope)
    base = committed if committed is not None else spark.createDataFrame([], PAPER)
    fresh = build.map_journals(works, scope, config, fixups=json_docs.fixups(spark, f"{landing}/fixups.json"), overrides=json_docs.overrides(spark, f"{landing}/overrides.json"))
    fresh, base = written(fresh.select(*PAPER_COLUMNS)), base.select(*PAPER_COLUMNS)
    reasons = build.fallback_reasons(fresh, base, config)
    papers = build.with_fallback(fresh, base, config)
    shared, own = (json_docs.editors_cache(spark, f"{landing}/{name}.json") for name in ("editors", "own-editors"))
    shared = shared.limit(0) if config.mock else shared
    papers = build.apply_editors(papers, shared, own, dims)
    papers = build.append_supplement(papers, json_docs.supplement(spark, f"{landing}/supplement.json"), dims, config)
    papers = publish.drop_retired(papers, dims)
    papers = refresh.apply_preprints(papers, json_docs.preprint_cache(spark, f"{landing}/preprints.json"))
    papers = written(refresh.apply_citations(papers, json_docs.citation_cache(spark, f"{landing}/citations.json")).select(*PAPER_COLUMNS))
    known, first_run = json_docs.registry(spark, f"{landing}/registry.json")
    registry = written(build.updated_registry(papers, known, first_run, config))
    return {
        "papers": papers, "registry": registry, "authors": build.authors(papers, config), "affiliations": build.affiliations(papers, config),
        "recent": build.recent_papers(papers, registry, config), "manifest": publish.manifest(papers, dims), "meta": publish.meta(papers, dims, config.pull_date),
        "fallback": reasons,
    }
