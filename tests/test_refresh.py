from __future__ import annotations

import json

from quire.config import Config
from quire.functions.schemas import PAPER, SEARCH_HIT
from quire.plans import refresh
from quire.plans.run import catalogue

CONFIG = Config()


def papers(spark, *rows):
    df = spark.createDataFrame([(d, t, y, a, c) for d, t, y, a, c in rows], "doi_key string, title string, year string, authors array<string>, cited_by long")
    full = spark.createDataFrame([], PAPER)
    return full.unionByName(df, allowMissingColumns=True).fillna({"src_ord": 0, "ord": 0, "pub_rank": 0})


def test_citations(spark):
    p = papers(spark, ("a", "A", "2020", [], 5), ("b", "B", "2020", [], None), ("c", "C", "2020", [], 2), ("", "D", "2020", [], 1))
    cache = spark.createDataFrame([("a", 9, 100, False), ("b", None, 99, False)], "doi_key string, c long, t int, s2 boolean")
    asked = refresh.citation_requests(p, cache, 102, CONFIG)
    assert [r.doi_key for r in asked.collect()] == ["c", "b", "a"]
    reply = "doi_key string, c long, done boolean"
    first = spark.createDataFrame([("a", 4, True), ("b", None, True)], reply)
    second = spark.createDataFrame([("b", 3, True), ("c", None, False)], reply)
    got = refresh.concluded_counts(asked, first, second, cache, 102)
    assert {r.doi_key: (r.c, r.t, r.s2) for r in got.collect()} == {"a": (9, 102, False), "b": (3, 102, True)}
    lifted = {r.doi_key: (r.cited_by, r.cited_src) for r in refresh.apply_citations(p, got).collect()}
    assert lifted == {"a": (9, "oa"), "b": (3, "s2"), "c": (2, None), "": (1, None)}
    assert tuple(refresh.stale(p, got, 102, CONFIG).first()) == (3, 1)


def test_preprints(spark):
    p = papers(spark, ("a", "A study of long titles", "2020", ["Ann Lee"], None), ("b", "B", "2020", ["Bo Chen"], None), ("c", "C", "1980", [], None))
    empty = spark.createDataFrame([], "doi_key string, url string, src string, none boolean, ts int")
    asked = refresh.preprint_requests(p, empty)
    assert {r.doi_key: r.batch for r in asked.collect()} == {"a": 0, "b": 0, "c": 0}
    hit = "doi_key string, hit struct<" + SEARCH_HIT + ">"
    works = spark.createDataFrame([("b", (None, None, None, None, [("https://b.edu", "https://arxiv.org/pdf/7v2.pdf")], None, None, None, None))], hit)
    cache = refresh.found_by_doi(asked, works, asked.select("batch").distinct())
    assert {r.doi_key: (r.url, r.src, r.none) for r in cache.collect()} == {"a": (None, None, True), "b": ("https://arxiv.org/abs/7", "arxiv", False), "c": (None, None, True)}
    assert refresh.found_by_doi(asked, works, asked.select("batch").where("batch > 0")).count() == 0
    due = refresh.title_requests(p, cache, CONFIG)
    assert [r.doi_key for r in due.collect()] == ["a"]
    hits = spark.createDataFrame([("a", 1, ("10.2139/ssrn.5", "A Study of Long Titles", 2019, [(("A. Lee",),)], None, None, None, None, None))], "doi_key string, ord int, hit struct<" + SEARCH_HIT + ">")
    none = spark.createDataFrame([], "doi_key string, ord int, hit struct<DOI: string, title: array<string>, author: array<struct<family: string>>, issued: struct<`date-parts`: array<array<int>>>>")
    found = refresh.found_by_title(due, hits, none, spark.createDataFrame([], "doi_key string"), CONFIG)
    assert [(r.src, r.none, r.ts) for r in found.collect()] == [("ssrn", False, 3)]
    assert refresh.found_by_title(due, hits.limit(0), none, due.select("doi_key"), CONFIG).count() == 0
    assert {r.doi_key: r.preprint_src for r in refresh.apply_preprints(p, cache).collect()} == {"a": None, "b": "arxiv", "c": None}


def test_catalogue(spark, tmp_path):
    (tmp_path / "journals.json").write_text(json.dumps([{"key": "a", "name": "A", "aia": True}, {"key": "z", "name": "Z", "retired": True}]))
    work = {"DOI": "10.1/x", "type": "journal-article", "title": ["X"], "author": [{"given": "Ann", "family": "Lee"}], "issued": {"date-parts": [[2026]]}, "is-referenced-by-count": 2}
    (tmp_path / "works-a.json").write_text(json.dumps({"message": {"items": [work]}}))
    (tmp_path / "citations.json").write_text(json.dumps({"10.1/X": {"c": 7, "t": 1, "s2": 1}}))
    out = catalogue(spark, str(tmp_path), CONFIG)
    p = out["papers"].first()
    assert (p.doi_key, p.cited_by, p.cited_src, p.status) == ("10.1/x", 7, "s2", "Articles in Advance")
    assert [tuple(r) for r in out["fallback"].collect()] == [("a", 1, 0, 1, 0, 0, "fresh")]
    assert out["meta"].first().per_source == {"a": 1} and out["recent"].count() == 1 and out["authors"].first().author == "Ann Lee" and out["affiliations"].count() == 0


def test_a_mock_build_leaves_shared_editors_out(spark, tmp_path):
    (tmp_path / "journals.json").write_text(json.dumps([{"key": "a", "name": "A", "seEditors": True}, {"key": "none", "name": "N"}]))
    works = [{"DOI": f"10.1/{k}", "type": "journal-article", "title": [f"T {k}"], "issued": {"date-parts": [[2020]]}} for k in "xy"]
    (tmp_path / "works-a.json").write_text(json.dumps(works))
    (tmp_path / "editors.json").write_text(json.dumps({"10.1/x": {"se": "Shared Se"}}))
    (tmp_path / "own-editors.json").write_text(json.dumps({"10.1/y": {"se": "Own Se"}}))
    for config, want in ((CONFIG, {"10.1/x": "Shared Se", "10.1/y": "Own Se"}), (Config.from_env({"QUIRE_MOCK": "1"}), {"10.1/x": "", "10.1/y": "Own Se"})):
        got = {p.doi_key: p.senior_editor or "" for p in catalogue(spark, str(tmp_path), config)["papers"].collect()}
        assert got == want
