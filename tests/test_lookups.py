from __future__ import annotations

import json

from quire.config import Config
from quire.functions.schemas import PAPER
from quire.plans import jobs, publish
from quire.sources import http, lookups
from quire.sources.http import Breaker

GET, POST = "tests.offline:get", "tests.offline:post"


def down(url, timeout, payload=None):
    """A service that answers nothing for keys with a 7, and is throttled else."""
    return (503, 0.0, "") if "7" in url + (payload or "") else (429, 0.0, "")


def broken(url, timeout, payload=None):
    raise OSError("no route")


def test_retries_whatever_went_wrong():
    calls = iter([OSError("reset"), (404, 0.0, ""), (200, 0.0, "{nope"), (503, 40.0, ""), (500, 0.0, ""), (200, 0.0, "[1]")])
    waits = []

    def flaky(url, timeout):
        reply = next(calls)
        if isinstance(reply, Exception):
            raise reply
        return reply

    assert http.get_json(flaky, "u", sleep=waits.append) == [1] and waits == [2.0, 4.0, 8.0, 40.0, 32.0]
    assert http.get_once(broken, "u") == {"ok": False, "status": 0, "retry_after": 0.0, "body": None}


def test_post_waits_once():
    replies, waits = iter([(429, 90.0, ""), (200, 0.0, "[null]"), (429, 0.0, ""), (429, 0.0, ""), (500, 0.0, "")]), []
    send = lambda u, t, p: next(replies)
    assert http.post_batch(send, "u", ["a"], waits.append) == [None] and waits == [30.0]
    assert http.post_batch(send, "u", ["a"], waits.append) is None and waits == [30.0, 5.0]
    assert http.post_batch(send, "u", ["a"], waits.append) is None and http.post_batch(broken, "u", ["a"]) is None


def test_breaker_and_quota():
    breaker, waits = Breaker(3), []
    assert lookups.asked(lambda: {"ok": False, "status": 429, "retry_after": 7200.0, "body": None}, breaker, waits.append) is None and not waits and breaker.failures == 3
    breaker = Breaker(3)
    assert lookups.asked(lambda: {"ok": False, "status": 429, "retry_after": 0.0, "body": None}, breaker, waits.append) is None and waits == [5.0, 10.0]


def test_failed_lookups_are_no_misses(spark):
    asked = spark.createDataFrame([(0, "10.1/1"), (0, "10.1/2"), (1, "10.1/7")], "batch long, doi_key string")
    for name in ("tests.test_lookups:down", "tests.test_lookups:broken"):
        assert {(r.done, r.body) for r in lookups.by_key(asked, name, "https://works", "doi", pace=0.0).collect()} == {(False, None)}
        assert {(r.done, r.c) for r in lookups.counts_by_post(asked, name, "https://counts", pace=0.0).collect()} == {(False, None)}
        titled = asked.selectExpr("batch", "doi_key", "if(batch = 0, 'some title', '') AS query")
        got = {r.doi_key: (r.done, r.hits) for r in lookups.by_title(titled, "open", name, "https://works", pace=0.0).collect()}
        assert got == {"10.1/1": (False, []), "10.1/2": (False, []), "10.1/7": (True, [])}  # an empty title is a miss without a call


def test_sweeps_resume_merge_and_apply(spark, tmp_path):
    data = str(tmp_path / "data")
    rows = [(f"10.1/{n}", f"Paper {n} on the order of things", "2021", ["Ann Lee" + "abc"[n % 3], "Bo Chen"], None) for n in range(1, 13)]
    papers = spark.createDataFrame(rows, "doi_key string, title string, year string, authors array<string>, cited_by long")
    full = spark.createDataFrame([], PAPER).unionByName(papers, allowMissingColumns=True).fillna({"jkey": "j", "src_ord": 0, "ord": 0, "pub_rank": 0})
    publish.write_papers(full, f"{data}/papers")
    good, bad = jobs.Services(GET, POST, pace=0.0), jobs.Services("tests.test_lookups:broken", "tests.test_lookups:broken", pace=0.0)
    config = Config()
    assert tuple(jobs.citation_sweep(spark, data, 100, config, bad).first()) == (12, 12)  # nothing concluded
    saved = spark.createDataFrame([("10.1/4", 99, 101, False)], jobs.CITATION_CACHE)
    assert tuple(jobs.citation_sweep(spark, data, 100, config, good, apply_only=True, merge=saved).first()) == (12, 11)
    assert tuple(jobs.citation_sweep(spark, data, 100, config, good).first()) == (12, 0)
    cited = {r.doi_key: (r.cited_by, r.cited_src) for r in spark.read.parquet(f"{data}/papers").collect()}
    assert cited["10.1/4"] == (99, "oa") and cited["10.1/5"] == (10, "s2") and cited["10.1/8"] == (8, "oa") and cited["10.1/12"] == (None, None)
    assert tuple(jobs.preprint_backfill(spark, data, config, bad).first()) == (0, 0)  # unanswered keys are no misses
    assert tuple(jobs.preprint_backfill(spark, data, config, good).first()) == (8, 0)
    links = {r.doi_key: r.preprint_src for r in spark.read.parquet(f"{data}/papers").collect()}
    assert links["10.1/1"] == "arxiv" and links["10.1/3"] == "ssrn" and links["10.1/2"] is None


def test_pages_to_papers(spark, tmp_path):
    """The paged source's records as works, and pulls of several ISSNs in one folder: the first of a key counts."""
    from quire.plans.run import catalogue
    from quire.sources import json_docs

    spark.dataSource.register(http.WorksSource)
    raw = spark.read.format("quire_works").option("plan", json.dumps([["a", 0, "1"]])).option("transport", GET).option("pace", "0").load()
    assert [r.DOI for r in json_docs.pulled_works(raw).orderBy("ord").collect()] == [f"10.1/1-{p}-{i}" for p in (0, 1) for i in (0, 1, 2)]
    (tmp_path / "journals.json").write_text(json.dumps([{"key": "a b", "name": "A", "seEditors": True, "aeEditors": True}]))
    for issn, title in ((0, "First"), (1, "Second")):
        work = {"DOI": "10.1/x", "type": "journal-article", "title": [title], "issued": {"date-parts": [[2020]]}, "group-title": ["Finance"]}
        (tmp_path / f"works-a b.{issn}.0.json").write_text(json.dumps([work]))
    (tmp_path / "editors.json").write_text(json.dumps({"10.1/X": {"se": "Shared Se", "ae": "Shared Ae"}}))
    (tmp_path / "own-editors.json").write_text(json.dumps({"map": {"10.1/x": {"se": "Own Se"}}}))
    paper = catalogue(spark, str(tmp_path), Config())["papers"].collect()
    assert [(p.title, p.senior_editor, p.associate_editor) for p in paper] == [("First", "Own Se", "")]


def test_settings_from_the_environment():
    c = Config.from_env({"QUIRE_CITATION_CAP": "5", "QUIRE_CITATION_MS": "1500", "QUIRE_SEARCH_CAP": "7", "QUIRE_SEARCH_MS": "2000", "QUIRE_MIN_AGE_DAYS": "4"})
    assert (c.citation_cap, c.citation_seconds, c.search_cap, c.search_seconds, c.min_age_days) == (5, 1.5, 7, 2.0, 4)


def test_time_is_up(spark):
    asked = spark.createDataFrame([(0, "10.1/1"), (1, "10.1/2")], "batch long, doi_key string")
    assert {r.done for r in lookups.by_key(asked, GET, "https://works", "doi", pace=0.0, seconds=-1.0).collect()} == {False}
