from __future__ import annotations

import json

import pytest

from quire.config import Config
from quire.sources import http
from quire.sources.http import Breaker, Budget, LookupFailed


def transport(url, timeout):
    """A fake API: two pages for issn 1, an error for issn 2."""
    if "issn%3A2" in url:
        return 404, 0.0, ""
    page = "next" in url
    message = {"items": [], "next-cursor": None} if "end" in url else {"items": [{"DOI": f"10.1/{int(page)}"}], "next-cursor": "end" if page else "next"}
    return 200, 0.0, json.dumps({"message": message})


def test_retry_and_pages():
    replies = iter([(503, 0.0, ""), (429, 9.0, ""), (200, 0.0, "{}")])
    waits = []
    assert http.get_json(lambda u, t: next(replies), "u", sleep=waits.append) == {} and waits == [2.0, 9.0]
    with pytest.raises(LookupFailed):
        http.get_json(lambda u, t: (500, 0.0, ""), "u", sleep=lambda _: None)
    assert [i for p in http.pages(transport, "b", "issn:1", "DOI", sleep=lambda _: None) for i in p] == [{"DOI": "10.1/0"}, {"DOI": "10.1/1"}]
    assert http.get_once(lambda u, t: (429, 3.0, ""), "u") == {"ok": False, "status": 429, "retry_after": 3.0, "body": None}
    assert [http.wait_seconds(n) for n in (1, 2, 5)] == [5, 10, 60] and http.wait_seconds(1, 90) == 90


def test_first_issn_must_succeed():
    def fetch(issn):
        if issn == "bad":
            raise LookupFailed(issn)
        return [issn]

    assert http.journal_items(fetch, ["a", "bad"]) == [(0, "a")]
    with pytest.raises(LookupFailed):
        http.journal_items(fetch, ["bad", "a"])


def test_search_budget_breaker_and_failures():
    assert list(http.key_batches(["a", "b", "c"], 2)) == ["doi:a|b", "doi:c"]

    def flaky(key):
        if key == "f":
            raise LookupFailed(key)
        return {"u": key} if key == "hit" else None

    saved = []
    done = http.search_all(["hit", "miss", "f", "late"], [flaky], Budget(4, 99.0), Breaker(1), saved.append, every=1)
    assert done == [("hit", {"u": "hit"}), ("miss", None)] and len(saved) == 3
    assert http.search_all(["a", "b"], [flaky], Budget(1, 99.0), Breaker()) == [("a", None)]


def test_paged_source(spark):
    spark.dataSource.register(http.WorksSource)
    plan = json.dumps([["a", 0, "1"], ["a", 1, "2"]])
    df = spark.read.format("quire_works").option("plan", plan).option("transport", "tests.test_sources:transport").option("pace", "0").load()
    assert sorted((r.issn_ord, r.page_ord, json.loads(r.body)["DOI"]) for r in df.collect()) == [(0, 0, "10.1/0"), (0, 1, "10.1/1")]


def test_config():
    c = Config.from_env({"QUIRE_PULL_DATE": "2025-01-02", "QUIRE_ONLY": "a, b", "QUIRE_ALLOW_SHRINK": "1"})
    assert c.pull_year == 2025 and c.only == ("a", "b") and c.allow_shrink and not c.mock
