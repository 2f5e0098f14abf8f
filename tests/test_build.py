from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quire.config import Config
from quire.functions.schemas import PAPER_COLUMNS
from quire.plans import build, publish
from quire.sources import json_docs

CONFIG = Config()


def work(doi, title, year=2026, authors=(("Ann", "Lee", "0-1"),), abstract="", **more):
    people = [{"given": g, "family": f, "ORCID": f"https://orcid.org/{o}" if o else None, "affiliation": [{"name": "Uni A; Dept B"}]} for g, f, o in authors]
    return {"DOI": doi, "type": "journal-article", "title": [title], "author": people, "abstract": abstract, "issued": {"date-parts": [[year]]}} | more


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    a = [
        work("10.1/A1", "First <i>paper</i>", abstract="<p>Text. This paper was accepted by Jo Roe, finance.</p>"),
        work("10.1/a1", "A repeat of the first"),
        work("10.1/a2", "Second", authors=(("Ann", "Lee", "0-1"), ("Bo", "Chen", ""), ("", "", "")), volume="3", issue="2", page="10-20", year=2020),
        work("10.1/a3", ""), work("10.1/a4", "A review", type="book-review"), work("", "No key"), work("", "No key"),
    ]
    b = [work("10.2/b1", "Other", abstract="History: Cy Diaz, Senior Editor; Di Fox, Associate Editor."), work("10.1/a2", "Second elsewhere", year=2021)]
    (d / "works-a.json").write_text(json.dumps({"message": {"items": a}}))
    (d / "works-b.json").write_text(json.dumps(b))
    (d / "journals.json").write_text(json.dumps([{"key": "a", "name": "J. of A", "short": "A", "issns": ["1"], "editors": True, "aia": True}, {"key": "b", "name": "J. of B", "short": "B", "issns": ["2"], "seEditors": True, "aeEditors": True}, {"key": "c", "name": "Old", "retired": True}]))
    (d / "fix.json").write_text(json.dumps({"10.1/A1": {"volume": "9", "issue": "1", "page": "1-25", "year": "2025"}}))
    (d / "more.json").write_text(json.dumps({"10.1/new": {"jkey": "a", "Title": "Soon", "Authors": "Ed Gil, Flo Hu"}, "10.1/a2": {"jkey": "a", "Title": "Known"}, "10.2/x": {"jkey": "b", "Title": "Not in advance"}}))
    return d


@pytest.fixture(scope="module")
def built(spark, landing):
    dims = json_docs.journals(spark, f"{landing}/journals.json")
    works = json_docs.works(spark, f"{landing}/works-a.json", "a").unionByName(json_docs.works(spark, f"{landing}/works-b.json", "b"))
    papers = build.map_journals(works, build.active(dims), CONFIG, fixups=json_docs.fixups(spark, f"{landing}/fix.json"))
    papers = build.append_supplement(papers, json_docs.supplement(spark, f"{landing}/more.json"), dims, CONFIG)
    return dims, papers.select(*PAPER_COLUMNS).cache()


def test_papers(built):
    _, papers = built
    got = {(r.jkey, r.doi_key, r.ord): r for r in papers.collect()}
    assert sorted((k[0], k[1]) for k in got) == [("a", ""), ("a", ""), ("a", "10.1/a1"), ("a", "10.1/a2"), ("a", "10.1/new"), ("b", "10.1/a2"), ("b", "10.2/b1")]
    first = next(r for k, r in got.items() if k[1] == "10.1/a1")
    assert (first.title, first.volume, first.page, first.year, first.status, first.editor, first.area) == ("First paper", "9", "1-25", "2025", "", "This paper was accepted by Jo Roe, finance.", "finance")
    assert first.pub_rank == 2025009001001
    second = next(r for k, r in got.items() if k[:2] == ("a", "10.1/a2"))
    assert second.authors == ["Ann Lee", "Bo Chen"] and second.orcids == ["0-1", ""] and second.affiliations == ["Uni A; Dept B"]
    new = next(r for k, r in got.items() if k[1] == "10.1/new")
    assert (new.authors, new.status, new.year) == (["Ed Gil", "Flo Hu"], "Articles in Advance", "2026")
    b1 = next(r for k, r in got.items() if k[1] == "10.2/b1")
    assert (b1.senior_editor, b1.associate_editor, b1.editor) == ("Cy Diaz", "Di Fox", "")


def test_registry_and_recent(spark, built):
    _, papers = built
    empty = spark.createDataFrame([], "reg_key string, first_seen date")
    reg = build.updated_registry(papers, empty, True, CONFIG)
    rows = {r.reg_key: r.first_seen for r in reg.collect()}
    assert set(rows) == {"10.1/a1", "10.1/a2", "10.1/new", "10.2/b1", "t:no key|2026"}
    assert rows["10.1/a2"] is None  # the repeated title without a DOI takes up two of the three places
    assert str(rows["10.1/new"]) == "2026-07-23" and rows["10.1/a1"] is None
    again = build.updated_registry(papers, reg, False, CONFIG)
    assert again.count() == reg.count()
    assert [r.reg_key for r in build.recent_papers(papers, reg, CONFIG).collect()] == ["10.1/new", "10.2/b1", "t:no key|2026", "t:no key|2026"]


def test_rollups(built):
    _, papers = built
    people = {r.author: r for r in build.authors(papers, CONFIG).collect()}
    assert people["Ann Lee"].papers == 6 and people["Ann Lee"].journals == ["J. of A", "J. of B"] and people["Bo Chen"].papers == 1
    places = {r.name: (r.papers, r.area_count) for r in build.affiliations(papers, CONFIG).collect()}
    assert set(places) == {"Uni A", "Dept B"} and places["Uni A"][0] == 6


def test_publish(spark, built, tmp_path):
    dims, papers = built
    m = {r.key: r for r in publish.manifest(papers, dims).collect()}
    assert set(m) == {"a", "b"} and m["a"]["count"] == 5 and m["a"].first_year == 2020 and m["b"].aia is None
    meta = publish.meta(papers, dims, CONFIG.pull_date).first()
    assert (meta.paper_count, meta.journal_count, meta.per_source) == (7, 2, {"a": 5, "b": 2})
    back = publish.rehydrated(publish.public(papers), dims)
    keep = ["jkey", "doi_key", "title", "year", "pub_rank", "authors"]
    assert sorted(map(str, back.select(*keep).collect())) == sorted(map(str, papers.select(*keep).collect()))
    publish.write_papers(papers, str(tmp_path / "p"))
    publish.write_papers(papers.where("jkey = 'b'").limit(1), str(tmp_path / "p"))
    assert {r.jkey: r["count"] for r in spark.read.parquet(str(tmp_path / "p")).groupBy("jkey").count().collect()} == {"a": 5, "b": 1}
    assert publish.drop_retired(papers.withColumn("jkey", F.lit("c")), dims).count() == 0
    for name in ("x", "y"):
        publish.write_json(publish.manifest(papers, dims), str(tmp_path / name))
    files = [next((tmp_path / n).glob("*.json")).read_bytes() for n in ("x", "y")]
    assert files[0] == files[1]


def test_fallback_and_editors(spark, built):
    dims, papers = built
    shrunk = papers.where("jkey = 'b' or doi_key = '10.1/a1'")
    assert build.with_fallback(shrunk, papers, CONFIG).count() == 7
    assert build.with_fallback(shrunk, papers, Config(allow_shrink=True)).count() == 3
    shared = spark.createDataFrame([("10.1/a2", "Gus Ho", "Ida Ito")], "doi_key string, se string, ae string")
    own = spark.createDataFrame([("10.1/a2", "Jan Ko", "")], "doi_key string, se string, ae string")
    got = build.apply_editors(papers, shared, own, dims).where("doi_key = '10.1/a2'")
    assert {(r.jkey, r.senior_editor, r.associate_editor) for r in got.collect()} == {("a", None, None), ("b", "Jan Ko", "")}


def test_missing_and_corrupt_documents(spark, tmp_path):
    assert json_docs.json_or_empty(spark, str(tmp_path / "none.json"), "a int").count() == 0
    assert json_docs.citation_cache(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("{nope")
    assert json_docs.fixups(spark, str(tmp_path / "bad.json")).count() == 0
    assert json_docs.registry(spark, str(tmp_path / "bad.json"))[1]
    (tmp_path / "reg.json").write_text('{"10.1/a": "2026-01-02", "t:x|1": ""}')
    table, first = json_docs.registry(spark, str(tmp_path / "reg.json"))
    assert not first and {r.reg_key: str(r.first_seen) for r in table.collect()} == {"10.1/a": "2026-01-02", "t:x|1": "None"}
    (tmp_path / "ed.json").write_text('{"map": {"10.1/A": {"se": "X", "ae": ""}}}')
    assert [tuple(r) for r in json_docs.editors_cache(spark, str(tmp_path / "ed.json")).collect()] == [("10.1/a", "X", "")]
    got = json_docs.positional_counts(spark, ["a", "b", "c"], '[{"citationCount": 3}, null, {"citationCount": 0}]')
    assert {r.doi_key: r.c for r in got.collect()} == {"a": 3, "b": None, "c": 0}
