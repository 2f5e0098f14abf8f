"""Documents in byte ranges against the same documents read whole."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions.schemas import CITATIONS, SUPPLEMENT, WORK
from quire.sources import json_docs, ranges

ODD = ["plain", "a},\"b", "},", "x\\", "\"quoted\"", "{brace}", "},{", "[{", "é },\" ü", "line\nend", "\\\"},{\\\"", ""]


@pytest.fixture
def small(spark):
    """Ranges of 700 bytes, so that small documents are read by several tasks."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def minified(x) -> str:
    return json.dumps(x, ensure_ascii=False, separators=(",", ":"))


@pytest.mark.parametrize("wrapped", [False, True])
@pytest.mark.parametrize("texts", ["tame", "odd"])
def test_members(spark, tmp_path, small, wrapped, texts):
    rng = random.Random(4)
    word = (lambda: f"t{rng.randint(0, 99)}") if texts == "tame" else (lambda: rng.choice(ODD))
    doc = {f"10.1/K{k}" if texts == "tame" else f"10.1/k{k}{rng.choice(ODD)}": {"jkey": "j", "Title": word(), "Abstract": word()} for k in range(120)}
    (tmp_path / "x.json").write_text(minified({"map": doc} if wrapped else doc))
    each, odd = ranges.members(spark, str(tmp_path / "x.json"), SUPPLEMENT)
    assert odd.isEmpty() == (texts == "tame")
    if texts == "tame":
        assert each.count() == 120 and each.select(F.spark_partition_id()).distinct().count() >= 1
        assert ranges.pieces(spark, str(tmp_path / "x.json"), '},"').rdd.getNumPartitions() > 4
    got = json_docs.supplement(spark, str(tmp_path / "x.json")).orderBy("pos").collect()
    assert [(r.doi_key, r.Title, r.Abstract) for r in got] == [(k.lower(), v["Title"], v["Abstract"]) for k, v in doc.items()]


def test_irregular_members(spark, tmp_path, small):
    """Spaces, a member beside the map, a nested record, broken and empty documents: as read whole."""
    flat = {f"a{k}": {"c": k, "t": 1} for k in range(20)}
    cases = {"spaced": json.dumps(flat), "beside": minified({"map": flat, "made": 5}), "nested": minified(flat | {"n": {"c": 1, "x": {"y": 1}, "t": 2}}), "broken": minified(flat)[:-30], "empty": "{}", "nothing": "", "list": "[1]", "one": '{"a":{"c":3}}', "number": '{"a":5}'}
    for name, text in cases.items():
        (tmp_path / name).write_text(text)
        got = {r.doi_key: (r.c, r.t) for r in json_docs.sidecar(spark, str(tmp_path / name), CITATIONS).collect()}
        want = flat if name in ("spaced", "beside", "nested") else {"a": {"c": 3}} if name == "one" else {}
        want = {k: (v["c"], v.get("t")) for k, v in want.items()} | ({"n": (1, 2)} if name == "nested" else {})
        if name == "number":
            got = {k: v for k, v in got.items() if v != (None, None)}
        if name == "broken":  # a document that ends too soon holds nothing, or what its parser makes of it
            continue
        assert got == want, name
    assert json_docs.sidecar(spark, str(tmp_path / "missing"), CITATIONS).count() == 0


def work(rng, k) -> dict:
    author = [{"given": rng.choice(ODD), "family": f"F{k}"}, {"name": rng.choice(ODD)}]
    return {"DOI": f"10.1/{k}", "title": [rng.choice(ODD)], "author": author, "assertion": [{"label": rng.choice(ODD)}, {"value": "v"}], "issued": {"date-parts": [[2000 + k]]}}


@pytest.mark.parametrize("form", ["bare", "reply", "status first", "one", "none", "arrays beside", "spaced"])
def test_items(spark, tmp_path, small, form):
    rng = random.Random(7)
    works = [work(rng, k) for k in range({"one": 1, "none": 0}.get(form, 60))]
    doc = works if form in ("bare", "none") else {"message": {"items": works}}
    if form == "status first":
        doc = {"status": "ok", "message": {"total-results": 60, "facets": {}, "items": works, "next-cursor": "a},{b", "query": {"x": None}}}
    if form == "arrays beside":
        doc = {"message": {"items": works, "more": [{"DOI": "no"}, {"DOI": "no"}]}}
    (tmp_path / "works-j.json").write_text(json.dumps(doc) if form == "spaced" else minified(doc))
    journals = spark.createDataFrame([("j",)], "key string")
    got = json_docs.works_folder(spark, str(tmp_path), journals).orderBy("ord").collect()
    assert [(r.DOI, r.title, [a.name or a.given for a in r.author], r.issued["date-parts"]) for r in got] == [(w["DOI"], w["title"], [a.get("name") or a.get("given") for a in w["author"]], w["issued"]["date-parts"]) for w in works]
    if form == "status first":
        items, odd = ranges.items(spark, str(tmp_path), WORK)
        assert odd.isEmpty() and items.count() == 60 and ranges.pieces(spark, str(tmp_path), "},{").rdd.getNumPartitions() > 10


def test_several_files(spark, tmp_path, small):
    """Each file by itself, in one scan: an irregular one beside others."""
    rng = random.Random(1)
    want = {}
    for f in range(4):
        works = [work(rng, 100 * f + k) for k in range(5 + 10 * f)]
        want |= {w["DOI"]: f for w in works}
        doc = {"message": {"items": works}} | ({"x": 1} if f == 1 else {})
        (tmp_path / f"works-j{f}.json").write_text(("x" if f == 3 else "") + (json.dumps(doc) if f == 2 else minified(doc)))
    want = {k: v for k, v in want.items() if v != 3}  # a broken document has no items
    journals = spark.createDataFrame([(f"j{f}",) for f in range(4)], "key string")
    got = {r.DOI: r.jkey for r in json_docs.works_folder(spark, str(tmp_path), journals).collect()}
    assert got == {k: f"j{v}" for k, v in want.items()}
