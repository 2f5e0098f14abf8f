from __future__ import annotations

import random

from pyspark.sql import functions as F

from quire.operators import entities, matching, registry, rows, state
from quire.operators.components import connected_components


def test_keep_first_is_idempotent_and_keeps_blanks(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, None), (0, "b")], "ord int, k string")
    once = rows.keep_first(df, "k", ["ord"])
    assert sorted(r.ord for r in once.collect()) == [0, 1, 3, 4]
    assert sorted(map(str, rows.keep_first(once, "k", ["ord"]).collect())) == sorted(map(str, once.collect()))


def test_merges(spark):
    ddl = "k string, t int, c long"
    cur = spark.createDataFrame([("a", 5, None), ("b", 1, 9), ("c", 2, 2)], ddl)
    new = spark.createDataFrame([("a", 5, 0), ("b", 2, 1), ("d", 1, 1)], ddl)
    got = rows.merge_recency(cur, new, "k", "t", "c")
    assert {r.k: (r.t, r.c) for r in got.collect()} == {"a": (5, None), "b": (2, 1), "c": (2, 2), "d": (1, 1)}
    assert sorted(map(str, rows.merge_recency(got, new, "k", "t", "c").collect())) == sorted(map(str, got.collect()))
    ddl = "k string, u string, ts int"
    a = spark.createDataFrame([("a", "x", 1), ("b", None, 1), ("c", "", 1)], ddl)
    b = spark.createDataFrame([("a", "y", 2), ("b", None, 3), ("d", "z", 1)], ddl)
    assert {r.k: (r.u, r.ts) for r in rows.merge_found_wins(a, b, "k", "u").collect()} == {"a": ("x", 1), "b": (None, 3), "c": ("", 1), "d": ("z", 1)}


def test_carry_forward(spark):
    got = spark.createDataFrame([(4, 0, True, False, 9), (4, 2, True, True, 9), (4, 5, True, True, 1), (0, 0, True, False, 0)], "oa long, s2 long, od boolean, sd boolean, p long").select(state.counted(*[F.col(c) for c in ("oa", "s2", "od", "sd", "p")]).alias("g"))
    assert [(r.g.c, r.g.s2) for r in got.collect()] == [(9, False), (4, False), (5, True), (None, False)]


def test_components_any_order(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(30)] + [(50, 60), (60, 70), (80, 80)]
    for _ in range(2):
        rng.shuffle(edges)
        got = {r.node: r.component for r in connected_components(spark.createDataFrame([tuple(rng.sample(e, 2)) for e in edges], "a long, b long")).collect()}
        assert got == {i: 0 for i in range(31)} | {50: 50, 60: 50, 70: 50, 80: 80}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_identities(spark):
    m = spark.createDataFrame([("Hau L. Lee", ""), ("Hau Lee", ""), ("José Díaz", "1"), ("Jose Diaz", "1"), ("J Diaz", "2"), ("K Diaz", "2"), ("Solo", "")], "name string, orcid string")
    root = {r.name_key: r.root for r in entities.identities(m).collect()}
    assert root["hau l. lee"] == root["hau lee"] and len({root["j diaz"], root["k diaz"], root["solo"], root["jose diaz"]}) == 4


def test_registry_claims(spark):
    r = spark.createDataFrame([(0, "x", 2), (0, "y", 1), (1, "x", 1), (1, "z", 2), (0, "w", 3), (0, "v", 4)], "src_ord long, reg_key string, pos long")
    known = spark.createDataFrame([("w",)], "reg_key string")
    got = {k.reg_key: k.first_seen for k in registry.register(r, known, "2026-01-01", influx=2, seeds=2).collect()}
    assert set(got) == {"x", "y", "z", "v"} and got["v"] is None and got["x"] and got["y"] and got["z"]
    assert {x.src_ord: x.n_new for x in registry.influx_counts(r, known).collect()} == {0: 3, 1: 2}


HIT = "ord int, hit struct<doi: string, title: string, publication_year: int, authorships: array<struct<author: struct<display_name: string>>>, locations: array<struct<landing_page_url: string, pdf_url: string>>, best_oa_location: struct<landing_page_url: string, pdf_url: string>, primary_location: struct<landing_page_url: string, pdf_url: string>, open_access: struct<oa_url: string>, cited_by_count: long>"


def test_match_hits_takes_the_first_usable(spark):
    papers = spark.createDataFrame([("d", "Dueling Contests and More", "2020", ["Ann Lee", "Bo Chen"])], "doi_key string, title string, year string, authors array<string>")

    def hit(doi, title, year, names, url):
        return (doi, title, year, [(((n),),) for n in names], [(url, None)] if url else None, None, None, None, 1)

    hits = [(1, hit("", "Dueling Contests and More", 2019, ["A Lee", "B Chen"], "https://a.edu/x")), (2, hit("", "Dueling contests", 2013, ["A Lee", "B Chen"], "https://arxiv.org/abs/1")), (3, hit("10.2139/ssrn.77", "Dueling Contests and more", 2010, ["A Lee", "B Chen"], None)), (4, hit("", "Dueling Contests and More", 2020, ["A Lee", "B Chen"], "https://arxiv.org/abs/2"))]
    df = spark.createDataFrame([("d", *h) for h in hits], f"doi_key string, {HIT}")
    got = matching.match_hits(papers, df).first()
    assert (got.u, got.s, got.kind) == ("https://papers.ssrn.com/sol3/papers.cfm?abstract_id=77", "ssrn", "exact")
    works = spark.createDataFrame([("d", 1, ("10.48550/arXiv.5v1", ["Dueling contests: and more"], [("Lee",), ("Chen",)], ([[2020]],)))], "doi_key string, ord int, hit struct<DOI: string, title: array<string>, author: array<struct<family: string>>, issued: struct<`date-parts`: array<array<int>>>>")
    assert matching.match_works(papers, works).first().u == "https://arxiv.org/abs/5"


def test_no_cross_product_in_title_matching(spark):
    t = spark.createDataFrame([(1, "a long enough title")], "id long, title string")
    plan = matching.match_titles(t, t)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rows_are_pruned_and_filters_pushed(spark, sf_dir):
    from quire.queries import QUERIES

    plan = QUERIES["only_prune"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source:string>" in plan and "PushedFilters: [In(source" in plan


def test_fallback_tells_why(spark):
    ddl = "source string, key string, title string"
    old = spark.createDataFrame([("a", f"k{i}", "t") for i in range(4)] + [("b", f"k{i}", "t") for i in range(4)] + [("c", "k0", None), ("c", "k0", "x")], ddl)
    new = spark.createDataFrame([("a", "k0", "t"), ("b", "k0", "T"), ("b", "k1", "t"), ("b", "new", "t"), ("c", "k0", "x"), ("c", "k0", None), ("d", "k", "t")], ddl)
    kept, told = rows.fallback(new, old, "source", "key", ["title"])
    got = {r.source: (r.fresh, r.committed, r.added, r.gone, r.changed, r.kept) for r in told.collect()}
    assert got == {"a": (1, 4, 0, 3, 0, "committed"), "b": (3, 4, 1, 2, 1, "fresh"), "c": (2, 2, 0, 0, 0, "fresh"), "d": (1, 0, 1, 0, 0, "fresh")}
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.shrink_guard(new, old, "source").collect()))
    assert rows.fallback(new, old, "source", "key", ["title"], allow=True)[1].where("kept = 'committed'").count() == 0
