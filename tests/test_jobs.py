"""Jobs that are cut off anywhere and go on: publications, queues, legs, dumps."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quire.config import Config
from quire.functions.schemas import PAPER
from quire.operators import matching
from quire.plans import jobs, publication, publish, refresh
from quire.plans.publication import Conflict, Publication
from quire.sources import files
from quire.sources.dumps import Dumps
from quire.streaming import queue
from tests import offline

GET, POST = "tests.test_jobs:logged_get", "tests.test_jobs:logged_post"
LOG = Path("/tmp/quire-test-calls")


def logged_get(url, timeout):
    with LOG.open("a") as f:
        f.write(url + "\n")
    return offline.get(url, timeout)


def logged_post(url, timeout, payload):
    with LOG.open("a") as f:
        f.write(payload + "\n")
    return offline.post(url, timeout, payload)


def failing(url, timeout, payload=None):
    with LOG.open("a") as f:
        f.write(url + "\n")
    return 500, 0.0, ""


@pytest.fixture
def calls():
    LOG.unlink(missing_ok=True)
    yield lambda: LOG.read_text().splitlines() if LOG.exists() else []
    LOG.unlink(missing_ok=True)


def laid(spark, data, n, journals=1):
    rows = [(f"10.1/{k}", f"Paper {k} on the order of things", "2021", ["Ann Lee" + "abc"[k % 3], "Bo Chen"], f"j{k % journals}") for k in range(1, n + 1)]
    p = spark.createDataFrame(rows, "doi_key string, title string, year string, authors array<string>, jkey string")
    full = spark.createDataFrame([], PAPER).unionByName(p, allowMissingColumns=True).fillna({"src_ord": 0, "ord": 0, "pub_rank": 0})
    publish.write_papers(full, f"{data}/papers")


SCHEMA = "doi_key string, c long, t int, s2 boolean"


def test_cache_parts(spark, tmp_path):
    """The newest row of a key counts; what is written follows the change; parts of like size are merged."""
    data, want, written = str(tmp_path), {}, []
    for k in range(9):
        new = {f"k{(k * 3 + i) % 20}": k for i in range(6 if k else 40)}
        want |= new
        before = {p.name for p in tmp_path.glob("citations/p-*")}
        Publication(spark, data).add("citations", spark.createDataFrame([(a, b, b, None) for a, b in new.items()], SCHEMA))
        pub = Publication(spark, data)
        assert {r.doi_key: r.c for r in pub.cache("citations", SCHEMA).collect()} == want
        sizes = [n for _, n in pub.parts("citations")]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
        written.append(sum(spark.read.parquet(str(p)).count() for p in tmp_path.glob("citations/p-*") if p.name not in before))
    assert min(written[1:]) <= 6 and len(sizes) < 6
    assert pub.cache("none", SCHEMA).count() == 0


def test_two_writers(spark, tmp_path):
    one, two = Publication(spark, str(tmp_path)), Publication(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1, 1, None)], SCHEMA)
    one.add("citations", rows)
    with pytest.raises(Conflict):
        two.add("citations", rows)
    assert Publication(spark, str(tmp_path)).cache("citations", SCHEMA).count() == 1


def test_old_caches_and_parts(spark, tmp_path):
    """Caches of the earlier form are read; parts that no recent commit names go."""
    spark.createDataFrame([("a", 1, 1, None), ("b", 2, 1, None)], SCHEMA).write.parquet(f"{tmp_path}/citations/v3")
    laid(spark, str(tmp_path), 2)
    for k in range(6):
        Publication(spark, str(tmp_path)).add("citations", spark.createDataFrame([("a", 10 + k, 2, None)], SCHEMA))
    pub = Publication(spark, str(tmp_path))
    pub.settle()
    assert {r.doi_key: r.c for r in pub.cache("citations", SCHEMA).collect()} == {"a": 15, "b": 2}
    assert len(list(tmp_path.glob("citations/p-*"))) <= 2 * publication.KEPT and len(list(tmp_path.glob("commits/*.json"))) == publication.KEPT


@pytest.mark.parametrize("cut", ["staging", "settling"])
def test_a_run_that_ends_between_the_writes(spark, tmp_path, monkeypatch, calls, cut):
    data = str(tmp_path / "data")
    laid(spark, data, 12, journals=2)
    plain, n = publish.write_papers, []

    def broken(papers, path):
        n.append(path)
        if (cut == "staging") == ("staged" in path):
            raise OSError("gone")
        plain(papers, path)

    monkeypatch.setattr(publish, "write_papers", broken)
    services = jobs.Services(GET, POST, pace=0.0)
    with pytest.raises(OSError):
        jobs.citation_sweep(spark, data, 100, Config(), services)
    asked = len(calls())
    monkeypatch.setattr(publish, "write_papers", plain)
    shown = {r.doi_key: r.cited_by for r in Publication(spark, data).papers().collect()}
    assert shown["10.1/5"] == (None if cut == "staging" else 10)
    assert spark.read.parquet(f"{data}/papers").where("cited_by is not null").count() == 0
    assert tuple(jobs.citation_sweep(spark, data, 100, Config(), services).first()) == (12, 0)
    assert len(calls()) == asked  # nothing that was answered is asked again
    cited = {r.doi_key: r.cited_by for r in spark.read.parquet(f"{data}/papers").collect()}
    assert cited["10.1/5"] == 10 and cited["10.1/12"] is None and len(cited) == 12
    assert not list((tmp_path / "data" / "staged").glob("*"))


def test_only_changed_journals_are_written(spark, tmp_path):
    data = str(tmp_path)
    laid(spark, data, 8, journals=2)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("papers/jkey=j1/*.parquet")}
    works = spark.createDataFrame([(1, json.dumps({"doi": "https://doi.org/10.1/2", "cited_by_count": 7}))], "ord long, body string")
    dumps = Dumps(works, spark.createDataFrame([], "doi_key string, c long"))
    assert tuple(jobs.citation_sweep(spark, data, 100, Config(), dumps).first()) == (8, 0)
    assert {p: p.stat().st_mtime_ns for p in tmp_path.glob("papers/jkey=j1/*.parquet")} == before
    assert {r.doi_key: r.cited_by for r in spark.read.parquet(f"{data}/papers").where("cited_by > 0").collect()} == {"10.1/2": 7}


def test_a_sweep_that_is_cut_off_goes_on(spark, tmp_path, monkeypatch, calls):
    """Units of one call each; the run ends in the third. Answered units are not asked again, the broken one is."""
    data, config = str(tmp_path), Config(citation_flush=1)
    laid(spark, data, 220)
    plain, units = refresh.concluded, []

    def broken(*args):
        units.append(1)
        if len(units) == 3:
            raise OSError("gone")
        return plain(*args)

    monkeypatch.setattr(refresh, "concluded", broken)
    services = jobs.Services(GET, POST, pace=0.0)
    with pytest.raises(Exception, match="gone"):
        jobs.citation_sweep(spark, data, 100, config, services)
    assert Publication(spark, data).cache("citations", jobs.CITATION_CACHE).count() == 100
    assert tuple(jobs.citation_sweep(spark, data, 100, config, services).first()) == (220, 0)
    asked = [u for u in calls() if u.startswith("https://works")]
    assert len(asked) == 6 and len(set(asked)) == 5  # five calls of fifty keys at most, one of them twice
    assert spark.read.parquet(f"{data}/papers").where("cited_by is not null").count() == sum(1 for k in range(1, 221) if k % 3 or k % 4)


def test_no_time_left_and_a_dead_service(spark, tmp_path, calls):
    data = str(tmp_path)
    laid(spark, data, 420)
    services = jobs.Services(GET, POST, pace=0.0)
    assert tuple(jobs.citation_sweep(spark, data, 100, Config(citation_seconds=0.0), services).first()) == (420, 420) and not calls()
    dead = jobs.Services("tests.test_jobs:failing", "tests.test_jobs:failing", pace=0.0)
    assert tuple(jobs.citation_sweep(spark, data, 100, Config(citation_flush=1), dead).first()) == (420, 420)
    # both legs are given up before the nine units are through
    assert len([u for u in calls() if u.startswith("https://works")]) < 9 * 6 and len([u for u in calls() if u.startswith("https://counts")]) < 9
    assert tuple(jobs.citation_sweep(spark, data, 100, Config(), services).first()) == (420, 0)


def test_leg_counts_failures_over_tasks(spark):
    leg = jobs.Leg(6)
    told = lambda rows: spark.createDataFrame(rows, "call long, done boolean").repartition(4)
    leg.tell(told([(0, True), (1, False), (2, False)]))
    assert leg.failures == 2 and leg.alive
    leg.tell(told([(3, False), (3, False), (4, False)]))
    assert leg.failures == 4
    leg.tell(told([(5, False), (6, True)]))
    assert leg.failures == 0
    leg.tell(told([(k, False) for k in range(7, 13)]))
    assert not leg.alive


def test_queue_goes_on_where_it_stopped(spark, tmp_path):
    folder, done = str(tmp_path), []
    requests = lambda: spark.range(0, 100).select(F.col("id").alias("key"), F.floor(F.col("id") / 5).alias("batch"))

    def work(most):
        def one(name, df, number):
            if len(done) >= most:
                return False
            done.append((name, number, sorted(r.key for r in df.collect())))
            return True

        return one

    assert not queue.drain(spark, folder, requests, 4, work(2))
    assert not queue.drain(spark, folder, lambda: requests().where("key < 0"), 4, work(4))
    assert queue.drain(spark, folder, lambda: requests().where("key < 10"), 4, work(99))
    assert [x[1] for x in done] == [0, 1, 2, 3, 4, 0] and len({x[0] for x in done}) == 2
    assert [k for x in done[:5] for k in x[2]] == list(range(100)) and done[5][2] == list(range(10))
    assert queue.drain(spark, folder, lambda: requests().where("key < 0"), 4, work(0))  # nothing to do


def test_corpus_against_corpus(spark):
    """The first match of each paper, against comparing every pair with the same rules."""
    rng = random.Random(9)
    stems = ["the order of things", "the order of things: a reply", "introduction", "an introduction to the theory of games", "Introduction", "théorie des jeux et des choses", ""]
    names = ["Ann Lee", "Bo Chen", "Cy Díaz", "Jo Lee", "A. Lee-Moe", "Kim Roe", ""]

    def corpus(n, kind):
        return [(f"{kind}{k}", k, rng.choice(stems) + rng.choice(["", "", " and more of it", " comment"]), rng.choice(["2001", "2010", "2012", "", None]), [rng.choice(names) for _ in range(rng.randint(0, 4))]) for k in range(n)]

    papers, works = corpus(60, "p"), corpus(120, "w")
    ddl = "id string, ord long, title string, year string, authors array<string>"
    left, right = spark.createDataFrame(papers, ddl), spark.createDataFrame(works, ddl)
    got = sorted(map(tuple, matching.match_corpora(left.drop("ord"), right).collect()))
    kind = matching.titles_match(matching.match_norm(F.col("l.title")), matching.match_norm(F.col("r.title")))
    every = left.alias("l").crossJoin(right.alias("r")).withColumn("kind", kind)
    ok = (F.col("kind") != "") & matching.enough_shared(matching.surnames(F.col("l.authors")), matching.surnames(F.col("r.authors"))) & matching.plausible_year(F.col("kind"), F.col("l.year").try_cast("int"), F.col("r.year").try_cast("int"))
    want = every.where(ok).groupBy("l.id").agg(F.min(F.struct("r.ord", "r.id", "kind")).alias("m")).select("id", "m.id", "m.kind")
    assert got == sorted(map(tuple, want.collect())) and len(got) > 10 and {r[2] for r in got} == {"exact", "prefix"}


def test_new_files_are_whole(spark, tmp_path):
    assert files.write_new(spark, f"{tmp_path}/a", "1") and not files.write_new(spark, f"{tmp_path}/a", "2")
    assert (tmp_path / "a").read_text() == "1" and files.names(spark, str(tmp_path)) == ["a"]


def test_caps_do_not_cut_what_a_dump_answers(spark, tmp_path):
    """Caps spare a service its calls; a dump answers whatever is due."""
    data, config = str(tmp_path), Config(citation_cap=3, search_cap=2)
    laid(spark, data, 12)
    record = lambda k, **more: (k, json.dumps({"doi": f"https://doi.org/10.1/{k}", "cited_by_count": k} | more))
    works = spark.createDataFrame([record(k) for k in range(1, 13)], "ord long, body string")
    dumps = Dumps(works, spark.createDataFrame([], "doi_key string, c long"), spark.createDataFrame([], "ord long, body string"))
    assert tuple(jobs.citation_sweep(spark, data, 100, config, dumps).first()) == (12, 0)
    assert spark.read.parquet(f"{data}/papers").where("cited_by > 0").count() == 12
    assert tuple(jobs.preprint_backfill(spark, data, config, dumps).first()) == (0, 0)  # every title was searched


def test_a_dump_is_parsed_once_for_its_titles(spark):
    """However often the matching reads the records, each body is parsed once."""
    parsed = spark.sparkContext.accumulator(0)

    @F.udf
    def told(x):
        parsed.add(1)
        return x

    hit = lambda k: json.dumps({"doi": f"https://doi.org/10.2139/ssrn.{k}", "title": f"The order of things number {k}", "publication_year": 2020, "authorships": [{"author": {"display_name": "Ann Lee"}}]})
    works = spark.createDataFrame([(k, hit(k)) for k in range(20)], "ord long, body string").withColumn("body", told.asNondeterministic()("body"))
    asked = spark.createDataFrame([(f"10.1/{k}", f"The order of things number {k}", "2021", ["Ann Lee"]) for k in range(10)], "doi_key string, title string, year string, authors array<string>")
    got = Dumps(works).titled(asked, "open").collect()
    assert {r.doi_key: [json.loads(h)["doi"] for h in r.hits] for r in got} == {f"10.1/{k}": [f"https://doi.org/10.2139/ssrn.{k}"] for k in range(10)}
    assert parsed.value == 20
