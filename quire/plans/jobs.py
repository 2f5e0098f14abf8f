"""The refresh jobs end to end: read the published papers and the cache, look up what is due, apply, publish.

A data folder is a Publication: papers as publish.write_papers() writes them, and caches in parts. What is due goes through
a queue in units; the rows of each unit are committed before the next is asked for, so a run that is cut off, or whose
time is up, loses nothing that was answered and the next one goes on behind it. The time given is that of the whole job,
and a service that has failed several calls in a row, in whichever tasks, is asked no more in this run. `merge` overlays a
cache saved by another run first; `apply_only` looks nothing up.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import Config
from quire.functions.schemas import SEARCH_HIT, WORK_HIT
from quire.operators import matching, rows
from quire.plans import publish, refresh
from quire.plans.publication import Publication
from quire.sources import lookups
from quire.sources.dumps import Dumps
from quire.sources.shared import written
from quire.streaming import queue

CITATION_CACHE = "doi_key string, c long, t int, s2 boolean"
PREPRINT_CACHE = "doi_key string, url string, src string, none boolean, ts int"


@dataclass(frozen=True)
class Services:
    """Transports ("module:function") and addresses; `pace` scales all waits, `streams` is the calls at a time."""

    get: str
    post: str
    works: str = "https://works"
    registry: str = "https://registry/works"
    counts: str = "https://counts/batch"
    streams: int = 1
    pace: float = 1.0
    mailto: str = ""

    def keyed(self, requests: DataFrame, select: str, seconds: float) -> DataFrame:
        return lookups.by_key(requests, self.get, self.works, select, self.mailto, self.streams, self.pace, seconds)

    def counted(self, requests: DataFrame, seconds: float) -> DataFrame:
        return lookups.counts_by_post(due_batches(requests.select("doi_key"), 500), self.post, self.counts, self.streams, self.pace, seconds)

    def titled(self, requests: DataFrame, engine: str, seconds: float) -> DataFrame:
        base = self.works if engine == "open" else self.registry
        return lookups.by_title(requests.withColumn("batch", F.pmod(F.xxhash64("doi_key"), F.lit(1 << 20))), engine, self.get, base, self.mailto, self.streams, self.pace, seconds)

    def named(self, journals: DataFrame) -> DataFrame:
        return lookups.registered_titles(journals, self.get, "https://registry/journals", self.mailto, self.streams, self.pace)


@dataclass
class Leg:
    """One service in one run: it is given up after `most` failed calls in a row, whichever tasks made them."""

    most: int
    failures: int = 0

    @property
    def alive(self) -> bool:
        return self.failures < self.most

    def tell(self, calls: DataFrame) -> None:
        """calls: (call, done) of a unit, in the order of `call`."""
        last = calls.agg(F.max(F.when(F.col("done"), F.col("call"))).alias("last")).first()["last"]
        after = calls.where(~F.col("done")) if last is None else calls.where(~F.col("done") & (F.col("call") > last))
        failed = after.select("call").distinct().count()
        self.failures = failed + (self.failures if last is None else 0)


@dataclass
class Clock:
    """The time of a whole job."""

    seconds: float
    now: Callable[[], float] = time.time
    begun: float = field(init=False)

    def __post_init__(self) -> None:
        self.begun = self.now()

    @property
    def left(self) -> float:
        return self.begun + self.seconds - self.now()


def due_batches(requests: DataFrame, size: int) -> DataFrame:
    return written(rows.numbered_batches(requests, ["doi_key"], size))


def spared(config: Config, services: Services | Dumps) -> Config:
    """The settings without the caps where a dump answers: those spare the services calls, and a dump has none."""
    return replace(config, citation_cap=None, search_cap=None) if isinstance(services, Dumps) else config


def drained(spark: SparkSession, pub: Publication, name: str, requests: Callable[[], DataFrame], unit: int, services: Services | Dumps, work: Callable[[DataFrame], DataFrame | None], cache: str) -> None:
    """Each unit's rows go into the cache as soon as it has them; work() returns None to end the run before a unit. A dump
    answers all at once."""
    if isinstance(services, Dumps):
        found = work(written(requests()))
        if found is not None:
            pub.add(cache, found)
        return

    def one(queue_name: str, asked: DataFrame, number: int) -> bool:
        if pub.answered(f"{name}/{queue_name}", number):
            return True
        found = work(written(asked))
        if found is not None:
            pub.add(cache, found, f"{name}/{queue_name}", number)
        return found is not None

    queue.drain(spark, f"{pub.data}/queues/{name}", requests, unit, one)


def citation_sweep(spark: SparkSession, data: str, today: int, config: Config, services: Services | Dumps, apply_only: bool = False, merge: DataFrame | None = None) -> DataFrame:
    """Counts from two services into the cache and the papers. Returns one row: different keys, and those still stale."""
    config = spared(config, services)
    pub = Publication(spark, data)
    pub.settle()
    papers = written(pub.papers())
    if merge is not None:
        own = pub.cache("citations", CITATION_CACHE).join(merge.select("doi_key"), "doi_key", "left_semi")
        pub.add("citations", rows.merge_recency(own, merge, "doi_key", "t", "c"))
    if not apply_only:
        clock, first, second = Clock(config.citation_seconds), Leg(6), Leg(4)
        nothing = spark.createDataFrame([], "doi_key string, c long, done boolean")

        def requests() -> DataFrame:
            return due_batches(refresh.citation_requests(papers, pub.cache("citations", CITATION_CACHE), today, config), 50)

        def counts(asked: DataFrame) -> DataFrame | None:
            if clock.left <= 0 or not (first.alive or second.alive):
                return None
            a = b = nothing
            if first.alive:
                by_key = written(services.keyed(asked, "doi,cited_by_count", clock.left))
                first.tell(by_key.select(F.col("batch").alias("call"), "done"))
                a = by_key.select("doi_key", F.get_json_object("body", "$.cited_by_count").cast("long").alias("c"), "done")
            if second.alive:
                b = written(services.counted(asked, clock.left))
                second.tell(b.select(F.col("doi_key").alias("call"), "done"))
            return refresh.concluded(asked.select("doi_key"), a, b, pub.cache("citations", CITATION_CACHE), today)

        drained(spark, pub, "citations", requests, config.citation_flush, services, counts, "citations")
    cache = written(pub.cache("citations", CITATION_CACHE))
    before = papers.withColumn("_before", F.struct("cited_by", "cited_src"))
    done = written(refresh.apply_citations(before, cache))
    pub.publish(done.drop("_before"), done.where(~F.struct("cited_by", "cited_src").eqNullSafe(F.col("_before"))).select("jkey"))
    return refresh.stale(papers, cache, today, config)


def preprint_backfill(spark: SparkSession, data: str, config: Config, services: Services | Dumps, apply_only: bool = False, merge: DataFrame | None = None) -> DataFrame:
    """Links by key for new papers, by title for those without one, into the cache and the papers. Returns one row:
    papers with a link and papers still to search."""
    config = spared(config, services)
    pub = Publication(spark, data)
    pub.settle()
    papers = written(pub.papers())
    if merge is not None:
        own = pub.cache("preprints", PREPRINT_CACHE).join(merge.select("doi_key"), "doi_key", "left_semi")
        pub.add("preprints", rows.merge_found_wins(own, merge, "doi_key", "url"))
    if not apply_only:
        clock, keys, first, second = Clock(config.search_seconds), Leg(6), Leg(6), Leg(6)

        def links(asked: DataFrame) -> DataFrame | None:
            if clock.left <= 0 or not keys.alive:
                return None
            replies = written(services.keyed(asked, "doi,open_access,best_oa_location,locations", clock.left))
            keys.tell(replies.select(F.col("batch").alias("call"), "done"))
            found = replies.where("body is not null").select("doi_key", F.from_json("body", SEARCH_HIT).alias("hit"))
            return refresh.found_by_doi(asked, found, replies.where("done").select("batch").distinct())

        def searches() -> DataFrame:
            due = refresh.title_requests(papers, pub.cache("preprints", PREPRINT_CACHE), config)
            return due_batches(due.select("doi_key", "title", "year", "authors", "query"), 1)

        def titles(due: DataFrame) -> DataFrame | None:
            if clock.left <= 0 or not (first.alive and second.alive):
                return None
            told = written(services.titled(due, "open", clock.left))
            first.tell(told.select(F.col("doi_key").alias("call"), "done"))
            hits = told.select("doi_key", F.posexplode("hits").alias("ord", "h")).select("doi_key", "ord", F.from_json("h", SEARCH_HIT).alias("hit"))
            matched = matching.match_hits(due, hits).select("doi_key")
            rest = written(due.join(matched.unionByName(told.where("not done").select("doi_key")), "doi_key", "left_anti"))
            more = written(services.titled(rest, "registry", clock.left))
            second.tell(more.select(F.col("doi_key").alias("call"), "done"))
            works = more.select("doi_key", F.posexplode("hits").alias("ord", "h")).select("doi_key", "ord", F.from_json("h", WORK_HIT).alias("hit"))
            failed = told.where("not done").select("doi_key").unionByName(more.where("not done").select("doi_key"))
            return refresh.found_by_title(due, hits, works, failed, config)

        drained(spark, pub, "links", lambda: written(refresh.preprint_requests(papers, pub.cache("preprints", PREPRINT_CACHE))), config.citation_flush, services, links, "preprints")
        drained(spark, pub, "titles", searches, config.search_flush, services, titles, "preprints")
    cache = written(pub.cache("preprints", PREPRINT_CACHE))
    before = papers.withColumn("_before", F.struct("preprint", "preprint_src"))
    done = written(refresh.apply_preprints(before, cache))
    pub.publish(done.drop("_before"), done.where(~F.struct("preprint", "preprint_src").eqNullSafe(F.col("_before"))).select("jkey"))
    linked, backlog = done.where("preprint is not null").count(), refresh.title_requests(papers, cache, config).count()
    return spark.createDataFrame([(linked, backlog)], "linked long, backlog long")


def issn_check(journals: DataFrame, services: Services | Dumps, config: Config) -> DataFrame:
    """key, name, issn, title, ok, warning of active journals by the registry's title for their first ISSN; warnings only."""
    active = journals.where(~F.coalesce("retired", F.lit(False)))
    told = written(services.named(active))
    checked = publish.unconfirmed_titles(active, told.select("key", "title")).join(told.select("key", "issn", "warning"), "key", "left")
    why = F.when(F.col("warning").isNotNull(), F.col("warning")).when(~F.col("ok"), F.lit("title mismatch"))
    return checked.select("key", "name", "issn", "title", (F.col("ok") & F.col("warning").isNull()).alias("ok"), why.alias("warning"))
