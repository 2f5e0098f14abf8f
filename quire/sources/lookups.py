"""Lookups by key and by title as DataFrames: requests in, replies out, a batch of requests a call.

A lookup is two steps. The calls turn requests into replies (batch, done, body) in tasks; reading a reply is Spark's:
records(), slots(), hits() and titles() turn replies, from calls or from a table of replies kept from an earlier run, into
rows. Transports are named "module:function" and imported by the tasks. Requests are dealt to `streams` tasks, so that
many calls run side by side at most; each task paces itself and stops after several failures in a row, or when the time
that the job was given is up. A request that was not answered comes back with done = false, which is not the same as
an answer without a result.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.http import Breaker, get_once, loaded, paced, post_batch, wait_seconds
from quire.sources.shared import written

PAUSE = 0.4  # seconds between calls of one task
REPLY = "batch long, done boolean, body string"
QUOTA = 3600.0  # a server that asks for a longer wait has spent the day's quota


def in_batches(requests: DataFrame, streams: int) -> DataFrame:
    return requests.repartition(streams, "batch").sortWithinPartitions("batch")


def stopped(breaker: Breaker, end: float) -> bool:
    """Whether a task calls no more: too many failures in a row, or its time is up. The rest is left to the next run."""
    return breaker.failures >= breaker.most or time.time() > end


def asked(call, breaker: Breaker, sleep) -> dict | None:  # noqa: ANN001
    """The reply's body; throttling and errors are waited out while the breaker holds. None: not answered."""
    while True:
        reply = call()
        if reply["ok"]:
            breaker.record(True)
            return reply["body"]
        throttled = reply["status"] in (403, 429)
        alive = breaker.record(False)
        if not alive or (throttled and reply["retry_after"] > QUOTA):
            breaker.failures = breaker.most
            return None
        sleep(wait_seconds(breaker.failures, reply["retry_after"]) if throttled else 2.0)


def get_calls(requests: DataFrame, transport: str, streams: int = 1, pace: float = 1.0, seconds: float = math.inf) -> DataFrame:
    """requests (batch, url) -> replies (batch, done, body): a GET each; a request without an address is answered, with nothing."""
    end = time.time() + seconds

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send, sleep, breaker = loaded(transport), paced(pace), Breaker(6)
        for frame in frames:
            bodies: list[str | None] = []
            for url in frame["url"].tolist():
                if not url:
                    bodies.append("{}")
                    continue
                body = None if stopped(breaker, end) else asked(lambda u=url: get_once(send, u), breaker, sleep)
                bodies.append(None if body is None else json.dumps(body))
                sleep(PAUSE)
            yield pd.DataFrame({"batch": frame["batch"], "done": [b is not None for b in bodies], "body": bodies})

    return in_batches(requests.select("batch", "url"), streams).mapInPandas(run, REPLY)


def post_calls(requests: DataFrame, transport: str, url: str, streams: int = 1, pace: float = 1.0, seconds: float = math.inf) -> DataFrame:
    """requests (batch, ids array<string>) -> replies (batch, done, body): a POST each."""
    end = time.time() + seconds

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send, sleep, breaker = loaded(transport), paced(pace), Breaker(4)
        for frame in frames:
            replies = []
            for ids in frame["ids"].tolist():
                replies.append(post_batch(send, url, list(ids), sleep) if not stopped(breaker, end) else None)
                breaker.record(replies[-1] is not None)
            yield pd.DataFrame({"batch": frame["batch"], "done": [r is not None for r in replies], "body": [None if r is None else json.dumps(r) for r in replies]})

    return in_batches(requests.select("batch", "ids"), streams).mapInPandas(run, REPLY)


def batched_keys(requests: DataFrame) -> DataFrame:
    """(batch, keys): the keys of each batch in order. A batch is one call, so it is small."""
    return requests.groupBy("batch").agg(F.array_sort(F.collect_list("doi_key")).alias("keys"))


def records(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """(batch, doi_key, done, body) for requests (batch, doi_key): the record of each key (JSON), null where the reply has none."""
    bare = F.regexp_replace(F.lower(F.get_json_object("r", "$.doi")), "^https?://doi\\.org/", "")
    listed = replies.where("done").select("batch", F.posexplode(F.from_json("body", "results array<string>")["results"]).alias("i", "r"))
    # of several records of a key the last one counts
    found = listed.select("batch", "i", bare.alias("doi_key"), "r").groupBy("batch", "doi_key").agg(F.max_by("r", "i").alias("body"))
    done = replies.select("batch", "done").distinct()
    joined = requests.select("batch", "doi_key").join(done, "batch", "left").join(found, ["batch", "doi_key"], "left")
    return joined.select("batch", "doi_key", F.coalesce("done", F.lit(False)).alias("done"), "body")


def slots(batches: DataFrame, replies: DataFrame) -> DataFrame:
    """(doi_key, c, done) for batches (batch, keys) and positional replies, a slot a key: the count, null where there is
    none or it is no whole number."""
    counts = F.transform(F.from_json("body", "array<string>"), lambda x: F.get_json_object(x, "$.citationCount"))
    whole = F.transform(counts, lambda c: F.when(c.rlike("^-?[0-9]+$"), c.try_cast("long")))
    joined = batches.join(replies, "batch", "left").withColumn("v", F.coalesce(whole, F.array().cast("array<bigint>")))
    each = joined.select(F.coalesce("done", F.lit(False)).alias("done"), F.posexplode("keys").alias("i", "doi_key"), "v").where("doi_key is not null")
    return each.select("doi_key", F.get("v", F.col("i")).alias("c"), "done")


#: The two title searches: how the address goes on after its base, and where the hits are in the reply (fixed values of
#: the two services).
ENGINES = {
    "open": ("filter=title.search:{q}&per-page=25&select=doi,title,publication_year,authorships,best_oa_location,primary_location,locations", "results array<string>", "results"),
    "registry": ("query.bibliographic={q}&filter=prefix:10.2139&rows=8&select=DOI,title,author,issued", "message struct<items: array<string>>", "message.items"),
}


def hits(requests: DataFrame, replies: DataFrame, engine: str) -> DataFrame:
    """(doi_key, done, hits array<string>) for requests (call, doi_key) and replies by call."""
    _, schema, path = ENGINES[engine]
    told = replies.select(F.col("batch").alias("call"), "done", F.from_json("body", schema).alias("b")).select("call", "done", F.col(f"b.{path}").alias("hits"))
    joined = requests.select("call", "doi_key").join(told, "call", "left")
    return joined.select("doi_key", F.coalesce("done", F.lit(False)).alias("done"), F.coalesce("hits", F.array().cast("array<string>")).alias("hits"))


def titles(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """(key, issn, title, warning) for requests (call, key, issn) and replies (batch, status, body)."""
    told = replies.select(F.col("batch").alias("call"), "status", F.coalesce(F.get_json_object("body", "$.message.title"), F.lit("")).alias("t"))
    joined = requests.join(told, "call", "left")
    ok = F.col("status") == 200
    missing = F.concat(F.lit("no journal for ISSN "), "issn", F.lit(" (HTTP "), F.coalesce("status", F.lit(0)).cast("string"), F.lit(")"))
    none = F.coalesce("issn", F.lit("")) == ""
    return joined.select("key", F.when(~none, F.col("issn")).alias("issn"), F.when(~none & ok, F.col("t")).alias("title"), F.when(none, F.lit("no ISSN")).when(~F.coalesce(ok, F.lit(False)), missing).alias("warning"))


def encoded(text) -> Column:  # noqa: ANN001
    """Text as it stands in an address."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def mailed(mailto: str, first: str = "&") -> str:
    return f"{first}mailto={quote(mailto, safe='')}" if mailto else ""


def by_key(requests: DataFrame, transport: str, base: str, select: str, mailto: str = "", streams: int = 1, pace: float = 1.0, seconds: float = math.inf) -> DataFrame:
    """requests (batch, doi_key) -> (batch, doi_key, done, body): one GET a batch; body is the record found (JSON) or null."""
    address = F.concat(F.lit(f"{base}?filter=doi:"), F.array_join("keys", "|"), F.lit("&per-page="), F.size("keys").cast("string"), F.lit(f"&select={select}{mailed(mailto)}"))
    return records(requests, written(get_calls(batched_keys(requests).withColumn("url", address), transport, streams, pace, seconds)))


def counts_by_post(requests: DataFrame, transport: str, url: str, streams: int = 1, pace: float = 1.0, seconds: float = math.inf) -> DataFrame:
    """requests (batch, doi_key) -> (doi_key, c, done): one POST a batch, the reply in the order of the request."""
    batches = written(batched_keys(requests))
    ids = batches.withColumn("ids", F.transform("keys", lambda k: F.concat(F.lit("DOI:"), k)))
    return slots(batches, written(post_calls(ids, transport, url, streams, pace, seconds)))


def by_title(requests: DataFrame, engine: str, transport: str, base: str, mailto: str = "", streams: int = 1, pace: float = 1.0, seconds: float = math.inf) -> DataFrame:
    """requests (batch, doi_key, query) -> (doi_key, done, hits array<string>): one GET a request with a query."""
    tail = ENGINES[engine][0]
    before, after = tail.split("{q}")
    calls = written(requests.select("doi_key", "query").withColumn("call", F.monotonically_increasing_id()))
    address = F.when(F.coalesce("query", F.lit("")) != "", F.concat(F.lit(f"{base}?{before}"), encoded(F.col("query")), F.lit(after + mailed(mailto))))
    return hits(calls, written(get_calls(calls.select(F.col("call").alias("batch"), address.alias("url")), transport, streams, pace, seconds)), engine)


def registered_titles(journals: DataFrame, transport: str, base: str, mailto: str = "", streams: int = 1, pace: float = 1.0) -> DataFrame:
    """journals (key, issns) -> (key, issn, title, warning): the registry's title for each journal's first ISSN."""
    calls = written(journals.select("key", F.try_element_at("issns", F.lit(1)).alias("issn")).withColumn("call", F.monotonically_increasing_id()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send, sleep = loaded(transport), paced(pace)
        for frame in frames:
            out = []
            for call, issn in zip(frame["batch"], frame["issn"], strict=True):
                reply = get_once(send, f"{base}/{issn}{mailed(mailto, '?')}")
                out.append((call, reply["status"] if not reply["ok"] else 200, json.dumps(reply["body"])))
                sleep(0.25)
            yield pd.DataFrame(out, columns=["batch", "status", "body"])

    wanted = calls.where(F.coalesce("issn", F.lit("")) != "").select(F.col("call").alias("batch"), "issn")
    return titles(calls, written(in_batches(wanted, streams).mapInPandas(run, "batch long, status int, body string")))
