"""Paged and batched lookups. The transport is a function (url, timeout) -> (status, retry_after, body), so everything
runs offline in tests; on a cluster each (journal, ISSN) is one partition of the paged source."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Transport = Callable[[str, float], tuple[int, float, str]]


class LookupFailed(Exception):
    """A lookup that could not be answered; different from one that found nothing."""


def wait_seconds(attempt: int, retry_after: float = 0.0) -> float:
    """Pause before the next try: five seconds doubled each time up to a minute, or longer if the server says so."""
    return max(retry_after, min(5.0 * 2 ** (attempt - 1), 60.0))


def get_json(transport: Transport, url: str, tries: int = 6, timeout: float = 20.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """A GET that is repeated after 2, 4 ... 32 seconds whatever went wrong: an error of the transport, any status but
    200, a broken reply."""
    why: object = None
    for attempt in range(1, tries + 1):
        retry_after = 0.0
        try:
            status, retry_after, body = transport(url, timeout)
            if status == 200:
                return json.loads(body)
            why = status
        except Exception as e:  # noqa: BLE001 - transports raise what they like
            why = e
        if attempt < tries:
            sleep(max(retry_after, 2.0**attempt))
    raise LookupFailed(f"{url}: {why}")


def get_once(transport: Transport, url: str, timeout: float = 20.0) -> dict:
    """One GET: {ok, status, retry_after, body}; status 0 where there was no reply or a broken one."""
    try:
        status, retry_after, body = transport(url, timeout)
        return {"ok": status == 200, "status": status, "retry_after": retry_after, "body": json.loads(body) if status == 200 else None}
    except Exception:  # noqa: BLE001
        return {"ok": False, "status": 0, "retry_after": 0.0, "body": None}


def post_batch(transport: Callable[[str, float, str], tuple[int, float, str]], url: str, ids: Sequence[str], sleep: Callable[[float], None] = time.sleep) -> list | None:
    """One POST of {"ids": [...]} with a positional reply; throttling is waited out once (5 to 30 seconds). None: failed."""
    payload = json.dumps({"ids": list(ids)}, separators=(",", ":"))
    for attempt in range(2):
        try:
            status, retry_after, body = transport(url, 30.0, payload)
            if status == 200:
                reply = json.loads(body)
                return reply if isinstance(reply, list) else None
        except Exception:  # noqa: BLE001
            return None
        if status != 429 or attempt:
            return None
        sleep(min(max(retry_after, 5.0), 30.0))
    return None


def pages(transport: Transport, base: str, filters: str, select: str, mailto: str = "", rows: int = 1000, sleep: Callable[[float], None] = time.sleep) -> Iterator[list[dict]]:
    """Pages of a cursor-paged API until an empty one."""
    cursor = "*"
    while cursor:
        url = f"{base}?filter={quote(filters, safe='')}&select={quote(select, safe='')}&rows={rows}&cursor={quote(cursor, safe='')}" + (f"&mailto={quote(mailto, safe='')}" if mailto else "")
        message = get_json(transport, url, sleep=sleep).get("message") or {}
        items = message.get("items") or []
        if not items:
            return
        yield items
        cursor = message.get("next-cursor")
        sleep(0.12)


def journal_items(fetch: Callable[[str], list[dict]], issns: Sequence[str]) -> list[tuple[int, dict]]:
    """Items of all ISSNs with the ISSN's place; the first ISSN must succeed, later ones may fail."""
    out = []
    for k, issn in enumerate(issns):
        try:
            out += [(k, item) for item in fetch(issn)]
        except LookupFailed:
            if k == 0:
                raise
    return out


def key_batches(keys: Sequence[str], size: int = 50) -> Iterator[str]:
    """Filter values "doi:a|b|c" for `size` keys each."""
    for a in range(0, len(keys), size):
        yield "doi:" + "|".join(keys[a : a + size])


@dataclass
class Breaker:
    """Stops a leg after `most` failures in a row."""

    most: int = 6
    failures: int = 0

    def record(self, ok: bool) -> bool:
        self.failures = 0 if ok else self.failures + 1
        return self.failures < self.most


@dataclass
class Budget:
    """A cap on items and a deadline; what is left over is taken up by the next run."""

    cap: int
    seconds: float
    clock: Callable[[], float] = time.monotonic

    def __post_init__(self) -> None:
        self.started, self.used = self.clock(), 0

    def take(self) -> bool:
        if self.used >= self.cap or self.clock() - self.started >= self.seconds:
            return False
        self.used += 1
        return True


def search_all(keys: Sequence[str], engines: Sequence[Callable[[str], dict | None]], budget: Budget, breaker: Breaker, checkpoint: Callable[[list], None] = lambda _: None, every: int = 200) -> list[tuple[str, dict | None]]:
    """Searches key by key; later engines only if earlier ones found nothing. A failure leaves the key without a
    result (not a miss). Results are handed to `checkpoint` every `every` keys."""
    done: list[tuple[str, dict | None]] = []
    for key in keys:
        if not budget.take():
            break
        found, failed = None, False
        for engine in engines:
            try:
                found = engine(key)
            except LookupFailed:
                failed = True
                break
            if found:
                break
        if not failed:
            done.append((key, found))
            if len(done) % every == 0:
                checkpoint(done)
        if not breaker.record(not failed):
            break
    checkpoint(done)
    return done


@dataclass
class Slice(InputPartition):
    jkey: str
    issn_ord: int
    issn: str


class WorksSource(DataSource):
    """spark.read.format("quire_works"): raw items (jkey, issn_ord, page_ord, item_ord, body) of each journal's ISSNs.

    Options: plan (JSON list of [jkey, issn_ord, issn]), transport ("module:function"), base, mailto.
    """

    @classmethod
    def name(cls) -> str:
        return "quire_works"

    def schema(self) -> str:
        return "jkey string, issn_ord int, page_ord int, item_ord int, body string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return WorksReader(self.options)


#: Fields of a work that the build reads.
FIELDS = (
    "DOI,type,title,author,volume,issue,page,abstract,issued,published-print,published-online,created,group-title,subject,assertion,is-referenced-by-count"
)


def loaded(name: str) -> Callable:
    """The function that "module:function" names, imported where it is needed."""
    import importlib

    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def paced(factor: float) -> Callable[[float], None]:
    return lambda seconds: time.sleep(seconds * factor)


class WorksReader(DataSourceReader):
    """Pauses and repeats as get_json() and pages() do; the option `pace` scales the waits (0 in tests)."""

    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[Slice]:
        return [Slice(*x) for x in json.loads(self.options["plan"])]

    def read(self, partition: Slice) -> Iterator[tuple]:
        o = self.options
        sleep = paced(float(o.get("pace", "1")))
        found = pages(loaded(o["transport"]), o.get("base", ""), f"issn:{partition.issn},type:journal-article", o.get("select", FIELDS), o.get("mailto", ""), sleep=sleep)
        try:
            for p, items in enumerate(found):
                for i, item in enumerate(items):
                    yield partition.jkey, partition.issn_ord, p, i, json.dumps(item)
        except LookupFailed:
            if partition.issn_ord == 0:
                raise
