"""An API that answers from the requests themselves: the transports of the tests.

Keys are 10.1/<n>. Which keys are known, their counts, links and titles follow from n, so every reply can be foretold.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

PAGE, PAGES = 3, 2  # items on a page of a pull, and pages before the empty one


def number(key: str) -> int:
    return int(key.rsplit("/", 1)[1])


def record(n: int) -> dict:
    """By key: a link for odd n (of two addresses the better one comes second), a count of n."""
    places = [{"landing_page_url": f"https://papers.ssrn.com/x?id={n}", "pdf_url": f"https://arxiv.org/pdf/{n}v2.pdf"}] if n % 2 else []
    return {"doi": f"https://doi.org/10.1/{n}", "cited_by_count": n, "locations": places}


def hits(n: int) -> list[dict]:
    """By title "paper <n> ...": a hit by other people first, then the match where n is divisible by 3."""
    own = f"Paper {n} on the order of things"
    who = [{"author": {"display_name": f"Ann L. Lee{'abc'[n % 3]}"}}]
    other = {"doi": None, "title": own, "publication_year": 2020, "authorships": [{"author": {"display_name": "Zoe Quux"}}], "locations": [{"landing_page_url": "https://arxiv.org/abs/1"}]}
    match = {"doi": f"10.2139/ssrn.{n}", "title": own.upper(), "publication_year": 2019, "authorships": who, "locations": []}
    return [other, match] if n % 3 == 0 else [other]


def works(n: int) -> list[dict]:
    """By the registry's search: a match where n is divisible by 5, but ten years too late where by 10."""
    year = 2035 if n % 10 == 0 else 2020
    return [{"DOI": f"10.2139/ssrn.{n}", "title": [f"Paper {n} on the order of things"], "author": [{"given": "Ann", "family": f"Lee{'abc'[n % 3]}"}], "issued": {"date-parts": [[year]]}}] if n % 5 == 0 else []


def get(url: str, timeout: float) -> tuple[int, float, str]:
    """Keys, titles, pulls by ISSN (one that begins with 9 fails) and the registry of journals."""
    plain = unquote(url)
    if m := re.search(r"filter=doi:([^&]*)", plain):
        found = [record(number(k)) for k in m[1].split("|") if number(k) % 3]
        return 200, 0.0, json.dumps({"results": found})
    if m := re.search(r"title\.search:paper (\d+)", plain, re.IGNORECASE):
        return 200, 0.0, json.dumps({"results": hits(int(m[1]))})
    if m := re.search(r"query\.bibliographic=paper (\d+)", plain, re.IGNORECASE):
        return 200, 0.0, json.dumps({"message": {"items": works(int(m[1]))}})
    if m := re.search(r"filter=issn:([^,]*).*cursor=(.*?)(?:&|$)", plain):
        if m[1].startswith("9"):
            return 404, 0.0, ""
        page = 0 if m[2] == "*" else int(m[2])
        items = [{"DOI": f"10.1/{m[1]}-{page}-{i}", "type": "journal-article", "title": [f"{m[1]} {page} {i}"]} for i in range(PAGE)] if page < PAGES else []
        return 200, 0.0, json.dumps({"message": {"items": items, "next-cursor": str(page + 1)}})
    if m := re.search(r"/journals/(\d+)", plain):
        return (404, 0.0, "") if int(m[1]) % 4 == 0 else (200, 0.0, json.dumps({"message": {"title": f"The Journal {m[1]}"}}))
    return 404, 0.0, ""


def post(url: str, timeout: float, payload: str) -> tuple[int, float, str]:
    """Counts by key, in order; none where n is divisible by 4."""
    counts = [None if number(k) % 4 == 0 else {"citationCount": 2 * number(k)} for k in json.loads(payload)["ids"]]
    return 200, 0.0, json.dumps(counts)
